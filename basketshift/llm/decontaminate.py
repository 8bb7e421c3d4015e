"""Benchmark items in documents, by edit distance over words.

A window of a text and an item that differ by few insertions, deletions and replacements become strings of small Hamming
distance under the CGK embedding: a walk over the words that, at each step, writes down the current word
and moves on or stays, as a random function of step and word says. Two walks that an edit has parted tend to meet again.
Sampled places of the embedded strings are the keys of a locality-sensitive index. It holds every item from several of its
first words on, so that walks also meet where an item has lost its beginning. Walks and samples are repeated until
simulated copies at the allowed distance are found at the target recall, for each kind of edit by itself; copies without edits are
always found. Where that takes too many repeats, as for long items, all windows that pass the lossless word filters are candidates
instead. Every hit is confirmed by the exact edit distance.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketshift.llm.common import map_rows, parts_for, prepare, text_of

GOLDEN, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class EditParams:
    # Edits allowed, as a share of an item's words.
    share: float = 0.15
    # Items whose lengths differ by no more than this factor share windows, of the shortest one's size.
    class_ratio: float = 1.15
    # Steps of a walk, in window sizes; places sampled for a key.
    stretch: int = 3
    places: int = 3
    # Windows of an item in the index: from its first word on, and from others up to the edits allowed.
    anchors: int = 5
    # Share of simulated items, edited at the allowed distance, that must be hit for each kind of edit, and simulations per kind and class.
    recall: float = 0.95
    simulations: int = 400
    most_repeats: int = 96
    # How often that many repeats are added for a class that has not reached the recall, before it is checked exactly.
    rounds: int = 4
    # Items that one pass over the texts holds in its index; more items take more passes.
    items_per_pass: int = 20_000
    seed: int = 7


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def embed(windows: np.ndarray, steps: int, seed: int) -> np.ndarray:
    """The CGK embedding of each row of word numbers: ``steps`` words each, 0 once a walk is past the end."""
    every = np.arange(steps)[None, :]
    return sampled(windows, np.array([seed]), every)[0]


def sampled(windows: np.ndarray, seeds: np.ndarray, places: np.ndarray, block: int = 512) -> np.ndarray:
    """The words at the ``places`` (a sorted row per seed) of each window's embeddings: seeds x windows x places.

    At each step a walk moves on if a random function of seed, step and word says so. A seed's walks end at its last place, so seeds
    are taken in the order of these, and those that have ended are left out. Blocks of windows stay in the processor's cache.
    """
    n, size = windows.shape
    order = np.argsort(-places[:, -1], kind="stable")
    steps = int(places.max()) + 1
    walking = np.searchsorted(-places[order, -1], -np.arange(steps), "right")
    wanted: list[list[tuple[int, int]]] = [[] for _ in range(steps)]
    for row, seed in enumerate(order):
        for i, place in enumerate(places[seed]):
            wanted[place].append((row, i))
    found = np.zeros((len(seeds), n, places.shape[1]), dtype=windows.dtype)
    with np.errstate(over="ignore"):
        salts = ((np.asarray(seeds, dtype=np.uint64)[order, None] << np.uint64(20)) + np.arange(1, steps + 1, dtype=np.uint64)) * GOLDEN
        for begin in range(0, n, block):
            own = windows[begin:begin + block]
            # A walk never gets farther than one word a step, so it stays inside its row.
            width = max(size, steps) + 1
            words = np.zeros((len(own), width), dtype=np.uint64)
            words[:, :size] = own
            words = words.ravel()
            at = np.repeat(np.arange(len(own))[None, :] * width, len(seeds), axis=0)
            for step in range(steps):
                here = at[:walking[step]]
                word = words.take(here)
                for row, i in wanted[step]:
                    found[order[row], begin:begin + block, i] = word[row]
                word += salts[:walking[step], step, None]
                word *= MIX
                word >>= np.uint64(61)
                word &= np.uint64(1)
                here += word.view(np.int64)
    return found


def edit_distance_within(item: Sequence[int], text: Sequence[int], most: int) -> tuple[int, int] | None:
    """(distance, end) of the beginning of ``text`` that is nearest to ``item``, the shorter one if equal; None if
    it is farther than ``most``. Exact, by a band of the usual table. Number 0 equals nothing."""
    far = most + 1
    row = [min(j, far) for j in range(len(text) + 1)]
    for i, x in enumerate(item, 1):
        low, high = max(1, i - most), min(len(text), i + most)
        if low > high + 1:
            return None
        new = [far] * (len(text) + 1)
        if i <= most:
            new[0] = i
        for j in range(low, high + 1):
            new[j] = min(row[j - 1] + (x != text[j - 1] or x == 0), row[j] + 1, new[j - 1] + 1, far)
        if min(new[low - 1:high + 1]) >= far:
            return None
        row = new
    best = min(row)
    return (best, row.index(best)) if best <= most else None


def edited(words: list[int], edits: int, rng: random.Random, foreign: int) -> list[int]:
    """``words`` after random replacements by a foreign word, deletions and insertions."""
    out = list(words)
    for _ in range(edits):
        kind, at = rng.randrange(3), rng.randrange(len(out)) if out else 0
        if kind == 0 and out:
            out[at] = foreign
        elif kind == 1 and len(out) > 1:
            del out[at]
        else:
            out.insert(at, foreign)
    return out


def copies_of(words: list[int], edits: int, kind: str, rng: random.Random, foreign: int) -> list[list[int]]:
    """The windows, up to their ends, that hold ``words`` after so many edits of a kind and are within that distance of it."""
    if kind == "scattered":
        return [edited(words, edits, rng, foreign)]
    if kind == "head":
        return [words[edits:]]
    if kind == "tail":
        return [words[:len(words) - edits]]
    at = rng.randrange(len(words) - edits + 1)
    if kind == "gap":
        return [words[:at] + words[at + edits:]]
    inside = words[:at] + [foreign] * edits + words[at:]
    return [inside, words[at:]] if at <= edits else [inside]


# Edits anywhere; the first or last words lost; words in a row lost or put in.
KINDS = ("scattered", "head", "tail", "gap", "block")

# Numbers that no word has: what follows a simulated copy, and what follows an item in the index. Neither equals anything.
FOREIGN, BEHIND = -1, -2


class LengthClass:
    """The index of items of nearly one length: sampled places of ``repeats`` walks over windows of ``size`` words.

    ``offsets``: the words of an item from which on it is in the index. ``exact``: the walks do not reach the recall, and every window is a candidate for every item.
    """

    def __init__(self, items: list[tuple[int, list[int]]], params: EditParams):
        self.items, self.params = items, params
        self.size = min(len(w) for _, w in items)
        self.most = max(int(params.share * len(w)) for _, w in items)
        self.offsets = sorted({round(i * self.most / max(1, params.anchors - 1)) for i in range(params.anchors)})
        self.seeds, self.places = self._samples(params.rounds * params.most_repeats)
        needed = self._needed()
        self.exact = needed is None
        self.repeats = needed or 0
        if self.exact:
            return
        self.seeds, self.places = self.seeds[:self.repeats], self.places[:self.repeats]
        keys = self.keys_of(self.anchored([w for _, w in items]))
        self.order = np.argsort(keys, axis=1, kind="stable")
        self.keys = np.take_along_axis(keys, self.order, axis=1)

    def rows(self, texts: list[list[int]], fill: int) -> np.ndarray:
        """The first ``size`` words of each, filled up."""
        out = np.full((len(texts), self.size), fill, dtype=np.int32)
        for i, t in enumerate(texts):
            out[i, :min(self.size, len(t))] = t[:self.size]
        return out

    def anchored(self, texts: list[list[int]]) -> np.ndarray:
        """A window per text and offset, text by text."""
        return self.rows([t[o:] for t in texts for o in self.offsets], BEHIND)

    def _samples(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.params.seed * 1000 + self.size)
        # The walk stands near word j / 2 at step j: places within twice the size are words of the window.
        reach = min(self.params.stretch, 2) * self.size
        return self.params.seed + 1 + np.arange(n), np.array([np.sort(rng.choice(reach, min(self.params.places, reach), replace=False)) for _ in range(n)])

    def keys_of(self, windows: np.ndarray, first: int = 0, behind: int | None = None) -> np.ndarray:
        """A key per repeat, or per repeat of a range, and window."""
        seeds = self.seeds[first:behind]
        words = sampled(windows, seeds, self.places[first:behind]).astype(np.uint64)
        mixed = np.repeat(np.arange(first + 1, first + len(seeds) + 1, dtype=np.uint64)[:, None], len(windows), axis=1)
        with np.errstate(over="ignore"):
            for c in range(words.shape[2]):
                mixed = (mixed ^ words[:, :, c]) * MIX
                mixed ^= mixed >> np.uint64(29)
        return mixed

    def _needed(self) -> int | None:
        """Repeats at which simulated copies of every kind reach the recall, None if these do not."""
        if self.most == 0:
            return 1
        rng = random.Random(self.params.seed)
        picked = np.array([rng.randrange(len(self.items)) for _ in range(self.params.simulations)])
        used, place = np.unique(picked, return_inverse=True)
        anchors = self.anchored([self.items[i][1] for i in used])
        pending = []
        for kind in KINDS:
            texts = [copies_of(w, int(self.params.share * len(w)), kind, rng, FOREIGN) for w in (self.items[i][1] for i in picked)]
            pending.append((self.rows([t for own in texts for t in own], FOREIGN), np.repeat(np.arange(len(texts)), [len(own) for own in texts]),
                            np.zeros(len(texts), dtype=bool)))
        needed = 1
        for first in range(0, len(self.seeds), self.params.most_repeats):
            behind = min(first + self.params.most_repeats, len(self.seeds))
            own = self.keys_of(anchors, first, behind).reshape(behind - first, len(used), len(self.offsets))
            open_still = []
            for windows, owner, before in pending:
                same = (self.keys_of(windows, first, behind)[:, :, None] == own[:, place[owner]]).any(axis=2)
                hit = np.zeros((behind - first, len(before)), dtype=bool)
                repeat, window = np.nonzero(same)
                hit[repeat, owner[window]] = True
                hit = np.logical_or.accumulate(hit, axis=0) | before
                reached = np.nonzero(hit.mean(axis=1) >= self.params.recall)[0]
                if len(reached):
                    needed = max(needed, first + int(reached[0]) + 1)
                else:
                    open_still.append((windows, owner, hit[-1]))
            pending = open_still
            if not pending:
                return needed
        return None

    def candidates(self, windows: np.ndarray) -> list[tuple[int, int]]:
        """(window, item) pairs with an equal key, or all if ``exact``, that have words enough in common."""
        if self.exact:
            return [x for i in range(len(self.items)) for x in self._alike(windows, np.arange(len(windows)), i)]
        found = []
        for t, key in enumerate(self.keys_of(windows)):
            low, high = np.searchsorted(self.keys[t], key, "left"), np.searchsorted(self.keys[t], key, "right")
            for k in range(int((high - low).max(initial=0))):
                w = np.nonzero(high - low > k)[0]
                found.append(np.stack([w, self.order[t][low[w] + k] // len(self.offsets)], axis=1))
        if not found:
            return []
        out = []
        pairs = np.unique(np.concatenate(found), axis=0)
        for i in np.unique(pairs[:, 1]):
            out += self._alike(windows, pairs[pairs[:, 1] == i, 0], int(i))
        return out

    def _alike(self, windows: np.ndarray, w: np.ndarray, i: int) -> list[tuple[int, int]]:
        own = self.items[i][1]
        # An edit takes away one common word at most.
        near = np.isin(windows[w], own).sum(axis=1) >= self.size - int(self.params.share * len(own))
        return [(int(x), i) for x in w[near]]


class ItemIndex:
    """All items of a pass, by length class. Words that no item has are numbered 0."""

    def __init__(self, items: Sequence[tuple[int, str]], params: EditParams):
        self.params = params
        self.numbers: dict[str, int] = {}
        numbered = []
        for item, text in items:
            words = words_of(text)
            if words:
                numbered.append((item, [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words]))
        numbered.sort(key=lambda x: (len(x[1]), x[0] is not None, x[0] or 0, x[1]))
        self.classes: list[LengthClass] = []
        start = 0
        for i in range(1, len(numbered) + 1):
            if i == len(numbered) or len(numbered[i][1]) > params.class_ratio * len(numbered[start][1]):
                self.classes.append(LengthClass(numbered[start:i], params))
                start = i
        self.pairs = np.unique(np.array([a << 32 | b for _, w in numbered for a, b in zip(w, w[1:], strict=False)], dtype=np.int64))

    def search(self, texts: list[str], chunk: int = 5_000) -> list[tuple[int, int, int, int, int]]:
        """(text, item, distance, first word, word behind the last) of the nearest window of each item that is near enough.

        A window within ``most`` edits of an item has at most ``most`` words that no item has, and at most twice as
        many neighbours that no item has side by side; other windows are passed over, which loses nothing.
        """
        if not self.classes:
            return []
        # Between two texts so many unknown words that no window reaches from one into the other.
        get, gap = self.numbers.get, [0] * (max(len(w) for c in self.classes for _, w in c.items) + max(c.most for c in self.classes) + 1)
        line: list[int] = []
        begins, inside = [], []
        for t in texts:
            begins.append(len(line))
            line += [get(w, 0) for w in words_of(t)]
            inside.append(len(line))
            line += gap
        numbers, ends, n = np.array(line, dtype=np.int32), np.array(inside), len(line) - len(gap) + 1
        if n <= 0:
            return []
        # Sums over the words before each place: of known words, and of known neighbours.
        known = np.concatenate([[0], np.cumsum(numbers != 0)])
        both = numbers[:-1].astype(np.int64) << 32 | numbers[1:]
        at = np.nonzero((numbers[:-1] != 0) & (numbers[1:] != 0))[0]
        near = np.zeros(len(both), dtype=bool)
        if len(self.pairs):
            near[at] = self.pairs[np.minimum(np.searchsorted(self.pairs, both[at]), len(self.pairs) - 1)] == both[at]
        joined = np.concatenate([[0], np.cumsum(near)])
        best: dict[tuple[int, int, int], tuple[int, int, int]] = {}
        for c in self.classes:
            starts = np.nonzero((known[c.size:c.size + n] - known[:n] >= max(1, c.size - c.most))
                                & (joined[c.size - 1:c.size - 1 + n] - joined[:n] >= c.size - 1 - 2 * c.most))[0]
            for at in range(0, len(starts), chunk):
                some = starts[at:at + chunk]
                owner = np.searchsorted(begins, some, "right") - 1
                some, owner = some[some < ends[owner]], owner[some < ends[owner]]
                pairs = c.candidates(numbers[some[:, None] + np.arange(c.size)])
                # Copies without edits first, so that windows beside them need no table.
                for w, i in sorted(pairs, key=lambda x: line[some[x[0]]:some[x[0]] + len(c.items[x[1]][1])] != c.items[x[1]][1]):
                    own = c.items[i][1]
                    most, start, text = int(self.params.share * len(own)), int(some[w]), int(owner[w])
                    held = best.get((text, c.size, i))
                    if held is not None and held[0] == 0:
                        continue
                    hit = edit_distance_within(own, line[start:start + len(own) + most], most if held is None else held[0] - 1)
                    if hit:
                        best[text, c.size, i] = (hit[0], start - begins[text], start - begins[text] + hit[1])
        item_of = {(c.size, i): item for c in self.classes for i, (item, _) in enumerate(c.items)}
        return [(text, item_of[size, i], *hit) for (text, size, i), hit in best.items()]


def _span(text: str, first: int, behind: int) -> tuple[int, int]:
    """Code points of a run of words. Lower-casing can lengthen a text, so words are counted in the text as it is if it does."""
    low = text.lower()
    places = [m.span() for m in WORD.finditer(low if len(low) == len(text) else text)]
    return (places[first][0], places[min(behind, len(places)) - 1][1]) if first < len(places) else (0, len(text))


FOUND = "row_no bigint, key bigint, item_id bigint, distance int, start int, end int"


def find_items(docs: DataFrame, items: DataFrame, params: EditParams = EditParams(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Which benchmark items stand in which documents: row_no, ``key``, item_id, distance (edits over words) and the
    span start:end (code points) of the nearest window. Rows without any item are left out.

    ``items`` has item_id and text. An item counts as found where some window of whole words is within ``params.share`` of its words in
    edits; case and punctuation do not matter. Items without words, null texts and empty texts find nothing; repeated
    items, and repeated rows of ``docs``, are reported each. Null ids are kept. Other columns are not read.

    Texts are read where they lie and nothing is shuffled. The items are the broadcast part: ``params.items_per_pass`` of them at
    a time, chosen by hash, and as many passes as that takes.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row_no"), F.col(key).cast("bigint").alias("key"), text_of(text).alias("text"))
    out = None
    for index in _indexes(items, params):

        def run(batches, index=index) -> Iterator[dict]:
            for b in batches:
                got = {n.split()[0]: [] for n in FOUND.split(", ")}
                for i, item, distance, first, behind in index.value.search(b["text"]):
                    for n, v in zip(got, (b["row_no"][i], b["key"][i], item, distance, *_span(b["text"][i], first, behind)), strict=True):
                        got[n].append(v)
                yield got

        found = map_rows(rows, run, FOUND)
        out = found if out is None else out.unionByName(found)
    return out.withColumnRenamed("key", key)


def _indexes(items: DataFrame, params: EditParams) -> Iterator[Broadcast]:
    """The items in portions of about ``params.items_per_pass``, each as an index that is sent to all executors."""
    spark = items.sparkSession
    wanted = items.select(F.col("item_id").cast("bigint").alias("item_id"), text_of("text").alias("text"))
    passes = parts_for(wanted.count(), params.items_per_pass, 1)
    for p in range(passes):
        some = wanted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == p).collect()
        yield spark.sparkContext.broadcast(ItemIndex([tuple(r) for r in some], params))


def without_items(docs: DataFrame, items: DataFrame, params: EditParams = EditParams(), text: str = "text") -> DataFrame:
    """The rows of ``docs`` in whose text no item of ``items`` is found; see ``find_items``. Nothing is shuffled."""
    prepare(docs.sparkSession)
    for index in _indexes(items, params):

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for b in batches:
                hit = {i for i, *_ in index.value.search(["" if t is None else t for t in b.column(text).to_pylist()])}
                yield b.filter(pa.array([i not in hit for i in range(b.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
