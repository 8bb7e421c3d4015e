"""Byte-level BPE by dynamic programming over prefixes.

For each prefix of a byte string exactly one token can be the last of its encoding: the
one for which the tokens before it are the encoding of what precedes it, and which merges
cannot tear from its left neighbour. A table of these last tokens is the whole state of an
encoder. Appending bytes only adds entries, dropping bytes only removes them, and after an
edit the entries change only until they agree again with the old ones.

A text is cut by the vocabulary's pattern first; each match is encoded by itself.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketshift.llm.common import map_rows, text_of

# Encoded matches, encoded prefixes and judged pairs that a task remembers. Only speed depends on it: what is
# forgotten is computed again.
MEMORY, PREFIXES, PAIRS = 200_000, 100_000, 300_000
# Bytes up to which only those prefixes are looked at that the last tokens ask for.
SHORT = 64


class Vocabulary:
    """Ranked tokens, and which neighbours leave each other alone under the merges."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token_bytes = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks), default=0)
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no token for single bytes {missing[:5]}")
        # Tokens, and beginnings of tokens that are none themselves (-1).
        self.beginnings = {t[:k]: -1 for t in ranks for k in range(1, len(t))} | ranks
        self.packed = [i.to_bytes(4, "little") for i in range(max(ranks.values()) + 1)]
        self._judged: dict[int, bool] = {}
        self._prefixes: dict[bytes, bytes] = {}
        self.sizes = {i: len(t) for i, t in self.token_bytes.items()}
        self._edges: dict[int, dict[int, tuple]] = {-1: {}, 0: {}}

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """A rank file: one base64 token and its rank per line."""
        with open(path, "rb") as f:
            return cls({base64.b64decode(t): int(r) for t, r in map(bytes.split, filter(bytes.strip, f))})

    def merged(self, raw: bytes, below: int = 1 << 60, down_to: int = 1) -> list[bytes]:
        """``raw`` merged by lowest rank first, leftmost first among equals: the definition. Only
        merges of a rank under ``below`` are made, and none once ``down_to`` parts are left."""
        parts = [raw[i:i + 1] for i in range(len(raw))]
        while len(parts) > down_to:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank >= below:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _edge(self, token: int, side: int) -> tuple[tuple[bytes, int, int], ...]:
        """The tokens that stood at one edge of ``token`` while it was made, last first, each with the
        rank by which it came about (-1: a byte) and the rank by which it was absorbed."""
        known = self._edges[side].get(token)
        if known is None:
            raw, steps, absorbed = self.token_bytes[token], [], 1 << 60
            while True:
                made = self.ranks[raw] if len(raw) > 1 else -1
                steps.append((raw, made, absorbed))
                if made < 0:
                    break
                raw, absorbed = self.merged(raw, made, 2)[side], made
            known = self._edges[side][token] = tuple(steps)
        return known

    def side_by_side(self, left: int, right: int) -> bool:
        """Whether ``left`` and ``right`` survive as neighbours when their bytes are merged together.

        Undoes the merges of both, latest first, and looks for a merge across the border that would
        have come before the one that absorbed its left part, and no later than that of its right part
        (of equal ranks the one further left is made first).
        """
        pair = left << 32 | right
        known = self._judged.get(pair)
        if known is None:
            if len(self._judged) >= PAIRS:
                self._judged.clear()
            known = self._judged[pair] = self._apart(self._edge(left, -1), self._edge(right, 0))
        return known

    def last_tokens(self, raw: bytes) -> list[int]:
        """For each prefix of ``raw``, the last token of its encoding (-1 for the empty one).

        The same table as a ``PrefixEncoder`` holds, filled from left to right in one go: each token
        that begins at a place is tried as the last one of the prefix at whose end it stops.
        """
        get, judged, judge = self.beginnings.get, self._judged.get, self.side_by_side
        n = len(raw)
        last = [-1] * (n + 1)
        for start in range(n):
            before = last[start]
            pair = before << 32
            for end in range(start + 1, n + 1):
                token = get(raw[start:end])
                if token is None:
                    break
                if token >= 0 and last[end] < 0:
                    if start:
                        fits = judged(pair | token)
                        if not (fits if fits is not None else judge(before, token)):
                            continue
                    last[end] = token
        return last

    def packed_tokens(self, raw: bytes) -> bytes:
        """The encoding of ``raw`` as little-endian 32-bit integers."""
        whole = self.ranks.get(raw)  # a token is its own encoding
        if whole is not None:
            return self.packed[whole]
        if len(raw) <= SHORT:
            return self._from_prefix(raw)
        last, packed, size, out, end = self.last_tokens(raw), self.packed, self.sizes, [], len(raw)
        while end:
            token = last[end]
            out.append(packed[token])
            end -= size[token]
        out.reverse()
        return b"".join(out)

    def _from_prefix(self, raw: bytes) -> bytes:
        """The same for a short ``raw`` that is no token: the token that fits behind the encoding of what precedes it.

        The entries of the table that this asks for are remembered by their prefix, as other matches begin alike.
        """
        get, judged, known = self.ranks.get, self._judged.get, self._prefixes
        for start in range(1, len(raw)):
            token = get(raw[start:])
            if token is not None:
                head = raw[:start]
                before = known.get(head)
                if before is None:
                    before = self.packed_tokens(head)
                    if len(known) >= PREFIXES:
                        known.clear()
                    known[head] = before
                left = int.from_bytes(before[-4:], "little")
                fits = judged(left << 32 | token)
                if fits if fits is not None else self.side_by_side(left, token):
                    return before + self.packed[token]
        raise AssertionError("single bytes are tokens, so one always fits")

    def _apart(self, lefts: tuple, rights: tuple) -> bool:
        i = j = 0
        get = self.ranks.get
        while True:
            a, a_made, a_until = lefts[i]
            b, b_made, b_until = rights[j]
            across = get(a + b)
            if across is not None and across < a_until and across <= b_until:
                return False
            if a_made < 0 and b_made < 0:
                return True
            if b_made >= a_made:
                j += 1
            else:
                i += 1


class PrefixEncoder:
    """The encoding of a byte string that can grow, shrink and be edited.

    ``last[i]`` is the last token of the encoding of the first ``i`` bytes.
    """

    def __init__(self, vocabulary: Vocabulary, raw: bytes = b""):
        self.vocabulary = vocabulary
        self.raw = bytearray()
        self.last: list[int] = [-1]
        self.append(raw)

    def append(self, more: bytes) -> None:
        self.raw += more
        while len(self.last) <= len(self.raw):
            self._next()

    def truncate(self, length: int) -> None:
        del self.raw[length:], self.last[length + 1:]

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of ``raw[start:stop]``. Returns how many entries were computed."""
        old, tail = self.last[stop + 1:], bytes(self.raw[stop:])
        self.truncate(start)
        self.append(new)
        self.raw += tail
        # An entry depends on at most ``longest`` entries before it and on the bytes since then, so
        # after that many agreements in the unedited tail all later entries agree as well.
        same = done = 0
        for k, was in enumerate(old):
            if same >= self.vocabulary.longest:
                self.last.extend(old[k:])
                break
            done += 1
            same = same + 1 if self._next() == was else 0
        return done + len(new)

    def _next(self) -> int:
        """Compute the entry of the next prefix."""
        v, last, end = self.vocabulary, self.last, len(self.last)
        start = max(0, end - v.longest)
        tail = bytes(self.raw[start:end])
        get, judged = v.ranks.get, v._judged.get
        for k in range(len(tail)):
            token = get(tail[k:])
            if token is not None:
                before = last[start + k]
                if before < 0:
                    break
                fits = judged(before << 32 | token)
                if fits if fits is not None else v.side_by_side(before, token):
                    break
        else:
            raise AssertionError("single bytes are tokens, so one always fits")
        last.append(token)
        return token

    def tokens(self) -> list[int]:
        out, end = [], len(self.raw)
        while end:
            out.append(self.last[end])
            end -= len(self.vocabulary.token_bytes[out[-1]])
        return out[::-1]


class _Remembered(dict):
    """Results of ``make`` for short keys, in two generations: when the younger one is full it takes the place of
    the older one, and what is asked for again moves back. So frequent keys stay."""

    def __init__(self, make):
        self.make, self.older = make, {}

    def __missing__(self, key: str) -> bytes:
        out = self.older.get(key)
        if out is None:
            out = self.make(key)
            if len(key) > 64:
                return out
        if len(self) >= MEMORY // 2:
            self.older = dict(self)
            self.clear()
        self[key] = out
        return out


class Codec:
    """Encodes and decodes whole texts."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.vocabulary = Vocabulary.read(path)
        self.matches_of = regex.compile(pattern).findall
        self.matches = _Remembered(lambda match: self.vocabulary.packed_tokens(match.encode("utf-8")))

    def encode(self, text: str) -> bytes:
        """The ids as little-endian 32-bit integers. Matches are encoded and remembered one by one."""
        return b"".join(map(self.matches.__getitem__, self.matches_of(text)))

    def forget(self) -> None:
        """Leave the vocabulary alone in memory."""
        self.matches.clear()
        self.matches.older = {}
        self.vocabulary._prefixes.clear()
        self.vocabulary._judged.clear()

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.token_bytes.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@functools.lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


@dataclass(frozen=True)
class VocabularyFile:
    """A public vocabulary by its file name; each worker finds the file in its own installation."""

    name: str = "byte_bpe_50k.tiktoken"

    def codec(self) -> Codec:
        import public_tokenizers

        return codec(public_tokenizers.path(self.name), public_tokenizers.PATTERN)


def encode_texts(docs: DataFrame, vocabulary: VocabularyFile = VocabularyFile(), key: str = "doc_id", text: str = "text",
                 with_ids: bool = True) -> DataFrame:
    """Token ids of every whole text, and the bytes they decode to, as a hash.

    Returns ``key``, n_tokens, ids (array of int; only ``with_ids``), ids_sha256 over the ids as
    little-endian 32-bit integers, decoded_sha256. One row per input row, repeated and null keys
    included. A null text counts as empty: no tokens, and both hashes those of no bytes. Other
    columns of ``docs`` are not read. No shuffle; a text is one row's work, linear in its length.
    """
    kind = docs.schema[key].dataType.simpleString()
    ids = "ids array<int>, " if with_ids else ""

    def run(batches) -> Iterator[dict]:
        c = vocabulary.codec()
        try:
            for b in batches:
                encoded = [c.encode(t) for t in b["text"]]
                out = {"key": b["key"], "n_tokens": [len(e) // 4 for e in encoded],
                       "ids_sha256": [hashlib.sha256(e).hexdigest() for e in encoded],
                       "decoded_sha256": [hashlib.sha256(c.decode(e)).hexdigest() for e in encoded]}
                if with_ids:
                    out["ids"] = pa.array([np.frombuffer(e, dtype="<u4").astype("int32") for e in encoded], pa.list_(pa.int32()))
                yield out
        finally:
            c.forget()  # the worker lives on beside those of other stages

    return map_rows(docs.select(F.col(key).alias("key"), text_of(text).alias("text")), run,
                    f"key {kind}, n_tokens bigint, {ids}ids_sha256 string, decoded_sha256 string").withColumnRenamed("key", key)
