"""Personal data: fixed shapes, and identifiers found by bootstrapped contexts.

The fixed shapes are the seeds. The words around their occurrences, with the shape of what stands
between, are lexical patterns. Patterns and instances (distinct strings) form a graph: a pattern is as
good as the share of its instances that are of a kind, an instance is as sure as its best pattern
makes it. Spark passes scores along the edges for some rounds; strings that good patterns surround are seeds of
further patterns in the next round. Patterns that end up good enough, and
that several different seeds support, mark what else they surround.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketshift.llm.common import map_rows, prepare, text_of
from basketshift.session import stage

KINDS = ("email", "ip", "card", "phone")

# The shapes of the contract. An address is found from its @ (see ``emails``).
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# What could be an identifier: strings without white space that have digits or an @, of any length, less the punctuation around them;
# groups of digits that follow one another are one. WORD is any such string.
WORD = re.compile(r"\S+")
MARKED = re.compile(r"[0-9@]")
GROUP = re.compile(r"[(+]?[0-9][0-9().+/-]*")
OPENING, CLOSING = "\"'([<", "\"')]>.,;:!?"


@dataclass(frozen=True)
class PiiParams:
    rounds: int = 4
    # Share of a pattern's instances that must be of its kind, after smoothing.
    good: float = 0.7
    # What an unseen instance takes over of its best pattern's score. Under 1, so that patterns and
    # unseen instances cannot talk each other up to certainty.
    damping: float = 0.7
    # Distinct seeds of the kind that a pattern must surround.
    least_seeds: int = 5
    smoothing: float = 1.0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses, leftmost first and apart: at every @ the longest run of local characters before it
    that no earlier address holds, and the domain behind it. Linear, whatever the text."""
    end = 0
    at = text.find("@")
    while at >= 0:
        if at >= end:
            start = at
            while start > end and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                end = m.end()
                yield start, end
        at = text.find("@", at + 1)


def small_parts(address: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in address.split("."))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else 2 * n - 9 * (n > 4)
    return total % 10 == 0


def digits_of(string: str) -> str:
    return "".join(c for c in string if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed shapes, by start and kind. A match that fails its test is dropped as it is."""
    found = [(s, 0, e) for s, e in emails(text)]
    if not re.search(r"[0-9]", text):
        return found
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if small_parts(m[0])]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = digits_of(m[0])
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return sorted(found)


def shape_of(string: str) -> str:
    """What a string is like at large: whether it has an @, letters, and how many digits (few, as many as a number to call, more)."""
    digits = len(digits_of(string))
    return ("@" if "@" in string else "") + ("a" if re.search(r"[^\W\d_]", string) else "") + ("9" if digits < 7 else "99" if digits < 16 else "999")


def _short(string: str) -> str:
    """The string, or a digest that stands for it if it is long, so that no row holds more than a line."""
    return string if len(string) <= 64 else hashlib.blake2b(string.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _word(text: str) -> str:
    return _short(re.sub(r"[0-9]+", "9", text.lower().strip("\"'()[]<>.,;:!?")))


class Words:
    """The words of a text by place, and the spans that other occurrences in it hold."""

    def __init__(self, text: str, found: Sequence[tuple[int, int, int]]):
        self.text = text
        self.at = [m.span() for m in WORD.finditer(text)]
        self.starts = [s for s, _ in self.at]
        self.begins, self.ends = sorted(s for s, _, _ in found), sorted(e for _, e, _ in found)

    def word(self, i: int) -> str:
        return _word(self.text[slice(*self.at[i])]) if 0 <= i < len(self.at) else ""

    def contexts(self, start: int, end: int, shape: str) -> list[str]:
        """The patterns of an occurrence: two words before it, one on each side, and two behind it, each with the shape of the string.

        Words count whole. What stands in the occurrence's own word beside it is a word too, up to the next occurrence; at an edge of the text the
        missing word is empty.
        """
        first, last = bisect_right(self.starts, start) - 1, bisect_right(self.starts, end - 1) - 1
        i, j = bisect_right(self.ends, start) - 1, bisect_left(self.begins, end)
        low = max(self.starts[first], self.ends[i] if i >= 0 else 0)
        high = min(self.at[last][1], self.begins[j] if j < len(self.begins) else len(self.text))
        before = [self.word(first - 2), self.word(first - 1), *([_word(self.text[low:start])] if low < start else [])][-2:]
        after = [*([_word(self.text[end:high])] if end < high else []), self.word(last + 1), self.word(last + 2)][:2]
        return [f"{before[0]} {before[1]} | {shape}", f"{before[1]} | {shape} | {after[0]}", f"{shape} | {after[0]} {after[1]}"]


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, kind) of seeds, and of other strings with digits or an @ (kind -1) that no base span overlaps, by start."""
    out = [(s, e, k) for s, k, e in base]
    i, reach, group = 0, 0, False
    for m in WORD.finditer(text):
        if not MARKED.search(m[0]):
            group = False
            continue
        s = m.end() - len(m[0].lstrip(OPENING))
        e = m.start() + len(m[0].rstrip(CLOSING))
        while i < len(base) and base[i][0] < e:
            reach = max(reach, base[i][2])
            i += 1
        digits = GROUP.fullmatch(m[0].rstrip(CLOSING)) is not None
        if reach > s or s >= e:
            group = False
        elif group and digits:
            out[-1] = (out[-1][0], e, -1)
            group = text[e:m.end()] in ("", ")")
        else:
            out.append((s, e, -1))
            # Other punctuation than a bracket behind a group ends it.
            group = digits and text[e:m.end()] in ("", ")")
    return sorted(out)


SCANNED = ("row_no bigint, key bigint, base array<struct<start:int,kind:int,end:int>>, "
           "seen array<struct<start:int,end:int,kind:int,instance:string,patterns:array<string>>>")


def scan(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One pass over the whole texts: base spans, and every occurrence of a seed or candidate with its patterns."""

    def run(batches) -> Iterator[dict]:
        for b in batches:
            base = [base_spans(t) for t in b["text"]]
            seen = []
            for t, spans in zip(b["text"], base, strict=True):
                marked = candidates(t, spans) if spans or MARKED.search(t) else []
                words = Words(t, marked) if marked else None
                seen.append([{"start": s, "end": e, "kind": k, "instance": _short(t[s:e]), "patterns": words.contexts(s, e, shape_of(t[s:e]))}
                             for s, e, k in marked])
            yield {"row_no": b["row_no"], "key": b["key"], "seen": seen,
                   "base": [[{"start": s, "kind": k, "end": e} for s, k, e in spans] for spans in base]}

    rows = docs.select(F.monotonically_increasing_id().alias("row_no"), F.col(key).cast("bigint").alias("key"), text_of(text).alias("text"))
    return map_rows(rows, run, SCANNED)


def pattern_scores(occurrences: DataFrame, params: PiiParams = PiiParams()) -> DataFrame:
    """The good patterns: pattern, kind, score, seeds.

    ``occurrences`` has instance, kind (-1: not a seed) and patterns. Edges are counted once per pattern and
    instance, however often both meet, so repeated texts carry no more weight than one. Strings that good patterns found in a
    round are seeds of further patterns in the next. Every round is a few
    grouped sums and joins over the edges, written to the shared folder.
    """
    edges = stage(occurrences.select("instance", "kind", F.explode("patterns").alias("pattern"))
                  .groupBy("pattern", "instance").agg(F.max("kind").alias("kind")), "pii-edges")
    # A pattern that is good for the first time in a round takes what earlier rounds found for seeds; what it finds itself stays damped.
    born = found = scores = None
    for now in range(params.rounds):
        own = edges.withColumn("own", F.col("kind")).drop("kind")
        if found is not None:
            own = (own.join(found, "instance", "left").join(born, "pattern", "left")
                   .withColumn("own", F.when((F.col("own") < 0) & (F.col("at") < F.coalesce("since", F.lit(now))), F.col("as")).otherwise(F.col("own")))
                   .select("pattern", "instance", "own"))
        # Only patterns that surround some seed can get a score; only their instances matter.
        seeds = own.groupBy("pattern").agg(*[F.sum((F.col("own") == k).cast("bigint")).alias(f"seeds_{k}") for k in range(len(KINDS))],
                                           F.count("*").alias("instances"))
        most = F.greatest(*[F.col(f"seeds_{k}") for k in range(len(KINDS))])
        owned = (seeds.where(most >= params.least_seeds)
                 .select("pattern", "instances", most.alias("seeds"),
                         F.coalesce(*[F.when(F.col(f"seeds_{k}") == most, F.lit(k)) for k in range(len(KINDS))]).alias("kind")))
        live = stage(own.join(owned, "pattern"), "pii-graph")
        known = F.when(F.col("own") == F.col("kind"), 1.0).when(F.col("own") >= 0, 0.0)
        if scores is None:
            sure = live.withColumn("sure", F.coalesce(known, F.lit(0.0)))
        else:
            believed = (live.where("own < 0").join(scores.select("pattern", "score"), "pattern").groupBy("instance", "kind")
                        .agg((F.max("score") * params.damping).alias("believed")))
            sure = live.join(believed, ["instance", "kind"], "left").withColumn("sure", F.coalesce(known, "believed", F.lit(0.0)))
        scores = stage(sure.groupBy("pattern", "kind", "instances", "seeds")
                       .agg((F.sum("sure") / (F.col("instances") + params.smoothing)).alias("score")), "pii-scores")
        good = scores.where(F.col("score") >= params.good)
        fresh = good.select("pattern", F.lit(now).alias("since"))
        born = stage(fresh if born is None else born.unionByName(fresh).groupBy("pattern").agg(F.min("since").alias("since")), "pii-born")
        # Confident: unseen, and all good patterns around it agree.
        sure_now = (live.where("own < 0").select("pattern", "instance").join(good.select("pattern", "kind"), "pattern").groupBy("instance")
                    .agg(F.min("kind").alias("as"), F.max("kind").alias("_other")).where(F.col("as") == F.col("_other"))
                    .select("instance", "as", F.lit(now).alias("at")))
        if found is not None:
            sure_now = found.unionByName(sure_now.join(found, "instance", "left_anti"))
        sure_now = stage(sure_now, "pii-found")
        found = sure_now if found is not None or not sure_now.isEmpty() else None
    return scores.where(F.col("score") >= params.good).select("pattern", "kind", "score", "seeds")


def find_personal_data(docs: DataFrame, params: PiiParams = PiiParams(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Personal data of every whole text: ``key``, n_email, n_ip, n_card, n_phone and base (the fixed shapes), n_found (by context)
    and spans (all), as kind:start:end in code points by start and kind.

    One row per input row, repeated and null keys included; a null text counts as empty. An empty table gives an empty
    result; columns other than ``key`` (an integer) and ``text`` are not read. Of kinds that tie for a pattern the first
    listed counts. The texts are read once; only spans, contexts and row numbers move.
    """
    prepare(docs.sparkSession)
    scanned = stage(scan(docs, key, text), "pii-scanned")
    seen = scanned.select("row_no", F.explode("seen").alias("o")).select("row_no", "o.*")
    good = pattern_scores(seen.select("instance", "kind", "patterns"), params)
    # One unseen occurrence can match by several patterns; its kind is that of the best.
    found = (seen.where("kind < 0").select("row_no", "start", "end", F.explode("patterns").alias("pattern"))
             .join(good, "pattern").groupBy("row_no", "start", "end")
             .agg(F.min(F.struct((-F.col("score")).alias("score"), "kind")).alias("best"))
             .select("row_no", F.struct("start", F.col("best.kind").alias("kind"), "end").alias("span"))
             .groupBy("row_no").agg(F.collect_list("span").alias("found")))
    spans = lambda c: F.array_join(F.transform(F.array_sort(c), lambda s: F.concat_ws(":", F.element_at(
        F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"], s["end"])), ",")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    joined = scanned.select("row_no", "key", "base").join(found, "row_no", "left").withColumn("found", F.coalesce("found", none))

    def of_kind(k):
        # One parameter only: to a second one Spark hands the element's index.
        return F.size(F.filter("base", lambda s: s["kind"] == k))

    count = [of_kind(k).cast("bigint").alias(f"n_{n}") for k, n in enumerate(KINDS)]
    return joined.select(F.col("key").alias(key), *count, F.size("found").cast("bigint").alias("n_found"), spans(F.col("base")).alias("base"),
                         spans(F.concat("base", "found")).alias("spans"))
