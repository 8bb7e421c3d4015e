"""Toxicity by a weighted lexicon.

Texts are folded: look-alike letters of other scripts, digits and signs that stand for letters become
those letters, and words are set apart by single spaces. An Aho-Corasick automaton finds all entries of the lexicon in
one pass: whole words, word beginnings, and exception phrases, inside which a hit does not count. The
weights found, as a sum and in relation to the length, give the score.

Lexicon, weights, exception phrases and the two coefficients are learned from labelled rows.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketshift.llm.common import map_rows, prepare, text_of
from basketshift.session import stage

# Letters that look like Latin ones (Cyrillic, then Greek), and digits used as letters.
FOLDS = (
    ("абвгдезикмнорстухѕіјԁһӏԛԝ", "abbrdesukmhopctyxsijdhlqw"),
    ("αβγεηικνορτυχωϲ", "abyenikvoptuxwc"),
    ("0123456789", "oizeasgtbg"),
)
# Signs count as letters only between two letters: elsewhere they are punctuation.
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "l", "€": "e"}
HIDDEN = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
TABLE = {ord(a): b for left, right in FOLDS for a, b in zip(left, right, strict=True)} | HIDDEN
_SIGN = re.compile(r"(?<=[^\W_])[@$!|€](?=[^\W_])")
_GAP = re.compile(r"[\W_]+")


def fold(text: str) -> str:
    """Folded words between single spaces, with a space at both ends. Whole text, linear."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = _SIGN.sub(lambda m: SIGNS[m[0]], text.lower().translate(TABLE))
    return f" {_GAP.sub(' ', text).strip()} "


@dataclass(frozen=True)
class ToxicityParams:
    # Labelled rows that training may use, picked by a hash of their id. The bound of the fit.
    train_rows: int = 40_000
    # Rows of one remainder (of five) are held out; those of another set the coefficients.
    held_out: int = 0
    calibration: int = 4
    # Entries: word beginnings of these lengths, and whole words.
    shortest: int = 3
    longest: int = 8
    # Toxic training rows that have an entry; distinct words before it (of 64 classes), so that copies of
    # one text do not make entries; the share of clean rows among those that have it, at most.
    least_rows: int = 8
    least_contexts: int = 6
    clean_share: float = 0.2
    # Exception phrases: clean rows that have it, and the toxic share among those that have it, at most.
    exception_rows: int = 3
    exception_share: float = 0.1


def remainder(key: str):
    """crc32 of the id as text, modulo 5: which rows are held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5, F.lit(-1)).cast("int")


@dataclass(frozen=True)
class Lexicon:
    """Weights of entries (" abc": words that begin so, " abc ": this word), exception phrases and coefficients."""

    weights: tuple[tuple[str, float], ...] = ()
    exceptions: tuple[str, ...] = ()
    # Intercept, and factors of the sum and of the density. Without training everything scores 0.
    coefficients: tuple[float, float, float] = (-math.inf, 0.0, 0.0)

    @property
    def fitted(self) -> bool:
        return self.coefficients[0] > -math.inf


@functools.lru_cache(maxsize=4)
def automaton(lexicon: Lexicon):
    import ahocorasick

    a = ahocorasick.Automaton()
    for entry, weight in lexicon.weights:
        a.add_word(entry, (len(entry), weight))
    for phrase in lexicon.exceptions:
        a.add_word(phrase, (len(phrase), None))
    a.make_automaton()
    return a


def hits(lexicon: Lexicon, folded: str) -> list[tuple[int, float]]:
    """(place, weight) of each word that has an entry outside exception phrases; the heaviest entry counts."""
    if not lexicon.weights:
        return []
    best: dict[int, float] = {}
    excused: list[tuple[int, int]] = []
    for end, (length, weight) in automaton(lexicon).iter(folded):
        start = end - length + 1
        if weight is None:
            excused.append((start, end))
        elif weight > best.get(start, -math.inf):
            best[start] = weight
    if excused:
        excused.sort()
        kept, i, reach = {}, 0, -1
        for start in sorted(best):
            while i < len(excused) and excused[i][0] <= start:
                reach = max(reach, excused[i][1])
                i += 1
            if reach <= start:
                kept[start] = best[start]
        best = kept
    return sorted(best.items())


def features(lexicon: Lexicon, text: str) -> tuple[float, float]:
    """The damped sum of the weights found, and their damped density over the length in words."""
    folded = fold(text)
    total = sum(w for _, w in hits(lexicon, folded))
    words = folded.count(" ") - 1
    return math.log1p(total), math.log1p(100 * total / (words + 20))


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def score(lexicon: Lexicon, text: str) -> float:
    if not lexicon.fitted:
        return 0.0
    a, b, c = lexicon.coefficients
    x, y = features(lexicon, text)
    return sigmoid(a + b * x + c * y)


def training_rows(docs: DataFrame, labels: DataFrame, params: ToxicityParams, key: str, text: str) -> DataFrame:
    """part (remainder), toxic and text of the picked rows. Their ids are at most ``train_rows``, so
    they are sent to the texts, which do not move."""
    picked = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
              .withColumn("part", remainder("doc_id")).where(F.col("part") != params.held_out)
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.train_rows))
    return stage(docs.select(F.col(key).alias("doc_id"), text_of(text).alias("text"))
                 .join(F.broadcast(picked), "doc_id").select("part", "toxic", "text"), "toxicity-training")


def _entries(folded: str, params: ToxicityParams) -> Iterator[tuple[str, str]]:
    """(entry, word before it) of every word."""
    before = ""
    for word in folded.split():
        for k in range(params.shortest, min(params.longest, len(word)) + 1):
            yield " " + word[:k], before
        yield f" {word} ", before
        before = word


def _counted(rows: DataFrame, find) -> DataFrame:
    """Rows that have each string of ``find(folded)``, toxic and clean ones, and the classes of their contexts as a mask."""

    def run(batches) -> Iterator[dict]:
        import zlib

        held: dict[str, list[int]] = {}

        def out() -> dict:
            got = {"entry": list(held), "toxic": [v[0] for v in held.values()], "clean": [v[1] for v in held.values()],
                   "mask": [v[2] - (1 << 64) * (v[2] >> 63) for v in held.values()]}
            held.clear()
            return got

        for b in batches:
            for toxic, text in zip(b["toxic"], b["text"], strict=True):
                seen: dict[str, int] = {}
                for entry, context in find(fold(text)):
                    seen[entry] = seen.get(entry, 0) | 1 << zlib.crc32(context.encode()) % 64
                for entry, mask in seen.items():
                    v = held.setdefault(entry, [0, 0, 0])
                    v[1 - toxic] += 1
                    v[2] |= mask * toxic
            if len(held) > 100_000:
                yield out()
        yield out()

    return (map_rows(rows.select("toxic", "text"), run, "entry string, toxic bigint, clean bigint, mask bigint").groupBy("entry")
            .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.bit_count(F.bit_or("mask")).alias("contexts")))


def _pruned(found: Iterable[tuple[str, float]]) -> dict[str, float]:
    """Without entries that a shorter one, as heavy or nearly so, stands for."""
    kept: dict[str, float] = {}
    for entry, weight in sorted(found, key=lambda e: (len(e[0]), e[0])):
        shorter = max((kept.get(entry[:k], -math.inf) for k in range(2, len(entry))), default=-math.inf)
        if weight > shorter + 0.5:
            kept[entry] = weight
    return kept


def fit(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams(), key: str = "doc_id", text: str = "text") -> Lexicon:
    """The lexicon that the labelled rows support. Without toxic or without clean rows it is empty and not fitted."""
    rows = training_rows(docs, labels, params, key, text)
    sizes = {(p, t): n for p, t, n in rows.groupBy("part", "toxic").count().collect()}
    learn = rows.where(F.col("part") != params.calibration)
    toxic, clean = (sum(n for (p, t), n in sizes.items() if t == want and p != params.calibration) for want in (1, 0))
    if not toxic or not clean:
        return Lexicon()
    ratio = toxic / clean
    share = F.col("clean") * ratio / (F.col("clean") * ratio + F.col("toxic"))
    found = (_counted(learn, functools.partial(_entries, params=params))
             .where((F.col("toxic") >= params.least_rows) & (F.col("contexts") >= params.least_contexts) & (share <= params.clean_share))
             .select("entry", F.log((F.col("toxic") + 0.5) / toxic * clean / (F.col("clean") + 0.5)).alias("weight")))
    weights = tuple(sorted(_pruned((e, w) for e, w in found.collect()).items()))
    plain = Lexicon(weights)

    def phrases(folded: str) -> Iterator[tuple[str, str]]:
        """A word that has an entry with the word before it, and with the one behind it."""
        for start, _ in hits(plain, folded):
            stop = folded.index(" ", start + 1)
            if start:
                yield folded[folded.rindex(" ", 0, start):stop + 1], ""
            if stop + 1 < len(folded):
                yield folded[start:folded.index(" ", stop + 1) + 1], ""

    excused = (_counted(learn, phrases)
               .where((F.col("clean") >= params.exception_rows) & (F.col("toxic") <= params.exception_share * (F.col("toxic") + F.col("clean"))))
               .select("entry").collect())
    lexicon = Lexicon(weights, tuple(sorted(r[0] for r in excused)))

    def measured(batches) -> Iterator[dict]:
        for b in batches:
            f = [features(lexicon, t) for t in b["text"]]
            yield {"toxic": b["toxic"], "x": [v[0] for v in f], "y": [v[1] for v in f]}

    # Rows that the entries were not chosen by, so that their hits are as good as those of new texts.
    fresh = rows.where(F.col("part") == params.calibration) if {(params.calibration, 0), (params.calibration, 1)} <= set(sizes) else learn
    points = map_rows(fresh.select("toxic", "text"), measured, "toxic int, x double, y double").collect()
    return Lexicon(weights, lexicon.exceptions, logistic([(p.x, p.y) for p in points], [p.toxic for p in points]))


def logistic(x: list[tuple[float, float]], y: list[int], ridge: float = 0.01) -> tuple[float, float, float]:
    """Ridge logistic regression on two features by Newton steps."""
    a, t = np.column_stack([np.ones(len(y)), np.array(x)]), np.array(y, dtype=float)
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -50, 50)))
        grad = a.T @ (t - p) - ridge * w
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(3), grad)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(map(float, w))


def score_texts(docs: DataFrame, lexicon: Lexicon, params: ToxicityParams = ToxicityParams(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs``, held_out, score (0 to 1), predicted (1 from 0.5) and n_hits; existing columns of these names are replaced.

    One row per input row, nothing is shuffled. A null text counts as empty; empty texts get the score of a text without
    hits. A row with a null key is not held out. Without training rows of both labels every score is 0.
    """
    def run(batches) -> Iterator:
        import pyarrow as pa

        for b in batches:
            texts = b.column("_folding").to_pylist()
            scores = [score(lexicon, t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(b.num_columns - 1)), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                 pa.array([len(hits(lexicon, fold(t))) if s >= 0.5 else 0 for t, s in zip(texts, scores, strict=True)], pa.int32())],
                names=[*b.schema.names[:-1], "score", "predicted", "n_hits"])

    from pyspark.sql.types import DoubleType, IntegerType, StructType

    kept = docs.drop("held_out", "score", "predicted", "n_hits", "_folding").withColumn("held_out", remainder(key) == params.held_out)
    schema = StructType([*kept.schema.fields]).add("score", DoubleType()).add("predicted", IntegerType()).add("n_hits", IntegerType())
    return kept.withColumn("_folding", text_of(text)).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fit on the labelled rows that are not held out, then score every whole text of ``docs``; see ``score_texts``."""
    prepare(docs.sparkSession)
    return score_texts(docs, fit(docs, labels, params, key, text), params, key, text)
