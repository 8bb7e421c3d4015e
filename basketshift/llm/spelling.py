"""Spelling variants by blocked Gram matrices.

Words are points by their letter counts. One inserted or deleted letter moves a word by a squared distance of 1, one
replaced letter by 2, so near words are among the pairs at a squared distance of at most 2, of equal or adjacent length.
Blocks hold the words that take equally many letters from each of a few letter groups; near words lie in the same or in
adjacent blocks. The distances of two blocks come from one NumPy product of their letter-count matrices, and pairs that
are close enough are verified letter by letter.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketshift.llm.common import LOWER, UPPER, parts_for, prepare, spark_schema, text_of
from basketshift.session import stage


@dataclass(frozen=True)
class SpellingParams:
    # Words have at least so many letters and occurrences.
    letters: int = 7
    occurrences: int = 2
    # A form occurs at least so many times as often as its variant.
    ratio: int = 10
    # One run in so many, by the hash of document and run, loses a letter.
    misspelt: int = 31
    # Rows of the left and of the right matrix of one product.
    rows: int = 2048
    # Words that a block holds on average, within a factor of about 5: decides the number of letter groups.
    block_words: int = 256
    # Rows of one task of the products.
    task_rows: int = 150_000


def words(docs: DataFrame, params: SpellingParams = SpellingParams(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """word and n, its occurrences, of the words that are long and frequent enough.

    A null text has no runs; a null key counts as an empty one.
    """
    run = F.translate(F.col("run"), UPPER, LOWER)
    # Shorter runs cannot become words, so they are not taken out of the text at all.
    runs = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all(text_of(text), F.lit(f"[A-Za-zÀ-ÿ]{{{params.letters},}}+"), F.lit(0))).alias("run"),
    ).select("doc", run.alias("run"))
    h = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    word = F.when(F.col("h") % params.misspelt == 0,
                  F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))).otherwise(F.col("run"))
    found = runs.withColumn("h", h).select(word.alias("word")).where(F.length("word") >= params.letters)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= params.occurrences)


def letter_groups(counted: DataFrame, groups: int) -> list[str]:
    """The letters of all words in groups of nearly equal weight. There are at most 90 letters, so the driver may hold them."""
    seen = counted.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count().collect()
    out, weight = [""] * groups, [0] * groups
    for letter, n in sorted(seen, key=lambda r: (-r[1], r[0])):
        at = weight.index(min(weight))
        out[at] += letter
        weight[at] += n
    return out


def _block(counts: list[Column]) -> Column:
    return F.concat_ws(",", *counts)


def _cells(counted: DataFrame, groups: list[str], params: SpellingParams) -> DataFrame:
    """Rows of all products: a block's words, cut into chunks, on the left (side 0); on the right the words of the same
    block (side 1) and of the adjacent ones (side 2), once for each chunk.

    Of two adjacent blocks of one length, the right one gives a letter of an earlier group for one of a later group; of two
    lengths, the longer one is right. So every pair of blocks meets once.
    """
    c = [F.col(f"c{i}") for i in range(len(groups))]
    one = F.lit(1)

    def moved(up: int | None, down: int) -> Column:
        """The block with a letter less of group ``down`` and one more of group ``up``."""
        return F.when(c[down] > 0, _block([x + one if i == up else x - one if i == down else x for i, x in enumerate(c)]))

    same = [moved(i, j) for i in range(len(c)) for j in range(i + 1, len(c))]
    shorter = [moved(None, i) for i in range(len(c))]
    sized = counted.select("word", "n", *[(F.length("word") - F.length(F.translate("word", g, ""))).alias(f"c{i}") for i, g in enumerate(groups)])
    blocked = stage(sized.withColumn("block", _block(c)), "blocks")
    chunks = blocked.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / params.rows).cast("int").alias("chunks"))
    left = blocked.join(chunks, "block").select("block", F.pmod(F.xxhash64("word"), "chunks").cast("int").alias("chunk"), F.lit(0).alias("side"), "word", "n")
    targets = F.array_compact(F.array(
        F.struct(F.col("block").alias("block"), F.lit(1).alias("side")),
        *[F.when(t.isNotNull(), F.struct(t.alias("block"), F.lit(2).alias("side"))) for t in same + shorter]))
    sent = blocked.select(F.explode(targets).alias("to"), "word", "n").select("to.block", "to.side", "word", "n")
    right = sent.join(chunks, "block").select(
        "block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "side", "word", "n")
    return left.unionByName(right)


class _Words:
    """Words of one length as rows of letters, and the matrix of their letter counts."""

    def __init__(self, words: list[str], n: list[int]):
        self.words, self.n = words, n
        self.letters = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), -1)
        rows = np.arange(len(words))[:, None] * 256
        self.counts = np.bincount((rows + self.letters).ravel(), minlength=len(words) * 256).reshape(len(words), 256)
        self.squares = (self.counts * self.counts).sum(1)


def close_pairs(a: _Words, b: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and of b whose letter counts are at a squared distance of at most 2, by one product of their matrices."""
    used = np.nonzero(a.counts.any(0) | b.counts.any(0))[0]
    # Sums of squares up to 2 ** 24 are exact in single precision.
    kind = np.float32 if max(a.letters.shape[1], b.letters.shape[1]) <= 2000 else np.float64
    ones = np.ones((1, 1), dtype=kind)
    left = np.hstack([a.counts[:, used].astype(kind), a.squares[:, None].astype(kind), np.repeat(ones, len(a.words), 0)])
    right = np.hstack([b.counts[:, used].astype(kind) * -2, np.repeat(ones, len(b.words), 0), b.squares[:, None].astype(kind)])
    return np.nonzero(left @ right.T < 2.5)


def near_pairs(a: _Words, b: _Words) -> tuple[np.ndarray, np.ndarray]:
    """The close pairs that differ by exactly one replaced letter, or one more letter in b."""
    i, j = close_pairs(a, b)
    keep = np.zeros(len(i), dtype=bool)
    width = a.letters.shape[1]
    step = max(1, (1 << 23) // max(1, width))
    for s in range(0, len(i), step):
        x, y = a.letters[i[s:s + step]], b.letters[j[s:s + step]]
        if y.shape[1] == width:
            keep[s:s + step] = (x != y).sum(1) == 1
        else:
            head = np.logical_and.accumulate(x == y[:, :-1], axis=1).sum(1)
            tail = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(1)
            keep[s:s + step] = head + tail >= width
    return i[keep], j[keep]


class _Best:
    """Near words of each row of a matrix: how many, and the best, of largest n and then smallest."""

    def __init__(self):
        self.count: dict[str, int] = {}
        self.best: dict[str, tuple[int, str]] = {}

    def add(self, word: str, n: int, other: str) -> None:
        self.count[word] = self.count.get(word, 0) + 1
        # Letters are below U+0100, so Python's order is that of code points.
        if (found := (-n, other)) < self.best.get(word, (0, "")):
            self.best[word] = found

    def batch(self) -> dict[str, list]:
        names = list(self.count)
        return {"word": names, "n_near": [self.count[w] for w in names], "least": [self.best[w][0] for w in names],
                "other": [self.best[w][1] for w in names]}


def _pieces(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[tuple[tuple, list[str], list[int]]]:
    """Consecutive rows of one (block, chunk, side, length), at most ``rows`` at a time."""
    at, names, ns = None, [], []
    for b in batches:
        columns = (b.column(x).to_pylist() for x in ("block", "chunk", "side", "word", "n"))
        for block, chunk, side, word, n in zip(*columns, strict=True):
            here = (block, chunk, side, len(word))
            if here != at or len(names) == rows:
                if names:
                    yield at, names, ns
                at, names, ns = here, [], []
            names.append(word)
            ns.append(n)
    if names:
        yield at, names, ns


def near_words(counted: DataFrame, params: SpellingParams = SpellingParams()) -> DataFrame:
    """word, n_near (its near words) and other (that of largest n; ties: the smallest), of words with a near one.

    A left chunk is the only thing that a task holds; right rows stream past it in pieces. A chunk has ``params.rows`` words
    whatever the size of its block, so blocks are never gathered, and more words mean more letter groups, not larger blocks.
    """
    spark = counted.sparkSession
    total = counted.count()
    groups = max(4, round(math.log(max(1.0, total / params.block_words), 5)))
    cells = _cells(counted, letter_groups(counted, groups), params)
    schema = "word string, n_near bigint, least bigint, other string"
    target = spark_schema(spark, schema)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, left, mine = None, [], _Best()
        for (block, chunk, side, _), names, n in _pieces(batches, params.rows):
            if (block, chunk) != cell:
                if mine.count:
                    yield pa.RecordBatch.from_pydict(mine.batch(), schema=target)
                cell, left, mine = (block, chunk), [], _Best()
            here = _Words(names, n)
            if side == 0:
                # Chunks are dealt by hash: one may hold a few more words than a matrix has rows.
                left.append(here)
                continue
            theirs = _Best()
            for part in left:
                for i, j in zip(*(x.tolist() for x in near_pairs(part, here)), strict=True):
                    mine.add(part.words[i], n[j], names[j])
                    if side == 2:
                        theirs.add(names[j], part.n[i], part.words[i])
            if theirs.count:
                yield pa.RecordBatch.from_pydict(theirs.batch(), schema=target)
        if mine.count:
            yield pa.RecordBatch.from_pydict(mine.batch(), schema=target)

    copies = 2 + groups * (groups + 1) // 2
    tasks = parts_for(total * copies, params.task_rows, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = cells.repartition(tasks, "block", "chunk").sortWithinPartitions("block", "chunk", "side", F.length("word"))
    found = dealt.mapInArrow(multiply, schema)
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("least", "other")).alias("best")).select(
        "word", "n_near", (-F.col("best.least")).alias("other_n"), F.col("best.other").alias("other"))


def spelling_groups(docs: DataFrame, params: SpellingParams = SpellingParams(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of ``docs``.

    A word's form is its near word of largest n (ties: the smallest by code points) if that occurs ``params.ratio`` times
    as often, else null; its root is what following the forms ends at, or the word itself. Null and empty texts have no
    words, repeated rows count each time, an empty table gives no words, and other columns of ``docs`` are not read. Runs
    of any length are words.
    """
    prepare(docs.sparkSession)
    counted = stage(words(docs, params, key, text), "words")
    near = near_words(counted, params)
    formed = F.col("other_n") >= F.col("n") * params.ratio
    known = stage(counted.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("other")).alias("form"),
        F.when(formed, F.col("other_n")).alias("form_n")), "forms")
    # Every step to a form multiplies n, so the longest path is known; each round doubles the steps taken.
    top = known.agg(F.max("n")).first()[0] or 1
    steps = math.log(max(1.0, top / params.occurrences), params.ratio) if params.ratio > 1 else top
    roots = known.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(1.0, steps))))):
        roots = stage(roots, "roots")
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        roots = roots.join(further, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def statement() -> str:
    """DuckDB SQL for ``spelling_groups`` with its own parameters, over ``documents``."""
    return r"""
with recursive
crc_table as (
  select list(c order by i) as t from (
    select i, list_reduce(list_prepend(i, range(8)), lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) as c
    from (select unnest(range(256)) as i))),
runs as (
  select coalesce(cast(doc_id as varchar), '') as doc,
         translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
  from documents),
kinds as (select doc, run, count(*) as n from runs where length(run) >= 7 group by doc, run),
bytes as (select *, hex(encode(doc || ':' || run)) as x from kinds cross join crc_table),
hashed as (
  select doc, run, n,
         xor(list_reduce(list_prepend(4294967295, list_transform(range(length(x) // 2), lambda i: cast('0x' || substr(x, cast(2 * i + 1 as bigint), 2) as bigint))),
                         lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1])), 4294967295) as h
  from bytes),
spelt as (
  select case when h % 31 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word, n from hashed),
words as (select word, cast(sum(n) as bigint) as n from spelt where length(word) >= 7 group by word having sum(n) >= 2),
less as (
  select distinct word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
  from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
near as (
  select distinct a.word, a.n, b.word as other, b.n as other_n from less a join less b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union select a.word, a.n, b.word, b.n from words a join less b on a.word = b.rest
  union select b.word, b.n, a.word, a.n from words a join less b on a.word = b.rest),
best as (
  select word, count(*) as n_near, arg_min(other, (-other_n, encode(other))) as other, max(other_n) as other_n from near group by word),
formed as (
  select words.word, words.n, coalesce(n_near, 0) as n_near, case when other_n >= 10 * words.n then other end as form,
         case when other_n >= 10 * words.n then other_n end as form_n
  from words left join best on words.word = best.word),
paths as (
  select word, word as root, 0 as steps from formed
  union all select p.word, f.form, p.steps + 1 from paths p join formed f on p.root = f.word where f.form is not null),
roots as (select word, arg_max(root, steps) as root from paths group by word)
select f.word, form, root, n, n_near, form_n from formed f join roots r on f.word = r.word
"""
