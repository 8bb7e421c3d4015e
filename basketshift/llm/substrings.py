"""Repeated passages by difference-cover anchors.

A passage is a window of ``window`` words. Hashing every window of a corpus would move every word's position. Instead
shorter windows, the anchors, are hashed at the positions of a document that lie in a difference cover modulo a period: for any
two positions some shift below the period moves both into the cover. So two equal passages, wherever they start, hold an equal anchor
at the same distance from their starts. Anchors that occur once rule their surroundings out; what holds a repeated one is extended to
whole windows, whose 96-bit hashes decide which of them start earlier elsewhere.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketshift.llm.common import parts_for, prepare, spark_schema, text_hash, text_of
from basketshift.llm.minhash import mix
from basketshift.session import stage

LOW = -(1 << 63)
# Distinct words whose hashes a worker remembers, and bytes of text that it works on at once.
MEMORY, SLICE_BYTES = 300_000, 4 << 20
# Bytes of text in which one anchor is looked for, about.
BYTES_PER_ANCHOR = 20
# Bits of one row of the anchor filter.
CHUNK = 1 << 16


@dataclass(frozen=True)
class SubstringParams:
    # Words of a passage.
    window: int = 20
    # A difference cover modulo the period; an anchor has window - period + 1 words.
    period: int = 13
    cover: tuple[int, ...] = (0, 1, 3, 9)
    # The anchor filter has this many bits for each repeated anchor, and 2 ** most_bits (32 MB) in all at most. A fuller
    # filter lets more windows be judged, and changes no result.
    bits: int = 32
    most_bits: int = 28
    # Passages, or anchors, of one bucket of hashes.
    bucket_rows: int = 400_000

    def __post_init__(self):
        if not 0 < self.period <= self.window:
            raise ValueError("the period must lie between 1 and the window's words")
        met = {(a - b) % self.period for a in self.cover for b in self.cover}
        if met != set(range(self.period)):
            raise ValueError(f"{self.cover} is no difference cover modulo {self.period}")

    @property
    def anchor(self) -> int:
        return self.window - self.period + 1


def _multipliers(n: int, salt: int) -> np.ndarray:
    """n odd 64-bit numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 32)) | np.uint64(1)


class WordHashes(dict):
    """Two 64-bit hashes of each word; words met before are looked up."""

    def __init__(self):
        super().__init__()
        self.digests = bytearray()

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self)
        self.digests += xxhash.xxh3_128_digest(word)
        return at

    def of(self, words: Iterable[bytes], n: int) -> np.ndarray:
        """An array of two columns."""
        if len(self) > MEMORY:
            self.clear()
            self.digests = bytearray()
        at = np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=n)
        return np.frombuffer(bytes(self.digests), dtype="<u8").reshape(-1, 2)[at]


def _slices(b: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """First row and texts of consecutive rows of about SLICE_BYTES."""
    texts = b.column("text").cast(pa.binary())
    start = size = 0
    for i in range(len(texts)):
        size += len(texts[i].as_buffer())
        if size >= SLICE_BYTES or i == len(texts) - 1:
            yield start, texts.slice(start, i + 1 - start).to_pylist()
            start, size = i + 1, 0


class Passages:
    """The words of some texts on end, with where each text starts and ends."""

    def __init__(self, texts: list[bytes], hashes: WordHashes, params: SubstringParams):
        self.params = params
        # White space of bytes is exactly \x20 and \x09 to \x0D.
        self.words = [t.split() for t in texts]
        self.sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.total = int(self.ends[-1]) if len(texts) else 0
        self.hashed = hashes.of(chain.from_iterable(self.words), self.total)
        self.text = np.repeat(np.arange(len(texts)), self.sizes)

    def _hash(self, at: np.ndarray, n: int, column: int, salt: int) -> np.ndarray:
        """Hashes of the n words from each place."""
        out, source = np.zeros(len(at), dtype=np.uint64), self.hashed[:, column]
        for i, m in enumerate(_multipliers(n, salt)):
            out += source[at + i] * m
        return mix(out)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the anchors of texts that have a passage, and their hashes."""
        at = np.arange(self.total)
        own = at - self.starts[self.text]
        fits = (own + self.params.anchor <= self.sizes[self.text]) & (self.sizes[self.text] >= self.params.window)
        at = at[fits & np.isin(own % self.params.period, self.params.cover)]
        return at, self._hash(at, self.params.anchor, 0, 1)

    def around(self, anchors: np.ndarray) -> np.ndarray:
        """Starts of the passages that hold one of the given anchors at a distance below the period."""
        text = self.text[anchors]
        first = np.maximum(anchors - (self.params.period - 1), self.starts[text])
        last = np.minimum(anchors, self.ends[text] - self.params.window)
        change = np.bincount(first, minlength=self.total + 1) - np.bincount(last + 1, minlength=self.total + 1)
        return np.nonzero(np.cumsum(change) > 0)[0]

    def passages(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of the passages at the given starts."""
        return self._hash(at, self.params.window, 0, 2), self._hash(at, self.params.window, 1, 3)


class AnchorFilter:
    """Which anchors may be repeated: two bits for each, of a fixed number of bits."""

    def __init__(self, bits: int, data: bytes):
        self.bits, self.data = bits, np.frombuffer(data, dtype=np.uint8)

    @staticmethod
    def places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64((1 << bits) - 1)
        return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        a, b = self.places(hashes, self.bits)
        return ((self.data[a >> 3] >> (a & 7)) & (self.data[b >> 3] >> (b & 7)) & 1).astype(bool)


def _packed(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    """The columns as bytes, apart for each bucket."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    ids, starts = np.unique(bucket[order], return_index=True)
    for i, s, e in zip(ids.tolist(), starts.tolist(), [*starts[1:].tolist(), len(order)], strict=True):
        yield i, [c[order[s:e]].tobytes() for c in columns]


def repeated_anchors(texts: DataFrame, params: SubstringParams) -> DataFrame:
    """h, the hash of every anchor that occurs more than once.

    A task sends the anchors of a slice of its texts packed, apart for each bucket of hashes: once, or twice if the slice repeats them.
    There are as many buckets as keep a bucket near ``bucket_rows``, whatever the size of the corpus.
    """
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = parts_for(size, BYTES_PER_ANCHOR * params.bucket_rows, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            for _, part in _slices(b):
                h, n = np.unique(Passages(part, hashes, params).anchors()[1], return_counts=True)
                h = np.concatenate([h, h[n > 1]])
                parts = list(_packed((h % np.uint64(buckets)).astype(np.int64), h))
                yield pa.RecordBatch.from_pydict({"bucket": pa.array([x[0] for x in parts], pa.int32()), "packed": pa.array([x[1][0] for x in parts], pa.binary())})

    def repeated(t: pa.Table) -> pa.Table:
        h = np.sort(np.frombuffer(b"".join(t["packed"].to_pylist()), dtype=np.uint64))
        return pa.table({"h": np.unique(h[1:][h[1:] == h[:-1]]).view(np.int64)})

    return texts.mapInArrow(run, "bucket int, packed binary").groupBy("bucket").applyInArrow(repeated, "h bigint")


def anchor_filter(repeated: DataFrame, params: SubstringParams) -> AnchorFilter:
    """The filter of all repeated anchors, built in pieces of CHUNK bits by the tasks. The driver holds it whole: 2 ** most_bits bits."""
    repeated = stage(repeated, "anchors")
    bits = min(params.most_bits, max(16, int(repeated.count() * params.bits).bit_length()))
    schema = "chunk int, data binary"
    target = spark_schema(repeated.sparkSession, schema)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.unique(np.concatenate(AnchorFilter.places(b.column("h").to_numpy().view(np.uint64), bits)))
            yield pa.RecordBatch.from_arrays([pa.array((at // CHUNK).astype("int32")), pa.array((at % CHUNK).astype("int32"))], names=["chunk", "at"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, data = None, None
        for b in batches:
            ids, at = b.column("chunk").to_numpy(), b.column("at").to_numpy()
            for c in np.unique(ids).tolist():
                if c != chunk:
                    if chunk is not None:
                        yield pa.RecordBatch.from_pydict({"chunk": [chunk], "data": [np.packbits(data, bitorder="little").tobytes()]}, schema=target)
                    chunk, data = c, np.zeros(CHUNK, dtype=np.uint8)
                data[at[ids == c]] = 1
        if chunk is not None:
            yield pa.RecordBatch.from_pydict({"chunk": [chunk], "data": [np.packbits(data, bitorder="little").tobytes()]}, schema=target)

    spread = repeated.mapInArrow(places, "chunk int, at int").repartition("chunk").sortWithinPartitions("chunk")
    whole = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for r in spread.mapInArrow(fill, schema).toLocalIterator():
        whole[r["chunk"] * CHUNK // 8:(r["chunk"] + 1) * CHUNK // 8] = np.frombuffer(r["data"], dtype=np.uint8)
    return AnchorFilter(bits, whole.tobytes())


def _firsts(judged: DataFrame, params: SubstringParams) -> DataFrame:
    """row and places: the starts of the passages in question that start nowhere earlier, for each row that has any.

    A slice of texts sends each passage once, at its earliest start, so one that a third of all documents hold arrives once
    a slice. Only first starts are sent on: no passage's occurrences are ever gathered.
    """
    spark = judged.sparkSession
    asked = judged.where("asked is not null")
    total = asked.agg(F.sum(F.octet_length("asked") / 4)).first()[0] or 0
    buckets = parts_for(int(total), params.bucket_rows, int(spark.conf.get("spark.sql.shuffle.partitions")))
    fields = {"docs": np.dtype([("k", "<i8"), ("h", "<i8"), ("row", "<i8")]), "a": np.dtype("<u8"), "b": np.dtype("<u4"), "doc": np.dtype("<u4"), "place": np.dtype("<i4")}
    schema = "bucket int, " + ", ".join(f"{n} binary" for n in fields)
    target = spark_schema(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            keys = [batch.column(c).to_numpy() for c in ("row", "h", "k")]
            # In order of the documents, so that the first of equal passages is the earliest.
            batch = batch.take(pa.array(np.lexsort(keys)))
            texts = [zlib.decompress(t) for t in batch.column("text").to_pylist()]
            batch = pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("k", "h", "row", "asked")), pa.array(texts, pa.binary())], names=["k", "h", "row", "asked", "text"])
            for start, part in _slices(batch):
                p = Passages(part, hashes, params)
                docs = np.zeros(len(part), dtype=fields["docs"])
                for c in ("k", "h", "row"):
                    docs[c] = batch.column(c)[start:start + len(part)].to_numpy()
                places = [np.frombuffer(x, dtype="<i4") for x in batch.column("asked")[start:start + len(part)].to_pylist()]
                at = np.concatenate([x + s for x, s in zip(places, p.starts.tolist(), strict=True)])
                a, b = p.passages(at)
                b = b.astype(np.uint32)
                same = np.lexsort((b, a))
                new = np.ones(len(same), dtype=bool)
                new[1:] = (a[same][1:] != a[same][:-1]) | (b[same][1:] != b[same][:-1])
                least = same[new]
                doc = p.text[at[least]]
                place = (at[least] - p.starts[doc]).astype("<i4")
                out = {"bucket": [], **{n: [] for n in fields}}
                for bucket, columns in _packed((a[least] % np.uint64(buckets)).astype(np.int64), a[least], b[least], doc.astype("<u4"), place):
                    # Of the slice's documents only those that this bucket has passages of.
                    used, index = np.unique(np.frombuffer(columns[2], dtype="<u4"), return_inverse=True)
                    columns[2] = index.astype("<u4").tobytes()
                    out["bucket"].append(bucket)
                    for n, c in zip(fields, [docs[used].tobytes(), *columns], strict=True):
                        out[n].append(c)
                yield pa.RecordBatch.from_pydict(out, schema=target)

    def first(t: pa.Table) -> pa.Table:
        parts = [[np.frombuffer(x, dtype=d) for x in t[n].to_pylist()] for n, d in fields.items()]
        docs = np.concatenate([d[i] for d, i in zip(parts[0], parts[3], strict=True)])
        a, b, place = (np.concatenate(parts[i]) for i in (1, 2, 4))
        order = np.lexsort((place, docs["row"], docs["h"], docs["k"], b, a))
        a, b = a[order], b[order]
        new = np.ones(len(a), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        row, place = docs["row"][order[new]], place[order[new]]
        by_row = np.argsort(row, kind="stable")
        return pa.table({"row": row[by_row], "place": place[by_row]})

    sent = asked.select("row", "k", "h", "text", "asked").mapInArrow(run, schema)
    return sent.groupBy("bucket").applyInArrow(first, "row bigint, place int").groupBy("row").agg(F.collect_list("place").alias("places"))


def _judged(keyed: DataFrame, shared: Broadcast, bits: int, params: SubstringParams, with_text: bool) -> DataFrame:
    """Every document: final if no passage of it can be repeated; else with its text, packed, and the passages in question."""
    schema = "doc bigint, k bigint, h bigint, n_words bigint, sha string, kept string, text binary, asked binary"
    target = spark_schema(keyed.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, repeated = WordHashes(), AnchorFilter(bits, shared.value)
        for batch in batches:
            for start, part in _slices(batch):
                p = Passages(part, hashes, params)
                at, anchor = p.anchors()
                at = p.around(at[repeated.may_hold(anchor)])
                cuts = np.searchsorted(at, p.ends).tolist()
                sha, kept, text, asked, last = [], [], [], [], 0
                for i, cut in enumerate(cuts):
                    open_ = cut > last
                    joined = None if open_ else b" ".join(p.words[i])
                    sha.append(None if open_ else hashlib.sha256(joined).hexdigest())
                    kept.append(joined.decode() if with_text and not open_ else None)
                    text.append(zlib.compress(part[i], 1) if open_ else None)
                    asked.append((at[last:cut] - p.starts[i]).astype("<i4").tobytes() if open_ else None)
                    last = cut
                rows = slice(start, start + len(part))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c)[rows] for c in ("doc", "k", "h")] +
                    [pa.array(p.sizes), pa.array(sha, pa.string()), pa.array(kept, pa.string()), pa.array(text, pa.binary()), pa.array(asked, pa.binary())],
                    schema=target)

    return keyed.mapInArrow(run, schema)


def covered(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which of n words lie in a passage that starts at one of ``starts``."""
    change = np.bincount(starts, minlength=n + 1) - np.bincount(starts + window, minlength=n + 1)
    return np.cumsum(change)[:n] > 0


def remove_repeats(docs: DataFrame, params: SubstringParams = SubstringParams(), key: str = "doc_id", text: str = "text",
                   with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words left, joined by one space; null unless ``with_text``) and kept_sha256 of every row.

    A word goes if a passage that covers it also starts earlier: in a document of smaller id, or earlier in the same one. Null
    ids come first; documents of one id are ordered by a hash of their text. Of rows equal in id and text one counts, and all passages of the others
    start earlier. Null and empty texts have no words; texts shorter than a passage lose nothing. An empty table gives an empty
    result; other columns of ``docs`` are not read. Texts of any length are read whole.

    Texts are read twice; those without any repeated anchor are done then. The others are written packed, read again for their passages, and move
    once. Passages count as equal if 96 bits of hashes of their words do; in 10^12 passages the chance of any mistake is 10^-5.
    """
    spark: SparkSession = docs.sparkSession
    prepare(spark)
    keyed = docs.select(F.col(key).cast("bigint").alias("doc"), F.coalesce(F.col(key).cast("bigint"), F.lit(LOW)).alias("k"),
                        text_hash(text).alias("h"), text_of(text).alias("text"))
    found = anchor_filter(repeated_anchors(keyed.select("text"), params), params)
    shared, bits = spark.sparkContext.broadcast(found.data.tobytes()), found.bits
    judged = stage(_judged(keyed, shared, bits, params, with_text).withColumn("row", F.monotonically_increasing_id()), "judged")
    owned = _firsts(judged, params)
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept string, kept_sha256 string"
    target = spark_schema(spark, schema)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {"doc_id": b.column("doc"), "n_words": b.column("n_words"), "n_removed": [], "kept": [], "kept_sha256": []}
            for i, (sha, kept, raw, asked) in enumerate(zip(*(b.column(c).to_pylist() for c in ("sha", "kept", "text", "asked")), strict=True)):
                removed = 0
                if asked is not None:
                    words = zlib.decompress(raw).split()
                    places = b.column("places")[i].values
                    first = np.zeros(0, dtype=np.int32) if places is None else places.to_numpy()
                    gone = covered(len(words), np.setdiff1d(np.frombuffer(asked, dtype="<i4"), first, assume_unique=True), params.window)
                    removed = int(gone.sum())
                    left = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                    sha, kept = hashlib.sha256(left).hexdigest(), left.decode() if with_text else None
                out["n_removed"].append(removed)
                out["kept"].append(kept)
                out["kept_sha256"].append(sha)
            yield pa.RecordBatch.from_pydict(out, schema=target)

    return judged.join(owned, "row", "left").select("doc", "n_words", "sha", "kept", "text", "asked", "places").mapInArrow(finish, schema)


def statement() -> str:
    """DuckDB SQL for the query over ``documents``, with the default window."""
    return r"""
with texts as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
starts as (
  select doc_id, s, array_to_string(w[s:s + 19], ' ') as passage
  from (select doc_id, w, unnest(range(1, len(w) - 18)) as s from texts where len(w) >= 20)),
later as (select doc_id, s from (select *, row_number() over (partition by passage order by doc_id, s) as r from starts) where r > 1),
gone as (select distinct doc_id, unnest(range(s, s + 20)) as i from later),
words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from texts),
kept as (select doc_id, string_agg(word, ' ' order by i) as left_, count(*) as n from words anti join gone using (doc_id, i) group by doc_id)
select t.doc_id, cast(len(w) as bigint) as n_words, cast(len(w) - coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(left_, '')) as kept_sha256
from texts t left join kept using (doc_id)
"""
