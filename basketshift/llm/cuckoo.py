"""Exact deduplication through a cuckoo-filter index of live digests.

The index is cut into segments by digest. A segment is a cuckoo filter whose slots hold, beside
the short fingerprint, the entry itself: the full digest, the row that stays and the number of
live rows. A fingerprint that matches is only a hint; the full digest in that slot decides.
When an insertion finds no place after a bounded number of moves, the segment doubles and is
filled again from its stored digests.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketshift.llm.common import LOWER, UPPER, map_rows, parts_for, prepare, text_hash, text_of
from basketshift.session import stage

SLOTS = 4


class CuckooSegment:
    """Live digests of one segment: insertion, deletion and exact lookup."""

    def __init__(self, capacity: int = 64, max_moves: int = 200):
        self.max_moves = max_moves
        self.live = self.resizes = self.false_hits = 0
        self._turn = 1
        self._allot(1 << max(0, (capacity * 10 // (9 * SLOTS)).bit_length()))

    def _allot(self, buckets: int) -> None:
        self.mask = buckets - 1
        self.prints = bytearray(2 * SLOTS * buckets)
        self.prints = memoryview(self.prints).cast("H")
        self.entries: list[list | None] = [None] * (SLOTS * buckets)

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[8:10], "little") or 1
        first = int.from_bytes(digest[:8], "little") & self.mask
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x9E3779B1 & self.mask)

    def find(self, digest: bytes) -> int:
        """The slot of a live digest, or -1."""
        mark, first, second = self._places(digest)
        for bucket in (first, second) if second != first else (first,):
            for slot in range(SLOTS * bucket, SLOTS * bucket + SLOTS):
                if self.prints[slot] == mark:
                    if self.entries[slot][0] == digest:
                        return slot
                    self.false_hits += 1
        return -1

    def get(self, digest: bytes) -> list | None:
        slot = self.find(digest)
        return None if slot < 0 else self.entries[slot]

    def insert(self, digest: bytes, entry: list) -> list:
        """The stored entry of ``digest``: an earlier one if it is live, else ``entry``."""
        slot = self.find(digest)
        if slot >= 0:
            return self.entries[slot]
        self.live += 1
        self._place(entry)
        return entry

    def _place(self, entry: list) -> None:
        mark, first, second = self._places(entry[0])
        for bucket in (first, second):
            if self._put(bucket, mark, entry):
                return
        bucket = first
        for _ in range(self.max_moves):
            self._turn = self._turn * 1103515245 + 12345 & 0x7FFFFFFF
            slot = SLOTS * bucket + (self._turn >> 16) % SLOTS
            moved, moved_mark = self.entries[slot], self.prints[slot]
            self.entries[slot], self.prints[slot] = entry, mark
            entry, mark, bucket = moved, moved_mark, self._other(bucket, moved_mark)
            if self._put(bucket, mark, entry):
                return
        stored = [e for e in self.entries if e is not None]
        self.resizes += 1
        self._allot(2 * (self.mask + 1))
        for e in [*stored, entry]:
            self._place(e)

    def _put(self, bucket: int, mark: int, entry: list) -> bool:
        for slot in range(SLOTS * bucket, SLOTS * bucket + SLOTS):
            if self.entries[slot] is None:
                self.entries[slot], self.prints[slot] = entry, mark
                return True
        return False

    def delete(self, digest: bytes) -> list | None:
        """Remove a live digest and return its entry; None if it is not there."""
        slot = self.find(digest)
        if slot < 0:
            return None
        entry, self.entries[slot], self.prints[slot] = self.entries[slot], None, 0
        self.live -= 1
        return entry

    def __iter__(self) -> Iterator[list]:
        return (e for e in self.entries if e is not None)


INDEX = "segment int, digest binary, keep_id bigint, keep_row bigint, live bigint"


@dataclass(frozen=True)
class DedupParams:
    # Distinct digests aimed at per segment; a segment is held by one task.
    segment_keys: int = 100_000
    # Digests that a task sums up before it passes them on.
    buffer_keys: int = 50_000


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key_id, row_no (tells repeated rows apart), text_hash (of the text as it is) and the SHA-256 of each text with A-Z in lower case."""
    return docs.select(text_hash(text).alias("text_hash"), F.col(key).cast("bigint").alias("key_id"), F.monotonically_increasing_id().alias("row_no"),
                       F.unhex(F.sha2(F.translate(text_of(text), UPPER, LOWER), 256)).alias("digest"))


def _later(a: tuple, b: tuple) -> bool:
    """Whether row a = (key, row_no) stays rather than b; a null key is the smallest."""
    return (a[0] is not None, a[0] or 0, a[1]) > (b[0] is not None, b[0] or 0, b[1])


def _merge(entry: list, keep_id, keep_row: int, live: int) -> None:
    if _later((keep_id, keep_row), (entry[1], entry[2])):
        entry[1], entry[2] = keep_id, keep_row
    entry[3] += live


def _as_rows(entries, segments: int) -> dict[str, list]:
    entries = list(entries)
    return {"segment": [int.from_bytes(e[0][-4:], "little") % segments for e in entries], "digest": [e[0] for e in entries],
            "keep_id": [e[1] for e in entries], "keep_row": [e[2] for e in entries], "live": [e[3] for e in entries]}


def insert_all(hashed: DataFrame, segments: int, params: DedupParams = DedupParams(), index: DataFrame | None = None) -> DataFrame:
    """The index after inserting ``hashed`` (key_id, row_no, digest) into ``index`` (none: an empty one).

    Each task first sums up the digests it reads, so a group of copies sends one row per task and
    buffer, however large it is. Segments are then spread by digest.
    """

    def summed(batches) -> Iterator[dict]:
        held: dict[bytes, list] = {}
        for b in batches:
            for key, row, digest in zip(b["key_id"], b["row_no"], b["digest"], strict=True):
                entry = held.get(digest)
                if entry is None:
                    held[digest] = [digest, key, row, 1]
                else:
                    _merge(entry, key, row, 1)
            if len(held) >= params.buffer_keys:
                yield _as_rows(held.values(), segments)
                held.clear()
        yield _as_rows(held.values(), segments)

    def fill(batches) -> Iterator[dict]:
        held: dict[int, CuckooSegment] = {}
        for b in batches:
            for segment, *entry in zip(b["segment"], b["digest"], b["keep_id"], b["keep_row"], b["live"], strict=True):
                filled = held.setdefault(segment, CuckooSegment())
                stored = filled.insert(entry[0], entry)
                if stored is not entry:
                    _merge(stored, *entry[1:])
        for filled in held.values():
            yield _as_rows(filled, segments)

    rows = map_rows(hashed.select("key_id", "row_no", "digest"), summed, INDEX)
    if index is not None:
        rows = rows.unionByName(index)
    return map_rows(rows.repartition(segments, "segment"), fill, INDEX)


def delete_all(index: DataFrame, removed: DataFrame, left: DataFrame, segments: int, params: DedupParams = DedupParams()) -> DataFrame:
    """The index after the rows ``removed`` have gone; ``left`` holds the rows that stay in the table.

    Both have key_id, row_no and digest. A digest without live rows leaves its segment. Where the row
    that stayed is among the removed ones, the digest is deleted and inserted anew from ``left``.
    """
    gone = insert_all(removed, segments, params).withColumn("live", -F.col("live"))

    def drop(batches) -> Iterator[dict]:
        held: dict[int, CuckooSegment] = {}
        waiting: list[tuple] = []
        for b in batches:
            for segment, *entry in zip(b["segment"], b["digest"], b["keep_id"], b["keep_row"], b["live"], strict=True):
                if entry[3] > 0:
                    held.setdefault(segment, CuckooSegment()).insert(entry[0], entry)
                else:
                    waiting.append((segment, entry))
        stale = []
        for segment, entry in waiting:
            filled = held.get(segment)
            stored = filled.get(entry[0]) if filled else None
            if stored is None:
                continue
            stored[3] += entry[3]
            if stored[3] <= 0:
                filled.delete(entry[0])
            elif (stored[1], stored[2]) == (entry[1], entry[2]):
                filled.delete(entry[0])
                stale.append([entry[0], None, -1, 0])
        for filled in held.values():
            yield _as_rows(filled, segments)
        yield _as_rows(stale, segments)

    after = stage(map_rows(index.unionByName(gone).repartition(segments, "segment"), drop, INDEX), "cuckoo-deleted")
    stale = after.where("live = 0").select("digest")
    again = left.join(stale, "digest", "left_semi")
    return insert_all(again, segments, params, after.where("live > 0"))


def segments_for(rows: int, spark, params: DedupParams = DedupParams()) -> int:
    return parts_for(rows, params.segment_keys, int(spark.conf.get("spark.sql.shuffle.partitions")))


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", params: DedupParams = DedupParams()) -> DataFrame:
    """One row per row of ``docs``: ``key``, row_no, text_hash, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical after lower-casing A-Z. Of equal texts the row of the largest key
    stays; a null key is smaller than all others, and of rows with the same key and text exactly one
    stays (keep_id is null where all keys of the group are). Null texts count as empty, and all empty
    texts are equal. An empty table gives an empty result; other columns are not read. Keys are
    integers.

    Texts are read and hashed once, in the JVM; what moves afterwards is 48 bytes a row. The last
    join has the hot groups on one side only, where adaptive execution can split them.
    """
    spark = docs.sparkSession
    prepare(spark)
    hashed = stage(digests(docs, key, text), "digests")
    index = insert_all(hashed, segments_for(hashed.count(), spark, params), params)
    return (hashed.join(index.select("digest", "keep_id", "keep_row", "live"), "digest")
            .select(F.col("key_id").alias(key), "row_no", "text_hash", "keep_id", F.col("live").alias("group_size"),
                    (F.col("row_no") == F.col("keep_row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")))
