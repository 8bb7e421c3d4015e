"""Near-duplicate documents by SuperMinHash.

A document is the set of its word shingles. Its signature holds, for each of m slots, the smallest rank that
any element gets there. An element's ranks are those of one random permutation of the slots plus a fraction,
so they are spread evenly over the slots instead of falling independently; this lowers the variance, and
lets the work stop as soon as no later rank can be smaller than what every slot has.

Bands of slots give buckets. Not all pairs of a bucket are made: members are compared with one of their bucket,
links join them, and only buckets that still hold several components are searched further, between
components, best pairs first. Every link is confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketshift.llm.common import map_rows, prepare, text_hash, text_of
from basketshift.llm.components import UnionFind, components
from basketshift.session import stage

GOLDEN, MIX_1, MIX_2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
FULL = np.uint32(0xFFFFFFFF)


@dataclass(frozen=True)
class MinHashParams:
    shingle: int = 2
    # Links: 100 * intersection >= percent * union.
    percent: int = 80
    # A pair at 80 % misses all bands with probability (1 - 0.8**5)**36 = 6e-7.
    bands: int = 36
    rows: int = 5
    # Agreement of signatures under which a pair is not confirmed: six standard deviations under 80 %.
    least_estimate: float = 0.62
    # First nodes of its buckets that a node is held against before any search.
    first_tries: int = 4
    # Members of a bucket that one task compares with as many others.
    block: int = 1000

    @property
    def slots(self) -> int:
        return self.bands * self.rows


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Distinct shingles of a text, as sorted 64-bit hashes."""

    def __init__(self, words: int, remembered: int = 150_000):
        self.words, self.remembered = words, remembered
        self.known: dict[bytes, int] = {}

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.remembered:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))

    def __call__(self, text: str) -> np.ndarray:
        """Words are runs without ASCII white space, A-Z in lower case; with fewer words than a shingle
        needs the whole sequence is one."""
        hashed = self._hashes(text.encode("utf-8").lower().split())
        n = len(hashed)
        if n == 0:
            return hashed
        k = min(self.words, n)
        out = np.full(n - k + 1, k, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for i in range(k):
                out = mix(out * GOLDEN + hashed[i:n - k + 1 + i])
        return np.unique(out)


def super_minhash(sets: list[np.ndarray], slots: int, most_elements: int = 1 << 16) -> np.ndarray:
    """The signatures of several sets, one row each: rank in the upper 8 bits, fraction in the lower 24.

    An empty set has all bits set everywhere. Sets are worked on together, level by level of their
    elements' permutations; a set leaves as soon as all its slots lie under the next level.
    """
    out = np.full((len(sets), slots), FULL, dtype=np.uint32)
    start = 0
    while start < len(sets):
        stop, elements = start + 1, len(sets[start])
        while stop < len(sets) and elements + len(sets[stop]) <= most_elements:
            elements += len(sets[stop])
            stop += 1
        _fill(out[start:stop], sets[start:stop], slots)
        start = stop
    return out


def _fill(out: np.ndarray, sets: list[np.ndarray], slots: int) -> None:
    element = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = out.reshape(-1)
    order = None  # each element's permutation so far
    with np.errstate(over="ignore"):
        for level in range(slots):
            if not len(element):
                return
            random = mix(element + np.uint64(level + 1) * GOLDEN)
            take = level + ((random & np.uint64(0xFFFFFFFF)) * np.uint64(slots - level) >> np.uint64(32)).astype(np.int64)
            if level == 0:
                slot = take
            else:
                if order is None:
                    order = np.tile(np.arange(slots, dtype=np.uint8), (len(element), 1))
                    first = mix(element + GOLDEN)
                    swap(order, 0, ((first & np.uint64(0xFFFFFFFF)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64))
                slot = swap(order, level, take)
            value = (random >> np.uint64(40)).astype(np.uint32) | np.uint32(level << 24)
            np.minimum.at(flat, owner * slots + slot, value)
            running = out.max(axis=1) >= np.uint32((level + 1) << 24)
            if not running.all():
                stays = running[owner]
                if not stays.all():
                    element, owner = element[stays], owner[stays]
                    order = order[stays] if order is not None else None


def swap(order: np.ndarray, level: int, take: np.ndarray) -> np.ndarray:
    """One step of a shuffle of every row: exchange places ``level`` and ``take``, return what comes to ``level``."""
    rows = np.arange(len(order))
    slot = order[rows, take]
    order[rows, take] = order[:, level]
    order[:, level] = slot
    return slot.astype(np.int64)


# A set is kept for confirmation as the upper bits of its sorted hashes. That two elements of a pair of sets agree
# in 38 bits by chance is as likely as one in a million pairs, and matters only for a pair at the very edge.
KEPT_BITS = np.uint64(38)


def pack(elements: np.ndarray) -> bytes:
    """A set as differences of 4 bytes; larger ones follow behind, in 8 bytes, with all bits set in their place."""
    steps = np.diff(elements >> np.uint64(64) - KEPT_BITS, prepend=np.uint64(0))
    wide = steps >= np.uint64(FULL)
    return len(steps).to_bytes(4, "little") + np.where(wide, np.uint64(FULL), steps).astype("<u4").tobytes() + steps[wide].astype("<u8").tobytes()


def unpack(packed: bytes) -> np.ndarray:
    n = int.from_bytes(packed[:4], "little")
    steps = np.frombuffer(packed, dtype="<u4", count=n, offset=4).astype(np.uint64)
    steps[steps == np.uint64(FULL)] = np.frombuffer(packed, dtype="<u8", offset=4 + 4 * n)
    return np.cumsum(steps, dtype=np.uint64)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets are similar enough. Exact."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)) or not len(a) or not len(b):
        return False
    places = np.searchsorted(a, b)
    common = int(np.count_nonzero(a[np.minimum(places, len(a) - 1)] == b))
    return 100 * common >= percent * (len(a) + len(b) - common)


SIGNED = "row_no bigint, key_id bigint, text_hash bigint, n_shingles bigint, set_key binary, band_keys array<bigint>, sketch binary, elements binary"


def sign(docs: DataFrame, params: MinHashParams, key: str, text: str) -> DataFrame:
    """One pass over the whole texts: set, signature (8 bits a slot) and bucket keys of every row."""

    def run(batches) -> Iterator[dict]:
        shingles = Shingler(params.shingle)
        for b in batches:
            sets = [shingles(t) for t in b["text"]]
            full = super_minhash(sets, params.slots)
            with np.errstate(over="ignore"):
                keys = np.tile(np.arange(1, params.bands + 1, dtype=np.uint64), (len(sets), 1))
                for r in range(params.rows):
                    keys = mix(keys * GOLDEN + full[:, r::params.rows].astype(np.uint64))
            keys = keys.view(np.int64)
            yield {"row_no": b["row_no"], "key_id": b["key_id"], "text_hash": b["text_hash"], "n_shingles": [len(s) for s in sets],
                   "set_key": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                   "band_keys": pa.array([keys[i] if len(s) else [] for i, s in enumerate(sets)], pa.list_(pa.int64())),
                   "sketch": [(row & np.uint32(0xFF)).astype(np.uint8).tobytes() for row in full], "elements": [pack(s) for s in sets]}

    rows = docs.select(F.monotonically_increasing_id().alias("row_no"), F.col(key).cast("bigint").alias("key_id"),
                       text_hash(text).alias("text_hash"), text_of(text).alias("text"))
    return map_rows(rows, run, SIGNED)


def confirm(pairs: DataFrame, sets: DataFrame, params: MinHashParams) -> DataFrame:
    """The distinct ``pairs`` (a, b) whose sets are similar enough.

    The pairs of a node b are cut into groups of about ``params.block``; to each group go the sets of its nodes a, after that of b.
    So a set moves once per group, not once per pair, and a node in very many pairs is many groups.
    """
    n_b = pairs.groupBy("b").agg(F.ceil(F.count("*") / params.block).cast("int").alias("groups"))
    dealt = pairs.select("a", "b").join(n_b, "b").select("a", "b", F.pmod(F.hash("a"), "groups").alias("part"))
    wanted = dealt.select(F.col("a").alias("node"), "b", "part").unionByName(dealt.select(F.col("b").alias("node"), "b", "part").distinct())
    ready = wanted.join(sets.select("node", "elements"), "node")

    def run(batches) -> Iterator[dict]:
        of, elements = None, None
        for batch in batches:
            a, b = [], []
            for node, other, part, packed in zip(batch["node"], batch["b"], batch["part"], batch["elements"], strict=True):
                if node == other:
                    of, elements = (other, part), unpack(packed)
                    continue
                assert of == (other, part), "the set of b comes first"
                if linked(unpack(packed), elements, params.percent):
                    a.append(node)
                    b.append(other)
            yield {"a": a, "b": b}

    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grouped = ready.repartition(n, "b", "part").sortWithinPartitions("b", "part", F.col("node") != F.col("b"))
    return map_rows(grouped, run, "a bigint, b bigint")


def near_pairs(members: DataFrame, nodes: DataFrame, params: MinHashParams) -> DataFrame:
    """Of the pairs of nodes in different components that share a bucket and whose signatures agree well enough, for each node in each
    task the best one (partner), and a forest that joins the nodes of all of them (root).

    ``members`` has bucket, node and comp, of buckets with several components. The largest component of a bucket is never
    compared with itself; it and the rest are cut into blocks, and a task compares two blocks. What comes out is one row per task and
    node, not one per pair.
    """
    parts = members.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    sizes = parts.groupBy("bucket").agg(F.max_by("comp", F.struct("n", "comp")).alias("top"), F.max("n").alias("n_top"), F.sum("n").alias("n_all"))
    blocks = lambda c: F.ceil(c / params.block).cast("int")
    placed = (members.join(sizes, "bucket").withColumn("in_top", F.col("comp") == F.col("top"))
              .withColumns({"top_blocks": blocks(F.col("n_top")), "rest_blocks": blocks(F.col("n_all") - F.col("n_top"))})
              .withColumn("own", F.when(F.col("in_top"), F.pmod(F.hash("node"), "top_blocks")).otherwise(
                  F.col("top_blocks") + F.pmod(F.hash("node"), "rest_blocks"))))
    every = F.sequence(F.lit(0), F.col("top_blocks") + F.col("rest_blocks") - 1)
    partner = F.explode(F.filter(every, lambda x: ~F.col("in_top") | (x >= F.col("top_blocks"))))
    spread = (placed.select("bucket", "node", "comp", "own", partner.alias("other"))
              .select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "comp"))
    ready = spread.join(nodes.select("node", "n_shingles", "sketch"), "node")

    def compare(batches) -> Iterator[dict]:
        held: dict[tuple, list] = {}
        for b in batches:
            for bucket, i, j, *row in zip(*(b[c] for c in ("bucket", "i", "j", "own", "node", "comp", "n_shingles", "sketch")), strict=True):
                held.setdefault((bucket, i, j), []).append(row)
        for (_, i, j), rows in held.items():
            left = [r for r in rows if r[0] == i]
            right = left if i == j else [r for r in rows if r[0] == j]
            if not left or not right:
                continue
            node, comp, size = (np.array([r[k] for r in right], dtype=np.int64) for k in (1, 2, 3))
            sketch = np.frombuffer(b"".join(r[4] for r in right), dtype=np.uint8).reshape(len(right), -1)
            best: dict[int, tuple[float, int]] = {}
            sets = UnionFind()
            for at, (_, x, c, n, s) in enumerate(left):
                fits = np.nonzero((comp != c) & (100 * np.minimum(size, n) >= params.percent * np.maximum(size, n)))[0]
                if i == j:
                    fits = fits[fits > at]
                if not len(fits):
                    continue
                agree = (sketch[fits] == np.frombuffer(s, dtype=np.uint8)).mean(axis=1)
                for k in np.nonzero(agree >= params.least_estimate)[0]:
                    y, now = int(node[fits[k]]), float(agree[k])
                    sets.join(x, y)
                    best[x] = max((now, y), best.get(x, (now, y)))
                    best[y] = max((now, x), best.get(y, (now, x)))
            yield {"node": list(best), "partner": [v[1] for v in best.values()], "estimate": [v[0] for v in best.values()],
                   "root": [sets.root(x) for x in best]}

    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_rows(ready.repartition(n, "bucket", "i", "j"), compare, "node bigint, partner bigint, estimate double, root bigint")


def last_links(near: DataFrame, nodes: DataFrame, params: MinHashParams) -> DataFrame:
    """Links (a, b) that join all components of a cluster that have any link between near nodes.

    ``near`` has cluster, node and comp, of clusters with several components. All nodes of a cluster meet, block by block, with their whole
    sets. A task passes over pairs that are in one component already, also by links that it has found itself.
    """
    sizes = near.groupBy("cluster").agg(F.ceil(F.count("*") / params.block).cast("int").alias("blocks"))
    placed = near.join(sizes, "cluster").withColumn("own", F.pmod(F.hash("node"), "blocks"))
    spread = (placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "comp"))
    ready = spread.join(nodes.select("node", "sketch", "elements"), "node")

    def search(batches) -> Iterator[dict]:
        held: dict[tuple, list] = {}
        for b in batches:
            for cluster, i, j, *row in zip(*(b[c] for c in ("cluster", "i", "j", "own", "node", "comp", "sketch", "elements")), strict=True):
                held.setdefault((cluster, i, j), []).append(row)
        for (_, i, j), rows in held.items():
            left = [r[1:] for r in rows if r[0] == i]
            pairs = list(_joining(left, left if i == j else [r[1:] for r in rows if r[0] == j], params))
            yield {"a": [max(p) for p in pairs], "b": [min(p) for p in pairs]}

    n = int(near.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_rows(ready.repartition(n, "cluster", "i", "j"), search, "a bigint, b bigint")


def _joining(left: list, right: list, params: MinHashParams) -> Iterator[tuple[int, int]]:
    """Links between rows (node, comp, sketch, elements) that join their components, one for each joining."""
    if not left or not right:
        return
    comp = np.array([r[1] for r in right], dtype=np.int64)
    sketch = np.frombuffer(b"".join(r[2] for r in right), dtype=np.uint8).reshape(len(right), -1)
    sets: list[np.ndarray | None] = [None] * len(right)
    joined = UnionFind()
    for at, (x, c, s, elements) in enumerate(left):
        apart = np.nonzero(comp != c)[0]
        if left is right:
            apart = apart[apart > at]
        good = apart[(sketch[apart] == np.frombuffer(s, dtype=np.uint8)).mean(axis=1) >= params.least_estimate] if len(apart) else apart
        mine = unpack(elements) if len(good) else None
        for k in good:
            if joined.root(c) == joined.root(int(comp[k])):
                continue
            if sets[k] is None:
                sets[k] = unpack(right[k][3])
            if linked(mine, sets[k], params.percent):
                joined.join(c, int(comp[k]))
                yield x, right[k][0]


def _with_roots(df: DataFrame, roots: DataFrame, node: str, out: str) -> DataFrame:
    """Adds the component of a node: its root, or itself if it has no link."""
    named = roots.select(F.col("node").alias(node), F.col("root").alias("_root"))
    return df.join(named, node, "left").withColumn(out, F.coalesce("_root", node)).drop("_root")


def find_links(nodes: DataFrame, params: MinHashParams) -> DataFrame:
    """Links (a, b) between ``nodes`` (node, n_shingles, band_keys, sketch, elements) whose components are those of all links.
    Only nodes that share a bucket with another one are read beyond their bucket keys.

    First every node is held against the first nodes, by a hash, of some of its buckets, and the components of the links are formed. Then
    buckets that hold several components are searched between these, and each node tries its best partner. Near nodes whose components are
    still apart after this form clusters, in which all components are compared in full. So a group of many near copies is
    joined by few trials per node, and yet no pair that could link two components stays untried.
    """
    in_bands = nodes.select("node", F.explode("band_keys").alias("bucket"))
    buckets = (in_bands.groupBy("bucket").agg(F.count("*").alias("n"), F.min_by("node", F.xxhash64("bucket", "node")).alias("first"))
               .where("n > 1").select("bucket", "first"))
    shared = stage(in_bands.join(buckets, "bucket"), "shared-buckets")
    nodes = stage(nodes.join(shared.select("node").distinct(), "node", "left_semi").drop("band_keys"), "near-nodes")
    met = (shared.where("node <> first").select(F.greatest("node", "first").alias("a"), F.least("node", "first").alias("b"), "node")
           .groupBy("node", "a", "b").agg(F.count("*").alias("met")))
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.col("met").desc(), "a", "b"))
    tried = stage(met.withColumn("rank", rank).where(F.col("rank") <= params.first_tries).select("a", "b").distinct(), "near-tries")
    links = stage(confirm(tried, nodes, params), "near-links")
    members = _with_roots(shared.select("bucket", "node"), components(links), "node", "comp")
    mixed = members.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("bucket")
    found = stage(near_pairs(stage(members.join(mixed, "bucket"), "mixed-buckets"), nodes, params), "near-candidates")
    best = (found.groupBy("node").agg(F.max_by("partner", F.struct("estimate", "partner")).alias("partner"))
            .select(F.greatest("node", "partner").alias("a"), F.least("node", "partner").alias("b")).distinct().join(tried, ["a", "b"], "left_anti"))
    links = stage(links.unionByName(confirm(best, nodes, params)), "near-links")

    forest = found.select(F.col("node").alias("a"), F.col("root").alias("b")).where("a <> b")
    near = _with_roots(_with_roots(found.select("node").distinct(), components(forest), "node", "cluster"), components(links), "node", "comp")
    several = near.groupBy("cluster").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("cluster")
    # Written, so that no task runs a Python worker for what reads the links beside the one that finds them.
    return stage(links.unionByName(last_links(stage(near.join(several, "cluster"), "near-clusters"), nodes, params)), "near-links")


def near_groups(docs: DataFrame, params: MinHashParams = MinHashParams(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """row_no, ``key``, text_hash, n_shingles, component_id (the smallest key that a row reaches by links) and first (true for one row of each
    component: the smallest key, of repeated keys the first row).

    One row per row of ``docs``. Rows of equal sets are one node and reach each other; a text without words (or null) has no
    shingles and reaches nothing. A null key counts as larger than all others, and component_id is null where all keys of a
    component are. Keys are integers; other columns are not read. An empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    signed = stage(sign(docs, params, key, text), "signatures")
    full = signed.where("n_shingles > 0")
    same = full.groupBy("set_key").agg(F.min("row_no").alias("node"))
    member_of = stage(full.select("row_no", "key_id", "set_key").join(same, "set_key").select("row_no", "key_id", "node"), "members")
    first_rows = member_of.where("row_no = node").select("row_no")
    nodes = (full.join(first_rows, "row_no", "left_semi")
             .select(F.col("row_no").alias("node"), "n_shingles", "band_keys", "sketch", "elements"))
    roots = components(find_links(nodes, params))
    rows = stage(_with_roots(member_of, roots, "node", "root"), "near-rows")
    order = F.struct(F.col("key_id").isNull(), F.col("key_id"), F.col("row_no"))
    least = rows.groupBy("root").agg(F.min(order).alias("least"))
    found = rows.join(least, "root").select("row_no", F.col("least.key_id").alias("component_id"), (F.col("row_no") == F.col("least.row_no")).alias("first"))
    return (signed.select("row_no", "key_id", "text_hash", "n_shingles").join(found, "row_no", "left")
            .select("row_no", F.col("key_id").alias(key), "text_hash", "n_shingles",
                    F.when(F.col("n_shingles") == 0, F.col("key_id")).otherwise(F.col("component_id")).alias("component_id"),
                    F.coalesce("first", F.lit(True)).alias("first")))
