"""Exact and near copies, and shards, against brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest

from basketshift.llm import cuckoo, histogram_sort, minhash
from basketshift.llm.common import keep_rows
from basketshift.llm.components import UnionFind, components
from tests.llm.cases import ROWS, documents


def lower(text):
    return (text or "").encode().lower()


def test_cuckoo_segment_inserts_deletes_and_resizes():
    rng, live, segment = random.Random(1), {}, cuckoo.CuckooSegment(4)
    for step in range(6000):
        digest = hashlib.sha256(bytes([rng.randrange(3)]) + rng.randrange(1500).to_bytes(2, "big")).digest()
        if rng.random() < 0.6:
            entry = [digest, step, step, 1]
            assert (segment.insert(digest, entry) is entry) == (digest not in live)
            live.setdefault(digest, entry)
        else:
            assert segment.delete(digest) is live.pop(digest, None)
    assert segment.resizes > 3 and segment.live == len(live) and {e[0] for e in segment} == set(live)
    assert all(segment.get(d) is e for d, e in live.items())


def test_cuckoo_false_hit_is_verified():
    segment = cuckoo.CuckooSegment(64)
    a = b"\x01" * 32
    segment.insert(a, [a, 1, 1, 1])
    same_print = a[:10] + b"\x02" * 22
    assert segment.find(same_print) == -1 and segment.false_hits == 1
    segment.insert(same_print, [same_print, 2, 2, 1])
    assert segment.get(a)[1] == 1 and segment.get(same_print)[1] == 2


def test_cuckoo_overflow_of_one_bucket_pair_keeps_all():
    """More keys with one print and place than two buckets hold: doubling must go on until they part."""
    segment = cuckoo.CuckooSegment(4, max_moves=20)
    keys = [(i << 40).to_bytes(8, "little") + bytes([9, 9]) + bytes(22) for i in range(8)]
    for k in keys:
        segment.insert(k, [k, 0, 0, 1])
    assert {e[0] for e in segment} == set(keys)


def test_exact_dedup(spark):
    rows = ROWS + [(100 + i, "Hot copy" if i % 2 else "hot COPY", "x") for i in range(300)]
    got = cuckoo.exact_dedup(documents(spark, rows)).collect()
    groups = collections.defaultdict(list)
    for i, t, _ in rows:
        groups[hashlib.sha256(lower(t)).hexdigest()].append(i)
    assert len(got) == len(rows)
    for r in got:
        ids = groups[r.text_sha256]
        assert r.group_size == len(ids) and r.keep_id == max((i for i in ids if i is not None), default=None)
    kept = collections.Counter(r.text_sha256 for r in got if r.kept)
    assert kept == dict.fromkeys(groups, 1)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_dedup_of_nothing(spark):
    assert cuckoo.exact_dedup(documents(spark, ROWS).where("false")).count() == 0


def test_index_takes_deletions(spark):
    docs = cuckoo.stage(cuckoo.digests(documents(spark, [(i, f"text {i % 7}", "x") for i in range(40)])), "t")
    index = cuckoo.stage(cuckoo.insert_all(docs, 4), "t")
    gone, left = docs.where("key_id >= 30 or key_id % 7 = 3"), docs.where("key_id < 30 and key_id % 7 <> 3")
    after = {bytes(r.digest): (r.keep_id, r.live) for r in cuckoo.delete_all(index, gone, left, 4).collect()}
    want = collections.defaultdict(list)
    for r in left.collect():
        want[bytes(r.digest)].append(r.key_id)
    assert after == {d: (max(v), len(v)) for d, v in want.items()}


def test_keep_rows_keeps_one_of_repeated_rows(spark):
    docs = documents(spark)
    got = keep_rows(docs, cuckoo.exact_dedup(docs).where("kept"))
    assert got.columns == docs.columns
    assert sorted(lower(r.text) for r in got.collect()) == sorted({lower(t) for _, t, _ in ROWS})


def brute_groups(rows, k, percent=80):
    sets = []
    for _, t, _ in rows:
        w = lower(t).split()
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    sets_of = UnionFind()
    for i, a in enumerate(sets):
        sets_of.root(i)
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                sets_of.join(i, j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[sets_of.root(i)] = min(least.get(sets_of.root(i), 1 << 60), r[0])
    return [(r[0], len(sets[i]), least.get(sets_of.root(i)) if sets[i] else r[0]) for i, r in enumerate(rows)]


def near_rows():
    rng, rows, n = random.Random(4), list(ROWS), 1000
    for group in range(12):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([6, 25, 60, 200]))]
        for _ in range(rng.choice([1, 2, 12, 40])):
            own = list(words)
            for _ in range(rng.randrange(1 + len(own) // 12)):
                own[rng.randrange(len(own))] = f"v{rng.randrange(10**6)}"
            rows.append((n, " ".join(own), "x"))
            n += 1
    # A chain: each text is near the next one, its ends are far apart.
    words = [f"c{i}" for i in range(100)]
    for i in range(20):
        words[5 * i:5 * i + 5] = [f"d{i}{j}" for j in range(5)]
        rows.append((n, " ".join(words), "x"))
        n += 1
    return rows


@pytest.mark.parametrize("shingle", [2, 5])
def test_near_groups(spark, shingle):
    rows = near_rows()
    got = minhash.near_groups(documents(spark, rows), minhash.MinHashParams(shingle=shingle, block=7)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == sorted(brute_groups(rows, shingle), key=str)
    firsts = collections.Counter(r.component_id for r in got if r["first"] and r.n_shingles)
    assert set(firsts.values()) == {1}


def test_links_are_found_by_one_python_worker_a_task(spark, monkeypatch):
    """What unites the links reads them written: a second worker beside the one that finds them would live on."""
    given = []
    monkeypatch.setattr(minhash, "components", lambda links: given.append(links) or components(links))
    minhash.near_groups(documents(spark, near_rows()), minhash.MinHashParams(shingle=2, block=7))
    assert given and not any("MapInArrow" in links._jdf.queryExecution().toString() for links in given)


def test_near_groups_of_nothing(spark):
    assert minhash.near_groups(documents(spark).where("false")).count() == 0


def test_super_minhash_is_unbiased_and_less_scattered():
    rng, off, plain = np.random.default_rng(2), [], []
    for _ in range(300):
        u = np.unique(rng.integers(0, 1 << 63, 60, dtype=np.uint64))
        rng.shuffle(u)
        a, b = np.sort(u[:40]), np.sort(u[10:50])
        s = minhash.super_minhash([a, b], 180)
        off.append((s[0] == s[1]).mean() - 0.6)
        assert (minhash.super_minhash([b], 180)[0] == s[1]).all()
        plain.append((0.6 * 0.4 / 180) ** 0.5)
    assert abs(np.mean(off)) < 0.01 and np.std(off) < 0.9 * plain[0]


def test_packed_sets_survive():
    for n in (0, 1, 700):
        x = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n, dtype=np.uint64))
        assert (minhash.unpack(minhash.pack(x)) == x >> np.uint64(26)).all()


def test_components_of_paths_stars_and_cycles(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 180)] + [(7, i) for i in range(200, 260)] + [(5, 6), (6, 5), (5, 5)]
    links += [(rng.randrange(1000, 1300), rng.randrange(1000, 1300)) for _ in range(200)]
    sets = UnionFind()
    for a, b in links:
        sets.join(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint").repartition(6)).collect()}
    assert got == {n: sets.root(n) for n in list(sets.parent) if sets.root(n) != n}


@pytest.mark.parametrize("part_bytes", [1 << 20, 500])
def test_shards(spark, part_bytes):
    rows = ROWS[:4] + ROWS[7:] + [(100 + i, f"some text {i} " * (i % 9), "x") for i in range(400)] + [(1000 + i, "hot text", "x") for i in range(300)]
    params = histogram_sort.SortParams(shards=5, part_bytes=part_bytes)
    got = histogram_sort.shard(documents(spark, rows), params).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(((r[0], r[1]) for r in rows), key=str)
    size, slots = collections.Counter(), collections.defaultdict(list)
    for r in got:
        assert r.size == len((r.text or "").encode()) + 8
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    largest = max(r.size for r in got)
    assert set(size) == set(range(5)) and max(size.values()) - min(size.values()) <= 2 * largest + 2
    assert sum(zlib.crc32((r.text or "").encode()) for r in got) > 0


def test_rows_that_agree_in_text_and_id_are_cut(spark):
    rows = [(None if i % 2 else 5, "the same text", "x") for i in range(4000)] + [(10 + i, f"other {i}", "x") for i in range(400)]
    got = histogram_sort.shard(documents(spark, rows), histogram_sort.SortParams(shards=24)).collect()
    sizes, slots = collections.Counter(), collections.defaultdict(list)
    for r in got:
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert len(got) == 4400 and len(sizes) == 24 and max(sizes.values()) - min(sizes.values()) <= 2 * 21
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_equal_a_sort(spark):
    """Against cutting the sorted list of sizes at the targets."""
    rng = random.Random(9)
    rows = [(rng.choice([None, i, 7]), "w " * rng.randrange(60), "x") for i in range(500)]
    for _ in range(2):
        got = histogram_sort.shard(documents(spark, rows), histogram_sort.SortParams(shards=6, tolerance=0.0)).collect()
        total = sum(r["size"] for r in got)
        below = 0
        for s in range(6):
            below += sum(r["size"] for r in got if r.shard == s)
            assert abs(below - total * (s + 1) / 6) <= max(r["size"] for r in got)


def test_columns_of_any_name_are_kept(spark):
    docs = documents(spark, ROWS).selectExpr("doc_id", "text", "lang as _h", "row_no as _part", "segment as `_boxed`", "score as `a.b`")
    got = histogram_sort.shard(docs)
    assert got.columns == [*docs.columns, "size", "shard", "slot"]
    assert sorted(map(str, got.select(*[f"`{c}`" for c in docs.columns]).collect())) == sorted(map(str, docs.collect()))


def test_shards_of_nothing_and_of_one_row(spark):
    assert histogram_sort.shard(documents(spark).where("false")).count() == 0
    assert [(r.slot, r["size"]) for r in histogram_sort.shard(documents(spark, ROWS[2:3])).collect()] == [(0, 8)]
