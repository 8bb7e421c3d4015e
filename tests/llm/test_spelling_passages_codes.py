"""Spelling variants, repeated passages and vector codes against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from basketshift.llm import queries, spelling, substrings, vector_codes
from tests.compare import database, differences
from tests.llm.cases import ROWS, documents

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.all_statements()))
def test_matches_sql(spark, name):
    assert differences(queries.all_queries()[name](spark, SF), database(SF), entry.oracle_sql()[name]) == []


# -- spelling -------------------------------------------------------------------


def brute_words(rows):
    n = {}
    for i, t, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c < "\x7f" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            n[run] = n.get(run, 0) + 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_spelling(rows):
    n = brute_words(rows)
    found = {}
    for w in n:
        others = sorted((x for x in n if near(w, x)), key=lambda x: (-n[x], x))
        form = others[0] if others and n[others[0]] >= 10 * n[w] else None
        found[w] = (form, n[w], len(others), n[form] if form else None)
    out = set()
    for w, (form, c, k, m) in found.items():
        root = w
        while found[root][0]:
            root = found[root][0]
        out.add((w, form, root, c, k, m))
    return out


def spelling_rows():
    rng, rows = random.Random(3), list(ROWS)
    base = ["algebraic", "éclairage", "ÀÿÀÿÀÿÀ", "mississippi", "banana" * 4, "z" * 2500]
    for b in base:
        rows += [(None, " ".join([b] * 40), "x"), (77, b.upper(), "x"), (78, b.upper() + "." + b, "x")]
        for _ in range(60):
            w = list(b)
            for _ in range(rng.randrange(1, 3)):
                k = rng.randrange(len(w))
                w[k:k + rng.randrange(2)] = rng.choice(["", "e", "q", "é", "×"])
            rows.append((rng.randrange(50), " ".join(["".join(w)] * rng.choice([2, 3, 25])), "x"))
    return rows


@pytest.mark.parametrize("params", [{}, {"rows": 3, "block_words": 2, "task_rows": 20}])
def test_spelling_equals_brute_force(spark, params):
    rows = spelling_rows()
    got = spelling.spelling_groups(documents(spark, rows), spelling.SpellingParams(**params))
    assert {tuple(r) for r in got.select("word", "form", "root", "n", "n_near", "form_n").collect()} == brute_spelling(rows)


def test_chains_of_forms_end_at_the_last(spark):
    counts = {"aaaaaaa": 2000, "aaaaaab": 200, "aaaaabb": 20, "aaaabbb": 2, "zzzzzzz": 9}
    rows = [(None, f"{w} ", "x") for w, n in counts.items() for _ in range(n)]
    found = {r["word"]: r for r in spelling.spelling_groups(documents(spark, rows), spelling.SpellingParams(misspelt=1 << 40)).collect()}
    assert {found[w]["root"] for w in list(counts)[:4]} == {"aaaaaaa"} and found["zzzzzzz"]["root"] == "zzzzzzz"
    assert found["aaaabbb"]["form"] == "aaaaabb" and found["aaaaaaa"]["form"] is None


def test_gram_distances_are_those_of_letter_counts():
    rng = random.Random(8)
    for width in (0, 1):
        a = ["".join(rng.choice("abcé") for _ in range(8)) for _ in range(60)]
        b = ["".join(rng.choice("abcé") for _ in range(8 + width)) for _ in range(70)]
        x, y = spelling._Words(a, [1] * 60), spelling._Words(b, [1] * 70)
        close = set(zip(*(v.tolist() for v in spelling.close_pairs(x, y))))
        far = {(i, j): sum((p.count(c) - q.count(c)) ** 2 for c in "abcé") for i, p in enumerate(a) for j, q in enumerate(b)}
        assert close == {k for k, d in far.items() if d <= 2}
        assert set(zip(*(v.tolist() for v in spelling.near_pairs(x, y)))) == {(i, j) for i, p in enumerate(a) for j, q in enumerate(b) if near(p, q)}


def test_spelling_of_nothing(spark):
    empty = documents(spark, ROWS).where("false")
    assert spelling.spelling_groups(empty).count() == 0
    assert spelling.spelling_groups(documents(spark, [(1, None, "x"), (2, "", None)])).count() == 0


# -- repeated passages ------------------------------------------------------------


def brute_passages(rows, window=20):
    """Kept words per row. Null ids first; equal ids in the order of Spark's hash, which the caller has sorted by."""
    seen, out = set(), []
    for i, t in rows:
        words = [w for w in re.split("[\x20\x09-\x0d]+", t or "") if w]
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            passage = tuple(words[s:s + window])
            if passage in seen:
                gone[s:s + window] = [True] * window
            seen.add(passage)
        out.append((i, len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return out


def passage_rows():
    rng, rows = random.Random(6), list(ROWS)
    shared = [" ".join(f"s{rng.randrange(500)}" for _ in range(n)) for n in (19, 20, 21, 33, 80)]
    for i in range(120):
        words = [f"w{rng.randrange(40)}" for _ in range(rng.randrange(60))]
        for s in rng.sample(shared, rng.randrange(3)):
            words.insert(rng.randrange(len(words) + 1), s)
        rows.append((rng.choice([None, -5, i]), " \n".join(words), "x"))
    rows += [(500 + i, rows[30 + i][1], "x") for i in range(20)] + [(900, "tick " * 300, "x"), (901, "tick " * 19, "x")]
    return rows


@pytest.mark.parametrize("params", [{}, {"period": 7, "cover": (0, 1, 3)}, {"bits": 1, "most_bits": 16}, {"window": 5, "period": 5, "cover": (0, 1, 2)}])
def test_passages_equal_brute_force(spark, params):
    p = substrings.SubstringParams(**params)
    docs = documents(spark, passage_rows())
    order = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()
    order.sort(key=lambda r: (-(1 << 63) if r.doc_id is None else r.doc_id, r.h))
    want = brute_passages([(r.doc_id, r.text) for r in order], p.window)
    got = substrings.remove_repeats(docs, p).collect()
    key = repr
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=key) == sorted(want, key=key)
    assert all(r.kept_sha256 == hashlib.sha256(r.kept.encode()).hexdigest() for r in got)


def test_passages_without_text_and_of_nothing(spark):
    docs = documents(spark, ROWS)
    assert {r.kept for r in substrings.remove_repeats(docs, with_text=False).collect()} == {None}
    assert substrings.remove_repeats(docs.where("false")).count() == 0


def test_cover_must_be_one():
    with pytest.raises(ValueError):
        substrings.SubstringParams(cover=(0, 1, 2, 3))
    with pytest.raises(ValueError):
        substrings.SubstringParams(window=5)


def test_any_two_equal_passages_share_an_aligned_anchor():
    p = substrings.SubstringParams()
    for a in range(p.period):
        for b in range(p.period):
            assert any((a + k) % p.period in p.cover and (b + k) % p.period in p.cover and k + p.anchor <= p.window for k in range(p.period))


# -- vector codes -------------------------------------------------------------------


def brute_codes(rows, parts=8, entries=16, rounds=6):
    x = np.array([[int(np.floor(4096 * v)) for v in r[1]] for r in rows], dtype=np.int64).reshape(len(rows), parts, -1)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))[:entries]
    books = x[order].transpose(1, 0, 2).copy()
    for t in range(rounds + 1):
        d = ((x.transpose(1, 0, 2)[:, :, None] - books[:, None]) ** 2).sum(-1)
        codes, least = d.argmin(-1), d.min(-1)
        if t < rounds:
            for p in range(parts):
                for e in range(len(order)):
                    held = x[codes[p] == e, p]
                    if len(held):
                        books[p, e] = held.sum(0) // len(held)
    return sorted((r[0] is None, r[0], bytes(codes[:, i].tolist()), int(least[:, i].sum())) for i, r in enumerate(rows)), books


def vector_rows(n, seed=2):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, rng.gauss(0, 1)]) for _ in range(16)], rng.choice([None, 1, 2])) for i in range(n)]
    return rows + [(n + i, list(rows[i % 7][1]), 3) for i in range(n // 3)]


def vectors(spark, rows):
    return spark.createDataFrame([(*r, b"x", 1.0, "c") for r in rows], "vec_id bigint, embedding array<float>, label int, whole binary, error double, codes string")


@pytest.mark.parametrize("n", [1, 5, 16, 400])
def test_codes_equal_a_full_search(spark, n):
    rows = vector_rows(n)
    rows = [(i, [float(np.float32(v)) for v in x], lb) for i, x, lb in rows]
    coded, books = vector_codes.compress(vectors(spark, rows))
    want, book = brute_codes(rows)
    assert sorted((r.vec_id is None, r.vec_id, bytes(r.codes), r.error) for r in coded.collect()) == want
    assert np.array_equal(books, book)
    sums = {}
    for r in coded.collect():
        sums[r.label] = sums.get(r.label, 0) + r.error
    labelled = vector_codes.with_label_error(coded).collect()
    assert len(labelled) == len(rows) and all(r.label_error == sums[r.label] for r in labelled)


def test_rounds_of_reassignment_equal_a_full_search():
    """With entries that stay, entries that agree, and parts as far from one as from another."""
    rng = np.random.default_rng(5)
    for trial in range(40):
        x = rng.integers(-6, 6, (200, 3))
        book = rng.integers(-6, 6, (9, 3))
        book[4] = book[2]
        codes, moved = np.zeros(200, dtype=np.int64), np.ones(9, dtype=bool)
        for _ in range(5):
            codes, least = vector_codes.reassign(x, codes, book, moved)
            d = ((x[:, None] - book[None]) ** 2).sum(-1)
            assert np.array_equal(codes, d.argmin(1)) and np.array_equal(least, d.min(1))
            new = book.copy()
            change = rng.random(9) < 0.3
            new[change] += rng.integers(-2, 3, (change.sum(), 3))
            moved, book = (new != book).any(1), new


def test_vectors_that_are_left_out(spark):
    nan, inf = float("nan"), float("inf")
    bad = [(1, None, 1), (2, [nan] * 16, 1), (3, [inf] + [0.0] * 15, None), (4, [None] + [0.0] * 15, 1)]
    good = [(None, [0.5] * 16, None), (6, [0.5] * 16, 1), (6, [0.5] * 16, 1)]
    coded, books = vector_codes.compress(vectors(spark, bad + good))
    assert sorted((r.vec_id or 0) for r in coded.collect()) == [0, 6, 6] and books.shape == (8, 3, 2)
    coded, books = vector_codes.compress(vectors(spark, bad))
    assert vector_codes.with_label_error(coded).count() == 0 and books.size == 0
    assert vector_codes.compress(vectors(spark, good).where("false"))[0].count() == 0


def test_vectors_that_cannot_be_coded(spark):
    for rows in ([(1, [1.0] * 9, 1)], [(1, [1.0] * 16, 1), (2, [1.0] * 8, 1)], [(1, [1e9] * 8, 1)]):
        with pytest.raises(Exception, match="differ in length|is not below|equal parts"):
            vector_codes.compress(vectors(spark, rows))
