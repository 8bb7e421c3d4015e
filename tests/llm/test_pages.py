"""Main text and archives of pages."""

from __future__ import annotations

import base64
import collections
import hashlib
import random
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from basketshift.llm import page_diff, warc
from basketshift.session import staging_path
from tests.llm.cases import LONG, pages


def length(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_lcs_is_longest():
    rng = random.Random(1)
    for _ in range(1500):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(12))] for _ in range(2))
        for found in (page_diff.lcs(a, b), page_diff._solve(a, b, 20)):
            assert len(found) == length(a, b) and all(a[i] == b[j] for i, j in found)
            assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(found, found[1:], strict=False))


def texts(page, *regions):
    return [t for r, t in page_diff.lines_of(page) if r in regions]


def test_blocks_and_regions():
    page = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var x="</p><p>no";</script></head><body class="has-menu">
    <nav><ul><li>Home</li></ul></nav><!-- <p>gone</p> --><div class="ad-box"><div>Buy</div> now</div>
    <article id=main><header><h1>Head</h1></header><h2>One&nbsp;two &eacute;&#x4e2d;</h2><p>A <b>bold</b>
    word<br>next<p>Second <a title="a > b" href='x'>link</a>.<form><input>Send</form><div class="comments"><p>I think</p></div>
    <aside>Side</aside><p>Last</article><footer>&copy; me</footer>"""
    assert texts(page, page_diff.MAIN) == ["One two é中", "A bold word next", "Second link.", "Last"]
    assert "var x" not in " ".join(texts(page, 0, 1, 2)) and texts(page, page_diff.LOOSE) == []
    assert page_diff.lines_of("") == [] and texts("just < text & more", page_diff.LOOSE) == ["just < text & more"]
    assert texts("<p>" + LONG, page_diff.LOOSE) == [LONG.strip()]


ARTICLE = "<p>" + "The whole article text of this page. " * 6


@pytest.mark.parametrize("page", [
    f'<div class="content with-sidebar"><article>{ARTICLE}</article></div>', f'<div id="page" class="no-sidebar"><main>{ARTICLE}</main></div>',
    f'<article><section class="social-studies">{ARTICLE}</section></article>', f'<article class="post comments-open">{ARTICLE}</article>',
    f'<div class="elementor-widget elementor-widget-text-editor">{ARTICLE}</div>', f'<form action="/x"><div>{ARTICLE}</div><p>Send</form>',
    f'<nav><ul><li>Home<article>{ARTICLE}</article>', f'<div class="widget">{ARTICLE}</div>', f'<header><main>{ARTICLE}</main></header>'])
def test_a_word_of_a_class_name_drops_no_article(page):
    assert ARTICLE[3:].strip() in texts(page, page_diff.MAIN, page_diff.LOOSE)


def test_hints_that_hold_a_small_part_are_believed():
    for small in ('<div class="ad-box">Buy</div>', '<div id="siteHeader"><b>Buy</b></div>', "<p hidden>Buy</p>", '<p hidden="hidden">Buy</p>', '<div role="navigation">Buy</div>',
                  '<div class="x cookie-banner wrapper">Buy</div>', '<section class="comments">' + "<p>I think so. " * 90 + "</section>", "<aside>Buy<article>Teaser</article></aside>"):
        assert texts(f"<div><article>{ARTICLE}</article>{small}</div>", page_diff.MAIN, page_diff.LOOSE) == [ARTICLE[3:].strip()], small
    assert texts('<p hidden="false">A<p data-x="hidden">B', page_diff.LOOSE) == ["A", "B"]


def test_pages_that_never_close_anything_take_linear_time():
    for piece in ('<a b="', "<a b='\"", "<p>", "<", "</p", "<!--", '<a b="">', "<div class='", "<nav><article>"):
        start = time.perf_counter()
        page_diff.lines_of(piece * (1_000_000 // len(piece)))
        page_diff.lines_of(piece * (1_000_000 // len(piece)) + ">")
        assert time.perf_counter() - start < 12, piece
    assert texts('<a b="x>one</a> <i c=\'>\'>two', page_diff.LOOSE) == ["one two"]


class Plain(HTMLParser):
    """The text of article elements without what is nested in unwanted ones, by another parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.blocks = [], [""]

    def handle_starttag(self, tag, attrs):
        if tag in page_diff.VOID:
            self.blocks[-1] += " " if tag == "br" else ""
            return
        bad = tag in page_diff.OUTSIDE or any(w in page_diff.HINTS | page_diff.COMMENT_HINTS for k, v in attrs if k in ("class", "id", "role") for w in (v or "").split())
        self.open.append((tag, bad))
        if tag not in page_diff.INLINE or bad:
            self.blocks.append("")

    def handle_endtag(self, tag):
        if tag in [t for t, _ in self.open]:
            while self.open.pop()[0] != tag:
                pass
        if tag not in page_diff.INLINE:
            self.blocks.append("")

    def handle_data(self, data):
        if any(t == "article" for t, _ in self.open) and not any(bad for _, bad in self.open):
            self.blocks[-1] += data


def test_given_pages_equal_another_parser(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()
    want = {}
    for r in rows:
        p = Plain()
        p.feed(r.html or "")
        p.close()
        want[r.page_id] = "\n".join(t for t in (" ".join(b.split()) for b in p.blocks) if t)
    twice = spark.createDataFrame(rows + rows[:5], "page_id bigint, url string, html string")
    got = page_diff.main_text(twice).collect()
    assert len(got) == len(rows) + 5 and all(r.text == want[r.page_id] and r.n_chars == len(r.text) for r in got)


def test_differencing_on_pages_without_article(spark):
    page = lambda *body: "".join(f"<div>{b}</div>" for b in ("Site name", *body, "All rights"))
    rows = [(1, "http://h.example/a/1", page("Text one", "more")), (2, "http://h.example/a/2", page("Text two")),
            (3, "http://h.example/z", page("Other")), (4, "http://alone.example/a", page("Alone")), (5, None, page("No url")),
            (6, "http://h.example/a/3", None), (7, "http://h.example/q", "<article><p>Site name<p>All rights</article>"), (8, "x", "")]
    got = {r.page_id: r for r in page_diff.main_text(pages(spark, rows)).collect()}
    # 6 is empty; 2 lies between 1 and 6, whose paths share as much with it: the former counts.
    want = {1: "Text one\nmore", 2: "Text two", 4: "Site name\nAlone\nAll rights", 5: "Site name\nNo url\nAll rights", 6: "", 7: "Site name\nAll rights", 8: ""}
    assert {k: got[k].text for k in want} == want and len(got) == len(rows)
    assert all(r.n_chars == len(r.text) and r.url == dict((a, b) for a, b, _ in rows)[r.page_id] for r in got.values())
    assert page_diff.main_text(pages(spark, rows).where("false")).count() == 0


def test_pages_with_marks_alone_are_differenced_too(spark):
    """All lines of marked pages are held against their neighbours; what the marks say is checked after that."""
    page = lambda *body: "<article>" + "".join(f"<p>{b}" for b in body) + "</article>"
    rows = [(i, f"http://m.example/{i}", page("Same first", f"own {i}", "same last")) for i in range(4)] + [(9, "http://m.example/9", None)]
    parsed = page_diff.parse(pages(spark, rows))
    got = {r.page_id: r for r in parsed.collect()}
    assert got[2].lines == ["Same first", "own 2", "same last"] and got[2].places == [0, 1, 2] and got[2].marked == [True] * 3 and got[9].lines == []
    shared = page_diff.shared_lines(parsed)
    assert sorted(r.shared for r in shared.collect()) == [[], *[[0, 2]] * 4] and page_diff.kept_lines(parsed, shared).count() == 0
    loose = parsed.withColumn("marked", F.transform("marked", lambda m: F.lit(False)))
    assert {r.row_no: r.kept for r in page_diff.kept_lines(loose, shared).collect()} == {got[i].row_no: [1] for i in range(4)}


def test_pairs_do_not_depend_on_blocks(spark):
    rng = random.Random(2)
    rows = [(i, f"http://hot.example/{rng.randrange(9)}/{rng.randrange(60)}", f"<p>Top {i % 3}<p>own {i}<p>end") for i in range(150)]
    a, b = ({r.page_id: r.text for r in page_diff.main_text(pages(spark, rows), page_diff.PageParams(n)).collect()} for n in (2, 512))
    assert a == b and all(f"own {i}" in t or t == "" for i, t in a.items()) and any("Top" not in t for t in a.values())


def test_text_survives_copies_passages_and_teasers(spark):
    body = lambda *b: "".join(f"<div>{x}</div>" for x in b)
    story, long = ["Once", "upon", "a", "time", "there", "was", "a", "page", "of", "ten"], "A long body in a plain element. " * 5
    rows = [(1, "http://two.example/a", body(*story)), (2, "http://two.example/b", body(*story)),
            (3, "http://re.example/a?1", body("Site", *story, "seen 1")), (4, "http://re.example/a?2", body("Site", *story, "seen 2")),
            (5, "http://re.example/b", body("Site", "Other one", "more")), (6, "http://re.example/c", body("Site", "Another", "less")),
            (7, "http://pass.example/a", body("Site", "One", "A common passage")), (8, "http://pass.example/b", body("Site", "Two", "A common passage", "x")),
            (9, "http://pass.example/c", body("Site", "Three", "y")),
            (10, "http://tease.example/a", body("Site") + "<article><p>Teaser</article>" + body(long)),
            (11, "http://tease.example/b", body("Site") + f"<main><p>{long}</main>" + body("Off")), (12, "http://tease.example/c", body("Site", "Other"))]
    got = {r.page_id: r.text for r in page_diff.main_text(pages(spark, rows)).collect()}
    text = "\n".join(story)
    assert got[1] == got[2] == text and got[3] == text + "\nseen 1" and got[4] == text + "\nseen 2"
    assert got[5] == "Other one\nmore" and got[7] == "One\nA common passage" and got[8] == "Two\nA common passage\nx"
    assert got[10] == "Teaser\n" + long.strip() and got[11] == long.strip() and got[12] == "Other"


def archived(spark, rows, **params):
    folder = staging_path(spark, "test-warc")
    return folder, warc.archive_and_index(pages(spark, rows), folder, warc.WarcParams(**params))


ROWS = [(1, "http://www.A.example:80/x?q=1#f", "same"), (2, "http://b.example/y z\r\nX: 1", "same"), (3, "http://b.example/", "hé\r\n\r\nWARC/1.1\r\n"),
        (4, None, None), (5, "", ""), (None, "http://n.example/", "same"), (6, "http://a.example/x", LONG), (7, "http://r.example", "twice"), (7, "http://r.example", "twice")]


def test_archives_round_trip(spark):
    rows = ROWS + [(100 + i, f"http://hot.example/{i % 7}", "hot" if i % 2 else f"page {i}") for i in range(120)]
    folder, index = archived(spark, rows, archive_bytes=4000, merge_rows=20)
    got = index.collect()
    owner = {}
    for i, _, h in rows:
        owner[h or ""] = max(owner.get(h or "", -1), -1 if i is None else i)
    want = collections.Counter()
    for i, _, h in rows:
        raw = (h or "").encode()
        want[i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), None if i == owner[h or ""] else owner[h or ""]] += 1
    twice = [r for r in got if r.page_id == 7]
    assert sorted(r.record_type for r in twice) == ["response", "revisit"] and {r.refers_to for r in twice} == {None, 7}
    assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.refers_to) for r in got if r.page_id != 7) == {
        k: v for k, v in want.items() if k[0] != 7}
    assert all((r.record_type == "revisit") == (r.refers_to is not None) for r in got)
    order = [(r.url_key, r.timestamp, r.page_id is not None, r.page_id or 0) for r in got]
    assert order == sorted(order) and ("example,a:80)/x?q=1" in {r.url_key for r in got})
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).collect()
    records = [r for f in files for r in warc.read_records(bytes(f.content))]
    assert len(files) > 3 and len(records) == len(rows) and len({h["warc-record-id"] for h, _ in records}) == len(rows)
    ids = {h["warc-record-id"]: h for h, _ in records}
    assert all(ids[h["warc-refers-to"]]["warc-type"] == "response" for h, _ in records if h["warc-type"] == "revisit")


def test_small_payloads_are_written_in_full(spark):
    assert {r.record_type for r in archived(spark, ROWS, least_bytes=10**6)[1].collect()} == {"response"}


def test_archive_of_nothing(spark):
    folder = staging_path(spark, "test-warc")
    assert warc.archive_and_index(pages(spark, ROWS).where("false"), folder).count() == 0


def test_loser_tree_merges():
    rng = random.Random(3)
    for k in (0, 1, 2, 3, 7, 20):
        runs = [sorted((rng.randrange(50),) for _ in range(rng.randrange(9))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(x for r in runs for x in r)
    rows = [(3,), (4,), (1,), (2,), (2,), (0,)]
    assert warc.ascending_runs(rows) == [[(3,), (4,)], [(1,), (2,), (2,)], [(0,)]]
