"""Main text of web pages, with page differencing against the nearest URL.

Pages are put in order of host and URL path; each page is paired with that neighbour of its host whose
path has the longest common beginning and that is not nearly a copy of it. The text lines of the two are aligned by a longest common
subsequence, and lines that both share are template, not text, if a second neighbour that is no copy of either has them too.

Differencing alone would also delete lines that two articles share, such as a common passage, and would
keep an advert that only one page has. So elements that hold menus, headers, footers, adverts and the like never count, and the
lines of a marked article are never deleted. What differencing leaves of the loose lines decides whether the mark
is believed: where the marked text is a small part of it, both are the text, else the marked lines alone. Every page is
differenced, whatever its marks; the marks are a check of what that gives.
"""

from __future__ import annotations

import html as markup
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketshift.llm.common import map_rows, prepare, text_of
from basketshift.session import stage

# Fixed values of HTML: elements whose content is raw text, that have no content, and that end a block.
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
                    "span strike strong sub sup time tt u var wbr").split())
# Elements that never hold main text, and the words of class, id and role names that say the same of others.
OUTSIDE = frozenset("nav header footer aside form menu button select option script style noscript template svg math iframe dialog head "
                    "title object audio video canvas".split())
HINTS = frozenset(("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar aside nav navbar "
                   "navigation menu breadcrumb breadcrumbs header masthead footer cookie cookies consent gdpr notice notices popup modal newsletter "
                   "subscribe subscription signup login share sharing social related recommended "
                   "complementary contentinfo search pagination pager toolbar widget").split())
COMMENT_HINTS = frozenset("comment comments reply replies disqus".split())
# Words that a class name may have beside a hint, such as the last of "ad-box" or the first of "site-header".
BESIDE = frozenset(("a all area bar block body bottom box btn button buttons c cell col column container el fixed float g global group icons in "
                    "inline inner item items js label large left line link links list mobile module mini n outer panel pane primary right row "
                    "secondary section site slot small standard sticky the top ui unit wrap wrapper").split())
# Elements that the page's article may lie in, wrongly or not.
SOFT = frozenset("nav header footer aside form menu dialog".split())
ROOTS = frozenset("html body main".split())
CONTAINERS = frozenset("article main".split())

_OPEN = re.compile(r"<!--|<[!?]|</?[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"""[>"']""")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

BOILERPLATE, LOOSE, MAIN = 0, 1, 2
# What an element says of its content: nothing; never text; no text unless it holds most of the page; no text unless it holds the article.
FREE, NEVER, HINTED, SEMANTIC = 0, 1, 2, 3


def _hints(name: str, words: frozenset[str]) -> bool:
    """Whether one whole class, id or role name is a hint, with nothing but neutral words beside it."""
    for token in name.split():
        parts = [p.lower() for p in _PARTS.findall(token)]
        if any(p in words for p in parts) and all(p in words or p in BESIDE or p.isdigit() for p in parts):
            return True
    return False


def _says(name: str, attributes: str) -> int:
    if name in OUTSIDE and name not in SOFT:
        return NEVER
    if "hidden" in attributes.lower() and name not in ROOTS and any(
            m[1].lower() == "hidden" and (m[2] or "").strip("\"'").lower() != "false" for m in _ATTRIBUTE.finditer(attributes)):
        return NEVER
    if name in SOFT:
        return HINTED if name == "form" else SEMANTIC
    if name in ROOTS or "=" not in attributes:
        return FREE
    named = [m[1] or m[2] or m[3] or "" for m in _NAMES.finditer(attributes)]
    if any(_hints(n, COMMENT_HINTS) for n in named):
        return NEVER
    return HINTED if name not in CONTAINERS and any(_hints(n, HINTS) for n in named) else FREE


class Tags:
    """The tags of a page, found with a pointer that only moves on: quotes and brackets that never close are looked for once."""

    def __init__(self, page: str):
        self.page = page
        self.without: set[str] = set()
        # Places outside quotes from which no tag ends.
        self.hopeless: set[int] = set()

    def _find(self, what: str, at: int) -> int:
        if what in self.without:
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.without.add(what)
        return found

    def end(self, at: int) -> int:
        """Place of the ``>`` that ends the tag whose attributes start at ``at``; -1 if there is none. Quotes that
        do not fit together are no quotes."""
        start, passed = at, []
        while at not in self.hopeless:
            passed.append(at)
            m = None if ">" in self.without else _STOP.search(self.page, at)
            if m is None:
                break
            if m[0] == ">":
                return m.start()
            close = self._find(m[0], m.end())
            if close < 0:
                break
            at = close + 1
        self.hopeless.update(passed)
        return self._find(">", start)


def lines_of(page: str) -> list[tuple[int, str]]:
    """(region, text) of every text block of a page, in order. One pass over the whole page, linear in its length.

    White space inside a block is one space and references are decoded. Elements are closed by their end tag, by that of an element
    around them, or by the end of the page. What an element says of its content is believed unless the page shows otherwise: a
    form or an element with a hint in its name is not believed if it holds more than half of the page's text, a menu, header, footer or side
    part not if it holds at least half of the marked text and a third of all, as one that is never closed does.
    """
    out: list[tuple[int, bool, str]] = []
    pieces: list[str] = []
    stack: list[tuple[str, int, bool]] = []  # name, group around it, whether a container is open around it
    opened: Counter[str] = Counter()
    said, parent = [FREE], [0]  # by group; group 0 is the page
    group, inside, place = 0, False, 0
    tags = Tags(page)

    def end_block() -> None:
        if pieces:
            text = " ".join(markup.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                out.append((group, inside, text))

    while m := _OPEN.search(page, place):
        if m.start() > place:
            pieces.append(page[place:m.start()])
        if m[0] == "<!--":
            place = page.find("-->", m.end()) + 3
            if place < 3:
                place = len(page)
            continue
        stop = tags.end(m.end()) if m[0][1] not in "!?" else tags._find(">", m.end())
        if stop < 0:
            # No tag ends behind here: a declaration takes the rest, anything else is text.
            if m[0][1] not in "!?":
                pieces.append(page[m.start():])
            place = len(page)
            break
        place = stop + 1
        if m[0][1] in "!?":
            continue
        closing, name = m[0][1] == "/", m[0].lstrip("</").lower()
        if name == "br":
            pieces.append(" ")
            continue
        says = FREE if closing or name in VOID else _says(name, page[m.end():stop])
        if name not in INLINE or says or (closing and stack and stack[-1][0] == name and stack[-1][1] != group):
            end_block()
        if closing:
            if opened[name]:
                while True:
                    last, group, inside = stack.pop()
                    opened[last] -= 1
                    if last == name:
                        break
        elif name not in VOID:
            stack.append((name, group, inside))
            opened[name] += 1
            if says:
                said.append(says)
                parent.append(group)
                group = len(said) - 1
            inside = inside or name in CONTAINERS
            if name in RAW:
                end = re.compile(f"</{name}", re.I).search(page, place)
                raw = page[place:end.start() if end else len(page)]
                if name == "textarea" or name == "title":
                    pieces.append(raw)
                place = end.start() if end else len(page)
    if place < len(page):
        pieces.append(page[place:])
    end_block()

    size, marked = [0] * len(said), [0] * len(said)
    for g, main, text in out:
        size[g] += len(text)
        marked[g] += len(text) if main else 0
    for g in range(len(said) - 1, 0, -1):
        size[parent[g]] += size[g]
        marked[parent[g]] += marked[g]
    gone = [False] * len(said)
    for g in range(1, len(said)):
        large = 2 * size[g] > size[0] if said[g] == HINTED else marked[g] and 2 * marked[g] >= marked[0] and 3 * size[g] >= size[0]
        gone[g] = gone[parent[g]] or said[g] == NEVER or not large
    return [(BOILERPLATE if gone[g] else MAIN if main else LOOSE, text) for g, main, text in out]


def lcs(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Index pairs of a longest common subsequence.

    Equal ends are taken off and symbols of one side only are left out. The rest is solved by rows of
    bits; where the rows would take too much memory the problem is halved first, so memory
    stays linear in the lengths.
    """
    if a is b or list(a) == list(b):
        return [(i, i) for i in range(len(a))]
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[len(a) - 1 - tail] == b[len(b) - 1 - tail]:
        tail += 1
    both = set(a[head:len(a) - tail]) & set(b[head:len(b) - tail])
    left = [i for i in range(head, len(a) - tail) if a[i] in both]
    right = [i for i in range(head, len(b) - tail) if b[i] in both]
    inner = _solve([a[i] for i in left], [b[i] for i in right])
    return [*((i, i) for i in range(head)), *((left[i], right[j]) for i, j in inner),
            *((len(a) - k, len(b) - k) for k in range(tail, 0, -1))]


def _rows(a: Sequence[int], b: Sequence[int], keep: bool) -> list[int]:
    """Bit j of row i is clear where the subsequence of a[:i+1] and b[:j+1] is longer than with b[:j]."""
    where: dict[int, int] = {}
    for j, y in enumerate(b):
        where[y] = where.get(y, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, []
    for x in a:
        hit = row & where.get(x, 0)
        row = (row + hit | row - hit) & full
        if keep:
            rows.append(row)
    return rows if keep else [row]


def _solve(a: list[int], b: list[int], most_bits: int = 1 << 26) -> list[tuple[int, int]]:
    if not a or not b:
        return []
    if len(a) == 1:
        return [(0, b.index(a[0]))] if a[0] in b else []
    if len(a) * len(b) > most_bits:
        mid = len(a) // 2
        first, second = _rows(a[:mid], b, False)[0], _rows(a[mid:][::-1], b[::-1], False)[0]
        ahead = [0]
        for j in range(len(b)):
            ahead.append(ahead[-1] + (not first >> j & 1))
        behind = [0]
        for j in range(len(b)):
            behind.append(behind[-1] + (not second >> j & 1))
        cut = max(range(len(b) + 1), key=lambda j: ahead[j] + behind[len(b) - j])
        return _solve(a[:mid], b[:cut], most_bits) + [(i + mid, j + cut) for i, j in _solve(a[mid:], b[cut:], most_bits)]
    rows, out = _rows(a, b, True), []
    i, j = len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                j -= 1
                out.append((i, j))
    return out[::-1]


@dataclass(frozen=True)
class PageParams:
    # Neighbouring pages that one task aligns.
    block: int = 512
    # Different pages on either side among which a page's pair is looked for.
    reach: int = 8
    # Pages that have this share of the longer one's lines in common are copies, and no pair.
    copy: float = 0.9
    # A marked text of less than this share of the page's own loose text is not the whole text.
    small: float = 0.5


PARSED = ("row_no bigint, page_id bigint, url string, host string, path string, hashes array<bigint>, "
          "lines array<string>, places array<int>, marked array<boolean>, sizes array<int>")


def _host_and_path(url: str | None) -> tuple[str, str]:
    m = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)([^?#]*)", url or "")
    if not m:
        return "", ""
    return m[1].rpartition("@")[2].lower(), m[2].rstrip("/") or "/"


def parse(pages: DataFrame) -> DataFrame:
    """Every page's lines as hashes, and those that could be text with their places, marks and sizes."""

    def run(batches) -> Iterator[dict]:
        for b in batches:
            out = {n: [] for n in ("host", "path", "hashes", "lines", "places", "marked", "sizes")}
            for url, page in zip(b["url"], b["html"], strict=True):
                lines = lines_of(page)
                inner = [(i, t, r == MAIN) for i, (r, t) in enumerate(lines) if r != BOILERPLATE]
                host, path = _host_and_path(url)
                out["host"].append(host)
                out["path"].append(path)
                out["hashes"].append([xxhash.xxh64_intdigest(t) - (1 << 63) for _, t in lines])
                out["lines"].append([t for _, t, _ in inner])
                out["places"].append([i for i, _, _ in inner])
                out["marked"].append([m for _, _, m in inner])
                out["sizes"].append([len(t) for _, t, _ in inner])
            yield {"row_no": b["row_no"], "page_id": b["page_id"], "url": b["url"], **out}

    rows = pages.select(F.monotonically_increasing_id().alias("row_no"), F.col("page_id").cast("bigint").alias("page_id"),
                        F.col("url").cast("string").alias("url"), text_of("html").alias("html"))
    return map_rows(rows, run, PARSED)


def _copies(a: Sequence[int], b: Sequence[int], share: float) -> bool:
    return (Counter(a) & Counter(b)).total() >= share * max(len(a), len(b))


def _template(pages: list[tuple], i: int, params: PageParams) -> list[int]:
    """Places of page ``i`` that its pair and, if there is one, a second neighbour have too. ``pages`` are (pos, host, path, group, hashes)."""
    _, host, path, _, own = pages[i]

    def near(k: int) -> tuple[int, int, int]:
        n = 0
        while n < min(len(path), len(pages[k][2])) and path[n] == pages[k][2][n]:
            n += 1
        return -n, abs(k - i), k

    around = range(max(0, i - params.reach), min(len(pages), i + params.reach + 1))
    order = sorted(near(k) for k in around if k != i and pages[k][1] == host)
    others = (pages[k][4] for _, _, k in order if pages[k][4] and not _copies(own, pages[k][4], params.copy))
    pair = next(others, None)
    if pair is None:
        return []
    shared = [x for x, _ in lcs(own, pair)]
    second = next((set(o) for o in others if not _copies(pair, o, params.copy)), None) if shared else None
    return shared if second is None else [x for x in shared if own[x] in second]


SHARED = "host string, digest bigint, shared array<int>"


def shared_lines(parsed: DataFrame, params: PageParams = PageParams()) -> DataFrame:
    """host, digest and the places of the template lines of a page, for every page with a host.

    Pages of a host with equal lines (a 64-bit digest of all line hashes) are one page here, at its first path. The order of pages is one
    distributed sort of (host, path, digest) with hashes for lines. A page's
    number in it gives its block; the pages near the edges of a block are sent to both. So a host of any size
    is spread over tasks, and the pairs do not depend on how.
    """
    keyed = (parsed.where("host <> ''").select("host", F.xxhash64("hashes").alias("digest"), "path", "hashes")
             .groupBy("host", "digest").agg(F.min("path").alias("path"), F.first("hashes").alias("hashes")))
    ordered = stage(keyed.repartitionByRange("host", "path", "digest").sortWithinPartitions("host", "path", "digest")
                    .select("*", F.monotonically_increasing_id().alias("_at")), "pages-in-order")
    slice_no, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = ordered.groupBy(slice_no.alias("slice")).count()
    # One number per task of the sort.
    offsets, total = {}, 0
    for s, n in sorted((r["slice"], r["count"]) for r in counts.collect()):
        offsets[s], total = total, total + n
    if not offsets:
        return parsed.sparkSession.createDataFrame([], SHARED)
    table = parsed.sparkSession.createDataFrame(list(offsets.items()), "slice bigint, before bigint")
    numbered = (ordered.withColumn("slice", slice_no.cast("bigint")).join(F.broadcast(table), "slice")
                .select("digest", "host", "path", "hashes", (F.col("before") + within).alias("pos")))
    b = params.block
    # A block, and the pages within reach before and behind it.
    blocks = F.sequence(F.floor((F.col("pos") - params.reach) / b), F.floor((F.col("pos") + params.reach) / b))
    spread = numbered.withColumn("block", F.explode(blocks)).where("block >= 0")

    def align(batches) -> Iterator[dict]:
        held: dict[int, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(batch[c] for c in ("block", "pos", "host", "path", "digest", "hashes")), strict=True):
                held.setdefault(row[0], []).append(row[1:])
        for block, pages in held.items():
            pages.sort()
            out = {"host": [], "digest": [], "shared": []}
            for i, (pos, host, _, digest, _) in enumerate(pages):
                if pos // b == block:
                    out["host"].append(host)
                    out["digest"].append(digest)
                    out["shared"].append(_template(pages, i, params))
            yield out

    n = max(int(parsed.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // (16 * b)))
    return map_rows(spread.repartition(n, "block"), align, SHARED)


def kept_lines(parsed: DataFrame, shared: DataFrame, params: PageParams = PageParams()) -> DataFrame:
    """row_no and the numbers of the lines that stay, of every page that loses a line: to its template, or because its marks are believed."""

    def decide(batches) -> Iterator[dict]:
        for batch in batches:
            out = {"row_no": [], "kept": []}
            for row_no, places, marks, sizes, template in zip(*(batch[c] for c in ("row_no", "places", "marked", "sizes", "shared")), strict=True):
                gone = set(template or ())
                own = [i for i, p in enumerate(places) if marks[i] or p not in gone]
                inside, loose = (sum(sizes[i] for i in own if marks[i] == side) for side in (True, False))
                trusted = inside and inside >= params.small * loose
                kept = [i for i in own if marks[i] or not trusted]
                if len(kept) < len(places):
                    out["row_no"].append(row_no)
                    out["kept"].append(kept)
            yield out

    pages = parsed.select("row_no", "host", F.xxhash64("hashes").alias("digest"), "places", "marked", "sizes")
    return map_rows(pages.join(shared, ["host", "digest"], "left").drop("host", "digest"), decide, "row_no bigint, kept array<int>")


def main_text(pages: DataFrame, params: PageParams = PageParams()) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages`` (page_id, url, html).

    Blocks are in page order, joined by one line feed; nothing else is dropped. A null html or a page without text
    gives an empty text. A page without a host, or without another page within reach on its host that is no copy of it, has no pair and
    loses no line. One row per input row, repeated rows included.
    An empty table gives an empty result; other columns are not read.

    Pages are parsed once; html never moves. What is sorted is 8 bytes a line. Which lines go is decided for every page from hashes, places,
    marks and sizes; the lines themselves meet only the list of pages that lose some.
    """
    prepare(pages.sparkSession)
    parsed = stage(parse(pages), "pages-parsed")
    kept = stage(kept_lines(parsed, shared_lines(parsed, params), params), "pages-kept")
    found = parsed.select("row_no", "page_id", "url", "lines").join(kept, "row_no", "left")
    lines = F.when(F.col("kept").isNull(), F.col("lines")).otherwise(F.transform("kept", lambda i: F.get("lines", i)))
    return found.select("page_id", "url", F.array_join(lines, "\n").alias("text")).withColumn("n_chars", F.char_length("text").cast("bigint"))
