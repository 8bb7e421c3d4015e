"""WARC archives of pages, and their capture index by external merge.

Pages are written as WARC/1.1 records through Spark's text writer, whose line separator is just the
blank lines that end a record, and read back as whole files. Each archive gives a run of captures
sorted by URL key and timestamp. The runs are cut by key range, and a loser tree merges the cuts of
all runs inside each range, so that the ranges in order are the captures in order.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketshift.llm.common import map_rows, parts_for, prepare, text_of
from basketshift.session import stage, staging_path

# Fixed value: the profile that marks revisits of identical payloads.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
EPOCH = datetime(2000, 1, 1, tzinfo=UTC)


@dataclass(frozen=True)
class WarcParams:
    # Payloads of fewer bytes are written in full even where an equal one exists.
    least_bytes: int = 0
    # An archive is closed after the record with which it passes this size.
    archive_bytes: int = 16 << 20
    # Captures aimed at in one task of the merge.
    merge_rows: int = 50_000
    compression: str = "gzip"


def record_id(page_id: int | None, sha1_hex: str, copy: int) -> str:
    """An id made of the page (0 for a null one, which the highest bit of the lower half marks), the payload and a number
    for rows that agree in both."""
    high = 0 if page_id is None else page_id & (1 << 64) - 1
    low = int(sha1_hex[:10], 16) << 23 | copy
    return f"<urn:uuid:{uuid.UUID(int=high << 64 | low | (1 << 63 if page_id is None else 0))}>"


def page_of(record: str) -> int | None:
    number = uuid.UUID(record[len("<urn:uuid:"):-1]).int
    if number >> 63 & 1:
        return None
    high = number >> 64
    return high - (1 << 64) if high >> 63 else high


def timestamp_of(page_id: int | None) -> str:
    """A capture time for tables without one: pages in order of their id, a second apart."""
    return (EPOCH + timedelta(seconds=(page_id or 0) % (1 << 31))).strftime("%Y-%m-%dT%H:%M:%SZ")


def header_value(value: str) -> str:
    """A URL as a header value: white space and control characters as percent escapes."""
    return re.sub(r"[\x00-\x20\x7f-\xa0  ]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), value)


def url_key(url: str) -> str:
    """Host names from the top level down, port, path and query, in lower case, without scheme, www and fragment."""
    try:
        parts = urlsplit(url)
        host, port = parts.hostname or "", parts.port
    except ValueError:
        return url.lower()
    host = re.sub(r"^www\d*\.", "", host)
    return (",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + (parts.path or "/")
            + (f"?{parts.query}" if parts.query else "")).lower()


def record(page_id: int | None, copy: int, url: str | None, payload: str, sha1_hex: str, keep_id: int | None, revisit: bool) -> str:
    """One WARC record without the two line ends that close it.

    A revisit carries the HTTP header, with the length of the full payload, but no payload.
    """
    size = len(payload.encode("utf-8"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    digest = base64.b32encode(bytes.fromhex(sha1_hex)).decode()
    target = header_value(url) if url else f"urn:page:{page_id}"
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id, sha1_hex, copy)}",
             f"WARC-Date: {timestamp_of(page_id)}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    if revisit:
        lines += [f"WARC-Refers-To: {record_id(keep_id, sha1_hex, 0)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + (0 if revisit else size)}"]
    return "\r\n".join(lines) + "\r\n\r\n" + http + ("" if revisit else payload)


def read_records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive, compressed or not."""
    file = gzip.GzipFile(fileobj=io.BytesIO(archive)) if archive[:2] == b"\x1f\x8b" else io.BytesIO(archive)
    while line := file.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers = {}
        while (line := file.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8").partition(":")
            headers[name.strip().lower()] = value.strip()
        yield headers, file.read(int(headers["content-length"]))


CAPTURE = ("run string, url_key string, timestamp string, page_id bigint, payload_bytes bigint, payload_digest string, "
           "record_type string, refers_to bigint")


def capture(headers: dict[str, str], block: bytes) -> tuple:
    """The index entry of a record. The payload of a response is measured, not believed."""
    head, _, payload = block.partition(b"\r\n\r\n")
    digest, kind = headers["warc-payload-digest"].removeprefix("sha1:"), headers["warc-type"]
    size = int(re.search(rb"(?im)^content-length:\s*(\d+)", head)[1])
    if kind == "response":
        size, found = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != digest:
            raise ValueError(f"payload of {headers['warc-record-id']} does not have its digest")
    refers = page_of(headers["warc-refers-to"]) if kind == "revisit" else None
    return url_key(headers["warc-target-uri"]), headers["warc-date"], page_of(headers["warc-record-id"]), size, digest, kind, refers


class LoserTree:
    """Merges sorted runs: each inner node holds the loser of its match, the overall winner is on top."""

    def __init__(self, runs: Iterable[Iterable[tuple]]):
        self.runs = [iter(r) for r in runs]
        self.heads = [next(r, None) for r in self.runs]
        k = len(self.runs)
        self.losers = [-1] * k
        for i in range(k):
            self._play(i)

    def _beats(self, a: int, b: int) -> bool:
        """Whether the head of run a comes first; an exhausted run loses, ties go to the lower run."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x, a) < (y, b)

    def _play(self, winner: int) -> None:
        node = (winner + len(self.runs)) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0:  # the first to come here waits for its opponent
                self.losers[node] = winner
                return
            if self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.runs and (head := self.heads[self.losers[0]]) is not None:
            winner = self.losers[0]
            yield head
            self.heads[winner] = next(self.runs[winner], None)
            self._play(winner)


def ascending_runs(rows: Iterable[tuple]) -> list[list[tuple]]:
    """Cut ``rows`` wherever the order falls."""
    out: list[list[tuple]] = []
    for r in rows:
        if out and out[-1][-1] <= r:
            out[-1].append(r)
        else:
            out.append([r])
    return out


def write_archives(pages: DataFrame, folder: str, params: WarcParams = WarcParams()) -> None:
    """Write a record for every row of ``pages`` (page_id, url, html) below ``folder``.

    Of rows with equal payloads of at least ``params.least_bytes`` bytes, the one with the largest page_id
    is a response and the others revisit it; of rows with the same page_id and payload, exactly one.
    A null html is an empty payload, a null page_id is smaller than all others, a null or empty url becomes a page URN.
    """
    key = F.coalesce(F.col("page_id"), F.lit(-(1 << 63)))
    rows = (pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), text_of("html").alias("html"))
            .withColumns({"key": key, "sha1": F.sha1(F.col("html").cast("binary"))}))
    # One row per page and payload decides for all rows that agree in both; they are told apart by number where they meet.
    facts = stage(rows.groupBy("key", "sha1").agg(F.first("page_id").alias("page_id")), "payloads")
    decided = stage(facts.join(facts.groupBy("sha1").agg(F.max("page_id").alias("keep_id")), "sha1")
                    .select("key", "sha1", "keep_id", F.col("page_id").eqNullSafe(F.col("keep_id")).alias("owner")), "payload-owners")
    copy = (F.row_number().over(Window.partitionBy("key", "sha1").orderBy(F.lit(0))) - 1).alias("copy")

    def compose(batches) -> Iterator[dict]:
        written, roll = 0, 0
        for b in batches:
            values, rolls = [], []
            for page, url, html, sha1, keep_id, owner, copy in zip(*(b[c] for c in columns), strict=True):
                small = len(html.encode("utf-8")) < params.least_bytes
                values.append(record(page, copy, url, html, sha1, keep_id, not small and (not owner or copy > 0)))
                rolls.append(roll)
                written += len(values[-1])
                if written >= params.archive_bytes:
                    written, roll = 0, roll + 1
            yield {"value": values, "roll": rolls}

    columns = ["page_id", "url", "html", "sha1", "keep_id", "owner", "copy"]
    composed = map_rows(rows.join(decided, ["key", "sha1"]).select(*columns[:-1], copy), compose, "value string, roll int")
    composed.write.partitionBy("roll").option("lineSep", "\r\n\r\n").option("compression", params.compression).text(folder)


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The captures of each archive as a locally sorted run."""

    def index(batches) -> Iterator[dict]:
        names = [c.split()[0] for c in CAPTURE.split(", ")]
        for b in batches:
            for path, content in zip(b["path"], b["content"], strict=True):
                run = sorted((capture(*r) for r in read_records(content)), key=_order)
                yield dict(zip(names, [[path] * len(run), *map(list, zip(*run, strict=True))], strict=True)) if run else {n: [] for n in names}

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(folder)
    return map_rows(files.select("path", "content"), index, CAPTURE)


def _order(c: tuple) -> tuple:
    """URL key, timestamp and page (null first), then the rest so that equal captures have one order."""
    return (c[0], c[1], c[2] is not None, c[2] or 0, *c[3:6], c[6] is not None, c[6] or 0)


def merge_runs(runs: DataFrame, params: WarcParams = WarcParams()) -> DataFrame:
    """All captures in order of URL key, timestamp and page: the partitions in order, each merged from the runs.

    Ranges are cut on all three keys, so one URL with very many captures is spread as well.
    """
    spark = runs.sparkSession
    held = stage(runs, "capture-runs")
    keys = ["url_key", "timestamp", "page_id"]
    n = parts_for(held.count(), params.merge_rows, int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = held.columns[1:]

    def merge(batches) -> Iterator[dict]:
        by_run: dict[str, list[tuple]] = {}
        for b in batches:
            for run, *rest in zip(*(b[c] for c in ("run", *names)), strict=True):
                by_run.setdefault(run, []).append((_order(tuple(rest)), tuple(rest)))
        # A shuffle may deliver a run's rows in pieces: each ascending piece is a run of its own.
        merged = [c for _, c in LoserTree(piece for run in sorted(by_run) for piece in ascending_runs(by_run[run]))]
        for i in range(0, len(merged), 1000):
            yield dict(zip(names, map(list, zip(*merged[i:i + 1000], strict=True)), strict=True))

    return map_rows(held.repartitionByRange(n, *keys), merge, CAPTURE.split(", ", 1)[1])


def archive_and_index(pages: DataFrame, folder: str | None = None, params: WarcParams = WarcParams()) -> DataFrame:
    """Write ``pages`` as archives to ``folder`` (none: a staging folder), read them back and merge their index.

    Returns per record page_id, url_key, timestamp, payload_bytes, payload_digest (bare base32 SHA-1), record_type and
    refers_to, both of the full payload, globally ordered. An empty table gives no archive and an empty index;
    columns other than page_id, url and html are not read.
    """
    spark = pages.sparkSession
    prepare(spark)
    folder = folder or staging_path(spark, "warc")
    write_archives(pages, folder, params)
    return merge_runs(read_runs(spark, folder), params)
