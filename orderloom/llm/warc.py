"""WARC archives of pages, and their merged index of captures (operator 5).

Writing: each page is one record, written as text that ends with the two line ends of the format, so Spark's own writer places
and commits the files on any store. Of pages with equal payloads (by SHA-1, from ``LEAST_BYTES`` on) that with the
largest id is a response, and the others are revisits that refer to it.

Reading: each file is parsed by its records' lengths, and its captures, sorted by URL key and time, are one run of the
index. Split keys taken from a bounded sample of the runs cut every run into segments. The segments of one key range
meet in a task, where a loser tree merges its k runs; ranges follow each other, so the histories are ordered
throughout. A key with very many captures is cut between times and ids, too.
"""

from __future__ import annotations

import gzip
import hashlib
import re
from bisect import bisect_right
from datetime import datetime, timedelta
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_schema, stored

LEAST_BYTES = 1000
FILE_BYTES = 16 << 20
RANGE_ROWS = 50_000
SAMPLE = 20_000
RECORD_END = "\r\n\r\n"
FIRST_DATE = "2020-01-01 00:00:00"


def page_rows(pages: DataFrame) -> DataFrame:
    """(page_id, url, html, payload_bytes, payload_digest, refers_to) of every page.

    A missing html is an empty payload. A page without id is a response, and none refers to it. Repeated rows of the id that is
    referred to are responses all.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.select("*", F.octet_length("html").cast("long").alias("payload_bytes"),
                       F.sha1(F.col("html").cast("binary")).alias("payload_digest"))
    kept = rows.filter(F.col("payload_bytes") >= LEAST_BYTES).groupBy("payload_digest").agg(
        F.max("page_id").alias("kept"), F.count("*").alias("n")).filter("n > 1").drop("n")
    joined = rows.join(kept, "payload_digest", "left")
    revisit = (F.col("payload_bytes") >= LEAST_BYTES) & (F.col("page_id") < F.col("kept"))
    return joined.select("page_id", "url", "html", "payload_bytes", "payload_digest",
                         F.when(revisit, F.col("kept")).alias("refers_to"))


def record_id(page_id: Column) -> Column:
    """A record's name, made from the page's id so that revisits can state it."""
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(page_id.cast("string"), F.lit("none"))))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def records(rows: DataFrame) -> DataFrame:
    """(value): WARC records without their final line ends. Rows of ``page_rows``; pages carry no time, so it is the id in
    seconds after a first date."""
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit("\r\n"))
    revisit = F.col("refers_to").isNotNull()
    date = F.date_format(F.timestamp_seconds(F.unix_timestamp(F.lit(FIRST_DATE)) + F.coalesce("page_id", F.lit(0))),
                         "yyyy-MM-dd'T'HH:mm:ss'Z'")
    url = F.regexp_replace(F.coalesce("url", F.lit("")), "[\\x00-\\x20]", "%20")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(RECORD_END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    head = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_id(F.col("page_id"))), line("WARC-Date", date), line("WARC-Target-URI", url),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        F.when(revisit, F.concat(
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"),
            line("WARC-Refers-To", record_id(F.col("refers_to"))),
            line("X-Refers-To-Page", F.col("refers_to").cast("string")))).otherwise(""),
        F.when(F.col("page_id").isNotNull(), line("X-Page", F.col("page_id").cast("string"))).otherwise(""),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(RECORD_END))
    return rows.select(F.concat(head, block).alias("value"))


def write_archives(pages: DataFrame, out: str, file_bytes: int = FILE_BYTES, compression: str = "gzip") -> None:
    """Write a record per page (page_id, url, html) to files of about ``file_bytes`` at most in the folder ``out``.

    Pages are written where the search for equal payloads left them, so their texts are shuffled once. A file is
    compressed as a whole (``compression`` may be "none"); sizes and places count its uncompressed bytes.
    """
    size, n = pages.select(F.sum(F.coalesce(F.octet_length("html"), F.lit(0)) + 600), F.count("*")).first()
    per_file = max(1, int(file_bytes * n / size)) if n else 1
    rows = records(page_rows(pages))
    rows.write.option("lineSep", RECORD_END).option("maxRecordsPerFile", per_file).text(out, compression=compression)


def url_key(url: str) -> str:
    """Sort-friendly form of a URL: the host's labels reversed, then path and query; without scheme, port and fragment."""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").lower()
    except ValueError:
        return url
    host = re.sub(r"^www\d*\.", "", host)
    return ",".join(reversed(host.split("."))) + ")" + (parts.path or "/") + ("?" + parts.query if parts.query else "")


def parse(content: bytes):
    """(headers, block start, block end, record start) of every record, by its lengths."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode("utf-8", "surrogateescape").split("\r\n")
        headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        begin = end + 4
        stop = begin + int(headers["Content-Length"])
        if content[stop:stop + 4] != b"\r\n\r\n" or not lines[0].startswith("WARC/"):
            raise ValueError(f"damaged record at byte {at}")
        yield headers, begin, stop, at
        at = stop + 4


CAPTURES = ("url_key string, at timestamp, page_id long, record_type string, payload_digest string, payload_bytes long, "
            "refers_to long, file string, offset long, length long")


def capture(content: bytes, file: str, found) -> tuple:
    """Index entry of one record. A response's payload is measured and its digest recomputed from the archive's bytes."""
    headers, begin, stop, at = found
    body = content.index(b"\r\n\r\n", begin, stop) + 4
    response = headers["WARC-Type"] == "response"
    digest = hashlib.sha1(content[body:stop]).hexdigest() if response else headers["WARC-Payload-Digest"].split(":")[1]
    if response and "sha1:" + digest != headers["WARC-Payload-Digest"]:
        raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its digest")
    number = lambda name: int(headers[name]) if name in headers else None
    return (url_key(headers["WARC-Target-URI"]), datetime.strptime(headers["WARC-Date"], "%Y-%m-%dT%H:%M:%SZ"),
            number("X-Page"), headers["WARC-Type"], digest, stop - body if response else None,
            number("X-Refers-To-Page"), file, at, stop + 4 - at)


def sort_key(c: tuple) -> tuple:
    """URL key, time, id (a missing one first), place."""
    return (c[0], c[1], c[2] is not None, c[2] or 0, c[7], c[8])


def sorted_runs(spark: SparkSession, out: str) -> DataFrame:
    """The captures of every file in order, a run each, with the run's number of the capture."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt*").load(out).select("path", "content")
    schema = arrow_schema(CAPTURES + ", seq long")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                path, content = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                name = path.rsplit("/", 1)[-1]
                if name.endswith(".gz"):
                    content = gzip.decompress(content)
                found = sorted((capture(content, name, r) for r in parse(content)), key=sort_key)
                for s in range(0, len(found), 5000):
                    part = found[s:s + 5000]
                    yield batch_of(part, schema, range(s, s + len(part)))

    return files.mapInArrow(run, CAPTURES + ", seq long")


def batch_of(rows: list[tuple], schema: pa.Schema, *more) -> pa.RecordBatch:
    columns = [*zip(*rows), *more] if rows else [[]] * len(schema)
    arrays = []
    for c, f in zip(columns, schema):
        c = list(c)
        if pa.types.is_timestamp(f.type):
            c = [int((x.replace(tzinfo=None) - datetime(1970, 1, 1)) / timedelta(microseconds=1)) for x in c]
            arrays.append(pa.array(c, pa.int64()).cast(f.type))
        else:
            arrays.append(pa.array(c, f.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


class LoserTree:
    """Merge of k sorted runs: each inner node keeps the loser of its match, so a step replays one path of log2 k."""

    def __init__(self, runs: list, key):
        self.runs = [iter(r) for r in runs]
        self.key = key
        self.k = len(runs)
        self.heads = [next(r, None) for r in self.runs]
        self.losers = [-1] * self.k
        for i in range(self.k - 1, -1, -1):
            self._replay(i, filling=True)

    def _before(self, a: int, b: int) -> bool:
        """Whether run a's head goes first; an exhausted run loses, equal heads go by run."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (self.key(x), a) < (self.key(y), b)

    def _replay(self, run: int, filling: bool = False) -> None:
        node, winner = (run + self.k) // 2, run
        while node:
            other = self.losers[node]
            if other < 0 and filling:
                self.losers[node] = winner
                return
            if self._before(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self):
        while self.k:
            winner = self.losers[0]
            head = self.heads[winner]
            if head is None:
                return
            yield head
            self.heads[winner] = next(self.runs[winner], None)
            self._replay(winner)


def merged_index(spark: SparkSession, out: str, range_rows: int = RANGE_ROWS, sample: int = SAMPLE) -> DataFrame:
    """All captures of a folder of archives in order: their columns, and ``place``, which ascends with (url_key, at, page_id)."""
    runs = stored(sorted_runs(spark, out), "runs")
    total = runs.count()
    ranges = max(1, -(-total // range_rows))
    bounds: list[tuple] = []
    if ranges > 1:
        drawn = F.pmod(F.xxhash64("file", "offset"), F.lit(1 << 20)) < int(min(1.0, sample / total) * (1 << 20)) + 1
        names = [c.strip().split(" ")[0] for c in CAPTURES.split(",")]
        keys = sorted(sort_key(tuple(r)) for r in runs.filter(drawn).select(*names).toLocalIterator())
        bounds = [keys[len(keys) * i // ranges] for i in range(1, ranges)] if keys else []
    schema = arrow_schema(CAPTURES + ", seq long")
    inner = arrow_schema("part int, run string, seq long, entries binary")

    def segments(batches):
        """Rows of one run and range as one row each."""
        for batch in batches:
            rows = list(zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)]))
            rows = [(r[0], r[1].replace(tzinfo=None), *r[2:]) for r in rows]
            parts = [bisect_right(bounds, sort_key(r)) for r in rows]
            begin = 0
            for i in range(1, len(rows) + 1):
                if i == len(rows) or parts[i] != parts[begin] or rows[i][7] != rows[begin][7]:
                    piece = rows[begin:i]
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, schema) as writer:
                        writer.write_batch(batch_of(piece, schema))
                    row = [[parts[begin]], [piece[0][7]], [piece[0][10]], [sink.getvalue().to_pybytes()]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, inner)], schema=inner)
                    begin = i

    whole = arrow_schema(CAPTURES + ", place long")

    def merge(batches):
        part, held = None, {}

        def close():
            tree = iter(LoserTree([held[r] for r in sorted(held)], sort_key))
            at, rows = 0, []
            for row in tree:
                rows.append(row[:10])
                if len(rows) == 5000:
                    yield batch_of(rows, whole, range((part << 32) + at, (part << 32) + at + len(rows)))
                    at, rows = at + len(rows), []
            if rows:
                yield batch_of(rows, whole, range((part << 32) + at, (part << 32) + at + len(rows)))

        for batch in batches:
            for p, run, _, entries in zip(*[c.to_pylist() for c in batch.columns]):
                if p != part:
                    if held:
                        yield from close()
                    part, held = p, {}
                table = pa.ipc.open_stream(entries).read_all()
                held.setdefault(run, []).extend(
                    (r[0], r[1].replace(tzinfo=None), *r[2:]) for r in zip(*[c.to_pylist() for c in table.columns]))
        if held:
            yield from close()

    pieces = runs.mapInArrow(segments, "part int, run string, seq long, entries binary")
    dealt = pieces.repartition(ranges, "part").sortWithinPartitions("part", "run", "seq")
    return dealt.mapInArrow(merge, CAPTURES + ", place long")


def captures(spark: SparkSession, out: str, **options) -> DataFrame:
    """The merged index with the payload bytes of revisits taken from the responses that they refer to."""
    index = stored(merged_index(spark, out, **options), "index")
    sizes = index.filter("record_type = 'response' AND page_id IS NOT NULL").groupBy(
        F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("_bytes"))
    return index.join(sizes, ["refers_to", "payload_digest"], "left").withColumn(
        "payload_bytes", F.coalesce("payload_bytes", "_bytes")).drop("_bytes")


def capture_history(captured: DataFrame) -> DataFrame:
    """The captures with their number within their URL key's history (1 for the oldest)."""
    return captured.withColumn("capture", F.row_number().over(Window.partitionBy("url_key").orderBy("place")))
