"""WARC archives: deduplicating writer, reader, and capture index by external merging.

Writing: of records with equal payloads the one with the largest page id is the response, the
others are revisits that name it and carry no payload. Records are written by Spark's text
writer, so any file system and lost tasks are handled by it; the record separator
``\\r\\n\\r\\n`` is the line separator. An archive holds ``ARCHIVE_CHARS`` characters or one longer
record, and is one gzip file in a folder of its own.

Reading: an archive is cut into records by ``Content-Length``, and yields a run of index entries
sorted by URL key and timestamp. The runs are written down and then read in their order: each is
cut into slices at the bounds of key ranges, a slice travels as one row and stays as sorted as its run, and
within each range the slices of all runs are merged by a loser tree. Nothing is sorted again. Ranges
in order, and entries within by ``place``, form the capture histories of all URLs.

The bounds are those of a sample of the entries, about ``SAMPLES_PER_RANGE`` for each range of
``entries_per_range``; the driver holds one key per range, ``MAX_RANGES`` at most, with
``BOUND_CHARS`` of its URL. Beyond that number the ranges grow. Any key may be a bound, so a sample
decides on balance, never on rows. The captures of one URL may lie in several ranges.

A null html counts as empty, a null url as "". Repeated rows are records of their own; if the
largest page id of a payload repeats, all rows with it are responses. A null page id is smaller
than any other and never named. Empty tables give none; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections import defaultdict
from datetime import UTC, datetime
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import arrow_schema, map_batches, written
from starloom.session import work_folder

ARCHIVE_CHARS = 32_000_000
ENTRIES_PER_RANGE = 50_000
SAMPLES_PER_RANGE = 64
MAX_RANGES = 50_000
BOUND_CHARS = 1_000
LEAST_PAYLOAD = 0
EPOCH = 1_700_000_000
# Dates are written with four digits of the year; times outside are moved to the nearest.
LAST_SECOND = 253_402_300_799

PAGE = "page_id long, url string, payload string, digest string, at long"
ENTRY = (
    "url_key string, at long, page_id long, url string, record_type string, payload_bytes long, "
    "payload_digest string, refers_to long, file string, offset long"
)
ORDER = ("url_key", "at", "page_id", "file", "offset")
RUN = 8  # the place of the file in an entry: every archive is one run
BREAK = b"\r\n\r\n"


def url_key(url: str) -> str:
    """Host labels reversed, then the path: captures of a site sort together."""
    try:
        parts = urlsplit(url.strip().lower())
        host, port = parts.hostname or "", f":{parts.port}" if parts.port not in (None, 80, 443) else ""
    except ValueError:
        return url.lower()
    labels = host.removeprefix("www.").split(".")
    return ",".join(reversed(labels)) + port + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def _digested(pages: DataFrame, at: Column) -> DataFrame:
    def columns(batch):
        return [*batch.columns[:3], [payload_digest(p.as_py().encode()) for p in batch["payload"]], batch["at"]]

    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    second = F.least(F.greatest(F.coalesce(at.cast("long"), F.lit(0)), F.lit(0)), F.lit(LAST_SECOND))
    given = pages.select(F.col("page_id").cast("long"), text("url").alias("url"), text("html").alias("payload"), second.alias("at"))
    return map_batches(given, PAGE, columns)


def typed(pages: DataFrame, at: Column, least_payload: int = LEAST_PAYLOAD) -> DataFrame:
    """Pages with ``first``, the response's page id of their payload, and ``is_revisit``."""
    rows = _digested(pages, at)
    # Copies are summed up before the shuffle; adaptive execution splits a hot payload in the join.
    chosen = rows.groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("copies"))
    joined = rows.join(chosen.filter("copies > 1").drop("copies"), "digest", "left")
    large = F.octet_length("payload") >= least_payload
    return joined.withColumn("is_revisit", F.coalesce(large & ~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False)))


def record(page_id, url: str, payload: str, digest: str, at: int, first, is_revisit: bool) -> str:
    """One WARC record without its closing line breaks."""
    raw = payload.encode()
    name = f"<urn:page:{'' if page_id is None else page_id}>"
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {name}",
        f"WARC-Date: {datetime.fromtimestamp(at, UTC):%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Target-URI: {url.encode('unicode_escape').decode()}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(raw)}",
    ]
    if is_revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{first}>"]
    head += ["Content-Type: text/html", f"Content-Length: {0 if is_revisit else len(raw)}"]
    return "\r\n".join(head) + "\r\n\r\n" + ("" if is_revisit else payload)


def write_archives(spark: SparkSession, pages: DataFrame, at: Column, least_payload: int = LEAST_PAYLOAD, archive_chars: int = ARCHIVE_CHARS) -> str:
    """The folder of the written archives."""
    ddl = "archive long, value string"
    schema = arrow_schema(ddl)

    def run(batches):
        # A task numbers its archives by itself; it writes them one after the other.
        archive, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            archives, records = [], []
            for row in batch.to_pylist():
                records.append(record(*row.values()))
                if held and held + len(records[-1]) > archive_chars:
                    archive, held = archive + 1, 0
                held += len(records[-1])
                archives.append(archive)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((archives, records), schema)], schema=schema)

    order = ("page_id", "url", "payload", "digest", "at", "first", "is_revisit")
    records = typed(pages, at, least_payload).select(*order).mapInArrow(run, ddl)
    folder = f"{work_folder(spark, 'warc')}/{uuid.uuid4().hex}"
    records.write.partitionBy("archive").option("lineSep", BREAK.decode()).option("compression", "gzip").text(folder)
    return folder


def records_of(data: bytes):
    """(offset, header fields, payload) of every record of an archive."""
    at = 0
    while at < len(data):
        stop = data.index(BREAK, at)
        lines = data[at:stop].decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        start = stop + len(BREAK)
        end = start + int(fields["Content-Length"])
        if data[end : end + len(BREAK)] != BREAK:
            raise ValueError(f"record at {at} doesn't end where its length says")
        yield at, fields, data[start:end]
        at = end + len(BREAK)


def _page(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def index_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The index entries of every archive: a run per file, sorted by URL key, time and page."""

    def entry(file, offset, fields, payload):
        revisit = fields["WARC-Type"] == "revisit"
        digest, size = payload_digest(payload), len(payload)
        told = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
        if not revisit and (digest, size) != told:
            raise ValueError(f"payload at {offset} of {file} differs from its header")
        url = fields["WARC-Target-URI"].encode().decode("unicode_escape")
        at = int(datetime.fromisoformat(fields["WARC-Date"]).timestamp())
        return (
            url_key(url), at, _page(fields["WARC-Record-ID"]), url, fields["WARC-Type"],
            told[1], told[0], _page(fields["WARC-Refers-To"]) if revisit else None, file, offset,
        )

    def columns(batch):
        rows = []
        for path, content in zip(batch["path"].to_pylist(), batch["content"]):
            data, file = zlib.decompressobj(31).decompress(content.as_py()), "/".join(path.rsplit("/", 2)[1:])
            rows += sorted((entry(file, *r) for r in records_of(data)), key=_order)
        return list(map(list, zip(*rows))) if rows else [[] for _ in ENTRY.split(", ")]

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return map_batches(files.select("path", "content"), ENTRY, columns)


def _order(entry: tuple) -> tuple:
    return entry[0], entry[1], -1 if entry[2] is None else entry[2], entry[RUN], entry[9]


def merge_runs(runs: list[list], key) -> list:
    """k sorted runs as one, by a loser tree.

    ``tree[n]`` holds the run that lost the match at node n; leaf i is node ``k + i``. The
    winner's next entry replays only the matches on its way up.
    """
    k = len(runs)
    if k < 2:
        return runs[0] if runs else []
    at = [0] * k
    last = (1,)
    heads = [(0, key(r[0])) if r else last for r in runs]
    tree = [-1] * k
    for run in range(k):
        winner, node = run, (run + k) // 2
        while node and tree[node] >= 0:
            if heads[tree[node]] < heads[winner]:
                tree[node], winner = winner, tree[node]
            node //= 2
        if node:
            tree[node] = winner
        else:
            top = winner
    merged = []
    while heads[top] != last:
        merged.append(runs[top][at[top]])
        at[top] += 1
        heads[top] = (0, key(runs[top][at[top]])) if at[top] < len(runs[top]) else last
        winner, node = top, (top + k) // 2
        while node:
            if heads[tree[node]] < heads[winner]:
                tree[node], winner = winner, tree[node]
            node //= 2
        top = winner
    return merged


def range_bounds(runs: DataFrame, entries_per_range: int) -> list[tuple]:
    """Keys, in order, at which the ranges after the first begin."""
    ranges = min(MAX_RANGES, -(-runs.count() // entries_per_range))
    if ranges < 2:
        return []
    one_in = max(1, entries_per_range // SAMPLES_PER_RANGE)
    sample = runs.filter(f"crc32(concat(file, ':', offset)) % {one_in} = 0").select(F.col("url_key").substr(1, BOUND_CHARS).alias("url_key"), *ORDER[1:])
    dealt = sample.repartitionByRange(ranges, *ORDER).select(F.spark_partition_id().alias("part"), F.struct(*ORDER).alias("key"))
    least = [tuple(r.key) for r in dealt.groupBy("part").agg(F.min("key").alias("key")).collect()]
    return sorted((key, at, -1 if page is None else page, file, offset) for key, at, page, file, offset in least)[1:]


def slices(runs: DataFrame, bounds: list[tuple]) -> DataFrame:
    """``part, entries``: the entries of one run within one key range, in the order of the run.

    A run that is read in several batches gives several slices of a range; each is sorted.
    """
    ddl = f"part int, entries array<struct<{ENTRY.replace(' ', ':').replace(',:', ',')}>>"
    schema = arrow_schema(ddl)
    shared = runs.sparkSession.sparkContext.broadcast(bounds)

    def run(batches):
        bounds = shared.value
        for batch in batches:
            starts, parts, last = [], [], None
            for i, row in enumerate(zip(*(c.to_pylist() for c in batch.columns))):
                key = _order(row)
                slice_of = row[RUN], bisect_right(bounds, key)
                # A key that falls would begin a slice too: what is sent is sorted, however it was read.
                if last is None or slice_of != last[0] or key < last[1]:
                    starts.append(i)
                    parts.append(slice_of[1])
                last = slice_of, key
            entries = pa.StructArray.from_arrays(batch.columns, fields=list(schema[1].type.value_type))
            lists = pa.ListArray.from_arrays(pa.array([*starts, len(batch)], pa.int32()), entries)
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), lists.cast(schema[1].type)], schema=schema)

    return runs.mapInArrow(run, ddl)


def capture_history(spark: SparkSession, folder: str, entries_per_range: int = ENTRIES_PER_RANGE) -> DataFrame:
    """All index entries in the order of ``part``, the number of the key range, and ``place`` in it."""
    runs = written(spark, index_runs(spark, folder), "warc-runs")
    bounds = range_bounds(runs, entries_per_range)
    ddl = f"part int, place int, {ENTRY}"
    schema = arrow_schema(ddl)

    def merge(batches):
        # One range a task; if Spark puts several together, they are merged one by one.
        ranges = defaultdict(list)
        for batch in batches:
            for part, entries in zip(batch["part"].to_pylist(), batch["entries"]):
                ranges[part].append(entries.values)
        for part in sorted(ranges):
            segments = [list(zip(*(c.to_pylist() for c in held.flatten()))) for held in ranges.pop(part)]
            rows = merge_runs(segments, _order)
            columns = [[part] * len(rows), range(len(rows)), *zip(*rows)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return slices(runs, bounds).repartitionById(len(bounds) + 1, "part").mapInArrow(merge, ddl)
