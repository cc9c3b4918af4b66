"""WARC archives: written as plain text files by Spark, indexed first, read by coalesced byte ranges.

* :func:`write_archive` turns rows into WARC/1.1 records.  The text writer's line separator is the
  blank line that ends a record, so each part file is an archive and Spark's commit protocol makes
  it whole or absent.  Equal payloads are stored once; later captures are ``revisit`` records.
* :func:`build_index` reads the headers of each archive and writes file, offset, length, URL and
  digest of every record as a table.
* :func:`read_records` sorts the wanted index rows by file and offset, joins neighbouring ranges to
  one read each, and cuts the records out of it.

Archives lie in a folder that all executors share; they are opened by ``pyarrow.fs``, which knows local
paths and the object stores and HDFS of its build.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortframe.llm.util import stage_table

CRLF = "\r\n"
#: Shorter payloads are always stored.
MIN_REVISIT = 100
#: Ranges with a gap of at most GAP bytes are one read, of RUN bytes at most unless one record is longer.
GAP, RUN = 1 << 16, 1 << 22
#: Bytes of archives for one task.
TASK = 1 << 24
#: Bytes read at once while headers are looked for.
HEAD = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "file string, offset long, length long, record_id string, record_type string, refers_to string, url string, digest string"


# ---------------------------------------------------------------- writing

def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_revisit: int = MIN_REVISIT, date: str = "2020-01-01T00:00:00Z") -> None:
    """One record for each row below ``path``: the payload in UTF-8, null as an empty one.

    Of rows with equal payloads of ``min_revisit`` bytes or more, those with the smallest id (nulls last)
    are responses and the others revisit them; repeated rows of that smallest id are responses,
    too.  Line breaks and other control characters in a URL are percent-encoded, a null URL has no
    header line, and a null id is written as ``null``.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload"))
    same = rows.filter(F.col("bytes") >= min_revisit).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    rows = rows.join(stage_table(same, "warc-same"), "digest", "left")
    again = F.col("first").isNotNull() & (F.col("id").isNull() | (F.col("id") > F.col("first")))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    escaped = F.col("url")
    for code in (*range(32), 127):
        escaped = F.replace(escaped, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    url = F.when(F.col("url").rlike(r"[\x00-\x1F\x7F]"), escaped).otherwise(F.col("url"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(CRLF * 2))
    block = F.when(again, http).otherwise(F.concat(http, F.col("payload")))
    block_bytes = F.octet_length(http) + F.when(again, 0).otherwise(F.col("bytes"))
    record = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", F.when(again, "revisit").otherwise("response")), line("WARC-Record-ID", urn("id")), line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", url), F.lit("")), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        F.when(again, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", urn("first")))).otherwise(""),
        line("Content-Type", F.lit("application/http;msgtype=response")), line("Content-Length", block_bytes.cast("string")), F.lit(CRLF), block)
    rows.select(record.alias("value")).write.option("lineSep", CRLF * 2).text(path)


# ---------------------------------------------------------------- reading

def _open(path: str):
    from pyarrow import fs
    if re.match(r"file:/|/", path):
        return fs.LocalFileSystem().open_input_file(re.sub(r"^file:/+", "/", path))
    store, inner = fs.FileSystem.from_uri(path)
    return store.open_input_file(inner)


def _header(raw: bytes) -> tuple[str, dict[str, str]]:
    first, *lines = raw.decode().split(CRLF)
    if not first.startswith("WARC/"):
        raise ValueError(f"no WARC record here: {first[:40]!r}")
    return first, {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}


def _headers(path: str) -> Iterator[tuple]:
    """An index row for each record of one archive; only a window of the file is held."""
    with _open(path) as f:
        size, at, base, window = f.size(), 0, 0, b""
        while at < size:
            end, want = window.find(b"\r\n\r\n", at - base) if base <= at < base + len(window) else -1, HEAD
            while end < 0:  # not in the window: read on from here, further each time
                f.seek(at)
                base, window = at, f.read(want)
                end = window.find(b"\r\n\r\n")
                if end < 0 and base + len(window) >= size:
                    raise ValueError(f"{path}: the record at {at} has no end of header")
                want *= 2
            _, h = _header(window[at - base:end])
            body = base + end + 4
            length = body + int(h["content-length"]) - at
            if at + length + 4 > size:
                raise ValueError(f"{path}: the record at {at} is cut off")
            yield path, at, length, h["warc-record-id"], h["warc-type"], h.get("warc-refers-to"), h.get("warc-target-uri"), h["warc-payload-digest"].removeprefix("sha256:")
            at += length + 4


def _tasks(ranges: DataFrame) -> int:
    """Tasks for reading ranges, by the bytes they will read and not by the size of their index."""
    return 1 + (ranges.agg(F.sum("length")).first()[0] or 0) // TASK


def build_index(spark: SparkSession, path: str) -> DataFrame:
    """Index of all archives below ``path``, one task's work being whole archives; written before any payload is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length").filter("length > 0")
    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.string()), ("url", pa.string()), ("digest", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                rows: list[tuple] = []
                for row in _headers(path):
                    rows.append(row)
                    if len(rows) == 8192:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    paths = files.select("path").repartition(_tasks(files))
    return stage_table(paths.mapInArrow(run, INDEX), "warc-index")


def read_records(index: DataFrame) -> DataFrame:
    """``(record_id, record_type, refers_to, url, digest, payload)`` of the index rows given; a revisit's payload is null."""
    want = index.select("file", "offset", "length")
    order = want.repartitionByRange(_tasks(want), F.col("file"), F.col("offset")).sortWithinPartitions("file", "offset")
    schema = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("url", pa.string()), ("digest", pa.string()), ("payload", pa.binary())])

    def record(raw: bytes) -> tuple:
        end = raw.index(b"\r\n\r\n")
        _, h = _header(raw[:end])
        payload = None if h["warc-type"] == "revisit" else raw[raw.index(b"\r\n\r\n", end + 4) + 4:]
        return h["warc-record-id"], h["warc-type"], h.get("warc-refers-to"), h.get("warc-target-uri"), h["warc-payload-digest"].removeprefix("sha256:"), payload

    def out(run: list[tuple[int, int]], f) -> pa.RecordBatch:
        begin = run[0][0]
        f.seek(begin)
        raw = f.read(max(o + n for o, n in run) - begin)
        rows = [record(raw[o - begin:o - begin + n]) for o, n in run]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, f, run = None, None, []
        for b in batches:
            for file, offset, length in zip(*(c.to_pylist() for c in b.columns)):
                near = run and file == name and offset <= run[-1][0] + run[-1][1] + GAP and offset + length <= run[0][0] + RUN
                if run and not near:
                    yield out(run, f)
                    run = []
                if file != name:
                    if f:
                        f.close()
                    name, f = file, _open(file)
                run.append((offset, length))
        if run:
            yield out(run, f)
            f.close()

    return order.mapInArrow(read, "record_id string, record_type string, refers_to string, url string, digest string, payload binary")


def captures(records: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` for each record, revisits with the payload they refer to.

    Size and digest come from the bytes that were read; a revisit has those of its response.
    """
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    seen = stage_table(records.select(
        number("record_id").alias("page_id"), "record_type", number("refers_to").alias("refers_to"), "digest",
        F.octet_length("payload").cast("long").alias("bytes"), F.sha2("payload", 256).alias("read_digest")), "warc-read")
    stored = seen.filter("record_type = 'response'").select(F.col("page_id").alias("p"), F.col("digest").alias("d"), "bytes", "read_digest").distinct()
    plain = seen.filter("record_type = 'response'").select("page_id", F.col("bytes").alias("payload_bytes"), F.col("read_digest").alias("payload_digest"), "record_type", "refers_to")
    again = seen.filter("record_type = 'revisit'").drop("bytes", "read_digest").join(stored, (F.col("refers_to") == F.col("p")) & (F.col("digest") == F.col("d")), "left")
    return plain.union(again.select("page_id", F.col("bytes").alias("payload_bytes"), F.col("read_digest").alias("payload_digest"), "record_type", "refers_to"))


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS bytes, sha256(html) AS digest FROM p),
f AS (SELECT digest, min(page_id) AS first FROM d WHERE bytes >= {MIN_REVISIT} GROUP BY digest)
SELECT page_id, CAST(bytes AS BIGINT) AS payload_bytes, d.digest AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM d LEFT JOIN f ON d.digest = f.digest
"""
