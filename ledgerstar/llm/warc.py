"""WARC archives: writing pages as records, reading records back by verified boundaries.

Writing: one record per page. Of the pages whose payloads are equal and at least ``REVISIT_BYTES`` long, the
one with the largest id is a ``response``, the others are ``revisit`` records that name it and carry no
payload. Spark's text writer writes the files (its line separator is the two CRLF that end a record), so
commits and retries are Spark's own and the files are plain uncompressed WARC/1.1 in any file system.

Reading: files are cut into byte ranges. A task that scans a range emits every place that looks like the
start of a record, with the place where its successor would start (from its Content-Length). Payloads may
hold such places too. Pointer jumping from the start of each file (every round doubles the length of the
known chain, a join on (file, position)) retains the records that are reachable; a file whose chain does not
end at its last byte is an error. Payloads are then read by position and hashed.

Ranges are opened with pyarrow's file systems (local, HDFS, S3, GCS), in tasks.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.llm.common import arrow_map, arrow_schema, cut, discard, ident, shared_path, stored

REVISIT_BYTES = 1000
RANGE_BYTES = 16 << 20   # bytes of a file that one scan task searches; results do not depend on it
DATE = "2024-01-01T00:00:00Z"
END = "\r\n\r\n"         # ends headers and records
MAGIC = b"\r\n\r\nWARC/1."


# --- writing -----------------------------------------------------------------------------------------------

def _text(c: Column) -> Column:
    return c.cast("string").cast("binary")


def records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(record): the bytes of one record per page, without the CRLF CRLF at its end.

    A NULL payload is empty, a NULL url has no Target-URI header, a NULL id is written as ``null`` and counts as
    the smallest. Rows equal in id and payload are all responses (or all revisits). Line ends in urls are percent-encoded.
    Other columns are ignored. Equality is by SHA-256 and length. Only ids and digests are grouped; payloads are
    moved only if the groups of equal payloads, written first, are too many for the planner to broadcast.
    """
    body = F.coalesce(ident(payload_col).cast("binary"), F.lit(b""))
    url = F.regexp_replace(F.regexp_replace(ident(url_col).cast("string"), "\r", "%0D"), "\n", "%0A")
    rows = pages.select(ident(id_col).cast("long").alias("id"), url.alias("url"), body.alias("body"))
    rows = rows.withColumn("n", F.octet_length("body").cast("long")).withColumn("same", F.when(F.col("n") >= REVISIT_BYTES, F.sha2("body", 256)))
    groups = (rows.filter("same is not null").groupBy("same", "n").agg(F.max("id").alias("owner"), F.count("*").alias("k"))
              .filter("k > 1 and owner is not null").drop("k"))
    groups = cut(groups, "warc-repeats").select(F.col("same").alias("same_"), F.col("n").alias("n_"), "owner")
    rows = rows.join(groups, (F.col("same") == F.col("same_")) & (F.col("n") == F.col("n_")), "left")
    revisit = F.col("owner").isNotNull() & F.coalesce(F.col("id") < F.col("owner"), F.lit(True))
    http = _text(F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n"), F.lit(END)))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("body")))
    lines = [F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
             F.concat(F.lit("WARC-Record-ID: <urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lit(">")),
             F.lit(f"WARC-Date: {DATE}"), F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
             F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.sha1("body")),
             F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("owner"), F.lit(">"))),
             F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
             F.lit("Content-Type: application/http; msgtype=response"),
             F.concat(F.lit("Content-Length: "), F.octet_length(block))]
    head = F.concat(F.concat_ws("\r\n", *lines), F.lit(END))  # concat_ws leaves NULL lines out
    return rows.select(F.concat(_text(head), block).alias("record"))


def write_archive(pages: DataFrame, path: str, **cols) -> None:
    """Write ``pages`` as WARC files under ``path``, one file per task; see :func:`records`."""
    records(pages, **cols).select(F.col("record").cast("string")).write.option("lineSep", END).text(path)


# --- reading -----------------------------------------------------------------------------------------------

@lru_cache(maxsize=64)
def _place(path: str) -> tuple[pafs.FileSystem, str]:
    if local := re.fullmatch(r"(?:file:)?/+(.*)", path, re.S):
        return pafs.LocalFileSystem(), "/" + local[1]
    return pafs.FileSystem.from_uri(path)


def _open(path: str) -> pa.NativeFile:
    fs, name = _place(path)
    return fs.open_input_file(name)


def _bracket(value: str | None) -> str | None:
    """The name in ``<urn:page:NAME>``."""
    return value[10:-1] if value and value.startswith("<urn:page:") and value.endswith(">") else value


def parse_header(head: bytes) -> dict[str, str] | None:
    """Fields by lower-case name; None if the lines are not a record header with a length."""
    first, *lines = head.decode("utf-8", "replace").split("\r\n")
    if not re.fullmatch(r"WARC/1\.\d", first):
        return None
    fields = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon:
            return None
        fields[name.strip().lower()] = value.strip()
    return fields if re.fullmatch(r"[0-9]{1,18}", fields.get("content-length", "")) else None


def scan_range(f: pa.NativeFile, size: int, start: int, end: int) -> Iterator[tuple]:
    """(pos, block, length, next, type, id, refers, digest) of every candidate that starts in [start, end).

    A candidate stands at the start of the file or after CRLF CRLF, which ends every record; so the headers of
    two candidates never overlap and the scan is linear. ``next`` is NULL beyond the end of the file.
    """
    low = max(0, start - 4)
    f.seek(low)
    data = f.read(min(size, end + len(MAGIC)) - low)
    at = [0] if start == 0 and data.startswith(MAGIC[4:]) else []
    k = data.find(MAGIC)
    while k >= 0:
        at.append(low + k + 4)
        k = data.find(MAGIC, k + 4)
    for pos in at:
        if not start <= pos < end:
            continue
        while (stop := data.find(b"\r\n\r\n", pos - low)) < 0 and low + len(data) < size:
            f.seek(low + len(data))
            data += f.read(min(1 << 20, size - low - len(data)))
        fields = parse_header(data[pos - low:stop]) if stop >= 0 else None
        if fields:
            block, n = low + stop + 4, int(fields["content-length"])
            after = block + n + 4
            digest = fields.get("warc-payload-digest")
            yield (pos, block, n, after if after <= size else None, fields.get("warc-type"), _bracket(fields.get("warc-record-id")),
                   _bracket(fields.get("warc-refers-to")), digest.removeprefix("sha1:") if digest else None)


CANDIDATE = T.StructType([T.StructField(n, t) for n, t in (
    ("file", T.LongType()), ("path", T.StringType()), ("pos", T.LongType()), ("block", T.LongType()), ("length", T.LongType()), ("next", T.LongType()),
    ("type", T.StringType()), ("name", T.StringType()), ("refers", T.StringType()), ("digest", T.StringType()))])


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, path, size) of the files under ``path``; contents are not read."""
    got = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size")).filter("size > 0")
    return cut(got.withColumn("file", F.monotonically_increasing_id()), "warc-files").select("file", "path", "size")


def candidates(files: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All places of the files that look like a record, with their successors (``CANDIDATE``)."""
    spark = files.sparkSession
    ranges = files.select("file", "path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(range_bytes).cast("long"))).alias("start"))
    ranges = ranges.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(CANDIDATE)
        for b in batches:
            for file, path, size, start in zip(*(c.to_pylist() for c in b.columns)):
                with _open(path) as f:
                    rows = [(file, path, *r) for r in scan_range(f, size, start, min(size, start + range_bytes))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    return arrow_map(ranges, run, CANDIDATE)


def reachable(links: DataFrame) -> DataFrame:
    """(file, pos) of the records on the chain from position 0, from links (file, pos, next).

    Pointer jumping: after k rounds every link jumps 2 ** k records, and the first 2 ** k records of each file
    are marked. The rounds end when no marked record jumps to a record; a chain of n records takes log2(n)
    rounds. Each round is one join and one grouping on (file, pos), written to the shared folder.
    """
    spark = links.sparkSession
    state, path = stored(links.select("file", "pos", F.col("next").alias("jump"), (F.col("pos") == 0).alias("reached")), "warc-chain")
    while state.filter("reached and jump is not null").limit(1).count():
        far = state.select("file", F.col("pos").alias("jump"), F.col("jump").alias("far"))
        moved = state.join(far, ["file", "jump"], "left").select("file", "pos", F.col("far").alias("jump"), "reached", F.lit(True).alias("known"))
        marks = state.filter("reached and jump is not null").select(
            "file", F.col("jump").alias("pos"), F.lit(None).cast("long").alias("jump"), F.lit(True).alias("reached"), F.lit(False).alias("known"))
        both = moved.union(marks).groupBy("file", "pos").agg(F.max("jump").alias("jump"), F.max("reached").alias("reached"), F.max("known").alias("known"))
        then, now = stored(both.filter("known").drop("known"), "warc-chain")
        discard(spark, path)
        state, path = then, now
    return state.filter("reached").select("file", "pos")


def read_archive(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(name, type, refers, payload_bytes, payload_digest) of every record; revisits have their own header's
    digest and no bytes. Raises ``ValueError`` where a file is not one chain of records or a payload does not
    match its digest. A folder without records gives an empty result."""
    files = archive_files(spark, path)
    found = cut(candidates(files, range_bytes), "warc-candidates")
    kept = cut(found.join(reachable(found.select("file", "pos", "next")), ["file", "pos"], "left_semi"), "warc-records")
    ends = kept.select("file", F.col("next").alias("size"))
    broken = files.join(ends, ["file", "size"], "left_anti").count()
    if broken:
        raise ValueError(f"{broken} files under {path} are not a chain of records")
    out = T.StructType([T.StructField("name", T.StringType()), T.StructField("type", T.StringType()), T.StructField("refers", T.StringType()),
                        T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, now, f = arrow_schema(out), None, None
        for b in batches:
            rows = []
            for path_, block, n, kind, name, refers, digest in zip(*(c.to_pylist() for c in b.columns)):
                if kind == "revisit":
                    rows.append((name, kind, refers, None, digest))
                    continue
                if path_ != now:
                    now, f = path_, _open(path_)
                f.seek(block)
                body = f.read(n)
                if kind == "response":
                    body = body[body.index(b"\r\n\r\n") + 4:]
                have = hashlib.sha1(body).hexdigest()
                if digest and digest.lower() != have:
                    raise ValueError(f"payload of {name} in {path_} does not match its digest")
                rows.append((name, kind, refers, len(body), have))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = kept.repartitionByRange(parts, "file", "pos").sortWithinPartitions("file", "pos")  # each file is read forwards
    return arrow_map(ordered.select("path", "block", "length", "type", "name", "refers", "digest"), run, out)


def round_trip(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to per page, read back from the archives.

    Revisits have the size and digest of the response that they name, which must be in the archives. Cases as in
    :func:`records`; an empty table gives an empty result; very long payloads are read one at a time.
    """
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    write_archive(pages, path, id_col=id_col, url_col=url_col, payload_col=payload_col)
    got = cut(read_archive(spark, path), "warc-read").select(
        F.when(F.col("name") != "null", F.col("name")).cast("long").alias("page_id"), "type", F.col("refers").cast("long").alias("refers_to"), "payload_bytes", "payload_digest")
    full = got.filter("type = 'response'")
    named = full.groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    again = got.filter("type = 'revisit'").drop("payload_bytes").join(named, ["refers_to", "payload_digest"], "left")
    cols = [F.col("page_id").alias(id_col), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to"]
    return full.select(*cols).unionByName(again.select(*cols))
