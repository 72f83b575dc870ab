"""Lines of UTF-16 files, read in byte ranges.

Spark's line splitter cuts at single bytes, so its readers parse a UTF-16 file whole. Here a file is cut into ranges
of whole code units; a task returns the lines that begin in its range and reads on to the end of the last one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerstar.session import send_package

RANGE_BYTES = 32 << 20    # bytes of a file in one row of work
PIECE = 1 << 20           # bytes read at a time
BATCH_LINES = 8_192

_BOM = {b"\xff\xfe": "little", b"\xfe\xff": "big"}
_PACKED = (".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate")
_FIXED = {"UTF16LE": "little", "UTF16BE": "big"}


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    if local := re.fullmatch(r"(?:file:)?/+(.*)", path, re.S):
        return pafs.LocalFileSystem(), "/" + local[1]
    return pafs.FileSystem.from_uri(path)


def _newline(piece: bytes, at: int, order: str) -> int:
    """The byte of the first newline unit from ``at`` on (both even); -1 if there is none."""
    unit = b"\n\0" if order == "little" else b"\0\n"
    found = piece.find(unit, at)
    while found % 2 == 1:                 # halves of two neighbouring units; -1 is odd as well
        if found < 0:
            return -1
        found = piece.find(unit, found + 1)
    return found


def lines_in(file, lo: int, hi: int, size: int, order: str | None, piece: int = PIECE) -> Iterator[str]:
    """Lines that begin at the bytes ``lo .. hi - 1`` (both even) of a file of ``size`` bytes.

    ``order`` is the byte order, None if a byte order mark tells it (big without one). A mark is no part of the
    first line; a last line without a newline counts; half a unit at the end is an error.
    """
    if size % 2:
        raise ValueError("a UTF-16 file has an even number of bytes")
    file.seek(0)
    mark = _BOM.get(file.read(2))
    order = order or mark or "big"
    body = 2 if mark == order else 0
    codec = "utf-16-le" if order == "little" else "utf-16-be"
    lo = max(lo, body)
    at = lo if lo == body else lo - 2     # a line begins at lo if the unit before it is a newline
    skipping = lo != body
    file.seek(at)
    held, start = b"", at                 # unread bytes of the current line and where they begin
    while start < hi or skipping:
        read = file.read(piece - piece % 2)
        if not read:
            break
        first = len(held)
        held += read
        used, end = 0, _newline(held, first, order)
        while end >= 0:
            if skipping:
                skipping = False
            elif start + used < hi:
                yield held[used:end].decode(codec)
            else:
                return
            used = end + 2
            end = _newline(held, used, order)
        if skipping:
            used = len(held)
        held, start = held[used:], start + used
    if held and not skipping and start < hi and start + len(held) == size:
        yield held.decode(codec)


def read_lines(spark: SparkSession, path: str, encoding: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(line): the lines of every file at ``path``, a task per range of a file, in no order.

    Empty lines and files give no rows. Files must be plain: a compressed one cannot be cut and raises ``ValueError``.
    """
    order = _FIXED.get(encoding.upper().replace("-", "").replace("_", ""))
    step = range_bytes - range_bytes % 2
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(step).cast("long"))
    n = files.agg(F.sum(F.ceil(F.col("length") / F.lit(step)))).first()[0] or 1
    work = files.select("path", "length", F.explode(starts).alias("lo")).repartition(n)
    send_package(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, size, lo in zip(*(c.to_pylist() for c in b.columns)):
                if name.lower().endswith(_PACKED):
                    raise ValueError(f"{name}: a compressed UTF-16 file cannot be cut into ranges")
                fs, place = _place(name)
                lines: list[str] = []
                with fs.open_input_file(place) as file:
                    for line in lines_in(file, lo, lo + step, size, order):
                        if line:
                            lines.append(line)
                        if len(lines) == BATCH_LINES:
                            yield pa.RecordBatch.from_pydict({"line": lines}, pa.schema([("line", pa.string())]))
                            lines = []
                yield pa.RecordBatch.from_pydict({"line": lines}, pa.schema([("line", pa.string())]))

    return work.mapInArrow(run, "line string")
