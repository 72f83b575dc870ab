"""Helpers shared by the operators: table access, cutting lineage, Arrow batches."""

from __future__ import annotations

import atexit
import contextlib
import io
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

import ledgerstar
from ledgerstar.session import scratch_path

# A word is a run of characters other than space, tab, \n, \v, \f and \r.
WORD_RE = r"[^\x20\x09-\x0D]+"

# Rows of an Arrow batch. Texts may be long, so batches are kept short (Spark also ends a batch at 64 MB, by
# spark.sql.execution.arrow.maxBytesPerBatch); results do not depend on it.
ARROW_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; read by Spark only, so any file system that Spark knows will do."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later jobs start from the files, so they neither recompute what is above nor lose it with an
    executor. The folder is the one named by ``spark.checkpoint.dir``.
    """
    return stored(df, name)[0]


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As :func:`cut`, with the place of the files, for :func:`discard` once they are no longer needed."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table of :func:`stored`. Nothing may be computed from it afterwards."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    _WRITTEN[:] = [w for w in _WRITTEN if w[1] != path]


_WRITTEN: list[tuple[SparkSession, str]] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder, deleted by :func:`clean_up`."""
    path = scratch_path(spark, name)
    _WRITTEN.append((spark, path))
    return path


def clean_up() -> None:
    """Delete all tables that operators of this process have written. Results that were not yet
    collected or written can no longer be computed afterwards. Runs at interpreter exit too."""
    while _WRITTEN:
        spark, path = _WRITTEN.pop()
        sc = spark.sparkContext
        if sc._jsc is None:  # the session has ended
            continue
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def _at_exit() -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone by then
        clean_up()


atexit.register(_at_exit)


def ident(name: str) -> Column:
    """A column by its exact name (dots and back-ticks are part of the name)."""
    return F.col("`" + name.replace("`", "``") + "`")


def ident_in(struct: str, name: str) -> Column:
    """A field of a struct column by its exact name."""
    return F.col(struct).getField(name)


def pack(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that added columns cannot clash with them."""
    return F.struct(*[ident(c) for c in df.columns])


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, wherever they were started.

    It goes through the shared folder, as a file that Spark hands to every executor."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root, data = Path(ledgerstar.__file__).parent, io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    path = f"{shared_path(spark, 'code')}/ledgerstar.zip"
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(sc._jsc.hadoopConfiguration()).create(target)
    out.write(data.getvalue())
    out.close()
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def arrow_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with short batches."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return df.mapInArrow(fn, schema)


def arrow_schema(struct: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(struct)


def draw(*keys: Column, seed: int) -> Column:
    """A uniform number in (0, 1) fixed by the keys and the seed (52 bits of an MD5 digest).

    The digest is used instead of Spark's own hash because other SQL engines have it as well.
    NULL keys count as the text ``~``.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("~")) for k in keys])
    n = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")
    return (n.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def repeats(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with ``repeat``: 0 for the first row of a ``key`` (a column, never NULL), then 1, 2, ...; which row is first
    does not matter.

    The rows are written with their places; a key is counted per written part and the parts of a key are
    numbered one after the other, so no task holds more of one key than one part has.
    """
    at = cut(rows.withColumn("place_", F.monotonically_increasing_id()), name).withColumn("part_", F.shiftright("place_", 33))
    before = F.sum("k_").over(W.partitionBy("key").orderBy("part_").rowsBetween(W.unboundedPreceding, -1))
    counts = at.groupBy("key", "part_").agg(F.count("*").alias("k_")).select("key", "part_", F.coalesce(before, F.lit(0)).alias("off_"))
    own = F.row_number().over(W.partitionBy("key", "part_").orderBy("place_")) - 1
    return at.withColumn("own_", own).join(counts, ["key", "part_"]).withColumn("repeat", F.col("own_") + F.col("off_")).drop("place_", "part_", "own_", "off_", "k_")


def ascii_ws_words(text: str | None) -> list[bytes]:
    """The words (``WORD_RE``) of a text as UTF-8 bytes; ``bytes.split`` splits on exactly that class."""
    return text.encode("utf-8", "surrogatepass").split() if text else []
