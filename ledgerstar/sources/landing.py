"""Landing of headerless, tab-separated text files.

Format rules: tab separator, newline records, no header, no quoting and no escaping,
empty field or the text 'NULL' means NULL, a row with the wrong column count fails
the load. Every column lands as text; typing happens in staging.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.sources.utf16 import read_lines

NULL_MARKERS = ("", "NULL")          # fixed values: both mean NULL
CORRUPT = "_corrupt_record"


def landing_schema(cols: list[str]) -> T.StructType:
    """All-text positional schema (column order is the only contract)."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols])


def _is_utf16(encoding: str) -> bool:
    return encoding.upper().replace("-", "").replace("_", "") in ("UTF16", "UTF16LE", "UTF16BE")


def _fields(spark: SparkSession, path: str, cols: list[str], encoding: str) -> tuple[DataFrame, Column, list[Column]]:
    """Lines of UTF-16 files, whether a line has all its fields and no more, and its fields by position."""
    lines = read_lines(spark, path, encoding).withColumn("_p", F.split("line", "\t", -1))
    return lines, F.size("_p") == len(cols), [F.nullif(F.get("_p", F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(cols)]


def _reader(spark: SparkSession, schema: T.StructType, encoding: str, mode: str):
    return (spark.read.schema(schema)
            .option("sep", "\t").option("header", "false")
            .option("quote", "\u0000").option("escape", "\u0000")   # no quoting, no escaping
            .option("nullValue", "").option("emptyValue", "")
            .option("mode", mode).option("encoding", encoding)
            .option("enforceSchema", "true"))


def null_markers(df: DataFrame, cols: list[str]) -> DataFrame:
    """Second NULL marker: the reader takes one ``nullValue``; 'NULL' is cleared here."""
    return df.select(*[F.when(F.col(c) == F.lit(NULL_MARKERS[1]), F.lit(None)).otherwise(F.col(c)).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def read_landing(spark: SparkSession, path: str, cols: list[str], encoding: str = "UTF-8",
                 drop_cols: list[str] | None = None) -> DataFrame:
    """Read a landing file strictly (FAILFAST): a short or long row fails the job when
    the columns are materialised. ``drop_cols`` removes hostile columns (XML,
    hierarchy ids) right after the scan."""
    if _is_utf16(encoding):
        lines, whole, fields = _fields(spark, path, cols, encoding)
        fault = F.raise_error(F.concat(F.lit("malformed landing row: "), F.col("line"))).cast("string")
        df = lines.select(*[F.when(whole, f).otherwise(fault).alias(c) for f, c in zip(fields, cols)])
    else:
        df = _reader(spark, landing_schema(cols), encoding, "FAILFAST").csv(path)
    df = null_markers(df, cols)
    if drop_cols:
        df = df.drop(*drop_cols)
    return df


def validate_landing(spark: SparkSession, path: str, cols: list[str], encoding: str = "UTF-8") -> DataFrame:
    """Dry run: the rows that would fail the load, with their raw text.

    Column pruning is off for this read alone, so that every row is parsed in full whatever
    the caller selects (otherwise a count or a narrow projection would not see a short or
    long row); no session setting is touched.
    """
    if _is_utf16(encoding):
        lines, whole, fields = _fields(spark, path, cols, encoding)
        return lines.where(~whole).select(*fields, F.col("line").alias(CORRUPT))
    schema = landing_schema(cols).add(T.StructField(CORRUPT, T.StringType(), True))
    df = (_reader(spark, schema, encoding, "PERMISSIVE").option("columnPruning", "false")
          .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    return df.where(F.col(CORRUPT).isNotNull())


def load_landing(spark: SparkSession, path: str, cols: list[str], target: str, encoding: str = "UTF-8",
                 drop_cols: list[str] | None = None) -> DataFrame:
    """Load a file into a landing table; the write materialises every column, so any bad
    row aborts the load and leaves no table behind (the job fails before commit)."""
    df = read_landing(spark, path, cols, encoding, drop_cols)
    df.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def write_landing(df: DataFrame, path: str, encoding: str = "UTF-8") -> str:
    """Write a DataFrame as a headerless TSV landing file set (used to land extracts and
    in tests): every column as text, NULL as the empty field."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    (text.write.mode("overwrite").option("sep", "\t").option("header", "false")
     .option("quote", "\u0000").option("escape", "\u0000").option("nullValue", "")
     .option("emptyValue", "").option("encoding", encoding).option("lineSep", "\n").csv(path))
    return path
