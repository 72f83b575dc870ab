"""Bronze extract (cutoff, children, load metadata) and load reconciliation."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAYERS = ("bronze", "silver", "gold")


def table_path(base: str, layer: str, name: str) -> str:
    """``<base>/<layer>/<table>``: layer names carry no prefix."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    return f"{base.rstrip('/')}/{layer}/{name}"


def new_batch_id(prefix: str = "init", now: _dt.datetime | None = None) -> str:
    """``<prefix>_<yyyymmdd_hhmmss>``, computed once per batch on the driver."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return f"{prefix}_{now.strftime('%Y%m%d_%H%M%S')}"


def with_load_metadata(df: DataFrame, batch_id: str, source_file: str | Column | None = None,
                       loaded_at: Column | None = None) -> DataFrame:
    """Add ``_loaded_at``, ``_source_file`` (the scanned file name when not given) and ``_batch_id``."""
    src = source_file if isinstance(source_file, Column) else (
        F.lit(source_file) if source_file is not None else F.col("_metadata.file_name"))
    return df.select("*", (loaded_at if loaded_at is not None else F.current_timestamp()).alias("_loaded_at"),
                     src.alias("_source_file"), F.lit(batch_id).alias("_batch_id"))


def before(col: str | Column, cutoff: str) -> Column:
    """Date text parses and is on or before the cutoff (unparsable text is dropped)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("date") <= F.lit(cutoff).cast("date")


def bronze_extract(df: DataFrame, date_col: str, cutoff: str, batch_id: str, source_file: str | None = None,
                   loaded_at: Column | None = None) -> DataFrame:
    """Rows whose order date is on or before the cutoff, with load metadata. The filter
    is a plain predicate, so it is pushed to the scan."""
    return with_load_metadata(df.where(before(date_col, cutoff)), batch_id, source_file, loaded_at)


def bronze_children(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Only the children of retained parents (semi join: no parent column, no fan-out)."""
    pk = parent_key or key
    return child.join(parent.select(F.col(pk).alias(key)), key, "left_semi")


def bronze_full(df: DataFrame, batch_id: str, source_file: str | None = None,
                loaded_at: Column | None = None) -> DataFrame:
    """Full reload of a reference table with metadata (written with overwrite)."""
    return with_load_metadata(df, batch_id, source_file, loaded_at)


def reconcile_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, one labelled row each (a count per table, unioned)."""
    out = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("tbl"), "n")
        out = c if out is None else out.unionByName(c)
    return out


def cutoff_split(df: DataFrame, date_col: str, cutoff: str) -> DataFrame:
    """Initial load / held back for later / total, by the cutoff; one pass."""
    d = F.col(date_col).try_cast("date")
    c = F.lit(cutoff).cast("date")
    return df.agg(F.count_if(d <= c).alias("bronze_initial"), F.count_if(d > c).alias("held_back"),
                  F.count(F.lit(1)).alias("total_source"))


def load_batches(df: DataFrame) -> DataFrame:
    """Distinct batch / source file with first load time and row count."""
    return df.groupBy("_batch_id", "_source_file").agg(F.min("_loaded_at").alias("first_loaded"),
                                                        F.count(F.lit(1)).alias("n_rows"))


def date_range(df: DataFrame, col: str) -> DataFrame:
    d = F.col(col).try_cast("date")
    return df.agg(F.min(d).alias("min_date"), F.max(d).alias("max_date"))


def freshness(df: DataFrame, ts_col: str, warn_days: int = 30, error_days: int = 90,
              now: str | None = None, by: list[str] | None = None) -> DataFrame:
    """Age in days of the newest row (optionally per group) and a pass / warn / error status."""
    ref = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    g = df.groupBy(*(by or [])) if by else df.groupBy()
    out = g.agg(F.max(ts_col).alias("max_loaded"))
    age = F.datediff(ref.cast("date"), F.col("max_loaded").cast("date"))
    return out.withColumn("age_days", age).withColumn(
        "status", F.when(F.col("age_days") > error_days, "error").when(F.col("age_days") > warn_days, "warn")
        .otherwise("pass"))


def bronze_delta(src: DataFrame, tgt: DataFrame, key: str | list[str], ts: str, date_col: str | None = None,
                 cutoff: str | None = None) -> DataFrame:
    """Bronze delta: source rows modified strictly after the target's newest modification
    (and on or before the cutoff when given), merged into the target on the natural key.

    The watermark is one aggregate over the target's timestamp column. Rows changed at
    or before the watermark are not re-read here; the gold loads add a look-back for that.
    """
    from ledgerstar.operators.incremental import merge_upsert

    keys = [key] if isinstance(key, str) else list(key)
    mark = tgt.agg(F.max(F.col(ts).try_cast("timestamp")).alias("m")).first()["m"]
    new = src.where(F.col(ts).try_cast("timestamp") > F.lit(mark)) if mark is not None else src
    if date_col and cutoff:
        new = new.where(before(date_col, cutoff))
    return merge_upsert(tgt, new.select(*tgt.columns), keys)
