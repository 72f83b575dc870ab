"""Continuous form of the incremental load: landing files -> look-back slice -> merge.

A file-source stream picks up new landing files; every micro-batch goes through the
same two steps as the batch load: the look-back slice, then a key merge restricted to
the partitions the batch touches. Spark's ``withWatermark`` is deliberately not used:
it would drop late rows, while the load must re-read them inside the look-back window
and rely on the merge being idempotent.

The slice's bound is taken once per run, from the table as the run finds it, and kept beside
the checkpoint until the run ends: all micro-batches of a landing use the same bound, however
many files a trigger takes, and a restarted run uses the bound it began with. Files of one
landing may come in any order; of several rows of a key the latest stays. A micro-batch that
is executed again merges the same rows again and leaves the table unchanged.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.operators.incremental import _fs, merge_table, read_current, watermark
from ledgerstar.operators.staging import latest_per_key


def run_bound(spark: SparkSession, table: str, checkpoint: str, ts: str, lookback_days: int) -> _dt.date:
    """The bound of the unfinished run if there is one, else a new one from the stored table."""
    path = f"{checkpoint}/bound"
    fs, p = _fs(spark, path)
    if fs.exists(_fs(spark, f"{path}/_SUCCESS")[1]):
        return spark.read.schema("bound date").parquet(path).first()["bound"]
    bound = watermark(read_current(spark, table), ts, lookback_days)
    spark.createDataFrame([(bound,)], "bound date").write.mode("overwrite").parquet(path)
    return bound


def end_run(spark: SparkSession, checkpoint: str) -> None:
    fs, p = _fs(spark, f"{checkpoint}/bound")
    fs.delete(p, True)


def merge_batch(spark: SparkSession, batch: DataFrame, table: str, keys: list[str], ts: str,
                partition_col: str, bound: _dt.date) -> None:
    """One micro-batch: rows from ``bound`` on (rows without a time are never cut), the
    latest per key, merged into the table."""
    part = batch.withColumn(partition_col, F.to_date(F.col(ts)))
    sl = part.where((F.col(ts) >= F.lit(bound)) | F.col(ts).isNull())
    merge_table(spark, table, latest_per_key(sl, keys, ts), keys, partition_col, newest=ts)


def stream_merge(spark: SparkSession, landing: str, schema: T.StructType, table: str, checkpoint: str,
                 keys: list[str], ts: str, partition_col: str = "event_date", lookback_days: int = 3,
                 files_per_trigger: int = 1000):
    """Process every landing file not yet consumed (``availableNow``) and return when done.
    ``files_per_trigger`` sets the size of a micro-batch; the result does not depend on it."""
    bound = run_bound(spark, table, checkpoint, ts, lookback_days)
    src = (spark.readStream.schema(schema).option("recursiveFileLookup", "true")
           .option("maxFilesPerTrigger", files_per_trigger).parquet(landing))

    def each(batch: DataFrame, epoch: int) -> None:
        merge_batch(spark, batch, table, keys, ts, partition_col, bound)

    q = (src.writeStream.foreachBatch(each).option("checkpointLocation", f"{checkpoint}/state")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    end_run(spark, checkpoint)
    return q
