"""The held-back delta as one chain: landing files -> bronze -> cutoff -> fact, exactly once.

Every micro-batch of landed rows is merged into bronze (the newest row of a key stays). Of its keys, those whose date is
within the cutoff that the fact has reached are built and merged into the fact; later ones are held back.
When all files are in, the cutoff moves: bronze rows between the old and the new cutoff are built and merged.

What was done is noted in the tables themselves: a merge publishes its version together with the number of the micro-batch
or the cutoff, in one step. A batch that is executed again after a restart finds its number in bronze or in
the fact and skips what was published; a cutoff is moved once. The fact step of a batch reads the bronze version
that the batch published.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.operators.incremental import list_versions, merge_table, read_current, read_note
from ledgerstar.operators.staging import latest_per_key

NEVER = "0001-01-01"


class Chain:
    """One entity's chain. ``build`` maps due bronze rows to fact rows; ``fact_keys`` and ``fact_partition`` are the fact's.

    ``on_step`` is called with (batch number, step) after each published step; tests interrupt a run there.
    """

    def __init__(self, spark: SparkSession, landing: str, schema: T.StructType, base: str, keys: list[str], ts: str, date_col: str,
                 build: Callable[[DataFrame], DataFrame], fact_keys: list[str], fact_partition: str,
                 on_step: Callable[[int, str], None] | None = None):
        self.spark, self.landing, self.schema, self.keys, self.ts, self.date_col = spark, landing, schema, keys, ts, date_col
        self.build, self.fact_keys, self.fact_partition = build, fact_keys, fact_partition
        self.bronze, self.fact, self.checkpoint = f"{base}/bronze", f"{base}/fact", f"{base}/stream"
        self.on_step = on_step or (lambda batch, step: None)

    def cutoff(self) -> str:
        """The cutoff that the fact has reached."""
        return read_note(self.spark, self.fact).get("cutoff", NEVER)

    def _date(self):
        return F.col(self.date_col).try_cast("date")

    def _to_fact(self, due: DataFrame, note: dict) -> None:
        merge_table(self.spark, self.fact, self.build(due), self.fact_keys, self.fact_partition, note=note)

    def _batch(self, batch: DataFrame, number: int) -> None:
        spark = self.spark
        if read_note(spark, self.bronze).get("batch", -1) < number:
            rows = latest_per_key(batch, self.keys, self.ts).withColumn("day_month", F.date_format(self._date(), "yyyy-MM"))
            merge_table(spark, self.bronze, rows, self.keys, "day_month", newest=self.ts, note={"batch": number})
        self.on_step(number, "bronze")
        if read_note(spark, self.fact).get("batch", -1) < number:
            version = next(v for v in list_versions(spark, self.bronze) if read_note(spark, self.bronze, v).get("batch", -1) >= number)
            own = batch.select(*[F.col(k).alias("__" + k) for k in self.keys]).distinct()
            stored = read_current(spark, self.bronze, version)
            same = F.lit(True)
            for k in self.keys:
                same = same & stored[k].eqNullSafe(own["__" + k])
            self._to_fact(stored.join(own, same, "left_semi").where(self._date() <= F.lit(self.cutoff()).cast("date")), {"batch": number})
        self.on_step(number, "fact")

    def run(self, cutoff: str, files_per_trigger: int = 1000) -> None:
        """Take in all landed files that are not yet in, then move the cutoff (never back)."""
        spark = self.spark
        src = (spark.readStream.schema(self.schema).option("recursiveFileLookup", "true")
               .option("maxFilesPerTrigger", files_per_trigger).parquet(self.landing))
        q = (src.writeStream.foreachBatch(self._batch).option("checkpointLocation", self.checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
        before = self.cutoff()
        stored = read_current(spark, self.bronze)
        if stored is None or cutoff <= before:
            return
        day = self._date()
        self._to_fact(stored.where((day > F.lit(before).cast("date")) & (day <= F.lit(cutoff).cast("date"))), {"cutoff": cutoff})
        self.on_step(-1, "cutoff")
