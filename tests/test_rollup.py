"""Bitmaps of ids against distinct counts."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from ledgerstar.operators.rollup import bitmap_rows, merge_bitmaps


def _facts(spark):
    rng = random.Random(4)
    edge = [0, 1, -1, 32_767, 32_768, 32_769, -32_767, -32_768, -32_769, 2**62, -2**62, None]
    data = [(rng.choice([2019, 2020, None]), rng.randrange(1, 13), rng.choice([*edge, rng.randrange(200_000), rng.randrange(500)]), rng.randrange(100)) for _ in range(4_000)]
    return spark.createDataFrame(data, "year int, month int, id long, amount long")


def test_months_roll_up_to_years_and_to_all(spark):
    df = _facts(spark)
    months = bitmap_rows(df, {"year": F.col("year"), "month": F.col("month")}, "id", ["amount"])
    for by in (["year", "month"], ["year"], ["month"], []):
        want = df.groupBy(*by).agg(F.sum("amount").alias("amount"), F.countDistinct("id").alias("ids"))
        assert rows(merge_bitmaps(months, by, "ids", ["amount"])) == rows(want)


def test_stored_parts_merge(spark):
    """Rows made from two parts of the facts, as two loads would leave them, give the counts of the whole."""
    df = _facts(spark)
    by = {"year": F.col("year")}
    parts = bitmap_rows(df.where("amount < 50"), by, "id", ["amount"]).unionByName(bitmap_rows(df.where("amount >= 50"), by, "id", ["amount"]))
    want = df.groupBy("year").agg(F.sum("amount").alias("amount"), F.countDistinct("id").alias("ids"))
    assert rows(merge_bitmaps(parts, ["year"], "ids", ["amount"])) == rows(want)


def test_empty_table_and_other_types(spark):
    df = _facts(spark)
    none = bitmap_rows(df.limit(0), {"year": F.col("year")}, "id", ["amount"])
    assert rows(merge_bitmaps(none, ["year"], "ids", ["amount"])) == []
    assert rows(merge_bitmaps(none, [], "ids", ["amount"])) == [(None, 0)]
    with pytest.raises(ValueError, match="whole numbers"):
        bitmap_rows(df.withColumn("id", F.col("id").cast("string")), {}, "id", [])


def test_pages_read_the_monthly_rows(spark):
    """The dashboard's totals and the yearly measures scan the monthly rows alone, not the line fact."""
    from ledgerstar.plans import business as BQ
    from ledgerstar.plans.warehouse import shared

    w = shared(spark, SF_SMALL)
    got = BQ.kpis_of_months(w.line_months)
    assert rows(got) == rows(BQ.kpis(w.fct_line))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "id_bits" in plan and "sk_sales_order_line" not in plan


def test_bitmaps_are_built_after_the_last_shuffle(spark):
    """Ids that lie in many tasks: sums per id are shuffled, never a bitmap of 4 KB per task, group and bucket."""
    df = spark.range(0, 40_000, 1, 20).select((F.col("id") % 7).alias("g"), (F.xxhash64("id") % 30_000).alias("id"), F.lit(1).alias("amount"))
    out = bitmap_rows(df, {"g": F.col("g")}, "id", ["amount"])
    plan = out._jdf.queryExecution().executedPlan().toString().splitlines()
    built = [i for i, line in enumerate(plan) if "bitmap_construct_agg" in line]
    dealt = [i for i, line in enumerate(plan) if "Exchange" in line]
    assert built and dealt and max(built) < min(dealt)        # a plan is printed from its result down
    assert out.count() == out.select("g", "id_bucket").distinct().count()
