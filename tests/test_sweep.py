"""Sweeps over long histories against the joins they stand for."""

import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import rows
from ledgerstar.operators import sweep
from ledgerstar.operators.intervals import asof_join

D = dt.date


def pairs(df):
    """All pairs of a key that overlap, by a self join."""
    a, b = df.toDF("k", "a", "fa", "ta"), df.toDF("k2", "b", "fb", "tb")
    hit = (F.col("k") == F.col("k2")) & (F.col("a") != F.col("b")) & (F.col("fa") < F.col("tb")) & (F.col("fb") < F.col("ta"))
    return a.join(b, hit).select("k", F.col("a").alias("version_a"), F.col("b").alias("version_b"))


def test_overlaps_pairs(spark):
    df = spark.createDataFrame([(1, "a", D(2020, 1, 1), D(2020, 3, 1)), (1, "b", D(2020, 2, 1), D(2020, 4, 1)),
                                (2, "c", D(2020, 1, 1), D(2020, 2, 1)), (2, "d", D(2020, 2, 1), D(2020, 3, 1))],
                               "k int, id string, valid_from date, valid_to date")
    assert rows(sweep.overlaps(df, "k", "id")) == [(1, "a", "b"), (1, "b", "a")]
    assert rows(sweep.overlaps(df.limit(0), "k", "id")) == []


def test_overlaps_against_self_join(spark):
    """Random ranges, empty and turned ones, NULLs, repeated rows, text keys, a hot key and a version over all others."""
    rng = random.Random(5)
    data = []
    for i in range(900):
        lo = rng.randrange(400)
        data.append((rng.choice(["hot", "hot", "x", "", None]), i, lo, lo + rng.choice([-3, 0, 1, 2, 30])))
    data += [("hot", 5_000, -1, 1_000), ("hot", 5_001, 7, None), ("hot", None, 7, 90), ("x", 5_002, None, 9), *data[:40]]
    df = spark.createDataFrame(data, "k string, id int, valid_from int, valid_to int")
    for n in (1, 7):
        got = rows(sweep.overlaps(df, "k", "id", num_partitions=n))
        assert got == rows(pairs(df)) and len(got) > 5_000


def test_overlaps_of_a_long_history(spark, monkeypatch):
    """200,000 versions of one key that touch, three that overlap others: no range holds the key, no group is large."""
    n = 200_000
    df = spark.range(n).select(F.lit(1).alias("k"), "id", F.col("id").alias("valid_from"), (F.col("id") + 1).alias("valid_to"))
    more = spark.createDataFrame([(1, n, 10, 12), (1, n + 1, 150_000, 150_500), (1, n + 2, 199_999, 200_005)], "k int, id long, valid_from long, valid_to long")
    seen = []
    pin = sweep.pin_ranges

    def watched(*args):
        seen.append(pin(*args))
        return seen[-1]

    monkeypatch.setattr(sweep, "pin_ranges", watched)
    got = sweep.overlaps(df.unionByName(more), "k", "id", num_partitions=8)
    assert got.count() == 2 * (2 + 500 + 1)
    assert max(r["count"] for r in seen[0].groupBy("_pid").count().collect()) < 2 * 2 * n / 8


def test_asof_merge_equals_the_join(spark):
    """Histories with gaps, one of 100,000 versions, dates at the edges, NULLs, repeated rows and clashing names."""
    hot = spark.range(100_000).select(F.lit("hot").alias("k"), (F.col("id") * 3).alias("valid_from"), (F.col("id") * 3 + 2).alias("valid_to"), F.col("id").alias("v"))
    few = spark.createDataFrame([("a", 0, 5, 1), ("a", 5, 9, 2), ("b", 3, 3, 3), ("b", 4, 2, 4), (None, 0, 9, 5), ("c", None, 9, 6), ("c", 1, None, 7)],
                                "k string, valid_from long, valid_to long, v long")
    iv = hot.unionByName(few)
    rng = random.Random(2)
    facts = [(rng.choice(["hot", "hot", "a", "b", "c", "z", None]), rng.choice([None, *range(-1, 12), rng.randrange(300_010)]), i % 50, i) for i in range(3_000)]
    fact = spark.createDataFrame(facts + facts[:100], "k string, d long, v long, at int")
    for how in ("left", "inner"):
        for n in (1, 6):
            got = rows(sweep.asof_merge(fact, iv, "k", "d", select={"v": "found"}, how=how, num_partitions=n))
            want = asof_join(fact.toDF("k", "d", "w", "at"), iv.withColumnRenamed("k", "ik"), "k", "d", iv_key="ik", select={"v": "found"}, how=how)
            assert got == rows(want)
    assert rows(sweep.asof_merge(fact.limit(0), iv, "k", "d", select={"v": "found"})) == []
    assert {r["found"] for r in sweep.asof_merge(fact, iv.limit(0), "k", "d", select={"v": "found"}).collect()} == {None}


def test_asof_merge_overlapping_versions(spark):
    """The latest start counts, then the latest end; once that version has ended, nothing is found."""
    iv = spark.createDataFrame([(1, 0, 100, "long"), (1, 10, 20, "inner"), (1, 10, 15, "shorter")], "k int, valid_from int, valid_to int, v string")
    fact = spark.createDataFrame([(1, 5), (1, 12), (1, 50)], "k int, d int")
    assert rows(sweep.asof_merge(fact, iv, "k", "d")) == [(1, 5, "long"), (1, 12, "inner"), (1, 50, None)]
