import random
from decimal import Decimal

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerstar.operators.selection import buckets, ntiles, order_keys, select_keys
from ledgerstar.operators.staging import latest_per_key
from ledgerstar.operators.windows import global_rank, keyed_lag, keyed_running_max

from conftest import rows


def _scores(spark, n):
    # many ties in "v", unique tie-breaker "id"
    data = [(i, i % 3, Decimal(i % 7)) for i in range(n)]
    return spark.createDataFrame(data, "id int, v int, m decimal(10,0)")


def window_rank(df, order, value, ntiles):
    """The plain windows, all in one task."""
    w = W.orderBy(*[F.col(o).asc() if isinstance(o, str) else F.col(o[0]).desc() for o in order])
    out = (df.withColumn("rank", F.row_number().over(w).cast("bigint"))
           .withColumn("running", F.sum(value).over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
           .withColumn("total", F.sum(value).over(W.partitionBy())))
    for name, k in ntiles.items():
        out = out.withColumn(name, F.ntile(k).over(w).cast("bigint"))
    return out


def test_global_rank_equals_window(spark):
    for n in (3, 7, 23, 101):
        df = _scores(spark, n)
        args = dict(order=[("v", "desc"), "id"], value="m", ntiles={"q5": 5, "q3": 3})
        assert rows(global_rank(df, num_partitions=4, **args)) == rows(window_rank(df, **args)), n


def test_rank_keys_of_every_kind(spark):
    import datetime as dt

    data = [(None if i % 11 == 0 else Decimal(i % 7 - 3) * Decimal("1.00000001"), dt.date(2020, 1, 1) + dt.timedelta(i % 5) if i % 13 else None,
             dt.datetime(2020, 1, 1, 0, 0, i % 3), f"{'é' if i % 2 else 'z'}{i}", Decimal(i)) for i in range(200)]
    df = spark.createDataFrame(data, "m decimal(38,8), d date, ts timestamp_ntz, name string, v decimal(10,0)")
    for order in (["m", "d", "name"], [("m", "desc"), ("d", "desc"), "ts", "name"], [("ts", "desc"), "m", "name"], ["name"]):
        args = dict(order=order, value="v", ntiles={"q": 5})
        assert rows(global_rank(df, num_partitions=5, **args), "name", "rank", "running", "q") == rows(window_rank(df, **args), "name", "rank", "running", "q")
    with pytest.raises(ValueError):
        global_rank(df, ["name", "v"])
    assert global_rank(df.limit(0), ["m", "name"], value="v", ntiles={"q": 5}).collect() == []


def test_ten_million_equal_values_are_split(spark):
    df = spark.range(10_000_000).selectExpr("id", "cast(7 as decimal(10,2)) as v")
    b = df.withColumn("b", buckets(df, [("v", "desc"), "id"], 16)).groupBy("b").count().collect()
    assert len(b) == 16 and max(r["count"] for r in b) < 1.3 * 10_000_000 / 16
    r = global_rank(df, [("v", "desc"), "id"], value="v", num_partitions=16)
    assert r.where("rank <> id + 1 or running <> 7 * rank").count() == 0


def test_selection_finds_the_rows_of_ranks(spark):
    rng = random.Random(5)
    values = [rng.choice([3, 3, 3, rng.randrange(10**9)]) for _ in range(4000)]
    df = spark.createDataFrame([(v, f"t{i:05d}") for i, v in enumerate(values)], "v long, t string")
    n, keys = order_keys(df, {"a": ["v", "t"], "b": [("v", "desc"), "t"]})
    ranks = [1, 2, 700, 1999, 4000]
    got = select_keys(df, keys, {"a": ranks, "b": ranks})
    for key, sign in (("a", 1), ("b", -1)):
        want = sorted(range(n), key=lambda i: (sign * values[i], f"t{i:05d}"))
        assert [text[-6:] for text in got[key]] == [f"t{want[r - 1]:05d}" for r in ranks]


def test_ntiles_equal_window_and_move_no_row(spark):
    for n in (0, 1, 3, 4, 5, 101, 1000):
        df = spark.createDataFrame([(i % 4, Decimal(i * 37 % 11), f"c{i}") for i in range(n)], "f int, m decimal(20,4), sk string")
        got = ntiles(df, {"x": (["f", "sk"], 5), "y": (["m", "sk"], 5), "z": ([("m", "desc"), "sk"], 3)})
        want = df.select("*", *[F.ntile(k).over(W.orderBy(*o)).cast("bigint").alias(c) for c, o, k in
                                (("x", ["f", "sk"], 5), ("y", ["m", "sk"], 5), ("z", [F.col("m").desc(), "sk"], 3))])
        assert rows(got) == rows(want)
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()


def test_marts_move_rows_once(spark):
    """No range exchange, no checkpoint; the Pareto ranks exchange the products once, by bucket."""
    from ledgerstar.plans import marts

    base = spark.createDataFrame([(f"c{i}", i, i % 3, Decimal(i)) for i in range(50)], "sk_customer string, recency_days int, frequency_orders long, monetary_total decimal(28,2)")
    p = marts.rfm_scores(base)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in p and "ExistingRDD" not in p
    lines = spark.createDataFrame([(f"p{i % 40}", Decimal(i), Decimal(1), 1) for i in range(400)], "sk_product string, net_amount decimal(20,2), gross_margin decimal(20,2), order_qty int")
    names = spark.createDataFrame([("p1", 1, "a", "b", "c")], "sk_product string, product_id int, product_name string, subcategory_name string, category_name string")
    p = marts.mart_product_abc_pareto(lines, names)._jdf.queryExecution().executedPlan().toString()
    main = [x for x in p.splitlines() if "Exchange hashpartitioning(_b" in x]
    assert "rangepartitioning" not in p, p
    assert len(main) == 2  # the rows, and one partial sum per bucket


def test_ntile_buckets(spark):
    df = _scores(spark, 7)
    out = rows(global_rank(df, ["id"], ntiles={"q": 5}, num_partitions=3), "id", "q")
    assert [q for _, q in out] == [1, 1, 2, 2, 3, 4, 5]


def test_keyed_lag_hot_key_spans_partitions(spark):
    # one key holds most rows, so the range partitions split it
    data = [(0, i) for i in range(200)] + [(k, i) for k in range(1, 6) for i in range(3)]
    df = spark.createDataFrame(data, "k int, t int")
    a = rows(df.withColumn("prev_t", F.lag("t").over(W.partitionBy("k").orderBy("t"))))
    assert rows(keyed_lag(df, ["k"], ["t"], ["t"], num_partitions=6)) == a


def test_keyed_lag_of_null_keys(spark):
    data = [(None, i) for i in range(150)] + [(1, i) for i in range(50)] + [(2, None)]
    df = spark.createDataFrame(data, "k int, t int")
    a = rows(df.withColumn("prev_t", F.lag("t").over(W.partitionBy("k").orderBy("t"))))
    assert rows(keyed_lag(df, ["k"], ["t"], ["t"], num_partitions=7)) == a


def test_running_max_of_a_hot_key(spark):
    data = [(0, i, (i * 37) % 101) for i in range(200)] + [(k, i, i) for k in range(1, 6) for i in range(3)]
    df = spark.createDataFrame(data, "k int, t int, v int")
    w = W.partitionBy("k").orderBy("t").rowsBetween(W.unboundedPreceding, -1)
    want = rows(df.withColumn("m", F.max("v").over(w)))
    assert rows(keyed_running_max(df, ["k"], ["t"], "v", out="m", num_partitions=7)) == want


def test_latest_per_key(spark):
    import datetime as dt
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1), "a"), (1, dt.date(2020, 1, 2), "b"),
                                (2, dt.date(2020, 1, 1), "c"), (2, dt.date(2020, 1, 1), "d")],
                               "id int, modified date, payload string")
    got = rows(latest_per_key(df, "id", "modified"))
    assert got == [(1, dt.date(2020, 1, 2), "b"), (2, dt.date(2020, 1, 1), "d")]
