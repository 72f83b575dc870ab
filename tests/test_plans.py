"""Plan-shape checks: the operators plan as intended (no Cartesian products, no
nested-loop joins where an equi-join is meant, NULL keys salted, constants as scalars)."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from ledgerstar.operators.intervals import asof_join
from ledgerstar.operators.star import literal_key_join, resolve_fk


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_asof_join_is_an_equi_join_with_range_residual(spark):
    f = spark.createDataFrame([(1, dt.date(2020, 1, 5))], "k int, d date")
    iv = spark.createDataFrame([(1, dt.date(2020, 1, 1), dt.date(2020, 2, 1), 7)],
                               "k int, valid_from date, valid_to date, v int")
    p = _plan(asof_join(f, iv, "k", "d", select=["v"]))
    assert "NestedLoop" not in p and "Cartesian" not in p
    assert "HashJoin" in p or "SortMergeJoin" in p


def test_literal_member_is_a_scalar_not_a_join(spark):
    f = spark.createDataFrame([(1,), (2,)], "x int")
    dim = spark.createDataFrame([("USD", "USD"), ("EUR", "EUR")], "sk string, code string")
    out = literal_key_join(f, dim, "code", "USD", "sk", "sk_currency")
    p = _plan(out)
    assert "Join" not in p.split("Subquery")[0]
    assert sorted(r.sk_currency for r in out.collect()) == ["USD", "USD"]


def test_null_keys_are_salted_in_sort_merge_joins(spark):
    f = spark.createDataFrame([(1, 10), (2, None)], "id int, k int")
    dim = spark.createDataFrame([(10, 100)], "k int, sk int")
    out = resolve_fk(f, dim, {"k": "k"}, "sk", out="sk_k")
    assert "xxhash64" in _plan(out)
    assert sorted((r.id, r.sk_k) for r in out.collect()) == [(1, 100), (2, -1)]


def test_line_fact_has_no_cartesian_or_nested_loop(spark):
    from ledgerstar.plans.warehouse import Warehouse

    from conftest import SF_SMALL
    wh = Warehouse(spark, SF_SMALL, materialize=False)
    p = _plan(wh.fct_line)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def _hot_lines(spark, n=60_000):
    lines = spark.range(n).select((F.col("id") % 10 == 0).cast("int").alias("cold"), "id")
    return lines.select("id", F.when(F.col("cold") == 1, F.col("id") % 997).otherwise(F.lit(5)).alias("product_id"),
                        F.expr("date_add(date'2020-01-01', cast(id % 300 as int))").alias("order_date"), F.lit("x" * 40).alias("pad"))


def test_hot_product_is_split(spark):
    """90 % of the lines on one product: the one product join of the line fact is skew-split."""
    iv = spark.range(1000).select(F.col("id").alias("product_id"), F.lit(dt.date(2019, 1, 1)).alias("valid_from"),
                                  F.lit(dt.date(2030, 1, 1)).alias("valid_to"), F.col("id").alias("cost"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
            "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = asof_join(_hot_lines(spark).repartition(8), iv, "product_id", "order_date", select=["cost"])
        out = out.select("id", (F.col("cost") + 1).alias("c"))
        assert len(out.collect()) == 60_000
        assert "isSkew=true" in out._jdf.queryExecution().executedPlan().toString() or "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_small_dimensions_broadcast_and_pages_read_the_stored_fact(spark):
    from ledgerstar.plans.warehouse import close_shared, shared

    from conftest import SF_SMALL
    wh = shared(spark, SF_SMALL)
    assert shared(spark, SF_SMALL) is wh
    for k in ("order_status", "ship_method", "special_offer"):
        plan = wh.header.select(F.col("ship_method_id").alias("x")).join(wh.dims[k], F.col("x") == F.col(wh.dims[k].columns[0]).cast("string"), "left")
        assert "BroadcastHashJoin" in _plan(plan), k
        assert "file" in _plan(wh.dims[k]).lower()
    p = _plan(wh.fct_line.groupBy("sk_order_date").count())
    assert "Scan parquet" in p and "Join" not in p
    paths = list(wh.written)
    close_shared(spark)
    import os
    assert paths and not any(os.path.exists(x.replace("file:", "")) for x in paths)


def test_keys_of_a_compressed_layer_are_not_taken_for_a_small_table(spark, tmp_path):
    """Three million keys in a file of a few MB: no broadcast through the driver; a small layer still is one."""
    from ledgerstar.plans.warehouse import Warehouse

    from conftest import SF_SMALL
    for name, n in (("many", 3_000_000), ("few", 1_000)):
        spark.range(n).select("id", F.lit("the same text in all rows").alias("c")).coalesce(1).write.option("compression", "zstd").parquet(f"{tmp_path}/{name}")
    Warehouse(spark, SF_SMALL)
    facts = spark.range(4_000_000).select((F.col("id") % 7).alias("k"))
    for name, small in (("many", False), ("few", True)):
        keys = spark.read.parquet(f"{tmp_path}/{name}").select("id")
        assert ("BroadcastHashJoin" in _plan(facts.join(keys, facts.k == keys.id, "left"))) is small, name


def test_keep_runs_the_jobs_of_a_plain_write(spark):
    from ledgerstar.plans.warehouse import Warehouse
    from ledgerstar.session import scratch_path

    from conftest import SF_SMALL
    wh = Warehouse(spark, SF_SMALL)
    df = wh.t["orders"].groupBy("o_custkey").count()
    sc, tracker = spark.sparkContext, spark.sparkContext.statusTracker()

    def jobs(name, fn):
        sc.setJobGroup(name, name)
        fn()
        sc.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(name))

    plain = jobs("plain-write", lambda: df.write.parquet(scratch_path(spark, "plain")))
    assert jobs("keep-write", lambda: wh.keep("kept", df)) == plain


def test_session_sets_no_sizes_on_a_cluster(monkeypatch):
    from ledgerstar import session

    seen = {}

    class Builder:
        def appName(self, _):
            return self

        def master(self, _):
            return self

        def config(self, k, v):
            seen[k] = v
            return self

        def getOrCreate(self):
            raise StopIteration

    monkeypatch.setattr(session, "SparkSession", type("S", (), {"builder": Builder()}))
    for call in (lambda: session.get_session(),):
        try:
            call()
        except StopIteration:
            pass
    assert not {"spark.sql.shuffle.partitions", "spark.driver.memory"} & set(seen)
    assert session.is_local("local[4]") and not session.is_local("local-cluster[2,1,1024]") and not session.is_local("yarn")


def test_a_single_reader_computes_only_its_columns_of_the_line_fact(spark):
    """One query's reading of the line fact writes neither the fact nor the lines, and shuffles no content hash."""
    from ledgerstar.plans.warehouse import Warehouse

    from conftest import SF_SMALL
    wh = Warehouse(spark, SF_SMALL)
    try:
        mart = wh.mart_pareto.select("sk_product", "revenue", "line_count")
        got = sorted(map(tuple, mart.collect()))
        assert not any(n in p for p in wh.written for n in ("fct_sales_order_line", "stg_orderdetail", "header_resolved"))
        lines = wh.lines.groupBy("sk_order_date").agg(F.sum("net_amount"))
        assert "l_linenumber" not in _plan(lines) and "c_name" not in _plan(lines)
        part = wh.with_lines(["sk_product", "sales_order_id", "net_amount"])
        assert part.lines.columns == ["sk_product", "sales_order_id", "net_amount"] and "fct_line" not in wh.__dict__
        want = wh.fct_line.where("sk_product <> '-1'").groupBy("sk_product").agg(F.sum("net_amount"), F.count(F.lit(1)))
        assert got == sorted(map(tuple, want.collect()))
        assert wh.lines is wh.fct_line                                     # once it is written, it is read
        assert wh.header is wh.header and "order_rollup" not in " ".join(wh.written)
    finally:
        wh.close()


def test_a_reader_of_no_totals_neither_sums_the_lines_nor_writes_the_headers(spark):
    from ledgerstar.plans.warehouse import Warehouse

    from conftest import SF_SMALL
    wh, whole = Warehouse(spark, SF_SMALL), Warehouse(spark, SF_SMALL)
    try:
        lines = wh.lines.groupBy("sk_order_date", "sk_order_status").agg(F.sum("net_amount"), F.count(F.lit(1)))
        assert not any(n in p for p in wh.written for n in ("stg_orderheader", "order_totals", "order_rollup"))
        assert _plan(lines).count("lineitem.parquet") == 1 and _plan(lines).count("orders.parquet") == 1
        want = whole.fct_line.groupBy("sk_order_date", "sk_order_status").agg(F.sum("net_amount"), F.count(F.lit(1)))
        assert sorted(map(tuple, lines.collect())) == sorted(map(tuple, want.collect()))
        cols = ["sk_sales_order_line", "allocated_freight", "allocated_tax", "line_share_of_order"]   # sums come from a plan, too
        assert wh.lines.select(*cols).exceptAll(whole.fct_line.select(*cols)).count() == 0
        assert wh.header is not None and "stg_orderheader" in str(wh.header_plan.inputFiles())       # once written, they are read
    finally:
        wh.close()
        whole.close()


def test_the_order_fact_takes_the_roll_up_with_the_headers(spark):
    """Wide header rows are not joined to the roll-up again; headers that are stored without it still are, with the same rows."""
    from ledgerstar.plans import facts as FCT
    from ledgerstar.plans.warehouse import Warehouse

    from conftest import SF_SMALL
    wh, old = Warehouse(spark, SF_SMALL), Warehouse(spark, SF_SMALL)
    try:
        assert set(FCT.ROLLUP) <= set(wh.header_rolled.columns)
        assert "Join" not in _plan(FCT.fct_sales_order(wh.header_rolled, wh.detail))
        joined = FCT.fct_sales_order(old.header_resolved, old.detail, rollup=old.rollup)
        assert wh.fct_order.columns == joined.columns
        assert wh.fct_order.exceptAll(joined).count() == joined.exceptAll(old.fct_order).count() == 0
        assert wh.fct_order.count() == wh.t["orders"].count()
        assert wh.header_resolved.columns == old.header_resolved.columns and not any("stg_orderheader" in p for p in wh.written)
    finally:
        wh.close()
        old.close()


def test_the_slice_and_the_declared_checks_write_only_the_columns_they_read(spark):
    from ledgerstar.operators.incremental import read_current
    from ledgerstar.plans import registry as REG
    from ledgerstar.plans import warehouse as WH

    from conftest import SF_SMALL
    WH.close_shared(spark)
    try:
        sliced = REG.QUERIES["inc_slice"](spark, SF_SMALL).count()
        wh = WH.shared(spark, SF_SMALL)
        part = read_current(spark, wh.line_first_load_part, 1)
        assert part.columns == ["sales_order_id", "source_modified_date", "order_month"]
        assert part.count() == wh.detail.where(F.col("modified_date") < F.lit(REG.INC_BOUNDARY).cast("date")).count()
        whole = read_current(spark, REG._first_load(wh), 1)                 # a query that needs all columns has its own
        assert whole.count() == part.count() and "sk_sales_order_line" in whole.columns
        assert REG.QUERIES["inc_slice"](spark, SF_SMALL).count() == sliced > 0
        assert REG.QUERIES["dq_declared"](spark, SF_SMALL).where("failures is null").count() == 0
        assert "fct_line" not in wh.__dict__ and not any("fct_sales_order_line" in p for p in wh.written)
    finally:
        WH.close_shared(spark)


def test_tables_are_written_without_leaving_their_shuffles(spark):
    from ledgerstar.session import shuffles_dropped

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    with pytest.raises(RuntimeError), shuffles_dropped(spark):
        assert spark.conf.get(name) == "true"
        raise RuntimeError
    assert spark.conf.get(name) == before
