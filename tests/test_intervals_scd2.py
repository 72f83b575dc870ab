import datetime as dt

from pyspark.sql import functions as F

from ledgerstar.operators.intervals import asof_join, closed_intervals
from ledgerstar.operators.quality import no_overlap, one_current
from ledgerstar.operators.scd2 import expose_versions, scd2_apply

from conftest import rows

D = dt.date


def _history(spark):
    return spark.createDataFrame(
        [(1, D(2020, 1, 1), D(2020, 2, 1), 10), (1, D(2020, 2, 1), None, 11),
         (2, D(2020, 1, 1), D(2020, 1, 10), 20), (2, D(2020, 1, 20), None, 21)],     # gap 10..20
        "k int, start_date date, end_date date, v int")


def test_closed_intervals_fallback(spark):
    cur = spark.createDataFrame([(1, 99), (3, 30)], "k int, v int")
    iv = closed_intervals(_history(spark), cur, "k", "v", flag="fb")
    got = rows(iv, "k", "v", "valid_from", "valid_to", "fb")
    assert (3, 30, D(1900, 1, 1), D(9999, 12, 31), True) in got
    assert (1, 11, D(2020, 2, 1), D(9999, 12, 31), False) in got
    assert len(got) == 5


def test_closed_intervals_broadcast_no_history(spark):
    """The history is exploded, so its estimate is far below its size: the fallback join takes each key once, by a shuffle."""
    few = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    hist = few.select("k", F.explode(F.sequence(F.lit(2020), F.lit(2026))).alias("y")).select(
        "k", F.make_date("y", F.lit(1), F.lit(1)).alias("start_date"), F.lit(None).cast("date").alias("end_date"), F.lit(5).alias("v"))
    cur = spark.createDataFrame([(1, 9), (2, 7), (2, 7), (None, 8)], "k int, v int")
    iv = closed_intervals(hist, cur, "k", "v", flag="fb")
    got = rows(iv.where("fb"), "k", "v")
    assert got == [(2, 7), (2, 7), (None, 8)] and iv.where("not fb").count() == 21
    plan = iv._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "LeftAnti" in plan and "HashAggregate" in plan


def test_asof_join_edges(spark):
    cur = spark.createDataFrame([(1, 99)], "k int, v int")
    iv = closed_intervals(_history(spark), cur, "k", "v", flag="fb")
    facts = spark.createDataFrame(
        [(1, D(2020, 1, 1)), (1, D(2020, 1, 31)), (1, D(2020, 2, 1)), (1, D(2019, 12, 31)),
         (2, D(2020, 1, 15)), (2, D(2020, 1, 9)), (2, D(2020, 1, 10))], "k int, d date")
    from conftest import _key
    got = rows(asof_join(facts, iv, "k", "d", select=["v"]), "k", "d", "v")
    assert got == sorted([(1, D(2020, 1, 1), 10), (1, D(2020, 1, 31), 10), (1, D(2020, 2, 1), 11),
                          (1, D(2019, 12, 31), None), (2, D(2020, 1, 15), None), (2, D(2020, 1, 9), 20),
                          (2, D(2020, 1, 10), None)], key=_key)
    closed_both = asof_join(facts, iv, "k", "d", select=["v"], closed="both")
    assert (2, D(2020, 1, 10), 20) in rows(closed_both, "k", "d", "v")


def test_no_overlap_names_the_later_version(spark):
    df = spark.createDataFrame([(1, "a", D(2020, 1, 1), D(2020, 3, 1)), (1, "b", D(2020, 2, 1), D(2020, 4, 1)),
                                (2, "c", D(2020, 1, 1), D(2020, 2, 1)), (2, "d", D(2020, 2, 1), D(2020, 3, 1))],
                               "k int, id string, valid_from date, valid_to date")
    assert rows(no_overlap(df, "k", "id")) == [(1, "b", D(2020, 3, 1))]


def _snap_runs(spark):
    s = "k int, a string, b int, modified date"
    r1 = spark.createDataFrame([(1, "x", 1, D(2020, 1, 1)), (2, "y", None, D(2020, 1, 1)),
                                (3, "z", 3, D(2020, 1, 1)), (4, "w", 4, D(2020, 1, 1))], s)
    # 1 unchanged, 2 null -> value, 3 value changed, 4 vanished, 5 new
    r2 = spark.createDataFrame([(1, "x", 1, D(2020, 2, 1)), (2, "y", 2, D(2020, 2, 1)),
                                (3, "Z", 3, D(2020, 2, 1)), (5, "v", 5, D(2020, 2, 1))], s)
    # 2 value -> null
    r3 = spark.createDataFrame([(1, "x", 1, D(2020, 3, 1)), (2, "y", None, D(2020, 3, 1)),
                                (3, "Z", 3, D(2020, 3, 1)), (5, "v", 5, D(2020, 3, 1))], s)
    return r1, r2, r3


def test_scd2_history(spark):
    r1, r2, r3 = _snap_runs(spark)
    s1 = scd2_apply(None, r1, "k", ["a", "b"], "2020-01-01")
    s2 = scd2_apply(s1, r2, "k", ["a", "b"], "2020-02-01")
    s3 = scd2_apply(s2, r3, "k", ["a", "b"], "2020-03-01")
    got = rows(s3, "k", "a", "b", "version_from", "version_to")
    T = dt.datetime
    from conftest import _key
    assert got == sorted([
        (1, "x", 1, T(2020, 1, 1), None),
        (2, "y", None, T(2020, 1, 1), T(2020, 2, 1)), (2, "y", 2, T(2020, 2, 1), T(2020, 3, 1)),
        (2, "y", None, T(2020, 3, 1), None),
        (3, "z", 3, T(2020, 1, 1), T(2020, 2, 1)), (3, "Z", 3, T(2020, 2, 1), None),
        (4, "w", 4, T(2020, 1, 1), None),
        (5, "v", 5, T(2020, 2, 1), None)], key=_key)
    # re-running the last run at the same time changes nothing
    again = scd2_apply(s3, r3, "k", ["a", "b"], "2020-03-01")
    assert rows(again) == rows(s3)
    v = expose_versions(s3, "k")
    assert rows(one_current(v, "k")) == []
    assert rows(no_overlap(v.withColumn("vid", F.col("version_from").cast("string")), "k", "vid")) == []
    first = rows(v.where("k = 3").orderBy("version_from"), "valid_from")
    assert first[0][0] == dt.datetime(1900, 1, 1)


def test_null_keys_are_keys(spark):
    s = "k int, a string"
    h = scd2_apply(None, spark.createDataFrame([(None, "x"), (1, "y")], s), "k", ["a"], "2020-01-01")
    h = scd2_apply(h, spark.createDataFrame([(None, "x"), (1, "y")], s), "k", ["a"], "2020-02-01")
    assert h.count() == 2
    h = scd2_apply(h, spark.createDataFrame([(None, "z"), (2, None)], s), "k", ["a"], "2020-03-01")
    T = dt.datetime
    from conftest import _key
    assert rows(h) == sorted([(None, "x", T(2020, 1, 1), T(2020, 3, 1)), (None, "z", T(2020, 3, 1), None), (1, "y", T(2020, 1, 1), None), (2, None, T(2020, 3, 1), None)], key=_key)
    assert [r["valid_from"].year for r in expose_versions(h, "k").where("a = 'x'").collect()] == [1900]


def _size(base):
    return {p.relative_to(base).as_posix(): p.stat().st_size for p in base.rglob("data/**/*.parquet")}


def test_stored_history_equals_whole_table_and_writes_only_changes(spark, tmp_path):
    from ledgerstar.operators import history as H

    base, path = tmp_path / "h", str(tmp_path / "h")
    n, whole, wrote, seen = 3000, None, [], {}
    for run in range(1, 6):
        src = spark.range(n).selectExpr("case when id <> 5 then id end as k", f"case when id % 1000 = 5 then {run} else 0 end as a", "repeat('p', 50) as pad").coalesce(1)
        before = rows(whole) if whole is not None else None
        whole = scd2_apply(whole, src, "k", ["a"], f"2020-0{run}-01").checkpoint()
        H.snapshot(spark, path, src, "k", ["a"], f"2020-0{run}-01")
        now = _size(base)
        assert all(now[f] == size for f, size in seen.items())                # nothing written before is touched
        wrote.append(sum(spark.read.parquet(str(base / f)).count() for f in now if f not in seen))
        seen = now
        assert rows(H.read_history(spark, path, "k")) == rows(whole) != before
        if run == 3:
            v = H.compact(spark, path, "k")
            assert rows(H.read_history(spark, path, "k")) == rows(whole) and H.compact(spark, path, "k") == v
            assert H.open_versions(spark, path, "k").count() == n
            seen = _size(base)
    assert wrote == [n, 6, 6, 6, 6]                                            # three closings and three openings a run
    assert H.snapshot(spark, path, src, "k", ["a"], "2020-09-01") == H.list_versions(spark, path)[-1]
    assert rows(H.read_history(spark, path, "k")) == rows(whole)               # a repeated run changes nothing


def test_runs_of_a_history_at_once(spark, tmp_path):
    import pytest

    from ledgerstar.operators import history as H
    from ledgerstar.operators.incremental import DuplicateKeys, VersionConflict

    path = str(tmp_path / "h")
    src = spark.createDataFrame([(1, "a"), (2, "b")], "k int, a string")
    H.snapshot(spark, path, src, "k", ["a"], "2020-01-01")
    _, listed, schema = H._layout(spark, path)
    H.snapshot(spark, path, spark.createDataFrame([(1, "x")], "k int, a string"), "k", ["a"], "2020-02-01")
    mine = H._write(spark, src.selectExpr("k", "a", "timestamp_ntz'2020-02-01' as version_from", "cast(null as timestamp_ntz) as version_to", "'open' as state"), path)
    with pytest.raises(VersionConflict):
        H._publish(spark, path, [tuple(r) for r in listed] + mine, schema, 1)
    assert not (tmp_path / "h" / "data" / mine[0][0]).exists() and H.read_history(spark, path, "k").count() == 3
    with pytest.raises(DuplicateKeys):
        H.snapshot(spark, path, src.union(src), "k", ["a"], "2020-03-01")
