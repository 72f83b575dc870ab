import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerstar.operators import quality as Q
from ledgerstar.operators.incremental import (DuplicateKeys, changed_rows, incremental_slice, list_versions, merge_table, merge_upsert,
                                              read_current, write_table)
from ledgerstar.sources import bronze as SB
from ledgerstar.sources import landing as SL

from conftest import rows

COLS = ["a", "b", "c"]


def _write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


def test_landing_utf8_and_utf16(spark):
    d = tempfile.mkdtemp(prefix="landing-", dir="/tmp")
    text = "1\t\tcafé\n2\tNULL\tsay \"hi\"\n"
    _write(os.path.join(d, "u8.tsv"), text)
    _write(os.path.join(d, "u16.tsv"), text, "utf-16")
    for name, enc in (("u8.tsv", "UTF-8"), ("u16.tsv", "UTF-16")):
        got = rows(SL.read_landing(spark, os.path.join(d, name), COLS, encoding=enc))
        assert got == [("1", None, "café"), ("2", None, 'say "hi"')], enc


def test_bad_rows_found_and_load_fails(spark):
    d = tempfile.mkdtemp(prefix="landing-", dir="/tmp")
    p = os.path.join(d, "bad.tsv")
    _write(p, "1\tx\ty\n2\tshort\n3\tx\ty\tlong\n")
    bad = SL.validate_landing(spark, p, COLS)
    assert sorted(r["a"] for r in bad.collect()) == ["2", "3"]
    with pytest.raises(Exception):
        SL.load_landing(spark, p, COLS, os.path.join(d, "out"))


def test_cutoff_children_and_reconcile(spark):
    h = spark.createDataFrame([("1", "2013-12-30"), ("2", "2013-12-31"), ("3", "2014-01-01"), ("4", "n/a")],
                              "id string, orderdate string")
    lines = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c"), ("3", "d")], "id string, x string")
    b = SB.bronze_extract(h, "orderdate", "2013-12-31", "init_x", "h.csv")
    assert sorted(r["id"] for r in b.collect()) == ["1", "2"]
    ch = SB.bronze_children(lines, b, "id")
    assert sorted(r["x"] for r in ch.collect()) == ["a", "b"]
    split = SB.cutoff_split(h, "orderdate", "2013-12-31").first()
    assert tuple(split) == (2, 1, 4)
    rc = rows(SB.reconcile_counts({"h": h, "b": b}))
    assert rc == [("b", 2), ("h", 4)]


def test_quality_checks_return_planted_rows(spark):
    df = spark.createDataFrame([(1, "A", None), (1, "B", 2), (2, "Z", 3)], "k int, c string, n int")
    assert rows(Q.not_null(df, ["k", "n"])) == [("n", 1)]
    assert rows(Q.unique(df, ["k"])) == [(1, 2)]
    assert rows(Q.accepted_values(df, "c", ["A", "B"])) == [("Z", 1)]
    dim = spark.createDataFrame([(1,)], "k int")
    assert rows(Q.relationships(df, "k", dim, "k")) == [(2, 1)]


def test_uniqueness_checks_of_a_table_share_one_exchange(spark):
    df = spark.createDataFrame([(1, "a", dt.date(2020, 1, 1)), (1, None, dt.date(2020, 1, 1)), (2, None, dt.date(2020, 1, 1)), (2, "1", None)], "k int, s string, d date")
    got = Q.declared_checks(df, ["s"], ["k", "s", "d"], {"s": ["a"]})
    assert {(r["check_name"], r["column_name"]): r["failures"] for r in got.collect()} == {
        ("not_null", "s"): 2, ("accepted_values", "s"): 1, ("unique", "k"): 2, ("unique", "s"): 0, ("unique", "d"): 1}
    plan = Q.declared_checks(df, [], ["k", "s", "d"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_uniqueness_checks_shuffle_a_hash_and_not_the_values(spark):
    df = spark.createDataFrame([("x" * 40, 1), ("x" * 40, 2), ("y" * 40, 3), (None, 3), (None, None)], "s string, k int")
    got = Q.declared_checks(df, [], ["s", "k"])
    assert {r["column_name"]: r["failures"] for r in got.collect()} == {"s": 1, "k": 1}
    assert any("repeated-hashes" in f for f in got.inputFiles())   # only values of these are grouped themselves


def test_checks_of_landed_text_read_it_once(spark, tmp_path):
    odd = [(1, "a", None), (1, None, "x"), (2, None, "x"), (None, "1", "y"), (None, None, None)]
    df = spark.createDataFrame(odd, "k int, s string, v string")
    for nn, un in ((["k", "s", "v"], ["k", "s", "v"]), (["v", "k"], []), (["s"], ["v"])):
        for part in (df, df.where("k = 2"), df.where("false")):
            assert rows(Q.declared_checks_once(part, nn, un)) == rows(Q.declared_checks(part, nn, un))
    path = SL.write_landing(df, str(tmp_path / "landed"))
    got = Q.declared_checks_once(SL.read_landing(spark, path, ["k", "s", "v"]), ["k", "s"], ["k", "v"])
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1


def test_the_staged_models_are_checked_in_one_scan_each(spark):
    from ledgerstar.plans import registry as REG

    got = REG.QUERIES["dq_declared_staging"](spark, "/root/testdata/sf0.001")
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == len(REG._staged_checks())


def test_integers_of_landed_text_round_as_ever(spark):
    from ledgerstar.functions.columns import to_int_rounded
    from ledgerstar.operators.staging import Col, apply_spec

    texts = ["0", "7", "-7", "+7", "007", " 7 ", "12.49996", "12.5", "-12.5", "1e3", "2147483647", "-2147483648", "3.", ".6", "-0", None]
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    assert apply_spec(df, [Col("c", "c", "i")]).collect() == df.select(to_int_rounded("c").alias("c")).collect()
    wide = spark.createDataFrame([(12, 12.5)], "a int, b double").selectExpr("a", "b", "cast(b as decimal(10, 2)) as c")
    assert tuple(apply_spec(wide, [Col(c, c, "i") for c in "abc"]).first()) == (12, 13, 13)
    with pytest.raises(Exception):
        apply_spec(spark.createDataFrame([("2147483648",)], "c string"), [Col("c", "c", "i")]).collect()


def test_net_gap_and_mutation(spark):
    header = spark.createDataFrame([(1, 10.0), (2, 5.0)], "o int, sub double")
    lines = spark.createDataFrame([(1, 4.0), (1, 6.0), (2, 5.0)], "o int, net double")
    assert rows(Q.net_gap(lines, header, "o", "net", "sub")) == []
    broken = lines.withColumn("net", F.col("net") * 1.1)
    assert [r[0] for r in rows(Q.net_gap(broken, header, "o", "net", "sub"))] == [1, 2]


def test_merge_drops_matched_rows_without_moving_the_target(spark, tmp_path):
    """The matched keys, a few, are found from the key columns and broadcast; the target's rows are not exchanged."""
    spark.range(100_000).selectExpr("if(id = 7, null, id) as k", "concat('row ', id) as v").write.parquet(str(tmp_path / "t"))
    spark.range(99_990, 200_000).selectExpr("if(id = 100007, null, id) as k", "'new' as v").write.parquet(str(tmp_path / "s"))
    tgt, src = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "s"))
    got = merge_upsert(tgt, src, "k")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100000")
    try:
        assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert (got.count(), got.where("v = 'new'").count(), got.where("k is null").count()) == (199_999, 100_010, 1)


def test_merge_is_idempotent_and_partition_scoped(spark, tmp_path):
    tgt = spark.createDataFrame([(1, "a", "m1"), (2, "b", "m1"), (3, "c", "m2")], "k int, v string, p string")
    src = spark.createDataFrame([(2, "B", "m1"), (4, "d", "m3")], "k int, v string, p string")
    once = merge_upsert(tgt, src, ["k"])
    assert rows(once) == [(1, "a", "m1"), (2, "B", "m1"), (3, "c", "m2"), (4, "d", "m3")]
    assert rows(changed_rows(once, merge_upsert(once, src, ["k"]))) == []
    base = str(tmp_path / "t")
    write_table(tgt, base, "p")
    assert merge_table(spark, base, src, "k", "p") == 2
    assert rows(read_current(spark, base)) == rows(once)
    assert merge_table(spark, base, src, "k", "p") == 3
    assert rows(read_current(spark, base)) == rows(once)          # replay changes nothing
    assert rows(read_current(spark, base, 1)) == rows(tgt)        # the old version is untouched
    runs = {f.split("/")[0] for v in (1, 3) for f in [r["folder"] for r in spark.read.parquet(f"{base}/versions/v={v}").collect()] if f.endswith("p=m2")}
    assert len(runs) == 1                                         # the untouched month was never rewritten


def test_merge_moves_keys_between_partitions_and_keeps_null(spark, tmp_path):
    base, schema = str(tmp_path / "t"), "k int, d date, p string"
    day = dt.date
    write_table(spark.createDataFrame([(1, day(2020, 1, 5), "2020-01"), (2, day(2020, 1, 29), "2020-01"), (3, None, None), (4, None, None)], schema), base, "p")
    src = spark.createDataFrame([(2, day(2020, 2, 2), "2020-02"), (3, day(2020, 2, 3), "2020-02"), (5, None, None)], schema)
    merge_table(spark, base, src, "k", "p")
    assert rows(read_current(spark, base)) == [(1, day(2020, 1, 5), "2020-01"), (2, day(2020, 2, 2), "2020-02"), (3, day(2020, 2, 3), "2020-02"),
                                               (4, None, None), (5, None, None)]


def test_merge_refuses_duplicate_source_keys(spark, tmp_path):
    tgt = spark.createDataFrame([(1, "a")], "k int, p string")
    twice = spark.createDataFrame([(1, "b"), (1, "c")], "k int, p string")
    with pytest.raises(DuplicateKeys):
        merge_upsert(tgt, twice, "k")
    base = str(tmp_path / "t")
    write_table(tgt, base, "p")
    with pytest.raises(DuplicateKeys):
        merge_table(spark, base, twice, "k", "p")
    assert rows(read_current(spark, base)) == [(1, "a")]


def test_failed_merge_leaves_the_old_version(spark, tmp_path):
    base = str(tmp_path / "t")
    write_table(spark.createDataFrame([(1, 1, "x")], "k int, v int, p string"), base, "p")
    broken = spark.createDataFrame([(2, 0, "y")], "k int, v int, p string").withColumn("v", (F.lit(1) / F.col("v")).cast("int"))
    with pytest.raises(Exception):
        merge_table(spark, base, broken, "k", "p")
    assert list_versions(spark, base) == [1] and rows(read_current(spark, base)) == [(1, 1, "x")]


def test_stream_of_many_batches_keeps_old_rows(spark, tmp_path):
    from ledgerstar.streaming.merge_stream import run_bound, stream_merge

    land, table, ckpt = (str(tmp_path / x) for x in ("land", "table", "ckpt"))
    schema = "id int, ts timestamp_ntz, v int"
    first = [(1, dt.datetime(2024, 1, 20), 1)], [(2, dt.datetime(2024, 1, 5), 1)], [(3, None, 1)], [(4, dt.datetime(2024, 1, 19), 1)]
    for k, part in enumerate(first):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{land}/a{k}")
    stream_merge(spark, land, spark.createDataFrame([], schema).schema, table, ckpt, ["id"], "ts", files_per_trigger=1)
    assert sorted(r["id"] for r in read_current(spark, table).collect()) == [1, 2, 3, 4]
    # second landing: one row moves to another day, one is older than the look-back, one arrives twice
    for k, part in enumerate([[(1, dt.datetime(2024, 1, 22), 2)], [(5, dt.datetime(2024, 1, 2), 2)], [(4, dt.datetime(2024, 1, 21), 3)], [(4, dt.datetime(2024, 1, 20), 2)]]):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{land}/b{k}")
    assert run_bound(spark, table, ckpt, "ts", 3) == dt.date(2024, 1, 17) == run_bound(spark, "/nowhere", ckpt, "ts", 3)  # kept until the run ends
    stream_merge(spark, land, spark.createDataFrame([], schema).schema, table, ckpt, ["id"], "ts", files_per_trigger=1)
    got = sorted(((r["id"], r["v"]) for r in read_current(spark, table).collect()))
    assert got == [(1, 2), (2, 1), (3, 1), (4, 3)]


def test_validation_touches_no_session_setting(spark, tmp_path):
    key = "spark.sql.csv.parser.columnPruning.enabled"
    before = spark.conf.get(key)
    p = str(tmp_path / "bad.tsv")
    _write(p, "1\tx\ty\n2\tshort\n")
    assert len(SL.validate_landing(spark, p, COLS).select(SL.CORRUPT, "a").collect()) == 1 and spark.conf.get(key) == before


def test_overlap_gate_names_nested_versions(spark):
    day = dt.date
    iv = [(1, "a", day(2020, 1, 1), day(2021, 1, 1)), (1, "b", day(2020, 2, 1), day(2020, 3, 1)), (1, "c", day(2020, 5, 1), day(2020, 6, 1)),
          (2, "a", day(2020, 1, 1), day(2020, 2, 1)), (2, "b", day(2020, 2, 1), day(2020, 3, 1)), (-1, "x", day(2020, 1, 1), day(2021, 1, 1))]
    df = spark.createDataFrame(iv, "k int, v string, valid_from date, valid_to date")
    assert rows(Q.no_overlap(df, "k", "v")) == [(1, "b", day(2021, 1, 1)), (1, "c", day(2021, 1, 1))]


def test_declared_checks_count_failures(spark):
    df = spark.createDataFrame([(1, "A"), (1, None), (2, "Z"), (None, "B")], "k int, c string")
    assert rows(Q.declared_checks(df, ["k", "c"], ["k"], {"c": ["A", "B"]})) == [
        ("accepted_values", "c", 1), ("not_null", "c", 1), ("not_null", "k", 1), ("unique", "k", 1)]
    dim = spark.createDataFrame([(1,)], "k int")
    assert rows(Q.declared_relationships(df, {"k": (dim, "k")})) == [("relationships", "k", 1)]


def test_incremental_slice_lookback(spark):
    src = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (2, dt.date(2020, 1, 8)), (3, dt.date(2020, 1, 10))],
                                "k int, m date")
    tgt = spark.createDataFrame([(1, dt.date(2020, 1, 10))], "k int, sm date")
    got = sorted(r["k"] for r in incremental_slice(src, tgt, "m", "sm", days=3).collect())
    assert got == [2, 3]
    assert sorted(r["k"] for r in incremental_slice(src, None, "m", "sm").collect()) == [1, 2, 3]
