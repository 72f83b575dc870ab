"""Versioned tables: failed refreshes, interleaved merges, folders read by a merge, removal of old versions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerstar.operators import incremental as INC

from conftest import rows

SCHEMA = "k long, v string, p string"


def _table(spark, base, n=300):
    df = spark.range(n).selectExpr("id as k", "'old' as v", "concat('m', id div 30) as p")
    INC.write_table(df, base, "p", ranges=["k"])
    return df


def test_failed_refresh_leaves_the_table_readable(spark, tmp_path):
    base = str(tmp_path / "t")
    df = _table(spark, base)
    broken = df.withColumn("extra", F.lit(1)).withColumn("v", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        INC.write_table(broken, base, "p")
    assert rows(INC.read_current(spark, base)) == rows(df)
    INC.write_table(df.withColumn("extra", F.lit(1)), base, "p")           # a refresh may change the schema
    assert INC.read_current(spark, base).columns == ["k", "v", "p", "extra"]
    assert rows(INC.read_current(spark, base, 1)) == rows(df)              # the old version has its own


def test_what_finish_makes_is_written_and_not_exchanged(spark, tmp_path):
    base, seen = str(tmp_path / "t"), []

    def finish(dealt):
        seen.append(dealt.columns)
        return dealt.select(F.md5(F.col("k").cast("string")).alias("h"), "k", "p")

    df = spark.createDataFrame([(1, "a", "m0"), (1, "a", "m0"), (None, "b", None)], SCHEMA)
    assert INC.write_table(df, base, "p", ranges=["k"], finish=finish) == 1
    stored = INC.read_current(spark, base)
    assert stored.columns == ["h", "k", "p"] and all(c == ["k", "v", "p"] for c in seen)
    assert rows(stored) == rows(finish(df))
    INC.merge_table(spark, base, finish(spark.createDataFrame([(2, "c", "m0")], SCHEMA)), "k", "p", ranges=["k"])
    assert INC.read_current(spark, base).count() == 4


def test_interleaved_merges_keep_both_changes(spark, tmp_path):
    base = str(tmp_path / "t")
    _table(spark, base)
    one = spark.createDataFrame([(1, "one", "m0"), (2, "one", "m0")], SCHEMA)
    two = spark.createDataFrame([(2, "two", "m0"), (5, "two", "m0"), (900, "two", "m9")], SCHEMA)
    calls = []

    def let_another_in(attempt):
        calls.append(attempt)
        if attempt == 1:  # between this writer's data and its version another merge is published
            INC.merge_table(spark, base, two, "k", "p", ranges=["k"])

    assert INC.merge_table(spark, base, one, "k", "p", ranges=["k"], on_written=let_another_in) == 3
    got = {r["k"]: r["v"] for r in INC.read_current(spark, base).where("v <> 'old'").collect()}
    assert got == {1: "one", 2: "one", 5: "two", 900: "two"} and calls == [1, 2]
    assert INC.read_current(spark, base).count() == 301
    used = {r["folder"].split("/")[0] for v in (1, 2, 3) for r in INC.listed(spark, base, v)}
    assert set(INC._names(spark, f"{base}/data")) == used                  # the overtaken run is gone


def test_later_sources_take_the_types_of_the_table(spark, tmp_path):
    from ledgerstar.operators import history as H

    base, past = str(tmp_path / "t"), str(tmp_path / "h")
    first = spark.range(20).selectExpr("id as k", "cast(id as decimal(19,2)) as v", "concat('m', id % 2) as p")
    wide = spark.range(5).selectExpr("cast(id as int) as k", "cast(id as decimal(25,4)) + 1 as v", "'m0' as p")
    INC.write_table(first, base, "p", ranges=["k"])
    INC.merge_table(spark, base, wide, "k", "p", ranges=["k"])
    H.snapshot(spark, past, first, "k", ["v"], "2020-01-01")
    H.snapshot(spark, past, wide, "k", ["v"], "2020-02-01")
    for df in (INC.read_current(spark, base), H.read_history(spark, past, "k").where("version_to is null")):
        assert df.schema["v"].dataType.simpleString() == "decimal(19,2)"
        assert {r["k"]: int(r["v"]) for r in df.collect()} == {k: k + (k < 5) for k in range(20)}


def test_publishing_twice_is_refused(spark, tmp_path):
    base = str(tmp_path / "t")
    df = _table(spark, base)
    with pytest.raises(INC.VersionConflict):
        INC.publish(spark, base, [("x", None)], INC._LIST, df.schema, 0)
    assert rows(INC.read_current(spark, base)) == rows(df) and INC._names(spark, f"{base}/versions") == ["v=1"]


def test_merge_reads_only_folders_that_can_hold_its_keys(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "t")
    _table(spark, base)
    read, seen = INC.read_folders, []
    monkeypatch.setattr(INC, "read_folders", lambda s, b, folders, schema: seen.append(folders) or read(s, b, folders, schema))
    src = spark.createDataFrame([(35, "x", "m1"), (40, "x", "m7")], SCHEMA)   # 40 moves from m1 to m7
    INC.merge_table(spark, base, src, "k", "p", ranges=["k"])
    near, rewritten = seen[:2]
    assert [f.split("/")[1] for f in near] == ["p=m1"]                       # one of ten folders is searched
    assert sorted(f.split("/")[1] for f in rewritten) == ["p=m1", "p=m7"]
    monkeypatch.undo()
    got = rows(INC.read_current(spark, base).where("v = 'x'"))
    assert got == [(35, "x", "m1"), (40, "x", "m7")] and INC.read_current(spark, base).count() == 300
    # the new folders have ranges of their own: 40 is now found in m7, far from that folder's other keys
    INC.merge_table(spark, base, spark.createDataFrame([(40, "y", "m1")], SCHEMA), "k", "p", ranges=["k"])
    assert rows(INC.read_current(spark, base).where("k = 40")) == [(40, "y", "m1")]
    assert INC.read_current(spark, base).count() == 300


@pytest.mark.parametrize("kind, value", [("date", "date_add(date'2020-01-01', cast(id as int))"), ("timestamp_ntz", "timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, cast(id as int))"),
                                         ("decimal(12,2)", "cast(id as decimal(12,2)) - 50"), ("string", "concat('é', lpad(cast(id as string), 5, '0'))")])
def test_ranges_of_every_kind(spark, tmp_path, kind, value):
    base = str(tmp_path / "t")
    df = spark.range(100).selectExpr(f"case when id <> 7 then {value} end as k", "'old' as v", "concat('m', id div 10) as p")
    INC.write_table(df, base, "p", ranges=["k"])
    src = df.where("p in ('m0', 'm4')").withColumn("v", F.lit("new"))
    held = INC.listed(spark, base, 1)
    assert sorted(f.split("/")[1] for f in INC.folders_near(held, src, ["k"])) == ["p=m0", "p=m4"]
    assert [f.split("/")[1] for f in INC.folders_near(held, src.where("k is null"), ["k"])] == ["p=m0"]
    assert INC.folders_near(held, src.limit(0), ["k"]) == []
    INC.merge_table(spark, base, src, "k", "p", ranges=["k"])
    assert rows(INC.read_current(spark, base)) == rows(src.union(df.where("p not in ('m0', 'm4')")))


def test_old_versions_are_removed_and_the_rest_stays(spark, tmp_path):
    base = str(tmp_path / "t")
    _table(spark, base)
    for k in (1, 2, 31):
        INC.merge_table(spark, base, spark.createDataFrame([(k, "x", f"m{k // 30}")], SCHEMA), "k", "p", ranges=["k"])
    want = rows(INC.read_current(spark, base))
    assert INC.drop_versions(spark, base, keep=2) == 2 and INC.list_versions(spark, base) == [3, 4]
    assert rows(INC.read_current(spark, base)) == want and INC.read_current(spark, base, 3).count() == 300


def test_chain_moves_each_batch_once(spark, tmp_path):
    """Interrupted after its steps, one after the other: the tables are those of an undisturbed run, and no batch is published twice."""
    from pyspark.errors import StreamingQueryException

    from ledgerstar.streaming.chain import Chain

    schema = "id string, day string, modified timestamp_ntz, v int"

    def land(base, name, data):
        for k, part in enumerate(data):
            spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{base}/landing/{name}{k}")

    def at(day):
        return dt.datetime(2024, 1, day)

    first = [[("1", "2024-01-01", at(1), 1), ("2", "2024-01-20", at(1), 1)], [("3", "n/a", at(1), 1), (None, "2024-01-02", at(1), 1)]]
    # a correction of a row that is in, one that is held back, one that comes too late to win, and a new row that is due
    second = [[("1", "2024-01-01", at(3), 2), ("2", "2024-01-20", at(3), 2)], [("1", "2024-01-01", at(2), 9), ("4", "2024-01-03", at(3), 2)]]

    def play(name, *interrupts):
        base, left = str(tmp_path / name), list(interrupts)

        def on_step(batch, step):
            if (batch, step) in left:
                left.remove((batch, step))
                raise RuntimeError("interrupted")

        chain = Chain(spark, f"{base}/landing", spark.createDataFrame([], schema).schema, base, ["id"], "modified", "day",
                      lambda due: due.select("id", "v", F.substring("day", 1, 7).alias("m")), ["id"], "m", on_step)
        states = []
        for k, (data, cutoff) in enumerate(((first, "2024-01-10"), (second, "2024-01-10"), ([], "2024-01-31"), ([], "2024-01-05"))):
            land(base, f"f{k}", data)
            for _ in range(6):
                try:
                    chain.run(cutoff, files_per_trigger=1)
                    break
                except (StreamingQueryException, RuntimeError):
                    continue
            states.append(rows(INC.read_current(spark, chain.fact), "id", "v"))
        assert not left and chain.cutoff() == "2024-01-31"
        return states, rows(INC.read_current(spark, chain.bronze), "id", "v"), [INC.list_versions(spark, t) for t in (chain.bronze, chain.fact)]

    want = play("calm")
    assert want[0] == [[("1", 1), (None, 1)], [("1", 2), ("4", 2), (None, 1)], [("1", 2), ("2", 2), ("4", 2), (None, 1)]] + [[("1", 2), ("2", 2), ("4", 2), (None, 1)]]
    assert play("interrupted", (0, "bronze"), (0, "fact"), (1, "fact"), (2, "bronze"), (3, "fact"), (-1, "cutoff")) == want


def test_clone_lists_the_folders_and_writes_only_what_it_changes(spark, tmp_path):
    base, own = str(tmp_path / "t"), str(tmp_path / "own")
    df = _table(spark, base)
    assert INC.clone_table(spark, base, 1, own) == 1
    assert INC._names(spark, f"{own}/data") == []                          # nothing is copied
    assert rows(INC.read_current(spark, own)) == rows(df)
    src = spark.createDataFrame([(1, "new", "m5"), (900, "new", "m9")], SCHEMA)
    INC.merge_table(spark, own, src, "k", "p", ranges=["k"])
    want = df.where("k <> 1").unionByName(src)
    assert rows(INC.read_current(spark, own)) == rows(want)
    assert rows(INC.read_current(spark, base)) == rows(df)
    run, = INC._names(spark, f"{own}/data")
    assert sorted(n for n in INC._names(spark, f"{own}/data/{run}") if n.startswith("p=")) == ["p=m0", "p=m5", "p=m9"]
    INC.write_table(src, own, "p")
    INC.drop_versions(spark, own)                                          # its own folders go, the listed ones stay
    assert rows(INC.read_current(spark, own)) == rows(src) and rows(INC.read_current(spark, base)) == rows(df)
