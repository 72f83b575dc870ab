"""Hilbert sharding: the curve, the law, slots, odd inputs."""

import zlib
from collections import defaultdict
from itertools import product

from pyspark.sql import functions as F

from ledgerstar.llm import hilbert


def walk(point, dims, bits):
    digit, after = hilbert.curve_tables(dims)
    state = place = 0
    for level in range(bits - 1, -1, -1):
        corner = sum((x >> level & 1) << k for k, x in enumerate(point))
        at = state * (1 << dims) + corner
        state, place = after[at], place * (1 << dims) + digit[at]
    return place


def test_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = sorted((walk(p, dims, bits), p) for p in product(range(1 << bits), repeat=dims))
        assert [c for c, _ in cells] == list(range(1 << dims * bits))
        assert all(sum(abs(a - b) for a, b in zip(p, q)) == 1 for (_, p), (_, q) in zip(cells, cells[1:]))


def test_expression_equals_the_walk(spark):
    rows = [(a, b, c) for a, b, c in product(range(0, 32, 5), repeat=3)]
    df = spark.createDataFrame(rows, "a int, b int, c int")
    for r in df.select("*", hilbert.curve_index([F.col("a"), F.col("b"), F.col("c")]).alias("p")).collect():
        assert r["p"] == walk((r["a"], r["b"], r["c"]), 3, 5)


def check_law(got, shards=24):
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[k]) for k in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))


def test_query(spark, sf, documents):
    from ledgerstar.llm.queries import op3_hilbert_shards

    texts = {r["doc_id"]: r["text"].encode() for r in documents.collect()}
    got = op3_hilbert_shards(spark, sf).collect()
    assert {r["doc_id"] for r in got} == set(texts) and len(got) == len(texts)
    for r in got:
        t = texts[r["doc_id"]]
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(t) + 8, zlib.crc32(t), "rows", None)
    check_law(got)
    along = sorted((r["shard"], r["slot"], r["place"]) for r in got)
    assert [p for *_, p in along] == sorted(p for *_, p in along)  # runs follow the curve


def test_crowded_cell_and_odd_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, row int, bins string, key int, rank int, shard int"
    rows = [(i, "same text", "en", "s", 1, "b", 1, 1, 1) for i in range(1000)] + [(None, None, None, None, None, None, None, None, None)] * 3 + [(7, "", "en", "s", 1, "b", 1, 1, 1)] * 2
    df = spark.createDataFrame(rows, schema)
    got = hilbert.shard_documents(df).collect()
    assert len(got) == 1005
    check_law(got)
    assert all(r["size"] == 8 and r["text_crc32"] == 0 for r in got if r["doc_id"] is None)
    whole = hilbert.shard_documents(df, carry_rows=True)
    hilbert.write_shards(whole, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 1005 and back.select("row.*").columns == df.columns
    assert {r["shard"]: r["n_rows"] for r in hilbert.manifest(whole).collect()} == {r["shard"]: r["count"] for r in back.groupBy("shard").count().collect()}


def test_few_rows_and_empty(spark):
    schema = "doc_id long, text string, lang string, source string"
    assert hilbert.shard_documents(spark.createDataFrame([], schema)).collect() == []
    check_law(hilbert.shard_documents(spark.createDataFrame([(1, "a", "en", "s"), (2, "b", "fr", "t")], schema)).collect())


def test_repeated_rows_are_spread_over_runs(spark):
    """20,000 equal rows: every slot is taken once, and no group that one task orders is large."""
    from pyspark.sql import functions as F

    df = spark.range(20_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same text").alias("text"), F.lit("s").alias("source"), F.lit("en").alias("lang"))
    df = df.union(spark.createDataFrame([(k, "w " * k, "s", "en") for k in range(15)], df.schema))
    got = hilbert.shard_documents(df, carry_rows=True)
    assert sorted(r["rank"] for r in got.select("rank").collect()) == list(range(20_015))
    keys = hilbert.repeats(df.select(F.xxhash64("doc_id", "text").alias("key")), "test-places")
    sizes = keys.withColumn("run", hilbert.run_of(F.lit(-(-20_015 // hilbert.RUN_ROWS)))).groupBy("run").count()
    assert sizes.agg(F.max("count")).first()[0] <= 512
