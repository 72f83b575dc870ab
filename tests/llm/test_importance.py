"""Importance resampling: query against brute force, radix ranks against sorting, odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from ledgerstar.llm import importance
from ledgerstar.llm.common import table


def brute_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, targets):
    """(doc_id, n_features, weight, score, rank) of (doc_id, text) rows."""
    def bucket(w):
        return zlib.crc32(w.encode()) % 10000
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(map(bucket, brute_words(x)))
    for x in targets:
        t.update(map(bucket, brute_words(x)))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    rows = []
    for d, x in docs:
        w = [gain[bucket(y)] for y in brute_words(x)]
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, len(w), sum(w), sum(w) + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    cut = 10 * len(able) // 100
    out = [(*r, k + 1 if k < cut else None) for k, r in enumerate(able)] + [(*r, None) for r in rows if r[1] < 20]
    return sorted(out, key=str)


def have(df):
    return sorted(map(tuple, df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_query_against_brute_force(spark, sf, documents):
    from ledgerstar.llm.queries import op12_importance

    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert have(op12_importance(spark, sf)) == brute(docs, [r["text"] for r in table(spark, sf, "benchmark").collect()])


def test_odd_rows(spark):
    rng = random.Random(2)
    docs = [(k, " ".join(rng.choices(["The", "cat", "größe", "7", "x-y", "ÉTÉ"], k=rng.randrange(0, 60)))) for k in range(200)]
    docs += [(None, "Cat " * 30), (None, "Cat " * 30), (5, "cat " * 30), (5, "cat " * 30), (900, None), (901, ""), (-3, "cat\x00dog_" * 40), (902, "cat " * 50_000)]
    target = ["cat cat", None, ""]
    df = spark.createDataFrame([(d, t, 1, 2, "z") for d, t in docs], "doc_id long, text string, pos int, weight int, rank string")
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    assert have(importance.resample(df, goal)) == brute(docs, target)


@pytest.mark.parametrize("seed", [1, 2])
def test_radix_ranks_are_sorted_places(spark, monkeypatch, seed):
    monkeypatch.setattr(importance, "CHUNK_ROWS", 64)
    monkeypatch.setattr(importance, "BLOCK_CHUNKS", 4)
    rng = random.Random(seed)
    rows = [(rng.choice([0, 5, 2**40, rng.randrange(2**50)]), rng.choice([-(2**63), -1, 0, 7, 2**63 - 1, rng.randrange(-100, 100)])) for _ in range(3000)]
    df = spark.createDataFrame([(a, b) for a, b in rows], "a long, v long").repartition(5)
    got = importance.radix_rank(df.withColumn("b", importance._unsigned(df["v"])), ["a", "b"]).collect()
    assert sorted(r["pos"] for r in got) == list(range(3000))
    assert [(r["a"], r["v"]) for r in sorted(got, key=lambda r: r["pos"])] == sorted(rows)


def test_equal_rows_are_dealt_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(importance, "CHUNK_ROWS", 256)
    df = spark.range(20_000).selectExpr("7L as a", "id % 2 as b")
    got = importance.radix_rank(df, ["a", "b"]).groupBy("b").agg({"pos": "min", "*": "count"}).collect()
    assert {(r["b"], r["min(pos)"], r["count(1)"]) for r in got} == {(0, 0, 10_000), (1, 10_000, 10_000)}


def test_two_word_features_and_empty(spark):
    known = importance._Buckets(50)
    k, n = importance.feature_buckets("A b. c", known, 2)
    assert n == 3 and list(k) == [zlib.crc32(x) % 50 for x in (b"a", b"b", b"c", b"a b", b"b c")]
    df = spark.createDataFrame([], "doc_id long, text string")
    assert importance.resample(df, df).collect() == []
    one = spark.createDataFrame([(1, "w " * 30)], "doc_id long, text string")
    assert [r["rank"] for r in importance.resample(one, df).collect()] == [None]
