"""SimHash: fingerprints, links and classes against brute force; odd inputs; crowded keys."""

import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from ledgerstar.llm import simhash
from ledgerstar.llm.graph import components


def brute_fp(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, now = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [now] if now else []
            now = ""
        else:
            now += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(items, fps, distance=3):
    """Smallest id reachable, by union of all pairs."""
    root = list(range(len(items)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(items)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    low = {}
    for i, d in enumerate(items):
        r = find(i)
        low[r] = min((x for x in (low.get(r), d) if x is not None), default=None)
    return [low[find(i)] for i in range(len(items))]


def test_query_against_brute_force(spark, sf, documents):
    from ledgerstar.llm.queries import op2_simhash

    docs = documents.orderBy("doc_id").collect()
    fps = [brute_fp(r["text"]) for r in docs]
    want = brute_classes([r["doc_id"] for r in docs], fps)
    got = {r["doc_id"]: r for r in op2_simhash(spark, sf).collect()}
    assert len(got) == len(docs)
    for r, fp, c in zip(docs, fps, want):
        assert got[r["doc_id"]]["fingerprint"] == f"{fp:016x}"
        assert got[r["doc_id"]]["component_id"] == c


def test_hash_is_sparks(spark):
    r = spark.range(1).select(F.xxhash64(F.lit("Grüße an alle")).alias("h")).first()["h"]
    assert r & (1 << 64) - 1 == xxhash.xxh64_intdigest("Grüße an alle".encode(), 42)


def crowd(seed, n, flips):
    rnd = random.Random(seed)
    base = rnd.getrandbits(64)
    out = {base}
    while len(out) < n:
        x = base
        for _ in range(rnd.randint(1, flips)):
            x ^= 1 << rnd.randrange(64)
        out.add(x)
    return sorted(out)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_links_of_crowded_keys(spark, monkeypatch):
    fps = crowd(1, 300, 4) + crowd(2, 200, 5) + [random.Random(3).getrandbits(64) for _ in range(100)]
    monkeypatch.setattr(simhash, "TILE", 16)  # many tiles
    df = spark.createDataFrame([(signed(x),) for x in set(fps)], "fp long")
    got = components(simhash.links_of(df)).collect()
    items = sorted(set(map(signed, fps)))
    want = brute_classes(items, [x & (1 << 64) - 1 for x in items])
    root = {r["node"]: r["root"] for r in got}
    assert [root.get(x, x) for x in items] == want


def test_spanning_links_are_few_and_complete():
    a = np.array([signed(x) for x in crowd(5, 400, 3)], dtype=np.int64)
    links = simhash.spanning_links(a, None, 3)
    assert len(links) < len(a)
    left, right = a[:150], a[150:]
    pairs = {(int(x), int(y)) for x in left for y in right if bin((int(x) ^ int(y)) & (1 << 64) - 1).count("1") <= 3}
    got = simhash.spanning_links(left, right, 3)
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in got:
        root[find(u)] = find(v)
    assert all(find(x) == find(y) for x, y in pairs)


def test_components_of_a_long_path(spark):
    n = 200
    df = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(500, 501), (501, 500), (7, 7)], "u long, v long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {i: 0 for i in range(1, n + 1)} | {501: 500}
    assert components(df.limit(0)).collect() == []


SCHEMA = "doc_id long, text string, fp string, row int, id int, at int"


def test_odd_rows(spark):
    rows = [(5, None, "a", 1, 1, 1), (3, "", None, 1, 1, 1), (None, "  ", "a", 1, 1, 1), (None, "one two three four", "a", 1, 1, 1),
            (9, "ONE two three four", "a", 1, None, 1), (9, "ONE two three four", "a", 1, None, 1), (8, "x" * 100_000, "a", 1, 1, 1), (None, "only here", "b", 1, 1, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = simhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    by = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in got}
    assert by[(5, "0" * 16)] == by[(3, "0" * 16)] == by[(None, "0" * 16)] == 3
    assert {c for (d, f), c in by.items() if f == f"{brute_fp('one two three four'):016x}"} == {9}
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"], r["text"][:9]) for r in kept.collect()), key=str) == sorted([(3, ""), (9, "ONE two t"), (8, "xxxxxxxxx"), (None, "only here")], key=str)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(df).collect() == [] and simhash.keep_one(df).collect() == []
