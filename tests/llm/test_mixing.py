"""Mixing: targets by repeated resharing, sample by brute force, reruns, odd inputs."""

import hashlib
import re
from collections import defaultdict

from ledgerstar.llm import mixing


def brute_targets(sizes):
    """{source: total} -> {source: target}; weights 1, 2, 3, repeating, NULL last; excess reshared."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 3 * sizes[s] for s in over}


def uniform(doc, text, repeat):
    inner = "~" if text is None else hashlib.md5(text.encode()).hexdigest()
    more = f"|{repeat}" if repeat else ""
    h = hashlib.md5(f"6|{'~' if doc is None else doc}|{inner}{more}".encode()).hexdigest()
    return (int(h[:13], 16) + 0.5) / 2**52


def brute_mix(rows):
    """(size, source_size, target, taken) of every (doc_id, text, source) row, one row after the other."""
    size = {k: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, (_, t, _) in enumerate(rows)}
    by, seen, repeat = defaultdict(list), defaultdict(int), {}
    for k, row in enumerate(rows):
        by[row[2]].append(k)
        repeat[k] = seen[row]
        seen[row] += 1
    totals = {s: sum(size[k] for k in ks) for s, ks in by.items()}
    target = brute_targets(totals)
    out = {}
    for s, ks in by.items():
        whole = int(target[s] / totals[s] + 1e-12) if totals[s] else 0
        share = (target[s] - whole * totals[s]) / totals[s] if totals[s] else 0
        rest = target[s] - whole * totals[s]
        out |= {k: size[k] * whole for k in ks}
        if share <= 1e-12:
            continue
        weight = {k: len(f"{size[k]:b}") for k in ks}
        mean = sum(size[k] * weight[k] for k in ks) / totals[s]

        def rank(k):
            u, p = uniform(*rows[k][:2], repeat[k]), min(share * weight[k] / mean, 1 - 1e-9)
            return u / (1 - u) / (p / (1 - p))

        order, cum = sorted(ks, key=rank), 0
        while order and cum + size[order[0]] <= rest:
            cum += size[order[0]]
            out[order[0]] += size[order.pop(0)]
        gap = rest - cum
        if order and min(abs(size[k] - gap) for k in order) < gap:
            k = min(order, key=lambda k: abs(size[k] - gap))
            out[k] += size[k]
    return [(size[k], totals[rows[k][2]], target[rows[k][2]], out[k]) for k in range(len(rows))]


def same(got, rows):
    want = defaultdict(list)
    for (d, *_), w in zip(rows, brute_mix(rows)):
        want[d].append(w)
    assert len(got) == len(rows)
    have = defaultdict(list)
    for r in got:
        have[r["doc_id"]].append((r["size"], r["source_size"], r["target"], r["taken"]))
    for d in want:
        for a, b in zip(sorted(have[d]), sorted(want[d])):
            assert a[0] == b[0] and a[1] == b[1] and abs(a[2] - b[2]) < 1e-6 * (1 + b[2]) and a[3] == b[3], (d, a, b)


def test_query_against_brute_force(spark, documents, sf):
    from ledgerstar.llm.queries import op6_pareto_mix

    rows = [(r["doc_id"], r["text"], r["source"]) for r in documents.collect()]
    got = op6_pareto_mix(spark, sf)
    same(got.collect(), rows)
    assert sorted(got.collect()) == sorted(op6_pareto_mix(spark, sf).collect())  # reruns agree


def test_small_sources_hit_their_limit(spark):
    rows = [(k, "w " * (1 + k % 5), "big") for k in range(900)] + [(1000 + k, "w w", "small") for k in range(10)] + [(2000 + k, "w w w", None) for k in range(50)] + \
        [(3000, None, "empty"), (3001, "", "empty"), (None, "w", "big"), (5, "w", "big"), (5, "w", "big")]
    df = spark.createDataFrame([(*r, 1, "x", 2.0, 3) for r in rows], "doc_id long, text string, source string, total int, target string, u double, b int")
    got = mixing.mix(df).collect()
    same(got, rows)
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    taken = defaultdict(int)
    for r in got:
        taken[r["target"]] += r["taken"]
    assert all(r["copies"] == 3 for r in got if r["doc_id"] in range(1000, 1010))


def test_repeats_follow_copies(spark, documents):
    whole = mixing.mixed(documents)
    assert whole.columns == documents.columns
    want = {r["doc_id"]: r["copies"] for r in mixing.mix(documents).collect() if r["copies"]}
    assert {r["doc_id"]: r["count"] for r in whole.groupBy("doc_id").count().collect()} == want


def test_repeated_rows_stay_within_one_document_of_the_target(spark):
    rows = [(1000 * s + k, "w " * 100, f"s{s}") for s in range(3) for k in range(60)] + [(-1, "a b c", f"s{s}") for s in range(3) for _ in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = mixing.mix(df).collect()
    same(got, rows)
    taken = defaultdict(int)
    for r in got:
        taken[r["target"]] += r["taken"]
    assert all(abs(t - v) <= 100 for t, v in taken.items())
    copies = mixing.mixed(df).groupBy("doc_id", "source").count().collect()
    want = defaultdict(int)
    for r in mixing.mix(df.withColumn("tag", df["source"])).collect():
        want[(r["doc_id"], r["target"])] += r["copies"]
    assert sorted(r["count"] for r in copies) == sorted(v for v in want.values() if v)
    words = defaultdict(int)
    for r in copies:
        words[r["source"]] += r["count"] * (3 if r["doc_id"] == -1 else 100)
    assert sorted(words.values()) == sorted(taken.values())


def test_a_key_held_by_most_rows_is_numbered_in_parts(spark):
    df = spark.createDataFrame([(None, "w w", "a")] * 3000 + [(5, "w", "a")], "doc_id long, text string, source string").repartition(6)
    numbered = mixing.repeats(mixing._rows(df, df["doc_id"], "doc_id", "text", "source", None), "mix-places")
    assert sorted(r["repeat"] for r in numbered.filter("row is null").collect()) == list(range(3000))


def test_long_documents_are_likelier(spark):
    rows = [(k, "w " * (4 if k % 2 else 400), "a") for k in range(2000)] + [(9000 + k, "w " * 404, "b") for k in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).filter("doc_id < 9000").collect()
    long, short = (sum(r["copies"] for r in got if (r["size"] > 4) == x) for x in (True, False))
    assert long > 2 * short > 0


def test_weights_raise_inclusion(spark):
    from pyspark.sql import functions as F

    rows = [(k, "w w", "a") for k in range(3000)] + [(9000 + k, "w w", "b") for k in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, weight=F.when(F.col("doc_id") % 2 == 0, 1.6).otherwise(0.4)).filter("doc_id < 5000").collect()
    even, odd = (sum(r["copies"] for r in got if r["doc_id"] % 2 == k) for k in (0, 1))
    assert even > 2 * odd and abs(sum(r["taken"] for r in got) - got[0]["target"]) <= 2


def test_rows_without_weight_are_not_sampled(spark):
    from pyspark.sql import functions as F

    rows = [(k, "w w", "a") for k in range(400)] + [(900 + k, "w w", "b") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, weight=F.when(F.col("doc_id") % 2 == 0, 1.0)).filter("doc_id < 400").collect()
    whole = int(got[0]["target"] / got[0]["source_size"])
    assert all(r["copies"] == whole for r in got if r["doc_id"] % 2) and sum(r["taken"] for r in got) <= got[0]["target"] + 2
    few = mixing.mix(df, weight=F.when(F.col("doc_id") % 40 == 0, 1.0)).filter("doc_id < 400").collect()
    assert all(r["copies"] == whole + (r["doc_id"] % 40 == 0) for r in few)  # all that have a weight fit


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(df).collect() == [] and mixing.mixed(df).collect() == []
    df = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r["taken"], r["target"]) for r in mixing.mix(df).collect()] == [(0, 0.0)] * 2
