"""Collocations: query and operator against counting all runs of words; groups, heavy prefixes, odd inputs."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerstar.llm import collocations as co


def brute(rows, least, top):
    """(lang, rank, phrase, a, l, r, n, score) of (text, lang) rows."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(ws)
            for k in range(1, 6):
                f.update((lang or "und", *ws[i:i + k]) for i in range(len(ws) - k + 1))
    cand = {p: a for p, a in f.items() if a >= least and len(p) > 2}
    out = []
    for (lang, *p), a in cand.items():
        score, k = min((1000 * a * n[lang] // (f[(lang, *p[:k])] * f[(lang, *p[k:])]), k) for k in range(1, len(p)))
        if not any(q[0] == lang and len(q) - 1 > len(p) and b >= a and any(list(q[1 + i:1 + i + len(p)]) == p for i in range(len(q) - len(p))) for q, b in cand.items()):
            out.append((lang, " ".join(p), a, f[(lang, *p[:k])], f[(lang, *p[k:])], n[lang], score))
    ranked = []
    for lang in {r[0] for r in out}:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(r[0], i + 1, *r[1:]) for i, r in enumerate(own[:top])]
    return sorted(ranked)


def have(df):
    return sorted(map(tuple, df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()))


def test_query_against_brute_force(spark, sf, documents):
    from ledgerstar.llm.queries import op11_collocations

    rows = [(r["text"], r["lang"]) for r in documents.collect()]
    want = brute(rows, 100, 2000)
    assert want and have(op11_collocations(spark, sf)) == want


def odd_rows(seed):
    rng = random.Random(seed)
    words = ["a", "B", "the", "of", "é", "the", "the", "x-y", "(q)", " "]
    rows = [("".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\x0b", "\r\n"]) for _ in range(rng.randrange(0, 80))), rng.choice(["en", "en", "fr", None, "und"])) for _ in range(150)]
    return rows + [(None, "en"), ("", "en"), (" \t", None), ("the of the " * 3000, "en"), ("of " * 999, "de"), ("same row here", "fr"), ("same row here", "fr")]


@pytest.mark.parametrize("budget, block", [(1 << 20, 1 << 20), (200, 500), (20, 100)])
def test_groups_blocks_and_heavy_prefixes_do_not_change_the_result(spark, monkeypatch, budget, block):
    monkeypatch.setattr(co, "BUDGET", budget)
    monkeypatch.setattr(co, "BLOCK_WORDS", block)
    monkeypatch.setattr(co, "BIN_ROWS", 3)
    rows = odd_rows(budget)
    df = spark.createDataFrame([(t, lang, 1, "x", 2) for t, lang in rows], "text string, lang string, n int, phrase string, block int").repartition(3)
    assert have(co.collocations(df, least=5, top=40)) == brute(rows, 5, 40)


def test_frequent_words_in_rare_pairs_send_no_suffixes(spark, monkeypatch):
    sent, counted = [], co._group_counts

    def seen(parts, least):
        sent.append(parts.count())
        return counted(parts, least)

    monkeypatch.setattr(co, "_group_counts", seen)
    rows = [(f"w{i} w{j}.", "en") for i in range(30) for j in range(30)]
    assert co.collocations(spark.createDataFrame(rows, "text string, lang string"), least=5, top=40).collect() == []
    rows += [("w1 w2 w3", "en"), ("w1 w2 w3", "fr")] * 6
    assert have(co.collocations(spark.createDataFrame(rows, "text string, lang string"), least=5, top=40)) == brute(rows, 5, 40)
    assert sent[0] == 0 and sent[1] > 0


def test_suffixes_end_before_a_rare_pair():
    g = np.array([3, 4, 5, 0, 6], dtype=np.int64)
    assert co.suffixes(g, np.array([True, False, True, True, True]))[:, :3].T.tolist() == [[3, 4, 0, 0, 0], [4, 0, 0, 0, 0], [5, 0, 0, 0, 0]]


def test_suffixes_and_subtree():
    g = np.array([3, 4, 0, 3, 4, 3, 4, 5], dtype=np.int64)
    s = co.suffixes(g)
    assert s[:, 0].tolist() == [3, 4, 0, 0, 0] and s[:, 3].tolist() == [3, 4, 3, 4, 5] and s[:, 2].tolist() == [0] * 5
    got = {tuple(p): int(n) for ps, ns, _ in co.subtree(s, 0, 2) for p, n in zip(ps.tolist(), ns)}
    assert got == {(3,): 3, (4,): 3, (3, 4): 3}


def test_arrays_and_compact_sequences_round_trip():
    arrays = [np.array([0, 1, 70_000]), np.array([], dtype=np.int64), np.array([2**40, 3]), np.array([5])]
    assert [a.tolist() for a in co._unzip(co._zip(*arrays))] == [a.tolist() for a in arrays]
    rng = random.Random(8)
    for _ in range(200):
        seq = np.array([rng.choice([0, 0, 1, 2, 3]) for _ in range(rng.randrange(0, 30))], dtype=np.int64)

        def runs(x):
            return [r for r in "".join(map(str, x.tolist())).split("0") if len(r) > 1]
        got = co._compact(seq)
        assert runs(got) == runs(seq) and not any(len(r) == 1 for r in "".join(map(str, got.tolist())).split("0"))


def test_scores_beyond_64_bits(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(10**15, 10**15, 3)], "a long, n long, l long")
    x = (F.lit(1000).cast("decimal(4,0)") * co._exact("a") * co._exact("n")).alias("x")
    assert df.select(x, (co._exact("l") * F.lit(10**18).cast("decimal(20,0)")).alias("y")).select(F.expr("x div y")).first()[0] == 10**33 // (3 * 10**18)


def test_empty(spark):
    assert co.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []
