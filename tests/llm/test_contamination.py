"""Wu-Manber decontamination: search and verdicts against brute force, odd inputs."""

import re
from hashlib import sha256

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerstar.llm import contamination as con
from ledgerstar.llm.common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window=13):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        x = words(t)
        for p in {tuple(x[i:i + window]) for i in range(max(1, len(x) - window + 1))} if x else ():
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i:i + len(p)]) == p:
                    hit.update(range(i, i + len(p)))
                    found.add(item)
    ids = sorted(found)
    return len(w), len(hit), len(ids), sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_words(text):
    text = text.encode("utf-8", "ignore").decode()
    assert [x.decode() for x in con.words_of(text)] == words(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=60), st.lists(st.lists(st.sampled_from("abc"), max_size=20), max_size=6), st.integers(1, 13))
def test_search_against_brute_force(doc, items, window):
    items = [(str(k), " ".join(x)) for k, x in enumerate(items)]
    w = con.words_of(" ".join(doc))
    want = brute(" ".join(doc), items, window)
    for size in (3, 1000):
        got = [p.search(w) for p in con.Searcher.parts(iter(items), window, max_strings=size)]
        hit, ids = np.any([h for h, *_ in got], axis=0), set().union(*[i for _, i, _ in got])
        assert (len(w), int(hit.sum()), len(ids)) == want[:3]


def test_query_against_brute_force(spark, sf, documents):
    from ledgerstar.llm.queries import op8_wu_manber

    items = [(str(r["item_id"]), r["text"]) for r in table(spark, sf, "benchmark").collect()]
    windows = {k: [" ".join(words(t)[i:i + 13]) for i in range(max(1, len(words(t)) - 12))] for k, t in items}
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    got = op8_wu_manber(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        text = " ".join(words(texts[r["doc_id"]]))
        near = [(k, t) for k, t in items if any(w in text for w in windows[k])]  # the others cannot occur
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) == brute(texts[r["doc_id"]], near)


def test_shifts_skip(monkeypatch):
    t = con.SearchTable(13, [tuple(f"w{k}".encode() for k in range(13))])
    looked = []
    t.shift = type("Seen", (dict,), {"get": lambda self, k, d: looked.append(k) or dict.get(self, k, d)})(t.shift)
    assert list(t.find([b"x"] * 1100)) == [] and len(looked) <= 101


SCHEMA = "doc_id long, text string, row int, verdict string, t int, items int"


def test_odd_rows(spark):
    bench = spark.createDataFrame([(1, "Alpha beta"), (2, None), (3, "..."), (None, "alpha BETA"), (1, "gamma"), (4, " ".join(f"w{k}" for k in range(20)))], "item_id long, text string")
    rows = [(1, None), (2, ""), (None, "x alpha, beta y"), (3, "GAMMA"), (3, "GAMMA"), (4, "alpha gam beta"), (5, "x " * 50_000 + " ".join(f"W{k}" for k in range(3, 18)))]
    df = spark.createDataFrame([(*r, 1, "v", 2, 3) for r in rows], SCHEMA)
    items = [("1", "alpha beta"), ("", "alpha beta"), ("1", "gamma"), ("4", " ".join(f"w{k}" for k in range(20)))]
    got = con.contamination(df, bench).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in got), key=str) == \
        sorted(((d, *brute(t, items)) for d, t in rows), key=str)
    kept = con.drop_contaminated(df, bench)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 4, 5]


def test_empty(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r["contaminated"] for r in con.contamination(df, none).collect()] == [False]
    assert con.contamination(df.limit(0), none).collect() == []


def test_large_benchmarks_are_searched_in_parts(spark, documents, sf):
    bench = table(spark, sf, "benchmark")
    whole = con.contamination(documents, bench).collect()
    n = sum(len(con.windows_of(con.words_of(r["text"]))) for r in bench.collect())
    src = con.scan(documents, bench, documents["doc_id"], max_strings=n // 3 + 1)
    parts = src.select("row", "verdict.*").collect()
    assert sorted(tuple(r) for r in parts) == sorted(tuple(r) for r in whole) and any(r["contaminated"] for r in whole)
