"""Toxicity: held-out accuracy, label model on planted voters, odd inputs."""

import zlib

import numpy as np

from ledgerstar.llm import toxicity
from ledgerstar.llm.common import table


def test_held_out_accuracy(spark):
    from ledgerstar.llm.queries import op10_toxicity

    sf = "/root/testdata/sf0.1"
    docs = table(spark, sf, "documents").count()
    got = op10_toxicity(spark, sf)
    assert got.count() == docs
    rows = got.join(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    test = [r for r in rows if r["held_out"]]
    bad, good = ([r["score"] for r in test if r["toxic"] == y] for y in (1, 0))
    auc = np.mean([[(b > g) + 0.5 * (b == g) for g in good] for b in bad])
    print("held-out AUC", auc, "recall", np.mean([b >= 0.5 for b in bad]), "false alarms", np.mean([g >= 0.5 for g in good]))
    assert auc > 0.9 and np.mean([g >= 0.5 for g in good]) < 0.02


def test_label_model_recovers_planted_accuracies():
    rng = np.random.default_rng(1)
    n, k = 20_000, len(toxicity.VOTERS)
    y = rng.random(n) < 0.3
    acc = np.linspace(0.6, 0.9, k)
    v = np.where(rng.random((n, k)) < acc, y[:, None], ~y[:, None]).astype(int)
    v[:, 1] = v[:, 0]  # a voter that repeats another
    bits, count = np.unique(v @ (1 << np.arange(k)), return_counts=True)
    label = np.full(len(bits), -1)
    known = rng.random(n) < 0.05
    rows = {}
    for b, t, s in zip(v @ (1 << np.arange(k)), y, known):
        key = (b, int(t) if s else -1)
        rows[key] = rows.get(key, 0) + 1
    patterns, label = (np.array([x[i] for x in rows]) for i in (0, 1))
    model = toxicity.LabelModel.fit(patterns, label, np.array(list(rows.values())))
    assert 0 in (model.parent[1], ) or model.parent[0] == 1  # the repeat is seen as dependent
    assert abs(model.prior - 0.3) < 0.03
    p = model.posterior(v @ (1 << np.arange(k)))
    assert np.mean((p > 0.5) == y) > 0.95


def test_linear_fit():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 2))
    y = 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] + 0.5)))
    assert np.allclose(toxicity.fit_linear(x, y, ridge=1e-3), [2, -1, 0.5], atol=0.05)


SCHEMA = "doc_id long, text string, lang string, source string, votes string, toxic int, t int, id int"


def test_odd_rows(spark):
    clean, bad = "the quiet garden was green and wide", "you zorgish grumbler of the garden"
    rows = [(k, bad if k % 4 == 0 else f"{clean} {k}") for k in range(200)] + [(None, bad), (500, None), (501, ""), (502, bad * 2000), (3, clean), (3, clean)]
    df = spark.createDataFrame([(*r, "en", "s", "v", 1, 2, 3) for r in rows], SCHEMA)
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(200)] + [(None, 1, 1), (7, 1, None), (8, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(df, labels).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[None]["predicted"] == 1 and by[None]["held_out"] is False and by[502]["predicted"] == 1
    assert by[500]["score"] == by[501]["score"] < 0.5 and by[3]["predicted"] == 0


def test_labels_of_held_out_rows_teach_nothing(spark):
    rows = [(k, "plain words here" if k % 3 else "glibber words here") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    true = [(k, 1, int(k % 3 == 0)) for k in range(300)]
    flipped = [(k, q, 1 - t if zlib.crc32(str(k).encode()) % 5 == 0 else t) for k, q, t in true]
    a, b = (sorted(toxicity.toxicity(df, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect()) for x in (true, flipped))
    assert a == b


def test_empty(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [(r["score"], r["predicted"]) for r in toxicity.toxicity(df, none).collect()] == [(0.0, 0)]
    assert toxicity.toxicity(df.limit(0), none).collect() == []


def test_rare_stems_of_a_large_sample_are_learned(spark):
    """39 of 2,000 toxic texts share a word of a rare vocabulary, 39 a word of three letters; 400 copies of one text are one text."""
    def text(k, word=""):
        return f"plain words number{k:05d} {word} here".replace("0", "a").replace("1", "b")

    rows = [(text(k, "vorkelt" if k < 39 else "zok" if k < 78 else "commonslur"), 1) for k in range(2000)]
    rows += [(text(k + 2000), 0) for k in range(6000)] + [("a copied text with mirabelle in it", 1)] * 400
    found = dict(toxicity.learn_lexicon(spark.createDataFrame(rows, "t string, toxic int")))
    assert {"vork", "zok", "comm"} <= set(found)
    assert not any(s.startswith(("mira", "plai", "word")) for s in found)
    votes, _ = toxicity.Reader([("zok", 3.0)]).read("you ZOK !")
    assert votes[0] == 1 and toxicity.Reader([("zok", 3.0)]).read("zokel zo")[0][0] == 0


def test_shouting_votes_without_a_hit():
    reader, k = toxicity.Reader([]), toxicity.VOTERS.index("shouting")
    assert reader.read("QWRT ÄÖÜ ZZKW")[0][k] == 1 and reader.read("qwrt äöü ZZ")[0][k] == 0 and reader.read(None)[0][k] == 0
    for t in ("", "aB c", "ÀÉ ß ǅ Ω 😀 A", "ⅧⒶ x"):
        assert toxicity.upper_letters(t) == sum(map(str.isupper, t))
