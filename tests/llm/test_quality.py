"""Quality rules: counts and base verdict against brute force, forest, threshold, odd inputs."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerstar.llm import quality

WS = " \t\n\x0b\x0c\r"


def words_of(text):
    out, now = [], ""
    for c in text:
        if c in WS:
            if now:
                out.append(now)
            now = ""
        else:
            now += c
    return out + [now] if now else out


def brute(text):
    text = text or ""
    w = words_of(text)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    covered = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words_of(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é#|\n\t\x0b\xa0", max_size=120))
def test_counts_equal_brute_force(text):
    assert quality.rule_counts(text)[:5] == brute(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=60))
def test_repeats_equal_brute_force(words):
    assert quality.rule_counts(" ".join(words))[4] == brute(" ".join(words))[4]


def test_query_against_brute_force(spark, sf, documents):
    from ledgerstar.llm.queries import op1_quality_rules

    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    got = op1_quality_rules(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        b = brute(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == b
        assert r["base_failed"] == (b[0] < 20 or 100 * b[4] > 30 * b[0])
        assert not (r["base_failed"] and r["kept"])


def test_forest_isolates_outliers():
    x = np.zeros((2000, len(quality.STATISTICS)))
    x[:40, 2] = np.linspace(0.5, 3, 40)
    forest = quality.IsolationForest.grow(np.random.default_rng(0).permutation(x), trees=50, rows=64)
    s = forest.score(x)
    assert s[:40].min() > s[40:].max()


def _labelled(sf):
    """Statistics and label (NaN: none) of the documents that pass the base rule."""
    import pyarrow.parquet as pq

    docs = pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    labels = dict(zip(*pq.read_table(f"{sf}/labels.parquet", columns=["doc_id", "quality"]).to_pydict().values()))
    counts = np.array([quality.rule_counts(t) for t in docs["text"]])
    c = {k: counts[:, i] for i, k in enumerate(quality.COUNTS)}
    passing = ~((c["n_words"] < 20) | (100 * c["n_repeat_words"] > 30 * c["n_words"]))
    x = quality.features(c)[passing]
    y = np.array([labels.get(d, np.nan) for d in docs["doc_id"]], dtype=float)[passing]
    return x, y


def _gap(scores, y):
    """Balanced accuracy of the best threshold on labelled rows."""
    good, bad = np.sort(scores[y == 1]), np.sort(scores[y == 0])
    at = np.unique(scores[~np.isnan(y)])
    return max((np.searchsorted(good, at, "right") / len(good) + 1 - np.searchsorted(bad, at, "right") / len(bad)) / 2)


def test_verdict_is_no_limit_on_one_statistic_and_needs_its_paths(sf):
    """The forest parts good from bad better than any limit on one statistic, its verdicts agree with none of them,
    and with its paths shuffled among the leaves of each tree it is worse."""
    x, y = _labelled(sf.replace("0.001", "0.01"))
    forest = quality.IsolationForest.grow(x, 100, 256)
    scores = forest.score(x)
    whole = _gap(scores, y)
    assert whole >= 0.99
    cut_at = np.quantile(scores[y == 1], 0.995)
    rejected = scores > cut_at
    for k in range(x.shape[1]):
        for side in (x[:, k], -x[:, k]):
            assert _gap(side, y) < whole
            assert min((rejected != (side > v)).sum() for v in np.unique(side)) > 0
    rng = np.random.default_rng(4)
    for k in range(len(forest.path)):
        leaf = forest.feature[k] < 0
        forest.path[k][leaf] = rng.permutation(forest.path[k][leaf])
    assert _gap(forest.score(x), y) < whole - 0.02


def test_small_samples_are_drawn_for_each_tree():
    x = np.random.default_rng(1).normal(size=(300, len(quality.STATISTICS)))
    x[0] = 9
    forest = quality.IsolationForest.grow(x, trees=40, rows=128)
    assert len(forest.feature) == 40 and forest.score(x).argmax() == 0


def test_good_kept_bad_rejected(spark):
    sf = "/root/testdata/sf0.01"
    from ledgerstar.llm.common import table

    got = quality.verdicts(table(spark, sf, "documents"), table(spark, sf, "labels")).filter("not base_failed").join(
        table(spark, sf, "labels"), "doc_id").groupBy("quality").agg({"*": "count"}).collect()
    kept = quality.verdicts(table(spark, sf, "documents"), table(spark, sf, "labels")).filter("kept").join(
        table(spark, sf, "labels"), "doc_id").groupBy("quality").agg({"*": "count"}).collect()
    n, k = ({r["quality"]: r["count(1)"] for r in x} for x in (got, kept))
    assert k[1] >= 0.98 * n[1] and k.get(0, 0) <= 0.2 * n[0]


SCHEMA = "doc_id long, text string, row int, counts string, kept int, id string"


def test_odd_rows(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(1, None, 1, "a", 1, "x"), (2, "", 1, None, 1, "x"), (None, good, 1, "a", 1, "x"), (3, good, None, "a", 1, "x"), (3, good, None, "a", 1, "x"),
            (4, " \n\t ", 1, "a", 1, None), (5, good * 200, 1, "a", 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(3, 1, 0), (None, 0, 0), (4, None, 0), (5, 0, 1), (5, 1, 1)], "doc_id long, quality int, toxic int")
    got = quality.verdicts(df, labels).collect()
    assert len(got) == 7
    assert all(r["base_failed"] for r in got if r["doc_id"] in (1, 2, 4))
    kept = quality.keep_good(df, labels)
    assert kept.columns == df.columns and sum(r["doc_id"] == 3 for r in kept.collect()) == 2


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.verdicts(df, labels).collect() == []
    one = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(40)))], "doc_id long, text string")
    assert [r["kept"] for r in quality.verdicts(one, labels).collect()] == [True]  # no labels: base rule only


def test_no_labels_of_one_kind_rejects_nothing(spark):
    df = spark.createDataFrame([(0.9, 1), (0.2, 1)], "anomaly double, good int")
    assert quality.calibrate(df) == float("inf")




def test_threshold_stands_between_good_and_bad(spark):
    rows = [(0.4, 1)] * 50 + [(0.8, 0)] * 10 + [(0.99, None)]
    df = spark.createDataFrame(rows, "anomaly double, good int")
    assert abs(quality.calibrate(df) - 0.6) < 0.01
