"""The pipeline: every stage held against its operator's brute force on the stage's own input."""

import re


import corpus_pipeline
import public_tokenizers
from llm.test_contamination import brute as brute_contamination
from llm.test_contamination import words
from llm.test_mixing import brute_mix
from llm.test_quality import brute as brute_quality
from llm.test_simhash import brute_classes, brute_fp
from llm.test_token_planes import want_of
from tokenizers import Tokenizer

from ledgerstar.llm.common import cut, table


def test_stages(spark, sf):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "SimHash near-dedup", "benchmark decontamination", "mixing sources to target weights", "token-ID / binary output"]
    docs = table(spark, sf, "documents")
    columns, seen = docs.columns, [sorted(docs.collect())]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = cut(stage(spark, docs, sf), f"test-{k}")
        assert k == 4 or docs.columns == columns
        seen.append(sorted(docs.collect()))
    raw, good, single, clean, mixed, out = seen

    def base(r):
        n, *_, repeat = brute_quality(r["text"])
        return n < 20 or 100 * repeat > 30 * n

    assert set(r["doc_id"] for r in good) <= {r["doc_id"] for r in raw if not base(r)}
    label = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").collect()}
    fair = [r for r in raw if label.get(r["doc_id"]) == 1 and not base(r)]
    assert sum(r in good for r in fair) >= 0.97 * len(fair)

    classes = brute_classes([r["doc_id"] for r in good], [brute_fp(r["text"]) for r in good])
    assert single == [r for r, c in zip(good, classes) if r["doc_id"] == c]

    items = [(str(r["item_id"]), r["text"]) for r in table(spark, sf, "benchmark").collect()]

    windows = {k: [" ".join(words(t)[i:i + 13]) for i in range(max(1, len(words(t)) - 12))] for k, t in items}

    def dirty(r):
        text = " ".join(words(r["text"]))
        near = [(k, t) for k, t in items if any(w in text for w in windows[k])]
        return brute_contamination(r["text"], near)[-1]

    assert clean == [r for r in single if not dirty(r)]

    taken = brute_mix([(r["doc_id"], r["text"], r["source"]) for r in clean])
    want = [r for r, (size, _, _, t) in zip(clean, taken) if size for _ in range(t // size)]
    assert mixed == want and any(re.search(r"\S", r["text"]) for r in mixed)

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in out) == want_of([(r["doc_id"], r["text"]) for r in mixed], library)


def test_run_and_empty_input(spark, sf, tmp_path):
    assert corpus_pipeline.run(spark, sf).columns[:4] == ["doc_id", "start", "n_tokens", "ids_crc32"]
    for name in ("documents", "labels", "benchmark"):
        table(spark, sf, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_odd_documents_through_all_stages(spark, tmp_path):
    """NULLs in every column, empty and very long texts, repeated rows and clashing extra columns."""
    good = [" ".join(f"word{(k * 31 + i) % 997}" for i in range(60 + k)) for k in range(12)]
    bad = "win $$$ ### *** now " * 30
    item = " ".join(f"bench{i}" for i in range(20))
    rows = [(k, good[k], "en", f"s{k % 3}", 1) for k in range(8)]
    rows += [(0, good[0], "en", "s0", 1)] * 2 + [(20, good[1], None, None, None), (None, good[2], "en", "s1", 2), (None, good[9], None, None, None),
             (21, None, "en", "s1", None), (22, "", None, "s2", 0), (23, " \n ", None, "s2", 0), (24, good[10] + " " + item + " tail", "en", "s1", 3),
             (25, (good[11] + " ") * 3000, "de", None, 9), (26, bad, "en", "s1", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    extra = ["row", "t", "id", "fp", "at", "u", "counts", "verdict", "kept", "spans", "part", "chunk", "share", "copies"]
    docs = spark.createDataFrame(rows, schema).selectExpr("*", *[f"'x' as `{c}`" for c in extra], "1 as `odd.name`")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 1, 0) for k in range(8)] + [(26, 0, 0), (None, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item), (None, item), (2, None), (3, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now, columns = docs, docs.columns
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        now = cut(stage(spark, now, str(tmp_path)), f"odd-{k}")
        assert k == 4 or now.columns == columns
        kept.append(now.collect())
    first, single, clean, mixed, out = kept
    assert not {21, 22, 23, 25, 26} & {r["doc_id"] for r in first}          # no words, repeated windows, symbols
    ids = [r["doc_id"] for r in single]
    assert sorted(x for x in ids if x is not None) == [0, 1, 2, 3, 4, 5, 6, 7, 24] and ids.count(None) == 1
    assert {r["doc_id"] for r in clean} == set(ids) - {24}
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in clean} and len(out) == len(mixed)
