"""Token planes: chunk round trip, ids equal the library's, order, starts, odd inputs."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerstar.llm import token_planes as tp

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=300), st.integers(1, 70))
def test_chunk_round_trip(ids, block):
    a = np.array(ids, dtype="<u4")
    chunk = tp.pack_chunk(a, block)
    assert (tp.unpack_chunk(chunk) == a).all()
    for k in range(-(-len(ids) // block)):
        assert (tp.unpack_block(chunk, k) == a[k * block:(k + 1) * block]).all()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aB éÉ.,'s1!\n\t\xa0\x1ćΣİ <|endoftext|>你ﬀ", max_size=40), max_size=5))
def test_ids_equal_the_library(texts):
    enc = tp.encoder(PATH, False)
    lib = Tokenizer.from_file(PATH) if not hasattr(test_ids_equal_the_library, "lib") else test_ids_equal_the_library.lib
    test_ids_equal_the_library.lib = lib
    for t, got in zip(texts, enc.encode(texts)):
        assert got.tolist() == lib.encode(t, add_special_tokens=False).ids


def test_letters_that_end_in_a_mark_before_a_full_stop(library):
    """In lower case or normal form these letters end in a combining mark, which joins the mark after it."""
    texts = ["\u0130. \u0301", "a\u0130, b", "\ufb1d. x"]
    for t, got in zip(texts, tp.encoder(PATH, False).encode(texts)):
        assert got.tolist() == library.encode(t, add_special_tokens=False).ids


def want_of(rows, library):
    """Rows (doc_id, start, n, crc) in ascending id order, NULL first."""
    out, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_against_the_library(spark, sf, documents, library):
    from ledgerstar.llm.queries import op5_token_planes

    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in op5_token_planes(spark, sf).collect())
    assert got == want_of(rows, library)


def test_files_in_order_and_odd_rows(spark, tmp_path, library):
    rows = [(k, f"text number {k}. " * (k % 7)) for k in range(300)] + [(None, "no id"), (1000, None), (1001, "long " * 40_000), (1002, "a <|endoftext|> b"), (1003, "A <|EndOfText|> B"), (1004, "H\u0331 h\u0331 I\u0307 \u212b"), (1005, "x., y.. Z,. é, «é», 5, a_,")]
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, part int, chunk string, t int").repartition(5)
    path = tp.write_planes(df, str(tmp_path / "planes"), PATH, parts=4, chunk_ids=200, block_ids=64)
    got = sorted(((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in tp.read_planes(spark, path).collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert got == want_of(rows, library)
    chunks = spark.read.parquet(path).orderBy("part", "chunk").collect()
    ids = [d for c in chunks for d in c["doc_ids"]]
    assert ids == [d for d, *_ in want_of(rows, library)] and len({c["part"] for c in chunks}) == 4


def test_repeated_rows_and_empty(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (1, "c"), (2, "")], "doc_id long, text string")
    got = tp.token_rows(df, PATH).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got) == [(1, 2), (1, 3), (1, 3), (2, 1)]
    assert sorted(r["start"] for r in got)[-1] == 8
    assert tp.token_rows(df.limit(0), PATH).collect() == []


def test_whole_texts_through_the_library(library):
    enc = tp.WordEncoder(PATH, whole=True)
    assert enc.encode(["Any text, with 3 words."])[0].tolist() == library.encode("Any text, with 3 words.", add_special_tokens=False).ids


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(tp, "CACHE_WORDS", 10)
    enc = tp.WordEncoder(PATH)
    for k in range(20):
        enc.encode([" ".join(f"{chr(97 + k)}{chr(97 + j)}" for j in range(26))])
    assert len(enc.known) < 100
