"""Benchmark decontamination: Wu-Manber search for many word strings at once.

The symbols are words. Test strings are the 13-word windows of the benchmark items (an item of fewer
words is one string). For a set of strings of at least ``m`` words:

* the *shift table* maps a block of ``b`` neighbouring words to the least number of positions by
  which the search may move on when that block ends at the current position; a block that no string
  holds allows the longest move, ``m - b + 1``;
* a block with shift 0 ends the first ``m`` words of some string: the *suffix bucket* of that block
  lists those strings, and each is compared with the document word by word.

Strings are grouped by length class so that one short item does not shorten the moves for all others.
The benchmark is a stated query set, read item by item. A search table holds at most ``MAX_STRINGS``
strings, which bounds what is sent to the executors; a larger benchmark is searched table after table,
each in a pass of its own over the texts, whose findings are written before the next begins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.llm.common import arrow_map, arrow_schema, cut, ident, pack

WINDOW = 13
MAX_STRINGS = 100_000   # strings in one search table (about 60 MB in a Python worker)
LENGTH_CLASSES = (1, 2, 3, 5, 8, 13)

# Digits and letters stay, A-Z as a-z, any other ASCII character separates words; bytes from 0x80 stay.
_FOLD = bytes(c if c >= 0x80 or chr(c).isalnum() and not chr(c).isupper() else c + 32 if chr(c).isupper() else 32
              for c in (i for i in range(256)))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def windows_of(words: list[bytes], size: int = WINDOW) -> set[tuple[bytes, ...]]:
    if not words:
        return set()
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}


@dataclass
class SearchTable:
    """Shift table and suffix buckets of strings that all have at least ``m`` words."""

    m: int
    strings: list[tuple[bytes, ...]]
    block: int = 0
    shift: dict = field(default_factory=dict)
    bucket: dict = field(default_factory=dict)

    def __post_init__(self):
        self.block = b = min(3, self.m)
        for k, s in enumerate(self.strings):
            for end in range(b, self.m + 1):
                key = s[end - 1] if b == 1 else s[end - b:end]
                move = self.m - end
                if move < self.shift.get(key, self.m - b + 1):
                    self.shift[key] = move
            self.bucket.setdefault(s[self.m - 1] if b == 1 else s[self.m - b:self.m], []).append(k)

    def find(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(start, string number) of every occurrence."""
        m, b, shift, bucket, strings = self.m, self.block, self.shift, self.bucket, self.strings
        longest, n, get = m - b + 1, len(words), shift.get
        end = m
        while end <= n:
            key = words[end - 1] if b == 1 else tuple(words[end - b:end])
            move = get(key, longest)
            if move:
                end += move
                continue
            start = end - m
            for k in bucket[key]:
                s = strings[k]
                if tuple(words[start:start + len(s)]) == s:
                    yield start, k
            end += 1


@dataclass
class Searcher:
    """All test strings with the items that hold each."""

    tables: list[SearchTable]
    owners: list[list[frozenset[str]]]

    @classmethod
    def build(cls, held: dict[tuple[bytes, ...], set[str]], window: int = WINDOW) -> Searcher:
        """From strings and the items that hold each."""
        classes: dict[int, list] = {}
        for s in sorted(held):
            m = len(s) if len(s) == window else max(c for c in LENGTH_CLASSES if c <= len(s))
            classes.setdefault(m, []).append(s)
        tables = [SearchTable(m, strings) for m, strings in sorted(classes.items())]
        return cls(tables, [[frozenset(held[s]) for s in t.strings] for t in tables])

    @classmethod
    def parts(cls, items: Iterator[tuple[str, str | None]], window: int = WINDOW, max_strings: int = MAX_STRINGS) -> Iterator[Searcher]:
        """Searchers of at most ``max_strings`` strings that together hold all items; one at least."""
        held: dict[tuple[bytes, ...], set[str]] = {}
        made = False
        for item, text in items:
            for w in windows_of(words_of(text), window):
                held.setdefault(w, set()).add(item)
                if len(held) == max_strings:
                    yield cls.build(held, window)
                    held, made = {}, True
        if held or not made:
            yield cls.build(held, window)

    def search(self, words: list[bytes]) -> tuple[np.ndarray, set[str], list[tuple[int, int]]]:
        """(hit mark per word, items, spans [start, end) of the occurrences)."""
        hit, items, spans = np.zeros(len(words), dtype=bool), set(), []
        for t, own in zip(self.tables, self.owners):
            for start, k in t.find(words):
                end = start + len(t.strings[k])
                hit[start:end] = True
                items |= own[k]
                spans.append((start, end))
        return hit, items, spans


VERDICT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType()),
    T.StructField("items", T.ArrayType(T.StringType()))])


def items_of(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> Iterator[tuple[str, str | None]]:
    """The benchmark's items one after the other; the driver holds one partition of it at a time."""
    src = benchmark.select(F.coalesce(ident(item_col).cast("string"), F.lit("")).alias("i"), ident(text_col).cast("string").alias("t"))
    return ((r["i"], r["t"]) for r in src.toLocalIterator())


FOUND = T.StructType([T.StructField("spans", T.ArrayType(T.IntegerType())), T.StructField("items", T.ArrayType(T.StringType()))])


def _pass(src: DataFrame, searcher: Searcher, last: bool) -> DataFrame:
    """One pass over (row, t, found): adds what this searcher finds; the last one gives the verdict."""
    held = src.sparkSession.sparkContext.broadcast(searcher)
    out = T.StructType([src.schema["row"], T.StructField("verdict", VERDICT)] if last else src.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, search = arrow_schema(out), held.value.search
        for b in batches:
            rows = []
            for t, before in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                words = words_of(t)
                hit, items, spans = search(words)
                flat = [x for s in sorted(set(spans)) for x in s]
                if before:
                    items |= set(before["items"])
                    for a, e in zip(before["spans"][::2], before["spans"][1::2]):
                        hit[a:e] = True
                    flat = before["spans"] + flat
                ids, n = sorted(items), int(hit.sum())
                rows.append({"n_words": len(words), "n_hit": n, "n_items": len(ids), "items": ids,
                             "items_sha256": sha256(",".join(ids).encode()).hexdigest(),
                             "contaminated": n > 0 and 20 * n >= len(words)} if last else {"spans": flat, "items": ids})
            row = b.column(0).cast(schema.field(0).type)
            cols = [row, pa.array(rows, schema.field(1).type)] if last else [row, b.column(1).cast(schema.field(1).type), pa.array(rows, schema.field(2).type)]
            yield pa.RecordBatch.from_arrays(cols, schema=schema)

    return arrow_map(src, run, out)


def scan(docs: DataFrame, benchmark: DataFrame, carry: Column, text_col: str = "text", window: int = WINDOW,
         max_strings: int = MAX_STRINGS) -> DataFrame:
    """(row, verdict): ``carry`` of every document and its verdict, without a shuffle.

    n_words, n_hit (words inside any occurrence), n_items, items (ids sorted as text), items_sha256
    (of those ids, comma-joined) and contaminated (n_hit > 0 and 20 * n_hit >= n_words). NULL and empty
    texts have no words and are never contaminated. An item with a NULL id counts under the empty id;
    rows that repeat an id are one item. An empty benchmark hits nothing.
    """
    found = docs.select(carry.alias("row"), ident(text_col).cast("string").alias("t"), F.lit(None).cast(FOUND).alias("found"))
    parts = Searcher.parts(items_of(benchmark), window, max_strings)
    now = next(parts)
    for following in parts:
        found, now = cut(_pass(found, now, False), "contamination-part"), following
    return _pass(found, now, True)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, then the fields of the verdict (see :func:`scan`)."""
    return scan(docs, benchmark, ident(id_col), text_col).select(F.col("row").alias(id_col), "verdict.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the contaminated rows; columns and their order stay."""
    return scan(docs, benchmark, pack(docs), text_col).filter("not verdict.contaminated").select("row.*")


ORACLE = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[p:p + least(len(w), 13) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS p FROM iw WHERE len(w) > 0)),
ks AS (SELECT DISTINCT k FROM win),
pos AS (
  SELECT doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM dw, ks WHERE len(w) >= k)),
occ AS (SELECT doc_id, item_id, p, win.k FROM pos JOIN win ON pos.s = win.s AND pos.k = win.k),
hits AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM occ) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hits USING (doc_id) LEFT JOIN its USING (doc_id)
"""
