"""Phrase collocations from depth-truncated suffix subtrees, partitioned vertically by memory budget.

Every word occurrence starts a suffix of at most ``MAX_WORDS`` words of its piece. A frequent phrase holds only
frequent words and frequent pairs of neighbours, so a suffix ends before a pair that is too rare, and a place that
starts with such a pair has none. The suffixes are divided by the hash of their first two words; a prefix that starts
more than ``BUDGET`` suffixes is extended by its next word, and so on. A group of hashes holds about ``BUDGET``
suffixes, and all suffixes of its prefixes, so its subtree is built on its own, level by level, and the number of
leaves below a node is the frequency of its phrase. Nodes with too few leaves are not grown.

Texts are read once, into blocks: a dictionary and an array of word numbers per language and about
``BLOCK_WORDS`` words. Blocks stay where they are. What they must know reaches them as two bitmaps of fixed size, of
the frequent words and of the frequent pairs, and as the few prefixes that are extended (one in ``BUDGET`` words at
most). Hashes only spare and deal out work: words or pairs of equal hashes count together and stay, and the subtrees
compare the words themselves, which every batch of suffixes brings as a dictionary of its own. Frequencies then meet
in joins: each phrase with its parts for the score, and with the phrases one word longer that contain it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ledgerstar.llm.common import arrow_map, arrow_schema, cut, discard, ident, ship, stored

MAX_WORDS = 5
LEAST = 100               # occurrences of a candidate
TOP = 2000
BUDGET = 1 << 20          # suffixes of a group (one prefix more at most)
BLOCK_WORDS = 1 << 20     # words of a block (one text more at most)
CHUNK = 1 << 21           # pairs or suffixes that a task holds before it sends them (one block more at most)
BIN_ROWS = 1 << 22        # pairs that are counted together, of all tasks and on average
FILTER_BITS = 22          # the bitmap of frequent words has 2 ** FILTER_BITS bits, whatever the vocabulary
PAIR_BITS = 26            # so does that of frequent pairs
KEY_BITS = 40             # bits of a prefix's hash
NO_LANG = "und"

# A-Z become a-z; the ends of pieces . , ; : ! ? \n \v \f \r become \n; a tab becomes a space.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))
_END, _NOTHING = 0, 1     # numbers of a piece end and of the empty string between two spaces


class _Words(dict):
    """Word -> number in order of appearance."""

    def __init__(self):
        super().__init__({b"\n": _END, b"": _NOTHING})

    def __missing__(self, word: bytes) -> int:
        self[word] = k = len(self)
        return k


def numbered(text: str | None, words: _Words) -> np.ndarray:
    """The word numbers of a whole text, with ``_END`` after each piece."""
    if not text:
        return np.empty(0, dtype=np.int32)
    parts = (text.encode("utf-8", "surrogatepass").translate(_BYTES).replace(b"\n", b" \n ") + b" \n").split(b" ")
    got = np.fromiter(map(words.__getitem__, parts), np.int32, len(parts))
    return got[got != _NOTHING]


def _zip(*arrays: np.ndarray) -> bytes:
    """Arrays of non-negative numbers in one zstandard frame, each in 2, 4 or 8 bytes a number."""
    out = [np.array([len(arrays)], dtype=np.int64).tobytes()]
    for a in arrays:
        top = int(a.max(initial=0))
        width = 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
        out += [np.array([width, a.size], dtype=np.int64).tobytes(), np.ascontiguousarray(a.ravel().astype(f"<u{width}")).tobytes()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(out))


def _unzip(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    out, at = [], 8
    for _ in range(int(np.frombuffer(raw, np.int64, 1)[0])):
        width, n = np.frombuffer(raw, np.int64, 2, at).tolist()
        out.append(np.frombuffer(raw, f"<u{width}", n, at + 16).astype(np.int64))
        at += 16 + width * n
    return out


BLOCK = T.StructType([T.StructField("lang", T.StringType()), T.StructField("words", T.ArrayType(T.BinaryType())), T.StructField("counts", T.ArrayType(T.LongType())),
                      T.StructField("n", T.LongType()), T.StructField("seq", T.BinaryType())])


def text_blocks(df: DataFrame, text_col: str, lang_col: str) -> tuple[DataFrame, str]:
    """(block, lang, words, counts, n, seq): the texts as dictionaries and word numbers, written once; and where."""
    src = df.select(F.coalesce(ident(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), ident(text_col).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, open_ = arrow_schema(BLOCK), {}

        def close(lang: str) -> pa.RecordBatch:
            words, parts, _ = open_.pop(lang)
            seq = np.concatenate(parts)
            counts = np.bincount(seq, minlength=len(words))[2:]
            rows = ([lang], [list(words)[2:]], [counts], [int(counts.sum())], [_zip(seq)])
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(rows, schema)], schema=schema)

        for b in batches:
            for lang, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words, parts, size = open_.get(lang) or (_Words(), [], 0)
                parts.append(numbered(t, words))
                open_[lang] = (words, parts, size + len(parts[-1]))
                if open_[lang][2] >= BLOCK_WORDS:
                    yield close(lang)
            if sum(x[2] for x in open_.values()) >= 4 * BLOCK_WORDS:  # many languages at once
                yield close(max(open_, key=lambda k: open_[k][2]))
        for lang in list(open_):
            yield close(lang)

    return stored(arrow_map(src, run, BLOCK).select(F.monotonically_increasing_id().alias("block"), "*"), "phrase-blocks")


def _shifted(g: np.ndarray, k: int) -> np.ndarray:
    return np.concatenate([g[k:], np.zeros(min(k, len(g)), dtype=g.dtype)])


def suffixes(g: np.ndarray, linked: np.ndarray | None = None) -> np.ndarray:
    """(MAX_WORDS, n): for every place the numbers that follow in its piece; 0 after a 0, and after a place that is
    not ``linked`` to the next."""
    out = np.zeros((MAX_WORDS, len(g)), dtype=np.int32)
    alive = np.ones(len(g), dtype=bool)
    for k in range(MAX_WORDS):
        s = _shifted(g, k)
        alive &= s > 0
        if k and linked is not None:
            alive &= _shifted(linked, k - 1)
        out[k] = np.where(alive, s, 0)
    return out


def _filter_bit(word: bytes, lang: bytes) -> int:
    return zlib.crc32(word + b"\0" + lang) % (1 << FILTER_BITS)


def _word_filter(vocabulary: DataFrame) -> np.ndarray:
    """A bitmap of 2 ** FILTER_BITS hash values, packed; a rare word that passes by chance is in no frequent phrase."""
    bit = F.pmod(F.crc32(F.concat("text", F.lit(bytearray(b"\0")), F.col("lang").cast("binary"))), F.lit(1 << FILTER_BITS))
    bits = np.zeros(1 << FILTER_BITS, dtype=bool)
    bits[vocabulary.select(bit.cast("int").alias("b")).distinct().toPandas()["b"].to_numpy()] = True
    return np.packbits(bits)


def _has(packed: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0


def _compact(seq: np.ndarray) -> np.ndarray:
    """``seq`` without runs of breaks (0) and without words between two breaks, which are in no phrase."""
    word = seq > 0
    before, after = np.r_[False, word[:-1]], np.r_[word[1:], False]
    seq = seq[(word & (before | after)) | (~word & (before | after))]
    word = seq > 0
    return seq[word | np.r_[True, word[:-1]]]


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _key(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - KEY_BITS)).astype(np.int64)


def _hashes(words: list[bytes], lang: str) -> np.ndarray:
    """A 64-bit hash of each word in its language, the same in every process; 0 for the break, number 0."""
    own = pd.util.hash_array(np.array([lang.encode("utf-8", "surrogatepass"), *words], dtype=object), categorize=False)
    return np.r_[np.zeros(1, dtype=np.uint64), _mixed(own[1:], own[:1])]


def _frequent(words: list[bytes], lang: str, seq: np.ndarray, bits: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(words, their hashes after a 0, seq) of a block without its rare words: seq counts the words from 1; 0 for ends and rare words."""
    tail = lang.encode("utf-8", "surrogatepass")
    held = np.flatnonzero(_has(bits, np.fromiter((_filter_bit(w, tail) for w in words), np.int64, len(words))))
    number = np.zeros(len(words) + 2, dtype=np.int32)
    number[held + 2] = np.arange(1, len(held) + 1)
    words = [words[k] for k in held]
    return words, _hashes(words, lang), _compact(number[seq])


def _pair_keys(seq: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, both) of every place and the next; both: neither is a break."""
    after = _shifted(seq, 1)
    return _key(_mixed(hashes[seq], hashes[after])), (seq > 0) & (after > 0)


def _prefixes(s: np.ndarray, hashes: np.ndarray) -> list[np.ndarray]:
    """The keys of the first 2, 3, ... words of suffixes."""
    h, out = hashes[s[0]], []
    for k in range(1, MAX_WORDS):
        h = _mixed(h, hashes[s[k]])
        out.append(_key(h))
    return out


def _routed(s: np.ndarray, hashes: np.ndarray, heavy: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(level, key): the words and the hash of the prefix that each suffix goes by; ``heavy``: the prefixes of 2, 3, ... words to be extended."""
    keys = _prefixes(s, hashes)
    level, key = np.full(s.shape[1], 2, dtype=np.int64), keys[0].copy()
    for k, held in enumerate(heavy):
        on = (level == k + 2) & np.isin(key, held)
        level[on], key[on] = k + 3, keys[k + 1][on]
    return level, key


def _blocks(batches: Iterator[pa.RecordBatch], bits: np.ndarray, pairs: np.ndarray | None) -> Iterator[tuple[str, list[bytes], np.ndarray, np.ndarray]]:
    """(lang, words, hashes, keys of pairs, or suffixes if the bitmap of the frequent ``pairs`` is given) of each block."""
    for b in batches:
        for i in range(b.num_rows):
            lang = b.column(0)[i].as_py()
            words, hashes, seq = _frequent(b.column(1)[i].as_py(), lang, _unzip(b.column(2)[i].as_py())[0], bits)
            keys, both = _pair_keys(seq, hashes)
            if pairs is None:
                yield lang, words, hashes, keys[both]
            else:
                s = suffixes(seq, both & _has(pairs, keys >> (KEY_BITS - PAIR_BITS)))
                yield lang, words, hashes, s[:, s[1] > 0]


PAIR = T.StructType([T.StructField("bin", T.LongType()), T.StructField("rows", T.BinaryType())])
BIN = T.StructType([T.StructField("bin", T.LongType()), T.StructField("load", T.LongType()), T.StructField("bits", T.BinaryType()), T.StructField("heavy", T.ArrayType(T.LongType()))])


def _key_counts(blocks: DataFrame, bins: int, least: int, bits, pairs=None, heavy: list[np.ndarray] | None = None) -> DataFrame:
    """``BIN``: per bin of the keys' first ``bins`` bits those with at least ``least`` occurrences, as bits of a bitmap (by their
    first PAIR_BITS bits), how often they occur together, and those with more than BUDGET. The keys are of all pairs or, if ``heavy`` is given, of its last
    prefixes with one word more."""
    budget = BUDGET

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(open_), return_counts=True)
            first = np.flatnonzero(np.r_[True, np.diff(keys >> (KEY_BITS - bins)) > 0])
            rows = [_zip(np.diff(keys[x:y], prepend=0), n[x:y]) for x, y in zip(first, np.r_[first[1:], len(keys)])]
            return pa.RecordBatch.from_arrays([pa.array(keys[first] >> (KEY_BITS - bins), pa.int64()), pa.array(rows, pa.binary())], schema=arrow_schema(PAIR))

        open_, size = [], 0
        for _, _, hashes, got in _blocks(batches, bits.value, pairs and pairs.value):
            if heavy is not None:
                level, key = _routed(got, hashes, heavy)
                got = key[level == len(heavy) + 2]
            if len(got):
                open_.append(got)
                size += len(got)
            if size >= CHUNK:
                yield packed()
                open_, size = [], 0
        if size:
            yield packed()

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        got = [_unzip(r) for r in pdf["rows"]]
        keys, where = np.unique(np.concatenate([np.cumsum(k) for k, _ in got]), return_inverse=True)
        n = np.bincount(where, np.concatenate([n for _, n in got])).astype(np.int64)
        places = np.zeros(1 << max(0, PAIR_BITS - bins), dtype=bool)
        places[(keys[n >= least] >> (KEY_BITS - PAIR_BITS)) & (len(places) - 1)] = True
        return pd.DataFrame({"bin": [int(pdf["bin"].iloc[0])], "load": [int(n[n >= least].sum())],
                             "bits": [zstandard.ZstdCompressor(level=3).compress(np.packbits(places).tobytes())], "heavy": [keys[n > budget].tolist()]})

    return arrow_map(blocks.select("lang", "words", "seq"), send, PAIR).groupBy("bin").applyInPandas(count, BIN)


PART = T.StructType([T.StructField("level", T.LongType()), T.StructField("group", T.LongType()), T.StructField("lang", T.StringType()),
                     T.StructField("words", T.BinaryType()), T.StructField("rows", T.BinaryType())])


def _parts(blocks: DataFrame, groups: int, bits, pairs, heavy: list[np.ndarray]) -> DataFrame:
    """The suffixes by group (``PART``), equal ones of a task once with their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, open_ = arrow_schema(PART), {}

        def close(lang: str) -> pa.RecordBatch:
            words, pieces = open_.pop(lang)[:2]
            names, rows = list(words), np.concatenate(pieces, axis=1)  # group, level, words
            rows = rows[:, np.lexsort(rows[::-1])]  # like suffixes side by side pack better
            first = np.flatnonzero(np.r_[True, (rows[:, 1:] != rows[:, :-1]).any(axis=0)])
            n, rows = np.diff(np.r_[first, rows.shape[1]]), rows[:, first]
            first = np.flatnonzero(np.r_[True, (rows[:2, 1:] != rows[:2, :-1]).any(axis=0)])
            held, packed = [], []
            for x, y in zip(first, np.r_[first[1:], rows.shape[1]]):
                used, small = np.unique(rows[2:, x:y], return_inverse=True)  # the break is always among them
                held.append(zstandard.ZstdCompressor(level=3).compress(b" ".join(names[k] for k in used)))
                packed.append(_zip(small, n[x:y]))
            cols = (rows[1, first], rows[0, first], [lang] * len(first), held, packed)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

        for lang, words, hashes, s in _blocks(batches, bits.value, pairs.value):
            if not s.shape[1]:
                continue
            level, key = _routed(s, hashes, heavy)
            names, pieces, size = open_.get(lang) or ({b"": 0}, [], 0)
            number = np.fromiter((names.setdefault(w, len(names)) for w in [b"", *words]), np.int32, len(words) + 1)
            pieces.append(np.concatenate([(key % groups)[None].astype(np.int32), level[None].astype(np.int32), number[s]]))
            open_[lang] = (names, pieces, size + s.shape[1])
            if open_[lang][2] >= CHUNK:
                yield close(lang)
            if sum(x[2] for x in open_.values()) >= 2 * CHUNK:
                yield close(max(open_, key=lambda k: open_[k][2]))
        for lang in list(open_):
            yield close(lang)

    return arrow_map(blocks.select("lang", "words", "seq"), run, PART)


def subtree(rows: np.ndarray, level: int, least: int, times: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Nodes deeper than ``level`` words with at least ``least`` leaves below, depth after depth:
    (phrases, leaves, a suffix of each). ``rows`` (MAX_WORDS, n): all suffixes of the group's prefixes, each as often as ``times`` says (once)."""
    at = np.arange(rows.shape[1])
    node = np.zeros(len(at), dtype=np.int64)
    for depth in range(MAX_WORDS):
        alive = rows[depth, at] > 0
        at, node = at[alive], node[alive]
        words, code = np.unique(rows[depth, at], return_inverse=True)
        key = node * len(words) + code
        _, where, child, leaves = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
        if times is not None:
            leaves = np.bincount(child, times[at], len(leaves)).astype(np.int64)
        big = leaves >= least
        if depth >= level and big.any():
            shown = at[where[big]]
            yield rows[:depth + 1, shown].T, leaves[big], shown
        keep = big[child]
        at, node = at[keep], child[keep]
        if not len(at):
            return


COUNTED = T.StructType([T.StructField("lang", T.StringType()), T.StructField("phrase", T.ArrayType(T.BinaryType())), T.StructField("n", T.LongType())])


def _group_counts(parts: DataFrame, least: int) -> DataFrame:
    """Phrase counts of every group from its subtree (``COUNTED``), and what it has of the extended prefixes, which other
    groups have, too. A group is about ``BUDGET`` suffixes."""
    ship(parts.sparkSession)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        level, out = int(pdf["level"].iloc[0]), []
        for lang, own in pdf.groupby("lang"):
            words, pieces, times = {b"": 0}, [], []
            for names, rows in zip(own["words"], own["rows"]):
                names = zstandard.ZstdDecompressor().decompress(names).split(b" ")
                codes, n = _unzip(rows)
                number = np.fromiter((words.setdefault(w, len(words)) for w in names), np.int32, len(names))
                pieces.append(number[codes].reshape(MAX_WORDS, -1))
                times.append(n)
            rows, times, names = np.concatenate(pieces, axis=1), np.concatenate(times), list(words)
            found = [(ps, ns) for ps, ns, _ in subtree(rows, level - 1, least, times)]
            for k in range(2, level):
                ps, where = np.unique(rows[:k], axis=1, return_inverse=True)
                ns = np.bincount(where.ravel(), times, ps.shape[1]).astype(np.int64)
                whole = ps[-1] > 0
                found.append((ps.T[whole], ns[whole]))
            out += [(lang, [names[w] for w in p], int(n)) for ps, ns in found for p, n in zip(ps, ns)]
        return pd.DataFrame(out, columns=["lang", "phrase", "n"])

    return parts.groupBy("level", "group").applyInPandas(run, COUNTED)


def phrase_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """All phrases of 1 to ``MAX_WORDS`` words with at least ``least`` occurrences: (lang, phrase as an array of words, n);
    the totals (lang, total)."""
    blocks, place = text_blocks(df, text_col, lang_col)
    totals = cut(blocks.groupBy("lang").agg(F.sum("n").alias("total")), "phrase-totals")
    entries = blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    words = cut(entries.groupBy("lang", F.col("w.words").alias("text")).agg(F.sum("w.counts").alias("n")).filter(F.col("n") >= least), "phrase-words")
    share = df.sparkSession.sparkContext.broadcast
    bits = share(_word_filter(words))
    bins = min(PAIR_BITS, (int(totals.agg(F.sum("total")).first()[0] or 0) // BIN_ROWS).bit_length())
    found, load, heavy = np.zeros(1 << max(0, PAIR_BITS - 3), dtype=np.uint8), 0, [[]]
    for r in _key_counts(blocks, bins, least, bits).collect():
        got = np.frombuffer(zstandard.ZstdDecompressor().decompress(r["bits"]), np.uint8)
        if bins <= PAIR_BITS - 3:
            found[r["bin"] * len(got):][:len(got)] = got
        else:  # a byte holds several bins
            width = 1 << (PAIR_BITS - bins)
            found[r["bin"] * width >> 3] |= got[0] >> (r["bin"] * width & 7)
        load += r["load"]
        heavy[0] += r["heavy"]
    pairs = share(found)
    while len(heavy) < MAX_WORDS - 2 and heavy[-1]:
        held = [np.array(h, dtype=np.int64) for h in heavy]
        heavy.append([k for r in _key_counts(blocks, bins, least, bits, pairs, held).select("heavy").collect() for k in r["heavy"]])
    parts = _parts(blocks, max(1, -(-load // BUDGET)), bits, pairs, [np.array(h, dtype=np.int64) for h in heavy if h])
    sums = _group_counts(parts, least).groupBy("lang", "phrase").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    counts = cut(words.select("lang", F.array("text").alias("phrase"), "n").unionByName(sums)
                 .select("lang", F.col("phrase").cast("array<string>").alias("phrase"), "n"), "phrase-counts")
    discard(df.sparkSession, place)
    return counts, totals


def _part(first: Column, n: Column) -> Column:
    return F.slice("phrase", first, n)


def _exact(c: str) -> Column:
    return F.col(c).cast("decimal(20,0)")


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language.

    a, l, r: occurrences of the phrase and of the two parts at its lowest-scoring cut (ties: the smallest first part);
    n: words of the language; score: floor(1000 a n / (l r)), in exact decimals. A phrase inside a longer one that is as
    frequent is dropped; one word longer is enough to look at, since anything between is as frequent, too. NULL and
    empty texts have no words; a NULL language is ``und``. Repeated rows count as often as they come. An empty
    table gives an empty result. Other columns are ignored. Texts are read whole, one at a time.
    """
    counts, totals = phrase_counts(df, text_col, lang_col, least)
    size = F.size("phrase")
    long = counts.filter(size > 1)
    cuts = long.select("*", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", F.col("n").alias("a"), "k", _part(F.lit(1), F.col("k")).alias("p"), _part(F.col("k") + 1, size - F.col("k")).alias("q"))
    cuts = (cuts.join(counts.select("lang", F.col("phrase").alias("p"), F.col("n").alias("l")), ["lang", "p"])
            .join(counts.select("lang", F.col("phrase").alias("q"), F.col("n").alias("r")), ["lang", "q"])
            .join(totals.withColumnRenamed("total", "n"), "lang"))
    cuts = cuts.select("lang", "phrase", "a", "n", "k", "l", "r", (F.lit(1000).cast("decimal(4,0)") * _exact("a") * _exact("n")).alias("x"), (_exact("l") * _exact("r")).alias("y"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(F.expr("x div y").alias("score"), "k", "l", "r")).alias("m"))
    inner = long.filter(size > 2).select("lang", F.explode(F.array(_part(F.lit(1), size - 1), _part(F.lit(2), size - 1))).alias("phrase"), F.col("n").alias("outer"))
    inside = inner.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    kept = best.join(inside, ["lang", "phrase"], "left").filter("outer is null or 100 * outer < 100 * a")
    kept = cut(kept.select("lang", "phrase", "a", "n", "m.score", "m.l", "m.r"), "phrase-kept")
    shown = (kept.select("lang", F.array_join("phrase", " ").alias("phrase"), "a", "l", "r", "n", "score")
             .withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64))))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    near = shown.withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= top)
    rank = F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")
    return near.withColumn("rank", rank).filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle(least: int = LEAST, top: int = TOP) -> str:
    return rf"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM t),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: list_slice(ws, i, i + k - 1))) AS p FROM w, range(1, 6) AS r(k) WHERE len(ws) >= k),
f AS (
  SELECT lang, k, p, count(*) AS c FROM g GROUP BY ALL HAVING count(*) >= {least}),
n AS (
  SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
cuts AS (
  SELECT f.lang, f.p, f.k, f.c AS a, n.n, j, l.c AS l, r.c AS r, CAST((1000::HUGEINT * f.c * n.n) // (l.c::HUGEINT * r.c) AS BIGINT) AS score
  FROM f JOIN n USING (lang), range(1, 5) AS s(j), f AS l, f AS r
  WHERE f.k > 1 AND j < f.k AND l.lang = f.lang AND r.lang = f.lang AND l.p = list_slice(f.p, 1, j) AND r.p = list_slice(f.p, j + 1, f.k)),
best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
inside AS (
  SELECT lang, list_slice(p, i, i + m - 1) AS p, max(c) AS c FROM f, range(2, 5) AS a(m), range(1, 5) AS b(i) WHERE m < k AND i + m - 1 <= k GROUP BY ALL),
kept AS (
  SELECT b.lang, array_to_string(b.p, ' ') AS phrase, a, l, r, n, score FROM best b LEFT JOIN inside x ON x.lang = b.lang AND x.p = b.p WHERE x.c IS NULL OR 100 * x.c < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= {top}
"""
