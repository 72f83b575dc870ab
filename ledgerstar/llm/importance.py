"""Importance resampling towards a target distribution.

Texts are bags of hashed features (runs of words in a fixed number of buckets). Two tables of bucket counts,
one of the corpus and one of the target, give each bucket a gain: the log of its ratio of smoothed shares. A text's weight is the
sum of the gains of its features, looked up in an array; with Gumbel noise fixed by its id, the highest
scores are a sample without replacement in proportion to the weights' exponentials.

The ranking is a distributed LSD radix sort: the composite key (score down, id up) is cut into digits, and each
pass places all rows stably by one digit. Rows are held in chunks of positions; a chunk counts its digits, prefix
sums over (digit, chunk) give where each chunk's rows of a digit go, and a row's new position is that offset plus
its place among equal digits of its chunk. After the last pass the position is the rank. No pass sorts more than
one digit of one chunk, and only digits in which keys differ need a pass.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ledgerstar.llm.common import arrow_map, arrow_schema, cut, discard, ident, stored

BUCKETS = 10_000
SEED = 2024
MIN_WORDS = 20
PERCENT = 10

DIGIT_BITS = 11
CHUNK_ROWS = 1 << 13     # positions of a chunk: what one window of a pass holds at most
BLOCK_CHUNKS = 1 << 10   # chunks whose prefix sums are taken together

# A-Z become a-z; 0-9, a-z and all non-ASCII bytes are parts of words, everything else separates.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class _Buckets(dict):
    """Feature -> bucket; remembers at most 2 ** 20 features, others are computed again."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        k = zlib.crc32(feature) % self.buckets
        if len(self) < 1 << 20:
            self[feature] = k
        return k


def feature_buckets(text: str | None, known: _Buckets, longest: int = 1) -> tuple[np.ndarray, int]:
    """Buckets of all runs of 1 to ``longest`` words of a whole text, repeats included, and its number of words."""
    words = text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []
    found = [np.fromiter(map(known.__getitem__, words), np.int32, len(words))]
    for k in range(2, longest + 1):
        runs = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)]
        found.append(np.fromiter(map(known.__getitem__, runs), np.int32, len(runs)))
    return np.concatenate(found), len(words)


def bucket_counts(df: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = 1) -> np.ndarray:
    """Features per bucket over all whole texts. Each task adds up its own; the driver gets ``buckets`` sums."""
    out = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = _Buckets(buckets), np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                total += np.bincount(feature_buckets(t, known, longest)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], schema=arrow_schema(out))

    got = arrow_map(df.select(ident(text_col).cast("string").alias("t")), run, out).groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(buckets, dtype=np.int64)
    for r in got:
        counts[r["bucket"]] = r["n"]
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of the smoothed shares), per bucket."""
    buckets, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    ratio = (target + 1) * float(s_all + buckets) / ((corpus + 1) * float(t_all + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighted(df: DataFrame, gains: np.ndarray, carry: Column, text_col: str = "text", longest: int = 1) -> DataFrame:
    """(row, n_words, n_features, weight): one pass over whole texts, no shuffle."""
    src = df.select(carry.alias("row"), ident(text_col).cast("string").alias("t"))
    out = T.StructType([src.schema["row"], *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")]])
    held = df.sparkSession.sparkContext.broadcast(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, gains_ = arrow_schema(out), held.value
        known = _Buckets(len(gains_))
        for b in batches:
            rows = []
            for t in b.column(1).to_pylist():
                k, n = feature_buckets(t, known, longest)
                rows.append((n, len(k), int(gains_[k].sum())))
            n = np.array(rows, dtype=np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(schema.field(0).type), *[pa.array(n[:, c]) for c in range(3)]], schema=schema)

    return arrow_map(src, run, out)


def noise(key: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, fixed by key and seed; a NULL key counts as the empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


# --- radix sort --------------------------------------------------------------------------------------------

def _offsets(counts: DataFrame) -> DataFrame:
    """(c, d, start): rows before those of digit d in chunk c, from counts (c, d, n).

    Sums of digits (at most 2 ** DIGIT_BITS rows), of blocks of chunks within a digit, of chunks within a block.
    """
    def before(*keys):
        return F.coalesce(F.sum("n").over(W.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))

    blocks = counts.groupBy("d", F.floor(F.col("c") / BLOCK_CHUNKS).alias("b")).agg(F.sum("n").alias("n"))
    digits = blocks.groupBy("d").agg(F.sum("n").alias("n")).select("d", before(F.lit(0), "d").alias("s0"))
    blocks = blocks.select("d", "b", before("d", "b").alias("s1"))
    held = counts.withColumn("b", F.floor(F.col("c") / BLOCK_CHUNKS)).select("c", "d", "b", before("d", "b", "c").alias("s2"))
    # the digits are at most 2 ** DIGIT_BITS rows by construction
    return held.join(blocks, ["d", "b"]).join(F.broadcast(digits), "d").select("c", "d", (F.col("s0") + F.col("s1") + F.col("s2")).alias("start"))


def _digits(rows: DataFrame, keys: list[str]) -> list[Column]:
    """Digit columns of the non-negative or sign-flipped long ``keys``, least significant key last, those that differ."""
    bits = rows.agg(*[F.expr(f"bit_or({k}) ^ bit_and({k})").alias(k) for k in keys]).first()
    out = []
    for k in reversed(keys):
        differ = (bits[k] or 0) & (2**64 - 1)
        for low in range(0, 64, DIGIT_BITS):
            if differ >> low & (1 << DIGIT_BITS) - 1:
                out.append(F.shiftrightunsigned(F.col(k), low).bitwiseAND((1 << DIGIT_BITS) - 1).cast("int"))
    return out


def radix_rank(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the place (from 0) in the order of the unsigned 64-bit ``keys``, first key first.

    Rows equal in all keys keep the order in which they were written. ``rows`` must not have columns ``pos``, ``c``, ``d``.
    """
    spark = rows.sparkSession
    state, path = stored(rows.withColumn("pos", F.monotonically_increasing_id()), "radix")
    digits = _digits(state, keys)
    for digit in digits or [F.lit(0)]:
        cols = rows.columns
        s = state.withColumn("c", F.floor(F.col("pos") / CHUNK_ROWS)).withColumn("d", digit)
        start = _offsets(s.groupBy("c", "d").agg(F.count("*").alias("n")))
        place = F.row_number().over(W.partitionBy("c", "d").orderBy("pos")) - 1
        then, now = stored(s.withColumn("k", place).join(start, ["c", "d"]).select(*cols, (F.col("start") + F.col("k")).alias("pos")), "radix")
        discard(spark, path)
        state, path = then, now
    return state


def _unsigned(c: Column) -> Column:
    """A long whose bits, read as unsigned, have the order of ``c``."""
    return c.bitwiseXOR(F.lit(-(2**63)).cast("long"))


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
             min_words: int = MIN_WORDS, buckets: int = BUCKETS, longest: int = 1, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank for every row of ``df``; rank is NULL for rows that are not drawn.

    Of the N rows with at least ``min_words`` words, floor(percent * N / 100) are drawn. NULL and empty texts have no
    features and weight 0; a NULL id is drawn after equal scores with an id. Repeated rows are ranked one after the other
    (rows equal in id and score by number of features). Other columns are ignored. Empty tables give empty results;
    an empty target has counts 0.
    """
    gains = bucket_gains(bucket_counts(df, text_col, buckets, longest), bucket_counts(target, text_col, buckets, longest))
    rows = weighted(df, gains, ident(id_col).cast("long"), text_col, longest).withColumnRenamed("row", "id")
    rows = cut(rows.withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "importance")
    able = rows.filter(F.col("n_words") >= min_words)
    n, top = able.agg(F.count("*"), F.max("score")).first()
    keyed = able.select("id", "n_features", "weight", "score", (F.lit(top or 0) - F.col("score")).alias("k0"), F.col("id").isNull().cast("long").alias("k1"),
                        _unsigned(F.coalesce("id", F.lit(0))).alias("k2"), F.col("n_features").alias("k3"))
    ranked = radix_rank(keyed, ["k0", "k1", "k2", "k3"])
    rank = F.when(F.col("pos") < n * percent // 100, F.col("pos") + 1)
    rest = rows.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    cols = [F.col("id").alias(id_col), "n_features", "weight", "score", "rank"]
    return ranked.withColumn("rank", rank.cast("long")).select(*cols).unionByName(rest.select(*cols))
