"""Quality rules with an isolation forest over rule statistics.

One pass over the texts counts what the rules need. The base rules reject outright; the forest judges
the rest by the statistics themselves (mean word length, symbols, echoes, the most frequent word, words and
bytes that are not letters): trees of random splits are grown on a bounded sample of rows, and a row that few
splits isolate (a short mean path) is anomalous. No statistic has a limit of its own; the one threshold, on the anomaly
score, is calibrated from all labelled rows. The statistics are written once; sampling, calibration and scoring read them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.llm.common import arrow_map, arrow_schema, cut, draw, ident, pack

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PCT = 30

TREES, TREE_ROWS = 100, 256   # the forest's sample: TREES * TREE_ROWS rows at most, whatever the input
SEED = 11
BINS = 4096                   # score histogram for the threshold

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_echo", "n_top", "n_lettered", "n_letters", "n_bytes")


def _repeat_marks(words: list[bytes], size: int) -> int:
    """Words inside ``size``-word windows whose content is found twice or more."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.uint64)
    if len(known) == len(words):
        return 0
    mixed = ids * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
    mixed ^= mixed >> np.uint64(29)
    h = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        h = h * np.uint64(0xBF58476D1CE4E5B9) + mixed[k:k + n]
    sorted_h = np.sort(h)
    if not (sorted_h[1:] == sorted_h[:-1]).any():
        return 0  # equal windows have equal hashes: no repeat
    # exact: number the windows by doubling, 1 -> 2 -> 4 -> 8 words
    rank, width = ids.astype(np.int64), 1
    while width < size:
        step = min(width, size - width)
        pairs = rank[:len(rank) - step] * (int(rank.max()) + 1) + rank[step:]
        rank, width = np.unique(pairs, return_inverse=True)[1], width + step
    twice = np.bincount(rank)[rank] > 1
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


_SPACES = b" \t\n\x0b\x0c\r"
_LETTERS = bytes(b for b in range(256) if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
_NEITHER = bytes(b for b in range(256) if b not in _LETTERS and b not in _SPACES)


def rule_counts(text: str | None) -> tuple[int, ...]:
    """The counts of one whole text, in the order of ``COUNTS``; NULL counts as empty.

    Letters are A-Z, a-z and all bytes of other scripts; n_top counts the most frequent word, n_echo words
    equal to the one before, n_lettered words with a letter.
    """
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [x for x in text.split("\n") if x.encode("utf-8", "surrogatepass").split()]
    n, spoken = len(raw), raw.translate(None, _NEITHER)  # letters and spaces
    return (len(words), len(text) - (n - len(raw.translate(None, _SPACES))), n - len(raw.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), _repeat_marks(words, WINDOW), sum(map(bytes.__eq__, words, words[1:])),
            max(Counter(words).values(), default=0), len(spoken.split()), len(spoken.translate(None, _SPACES)), n)


def rule_statistics(df: DataFrame, carry: Column, text_col: str = "text") -> DataFrame:
    """(row, counts): one pass over whole texts, no shuffle."""
    src = df.select(carry.alias("row"), ident(text_col).cast("string").alias("t"))
    counts = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])
    out = T.StructType([src.schema["row"], T.StructField("counts", counts)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(out)
        for b in batches:
            got = np.array([rule_counts(t) for t in b.column(1).to_pylist()], dtype=np.int64).reshape(-1, len(COUNTS))
            stats = pa.StructArray.from_arrays([pa.array(got[:, k]) for k in range(len(COUNTS))], fields=list(schema.field(1).type))
            yield pa.RecordBatch.from_arrays([b.column(0).cast(schema.field(0).type), stats], schema=schema)

    return arrow_map(src, run, out)


def base_failed(c: str = "counts") -> Column:
    n = F.col(f"{c}.n_words")
    return (n < MIN_WORDS) | (100 * F.col(f"{c}.n_repeat_words") > MAX_REPEAT_PCT * n)


STATISTICS = ("word_length", "symbols", "echoes", "top_word", "unlettered", "non_letters")


def features(c: dict[str, np.ndarray]) -> np.ndarray:
    """The rule statistics, raw, one column per name in ``STATISTICS``.

    All but the first are shares, so that long and short texts compare. Splits are drawn between the least and
    the greatest value, so a column's scale does not matter. Repeated windows are left to the base rule.
    """
    n, size = (np.maximum(1, c[k]).astype(float) for k in ("n_words", "n_bytes"))
    return np.stack([c["word_chars"] / n, c["n_symbols"] / n, c["n_echo"] / n, c["n_top"] / n, 1 - c["n_lettered"] / n, 1 - c["n_letters"] / size], axis=1)


@dataclass
class IsolationForest:
    """Trees as flat arrays: split feature (-1: leaf), threshold, first child, path length at a leaf."""

    feature: list[np.ndarray]
    cut: list[np.ndarray]
    child: list[np.ndarray]
    path: list[np.ndarray]
    norm: float

    @staticmethod
    def usual_path(n: np.ndarray | float) -> np.ndarray:
        """Mean path of an unsuccessful search in a random binary tree of n rows."""
        n = np.asarray(n, dtype=float)
        m = np.maximum(n, 2)
        return np.where(n > 2, 2 * (np.log(np.maximum(m - 1, 1)) + 0.5772156649015329) - 2 * (m - 1) / m, np.where(n == 2, 1.0, 0.0))

    @classmethod
    def grow(cls, x: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = SEED) -> IsolationForest:
        """``x``: the sample, tree after tree. Where it is smaller than all trees together, each draws its rows from it."""
        rng = np.random.default_rng(seed)
        per = min(rows, len(x))
        depth = int(np.ceil(np.log2(max(2, per))))
        out = cls([], [], [], [], float(max(1e-9, cls.usual_path(per))))
        for t in range(trees):
            part = x[t * per:(t + 1) * per] if len(x) >= trees * per else x[rng.choice(len(x), per, replace=False)]
            f, v, c, p, queue = [], [], [], [], [(part, 0)]
            while queue:
                rows_, d = queue.pop(0)
                lo, hi = (rows_.min(0), rows_.max(0)) if len(rows_) else (np.zeros(x.shape[1]),) * 2
                open_ = np.flatnonzero(hi > lo)
                if d >= depth or len(rows_) < 2 or not len(open_):
                    f.append(-1), v.append(0.0), c.append(0), p.append(d + float(cls.usual_path(len(rows_))))
                    continue
                k = int(rng.choice(open_))
                at = float(rng.uniform(lo[k], hi[k]))
                f.append(k), v.append(at), c.append(len(f) + len(queue)), p.append(0.0)
                queue += [(rows_[rows_[:, k] < at], d + 1), (rows_[rows_[:, k] >= at], d + 1)]
            out.feature.append(np.array(f)), out.cut.append(np.array(v)), out.child.append(np.array(c)), out.path.append(np.array(p))
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score in (0, 1): 2 ** (-mean path / usual path); higher is more anomalous."""
        total = np.zeros(len(x))
        for f, v, c, p in zip(self.feature, self.cut, self.child, self.path):
            node = np.zeros(len(x), dtype=np.int64)
            live = np.arange(len(x)) if f[0] >= 0 else np.empty(0, dtype=np.int64)
            while len(live):
                at = node[live]
                node[live] = c[at] + (x[live, f[at]] >= v[at])
                live = live[f[node[live]] >= 0]
            total += p[node]
        return np.exp2(-total / len(self.feature) / self.norm)


def _sample(stats: DataFrame, rows: int, size: int) -> np.ndarray:
    """At most ``size`` feature rows of ``rows``: those of the smallest draws (fixed by id and counts)."""
    if not rows:
        return np.empty((0, len(STATISTICS)))
    drawn = stats.select("counts.*", draw(F.col("id"), *[F.col("counts")[c] for c in COUNTS], seed=SEED).alias("u"))
    got = drawn.filter(F.col("u") < min(1.0, 2.0 * size / rows)).orderBy("u", *COUNTS).limit(size).toPandas()
    return features({c: got[c].to_numpy() for c in COUNTS})


def scored(stats: DataFrame, forest: IsolationForest) -> DataFrame:
    """``stats`` with the anomaly score of every row."""
    out = T.StructType([*stats.schema.fields, T.StructField("anomaly", T.DoubleType())])
    held = stats.sparkSession.sparkContext.broadcast(forest)
    where = stats.columns.index("counts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(out)
        for b in batches:
            counts = b.column(where)
            x = features({c: counts.field(k).to_numpy(zero_copy_only=False) for k, c in enumerate(COUNTS)})
            cols = [a.cast(f.type) for a, f in zip(b.columns, schema)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(held.value.score(x), pa.float64())], schema=schema)

    return arrow_map(stats, run, out)


def calibrate(judged: DataFrame, min_keep: float = 0.995) -> float:
    """The score above which rows are rejected, from labelled rows (anomaly, good 0/1, n).

    Of the thresholds that keep at least ``min_keep`` of the good rows, those with the highest balanced
    accuracy; where a stretch of them is equal, its middle, so that rows like the good ones have a margin.
    Without labelled rows of both kinds nothing is rejected. The driver sees a histogram of ``BINS`` bins.
    """
    hist = (judged.filter("good is not null").groupBy(F.floor(F.col("anomaly") * BINS).cast("int").alias("bin"), "good")
            .agg(F.count("*").alias("n")).collect())
    good, bad = np.zeros(BINS + 1), np.zeros(BINS + 1)
    for r in hist:
        (good if r["good"] else bad)[r["bin"]] += r["n"]
    if not good.sum() or not bad.sum():
        return float("inf")
    kept, caught = np.cumsum(good) / good.sum(), 1 - np.cumsum(bad) / bad.sum()
    value = np.where(kept >= min_keep, kept + caught, -1)
    first = last = int(np.argmax(value))
    while last + 1 < len(value) and value[last + 1] == value[first]:
        last += 1
    return float(((first + last) // 2 + 1) / BINS)


def quality_rules(df: DataFrame, labels: DataFrame, carry: Column, key: Column, text_col: str = "text") -> DataFrame:
    """(row, id, counts, base_failed, anomaly, kept) for every row of ``df``.

    ``key`` is the id that ``labels`` (doc_id, quality) uses. Labels with a NULL id or quality are not
    used; an id labelled more than once is good only if every label says so. NULL and empty texts have
    no words and fail the base rule. An empty table gives an empty result; without labels only the base
    rule rejects.
    """
    stats = cut(rule_statistics(df.select(F.struct(carry.alias("row"), key.alias("id")).alias("k"), ident(text_col).alias("t")), F.col("k"), "t")
                .select("row.row", "row.id", "counts", base_failed().alias("base_failed")), "quality-stats")
    passing = stats.filter("not base_failed")
    x = _sample(passing, passing.count(), TREES * TREE_ROWS)
    if not len(x):
        return stats.select("*", F.lit(0.0).alias("anomaly"), F.lit(False).alias("kept"))
    forest = IsolationForest.grow(x)
    good = (labels.select(ident("doc_id").alias("id"), ident("quality").cast("int").alias("q")).filter("id is not null and q is not null")
            .groupBy("id").agg(F.min((F.col("q") > 0).cast("int")).alias("good")))
    judged = scored(passing.select("id", "counts"), forest).join(good, "id")
    limit = calibrate(judged)
    return scored(stats, forest).withColumn("kept", ~F.col("base_failed") & (F.col("anomaly") < limit))


def verdicts(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, the counts, base_failed, anomaly, kept."""
    got = quality_rules(df, labels, F.lit(None).cast("string"), ident(id_col), text_col)
    return got.select(F.col("id").alias(id_col), "counts.*", "base_failed", "anomaly", "kept")


def keep_good(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without the rejected rows; columns and their order stay."""
    return quality_rules(df, labels, pack(df), ident(id_col), text_col).filter("kept").select("row.*")
