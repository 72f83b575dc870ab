"""Toxicity by weak supervision.

1. A lexicon of word stems is learned from a bounded sample of labelled rows: stems (word beginnings of 4 to
   7 letters, shorter words whole) that are far more frequent in texts labelled toxic. How many texts a stem
   needs does not depend on the size of the sample; equal texts count once. It is dealt out to several
   lexicon voters; a fixed list of insults and some patterns vote as well.
2. Every text is read once: votes and the shares behind them are written as one short row.
3. A generative label model explains the votes by a hidden class. Given the class, each voter depends on at
   most one other voter (the spanning forest of the strongest conditional dependences), so voters that
   repeat each other are not counted twice. Expectation-maximisation estimates the voters' accuracies and
   these correlations from the counts of vote patterns of all rows; known labels are held fixed.
4. A linear classifier is trained on the model's posterior labels and scores every row.

Only rows that are not held out (crc32 of the id as text, mod 5, is not 0) teach anything. Ids, languages,
sources and labels are never inputs of a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.llm.common import arrow_map, arrow_schema, cut, draw, ident

LABELLED_ROWS = 20_000     # labelled rows, at most, from which stems are learned
STEM = (4, 7)
MIN_TOXIC_TEXTS = 4        # a stem must be in that many different toxic texts (in all of them if there are fewer)
MIN_LOG_ODDS = 1.5
EVIDENCE_Z = 3.0           # and the lower bound (likelihood interval of 3 deviations) of its log odds must be above 0
LISTS = 6                  # lexicon voters
FIT_ROWS = 40_000          # rows, at most, on which the classifier is trained
CACHE_WORDS = 300_000
SEED = 10

# Common insults.
INSULTS = frozenset(("idiot", "moron", "stupid", "dumb", "loser", "clown", "trash", "scum", "pathetic", "worthless",
                     "disgusting", "fool", "imbecile", "jerk", "ugly", "filthy", "garbage", "vermin"))

VOTERS = (*[f"lexicon{k}" for k in range(LISTS)], "insults", "lexicon_dense", "lexicon_many", "shouting", "bangs", "symbols")
SHARES = ("hits", "dense", "strong", "insults", "upper", "bangs", "symbols", "any")


def held_out(id_: Column) -> Column:
    """Rows that teach nothing; NULL ids have no label and are not held out."""
    return F.coalesce(F.crc32(id_.cast("string")) % 5 == 0, F.lit(False))


# ---- lexicon ------------------------------------------------------------------------------------

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def _letters(word: str) -> str:
    return word if word.isalpha() else max(_NOT_LETTERS.split(word), key=len)


def _stems(word: str) -> list[str]:
    """The beginnings of a word; a word too short for one is its own stem."""
    return [word[:k] for k in range(min(len(word), STEM[0]), min(len(word), STEM[1]) + 1) if k]


def stems_of(text: str) -> set[str]:
    out: set[str] = set()
    for w in {_letters(x) for x in set(text.lower().split())}:
        out.update(_stems(w))
    return out


def learn_lexicon(rows: DataFrame) -> list[tuple[str, float]]:
    """(stem, log odds), strongest first, from rows (t, toxic 0/1). Texts are counted, not occurrences.

    Texts equal but for case and white space are one text, toxic if any of them is. Counts are made per batch, summed by Spark, and only stems that pass come to the driver:
    the sample of texts bounds them. A stem whose beginning is in the list as well is left out.
    """
    same = F.md5(F.trim(F.regexp_replace(F.lower(F.coalesce("t", F.lit(""))), r"\s+", " ")))
    rows = cut(rows.groupBy(same.alias("k")).agg(F.min("t").alias("t"), F.max("toxic").alias("toxic")), "tox-texts")
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return []
    out = T.StructType([T.StructField("stem", T.StringType()), T.StructField("bad", T.LongType()), T.StructField("good", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(out)
        for b in batches:
            sums = (Counter(), Counter())
            for t, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                sums[toxic].update(stems_of(t or ""))
            stems = list(sums[0] | sums[1])
            yield pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), pa.array([sums[1][s] for s in stems], pa.int64()),
                                              pa.array([sums[0][s] for s in stems], pa.int64())], schema=schema)

    counts = arrow_map(rows.select("t", F.col("toxic").cast("int")), run, out).groupBy("stem").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = F.log((F.col("bad") + 0.5) / F.lit(bad + 1.0)) - F.log((F.col("good") + 0.5) / F.lit(good + 1.0))
    # twice the log likelihood ratio against equal shares; it grows with a stem's texts, not with the sample
    b, g, share = F.col("bad"), F.col("good"), bad / (bad + good)
    parts = [F.when(x > 0, x * F.log(x / ((b + g) * F.lit(p)))).otherwise(0.0) for x, p in ((b, share), (g, 1 - share))]
    kept = (counts.filter(b >= min(MIN_TOXIC_TEXTS, bad)).withColumn("odds", odds).withColumn("evidence", 2 * (parts[0] + parts[1]))
            .filter((F.col("odds") >= MIN_LOG_ODDS) & (F.col("evidence") > EVIDENCE_Z ** 2))
            .collect())
    found = {r["stem"]: r["odds"] for r in kept}
    own = [(s, o) for s, o in found.items() if not any(s[:k] in found and found[s[:k]] >= o - 1.0 for k in range(STEM[0], len(s)))]
    return sorted(own, key=lambda x: (-x[1], x[0]))


# ---- votes --------------------------------------------------------------------------------------

_ASCII, _UPPER = bytes(range(128)), bytes(range(65, 91))


def upper_letters(text: str) -> int:
    """Upper-case letters of a text; only those beyond ASCII are looked at one by one."""
    raw = text.encode()
    return len(raw) - len(raw.translate(None, _UPPER)) + sum(map(str.isupper, raw.translate(None, _ASCII).decode()))


class Reader:
    """Votes and shares of texts under a lexicon; words seen before are remembered up to a limit."""

    def __init__(self, lexicon: list[tuple[str, float]]):
        self.of = {s: (k % LISTS, o) for k, (s, o) in enumerate(lexicon)}
        self.known: dict[str, tuple[int, float, bool] | None] = {}

    def _judge(self, word: str) -> tuple[int, float, bool] | None:
        w = _letters(word)
        found = max((self.of[s] for s in _stems(w) if s in self.of), key=lambda x: x[1], default=None)
        insult = w in INSULTS
        return (*(found or (-1, 0.0)), insult) if found or insult else None

    def read(self, text: str | None) -> tuple[list[int], list[float]]:
        words = text.lower().split() if text else []
        known = self.known
        for w in set(words).difference(known):
            known[w] = self._judge(w)
        hits = [x for w in words if (x := known[w])]
        if len(known) > CACHE_WORDS:
            self.known = {}
        n, chars = max(1, len(words)), max(1, len(text or ""))
        lists = {x[0] for x in hits if x[0] >= 0}
        odds = sum(x[1] for x in hits)
        many, dense = len(hits), len(hits) / n
        insults = sum(x[2] for x in hits)
        upper = upper_letters(text or "") / chars
        bangs, symbols = ((text or "").count("!")) / n, sum((text or "").count(c) for c in "#*$%&|") / n
        votes = [*[int(k in lists) for k in range(LISTS)], int(insults > 0), int(dense > 0.02), int(many > 2), int(upper > 0.4), int(bangs > 0.2), int(symbols > 0.2)]
        shares = [math.log1p(many), min(1.0, 10 * dense), math.log1p(odds), math.log1p(insults), upper, min(1.0, bangs), min(1.0, symbols), float(many > 0)]
        return votes, shares


def read_votes(df: DataFrame, id_col: str, text_col: str, lexicon: list[tuple[str, float]]) -> DataFrame:
    """(id, votes as the bits of an integer, shares) of every row, in one pass without a shuffle."""
    src = df.select(ident(id_col).alias("id"), ident(text_col).cast("string").alias("t"))
    out = T.StructType([src.schema["id"], T.StructField("votes", T.IntegerType()), *[T.StructField(s, T.DoubleType()) for s in SHARES]])
    held = df.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, reader = arrow_schema(out), Reader(held.value)
        for b in batches:
            got = [reader.read(t) for t in b.column(1).to_pylist()]
            votes = [sum(v << k for k, v in enumerate(x)) for x, _ in got]
            shares = np.array([s for _, s in got], dtype=float).reshape(-1, len(SHARES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(votes, pa.int32()), *[pa.array(shares[:, k]) for k in range(len(SHARES))]], schema=schema)

    return arrow_map(src, run, out)


# ---- the label model ----------------------------------------------------------------------------

@dataclass
class LabelModel:
    """P(class) and, per voter, P(vote = 1 | class, vote of its parent voter)."""

    prior: float
    parent: list[int]       # -1: depends on the class alone
    table: np.ndarray       # voters x class x parent's vote

    @staticmethod
    def _bits(patterns: np.ndarray) -> np.ndarray:
        return (patterns[:, None] >> np.arange(len(VOTERS))) & 1

    @staticmethod
    def _forest(v: np.ndarray, weight: np.ndarray, post: np.ndarray, least: float = 1e-3) -> list[int]:
        """For each voter its parent in the forest of the strongest dependences given the class."""
        k = v.shape[1]
        gain = np.zeros((k, k))
        total = weight.sum()
        for y in (0, 1):
            w = weight * (post if y else 1 - post)
            if w.sum() <= 0:
                continue
            p1 = (w @ v) / w.sum()
            p11 = (v * w[:, None]).T @ v / w.sum()
            for a, b in ((1, 1), (1, 0), (0, 1), (0, 0)):
                pa_, pb = (p1 if a else 1 - p1), (p1 if b else 1 - p1)
                joint = {(1, 1): p11, (1, 0): p1[:, None] - p11, (0, 1): p1[None, :] - p11, (0, 0): 1 - p1[:, None] - p1[None, :] + p11}[a, b]
                joint = np.maximum(joint, 1e-12)
                gain += w.sum() / total * joint * np.log(joint / np.maximum(pa_[:, None] * pb[None, :], 1e-12))
        parent, joined, best = [-1] * k, {0}, {j: (gain[0, j], 0) for j in range(1, k)}
        while best:  # Prim: the strongest edge to a voter not joined yet
            j = max(best, key=lambda x: (best[x][0], -x))
            g, i = best.pop(j)
            parent[j] = i if g > least else -1
            joined.add(j)
            for x in best:
                best[x] = max(best[x], (gain[j, x], j), key=lambda t: t[0])
        return parent

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """P(toxic | votes) of vote patterns."""
        v = self._bits(np.asarray(patterns, dtype=np.int64))
        logs = np.zeros((len(v), 2))
        for j, i in enumerate(self.parent):
            for y in (0, 1):
                p = self.table[j, y, v[:, i] if i >= 0 else 0]
                logs[:, y] += np.log(np.where(v[:, j] == 1, p, 1 - p))
        d = logs[:, 1] - logs[:, 0] + math.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(d, -60, 60)))

    @classmethod
    def fit(cls, patterns: np.ndarray, label: np.ndarray, weight: np.ndarray, rounds: int = 30) -> LabelModel:
        """Expectation-maximisation over pattern counts; label 0, 1 is held fixed, -1 is hidden."""
        v = cls._bits(patterns)
        weight = weight.astype(float)
        known = label >= 0
        toxic = weight[label == 1].sum() + 1.0
        clean = weight[label == 0].sum() + 1.0
        share = toxic / (toxic + clean)
        any_vote = v[:, :LISTS + 1].any(1)
        post = np.where(known, label, np.where(any_vote, 0.9, share * 0.1)).astype(float)
        model = None
        for _ in range(rounds):
            parent = cls._forest(v, weight, post)
            table = np.full((v.shape[1], 2, 2), 0.5)
            for j, i in enumerate(parent):
                for y in (0, 1):
                    w = weight * (post if y else 1 - post)
                    for x in (0, 1) if i >= 0 else (0,):
                        on = (v[:, i] == x) if i >= 0 else np.ones(len(v), bool)
                        table[j, y, x] = ((w * v[:, j])[on].sum() + 0.5) / (w[on].sum() + 1.0)
            prior = float(np.clip(((weight * post).sum() + 0.5) / (weight.sum() + 1.0), 1e-4, 1 - 1e-4))
            model = cls(prior, parent, np.clip(table, 1e-5, 1 - 1e-5))
            new = np.where(known, label, model.posterior(patterns))
            done = np.abs(new - post).max() < 1e-6
            post = new
            if done:
                break
        return model


# ---- the classifier -----------------------------------------------------------------------------

def fit_linear(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps; the last weight is the constant."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        g = z.T @ (p - y) + ridge * np.r_[w[:-1], 0]
        h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)) * np.r_[np.ones(len(w) - 1), 1e-6]
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w


def toxicity(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (score >= 0.5), votes; one row per input row.

    ``labels``: doc_id, toxic; NULL ids and labels are left out, an id labelled more than once is toxic if any
    label says so. NULL and empty texts get the score of a text without votes. Without labels of both
    kinds nothing can be learned: every score is 0. Other columns are ignored.
    """
    toxic = (labels.select(ident("doc_id").alias("label_id"), ident("toxic").cast("int").alias("y")).filter("label_id is not null and y is not null")
             .filter(~held_out(F.col("label_id"))).groupBy("label_id").agg((F.max("y") > 0).cast("int").alias("toxic")))
    toxic = cut(toxic, "tox-labels")
    n = toxic.count()
    u = draw(F.col("label_id"), seed=SEED)  # ordered, so that the bound keeps the same rows each time
    few = toxic.filter(u < min(1.0, LABELLED_ROWS / max(1, n))).orderBy(u, "label_id").limit(LABELLED_ROWS)
    teach = df.select(ident(id_col).alias("id"), ident(text_col).cast("string").alias("t")).join(few, F.col("id") == F.col("label_id")).select("t", "toxic")
    lexicon = learn_lexicon(cut(teach, "tox-teach"))
    out = F.col("id").alias(id_col)
    if not lexicon:
        return df.select(ident(id_col).alias("id")).select(out, held_out(F.col("id")).alias("held_out"), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.lit(0).alias("votes"))

    rows = cut(read_votes(df, id_col, text_col, lexicon), "tox-votes")
    taught = rows.filter(~held_out(F.col("id")))
    known = taught.join(toxic, F.col("id") == F.col("label_id"), "left")
    counts = known.groupBy("votes", F.coalesce("toxic", F.lit(-1)).alias("label")).agg(F.count("*").alias("n")).collect()  # at most 3 * 2 ** voters
    model = LabelModel.fit(*(np.array([r[k] for r in counts]) for k in ("votes", "label", "n")))

    size = sum(r["n"] for r in counts)
    fit = (taught.withColumn("u", draw(F.col("id"), seed=SEED + 1)).filter(F.col("u") < min(1.0, FIT_ROWS / max(1, size)))
           .orderBy("u", "votes", *SHARES).limit(2 * FIT_ROWS).select("votes", *SHARES).toPandas())
    w = fit_linear(fit[list(SHARES)].to_numpy(), model.posterior(fit["votes"].to_numpy()))
    z = sum((F.col(s) * F.lit(float(k)) for s, k in zip(SHARES, w)), F.lit(float(w[-1])))
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return rows.withColumn("score", score).select(out, held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "votes")
