"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words. Whole copies that the target certainly holds are allocated
to all documents of the source. The rest of the target is a sample: each document draws a uniform number
u and is ranked by its random odds u / (1 - u) divided by its inclusion odds p / (1 - p); the lowest
ranks are selected as long as they fit the size that is left, in words. p is the share of the source
that is left, times the document's own weight over the mean weight of the source's words; by default the weight
is the number of binary digits of the document's size, so long documents are likelier than short ones, but less than
in proportion. Rows that repeat both id and text of a source are numbered, and each draws for itself. Where the next document would
overrun the size, one more is taken: of those ranked higher, the one whose words come nearest to the gap
(the lowest rank of equals), if that is nearer than none.

The ranking is never sorted as a whole: ranks are cut into fine buckets of about ``BUCKET_ROWS``
documents, bucket totals are summed along the source, and only the one bucket per source in which the
sample ends is ordered. The plan (a row per source) then decides each document on its own, in one
pass over the texts. DataFrame expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerstar.llm.common import WORD_RE, cut, draw, ident, pack, repeats

SEED = 6
MAX_COPIES = 3
BUCKET_ROWS = 256


def n_words(text: Column) -> Column:
    """Words of the text; NULL: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def _odds(p: Column) -> Column:
    return p / (F.lit(1.0) - p)


def targets(sizes: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """Targets of sources (source, total, n): source, total, n, target.

    Weights are 1, 2, 3, repeating, over the sources by code point, NULL last; the targets share the sum
    of all totals by weight, none above ``max_copies`` times its source, the excess reshared by weight.
    That is one common rate for the sources below their limit: with the sources in the order of
    limit / weight, the first rate that its own source can take is it. One row per source is ordered here.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("w", F.pmod(F.row_number().over(by_name) - 1, F.lit(3)) + 1).withColumn("limit", F.col("total") * max_copies)
    along = W.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())
    every = W.partitionBy(F.lit(0))
    r = (w.withColumn("left", F.sum("total").over(every) - F.sum("limit").over(along.rowsBetween(W.unboundedPreceding, -1)))
         .withColumn("left", F.coalesce("left", F.sum("total").over(every)))
         .withColumn("open", F.sum("w").over(every) - F.coalesce(F.sum("w").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("rate", F.col("left").cast("double") / F.col("open").cast("double")))
    fits = F.col("rate") * F.col("w") <= F.col("limit")
    r = r.withColumn("common", F.min_by(F.when(fits, F.col("rate")), F.when(fits, F.col("open") * -1)).over(every))
    return r.select("source", "total", "n", F.least(F.col("common") * F.col("w"), F.col("limit").cast("double")).alias("target"))


def _ranked(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (source, u, weight) with their source's plan, rank q and bucket b."""
    joined = rows.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    p = F.least(F.col("share") * F.col("weight") / F.col("mean_weight"), F.lit(1.0 - 1e-9))
    q = F.when(p > 0, _odds(F.col("u")) / _odds(p))
    usual = F.lit(1.0) / _odds(F.col("share"))
    return joined.withColumn("q", q).withColumn("b", F.floor(F.col("q") / (F.col("q") + usual) * F.col("buckets")).cast("long"))


def plan_mix(rows: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """The plan, a row per source, from rows (source, size, u, weight):

    source, total, target, whole (copies that every document gets), share (of a copy, sampled), mean_weight,
    buckets, last_b and last_q (where the ranked sample ends), extra_q (the rank of the document that fills the gap).
    """
    sums = rows.groupBy("source").agg(F.sum("size").alias("total"), F.count("*").alias("n"),
                                      F.coalesce(F.sum(F.col("size") * F.col("weight")).cast("double") / F.nullif(F.sum("size"), F.lit(0)).cast("double"), F.lit(1.0)).alias("mean_weight"))
    sums = cut(sums, "mix-sources")
    t = targets(sums.select("source", "total", "n"), max_copies).join(sums.select(F.col("source").alias("s"), "mean_weight"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    whole = F.when(F.col("total") > 0, F.floor(F.col("target") / F.col("total"))).otherwise(0).cast("long")
    t = (t.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("total"))
         .withColumn("share", F.when(F.col("total") > 0, F.col("rest") / F.col("total")).otherwise(0.0))
         .withColumn("buckets", F.ceil(F.col("n") / BUCKET_ROWS).cast("long")))
    t = cut(t, "mix-targets")

    ranked = _ranked(rows, t.filter("share > 0")).filter("b is not null")
    sums_b = ranked.groupBy("source", "b").agg(F.sum("size").alias("s"), F.first("rest").alias("rest"))
    run = F.sum("s").over(W.partitionBy("source").orderBy("b"))
    over = sums_b.withColumn("upto", run).filter("upto > rest")
    last = over.groupBy("source").agg(F.min(F.struct("b", (F.col("upto") - F.col("s")).alias("before"))).alias("x")).select(
        F.col("source").alias("s1"), F.col("x.b").alias("b1"), F.col("x.before").alias("before"))
    edge = ranked.join(last, F.col("source").eqNullSafe(F.col("s1")) & (F.col("b") == F.col("b1")))
    upto = F.sum("size").over(W.partitionBy("source").orderBy("q")) + F.col("before")  # rows of equal rank together
    held = edge.withColumn("upto", upto).withColumn("in", F.col("upto") <= F.col("rest"))
    ends = held.groupBy("source", "b").agg(
        F.coalesce(F.max(F.when(F.col("in"), F.col("q"))), F.lit(-1.0)).alias("last_q"),
        (F.first("rest") - F.coalesce(F.max(F.when(F.col("in"), F.col("upto"))), F.first("before"))).alias("gap"))
    ends = cut(ends.select(F.col("source").alias("s2"), F.col("b").alias("last_b"), "last_q", "gap"), "mix-ends")
    beyond = ranked.join(ends, F.col("source").eqNullSafe(F.col("s2"))).filter("b > last_b or b = last_b and q > last_q")
    off = F.struct(F.abs(F.col("size") - F.col("gap")).alias("off"), F.col("q"))
    fill = beyond.groupBy("s2").agg(F.min(off).alias("m"), F.first("gap").alias("g")).filter("m.off < g").select(
        F.col("s2").alias("s3"), F.col("m.q").alias("extra_q"))
    plan = (t.join(ends, F.col("source").eqNullSafe(F.col("s2")), "left")
            .join(fill, F.col("source").eqNullSafe(F.col("s3")), "left").drop("s2", "s3", "gap"))
    # no end found: all that have a weight fit
    return cut(plan.withColumn("last_b", F.coalesce("last_b", F.col("buckets") + 1)), "mix-plan")


def _copies() -> Column:
    sampled = (F.col("share") > 0) & ((F.col("b") < F.col("last_b")) | (F.col("b") == F.col("last_b")) & (F.col("q") <= F.col("last_q"))
                                      | (F.col("q") == F.coalesce("extra_q", F.lit(-1.0))))
    return (F.col("whole") + F.coalesce(sampled.cast("int"), F.lit(0))).cast("long")


def _rows(df: DataFrame, carry: Column, id_col: str, text_col: str, source_col: str, weight: Column | None) -> DataFrame:
    """(row, source, size, weight, name, key): ``name`` is what the draw is made from, ``key`` is equal for repeated rows."""
    text, source = ident(text_col).cast("string"), ident(source_col).cast("string")
    name = F.concat(F.coalesce(ident(id_col).cast("string"), F.lit("~")), F.lit("|"), F.coalesce(F.md5(text), F.lit("~")))
    size = n_words(text)
    w = F.length(F.bin(size)) if weight is None else F.greatest(F.coalesce(weight.cast("double"), F.lit(0.0)), F.lit(0.0))
    return df.select(carry.alias("row"), source.alias("source"), size.alias("size"), w.alias("weight"), name.alias("name"),
                     F.md5(F.concat(name, F.coalesce(F.concat(F.lit("|"), source), F.lit("")))).alias("key"))


def _drawn(rows: DataFrame, repeat: Column) -> DataFrame:
    """The uniform number of every row, from its name and, where it repeats an earlier row, the number of that repeat."""
    name = F.concat("name", F.when(repeat > 0, F.concat(F.lit("|"), repeat.cast("string"))).otherwise(F.lit("")))
    return rows.withColumn("u", draw(name, seed=SEED)).drop("name")


def _all_drawn(df: DataFrame, carry: Column, *cols) -> DataFrame:
    rows = repeats(_rows(df, carry, *cols), "mix-places")
    return cut(_drawn(rows, F.col("repeat")), "mix-rows")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weight: Column | None = None, max_copies: int = MAX_COPIES) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes), copies; one row per document.

    The draw is fixed by id, text and, for rows that repeat id, text and source, the number of the repeat, so reruns
    agree: of repeated rows, as many are taken each time. NULL sources are one source, NULL and empty texts have
    size 0 and cost nothing. Other columns are ignored. Very long texts are ordinary rows; only their size travels. An
    empty table gives an empty result. With ``weight``, rows of weight 0 or NULL get the whole copies only.
    """
    rows = _all_drawn(df, ident(id_col), id_col, text_col, source_col, weight)
    plan = plan_mix(rows.select("source", "size", "u", "weight"), max_copies)
    return _ranked(rows, plan).withColumn("copies", _copies()).select(
        F.col("row").alias(id_col), "size", F.col("total").alias("source_size"), "target",
        (F.col("size") * F.col("copies")).alias("taken"), "copies")


def mixed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weight: Column | None = None, max_copies: int = MAX_COPIES) -> DataFrame:
    """``df`` with every row repeated by its copies (0 to ``max_copies``); columns and their order stay.

    Cases as in :func:`mix`. The plan decides a row on its own, in one pass over the whole rows; only rows that
    repeat id, text and source are written and numbered again.
    """
    cols = (id_col, text_col, source_col, weight)
    rows = _all_drawn(df, F.lit(0), *cols)
    plan = plan_mix(rows.select("source", "size", "u", "weight"), max_copies)
    repeated = cut(rows.filter("repeat = 1").select("key"), "mix-repeated")
    whole = _rows(df, pack(df), *cols)
    single = _drawn(whole.join(repeated, "key", "left_anti"), F.lit(0))
    again = _drawn(repeats(whole.join(repeated, "key", "left_semi"), "mix-places"), F.col("repeat"))
    both = single.select("row", "source", "u", "weight").union(again.select("row", "source", "u", "weight"))
    return (_ranked(both, plan).withColumn("copies", _copies()).filter("copies > 0")
            .select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*"))


ORACLE = r"""
WITH z AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5(text) AS m, row_number() OVER (PARTITION BY doc_id, text, source) - 1 AS j
  FROM documents),
d AS (
  SELECT doc_id, source, size, length(bin(size)) AS weight,
         (CAST('0x' || substr(md5('6|' || coalesce(CAST(doc_id AS VARCHAR), '~') || '|' || coalesce(m, '~') || CASE WHEN j > 0 THEN '|' || j ELSE '' END), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u
  FROM z),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS total, CASE WHEN sum(size) > 0 THEN CAST(sum(size * weight) AS DOUBLE) / CAST(sum(size) AS DOUBLE) ELSE 1 END AS mean_weight, 3 * CAST(sum(size) AS BIGINT) AS cap, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, CAST((SELECT sum(total) FROM s) - coalesce(sum(cap) OVER before, 0) AS DOUBLE) / CAST((SELECT sum(w) FROM s) - coalesce(sum(w) OVER before, 0) AS DOUBLE) AS rate,
         row_number() OVER (ORDER BY CAST(cap AS DOUBLE) / w, source NULLS LAST) AS k
  FROM s WINDOW before AS (ORDER BY CAST(cap AS DOUBLE) / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, total, mean_weight, least((SELECT arg_min(rate, k) FROM o WHERE rate * w <= cap) * w, CAST(cap AS DOUBLE)) AS target FROM o),
f AS (
  SELECT *, CASE WHEN total > 0 THEN CAST(floor(target / total) AS BIGINT) ELSE 0 END AS whole FROM t),
g AS (
  SELECT *, target - whole * total AS rest, CASE WHEN total > 0 THEN (target - whole * total) / total ELSE 0 END AS share FROM f),
r AS (
  SELECT e.*, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q
  FROM (SELECT d.doc_id, d.size, u, g.*, least(share * weight / mean_weight, 1 - 1e-9::DOUBLE) AS p FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source) AS e),
c AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY q RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= rest AND share > 0, false) AS inside
  FROM r),
e AS (
  SELECT *, rest - coalesce(sum(size) FILTER (WHERE inside) OVER (PARTITION BY source), 0) AS gap FROM c),
n AS (
  SELECT *, row_number() OVER (PARTITION BY source, inside ORDER BY abs(size - gap), q) AS k FROM e),
x AS (
  SELECT source AS sx, q AS extra FROM n WHERE k = 1 AND NOT inside AND share > 0 AND abs(size - gap) < gap)
SELECT doc_id, CAST(size AS BIGINT) AS size, total AS source_size, target,
       CAST(size * (whole + CASE WHEN inside OR coalesce(q = extra, false) THEN 1 ELSE 0 END) AS BIGINT) AS taken,
       CAST(whole + CASE WHEN inside OR coalesce(q = extra, false) THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM n LEFT JOIN x ON n.source IS NOT DISTINCT FROM x.sx
"""
