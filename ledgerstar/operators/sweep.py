"""Sweeps over the starts and ends of validity ranges, for keys whose history is long.

``intervals.asof_join`` tests a row against every version of its key, and a self join of a history writes all
candidates of a key into one task. Here starts, ends and dates are put in one order instead, dealt to ranges
(``windows.pin_ranges``, a hot key is split by what follows it) and read once; what an earlier range hands on is
one row per range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerstar.operators.windows import pin_ranges
from ledgerstar.session import written

BLOCK = 64        # places that are met together
CHUNK = 4_096     # sweeping versions that meet a block in one group
SPAN = 1_024      # blocks listed in one row


def asof_merge(fact: DataFrame, intervals: DataFrame, fact_key: str, fact_date: str, iv_key: str | None = None,
               valid_from: str = "valid_from", valid_to: str = "valid_to", select: list[str] | dict[str, str] | None = None,
               how: str = "left", num_partitions: int | None = None) -> DataFrame:
    """Point-in-time join by a merge: the result of ``asof_join`` with work linear in rows plus versions.

    Rows and versions are ordered together by key and date, and every row takes the last version before it, if
    that is still valid (``valid_from <= date < valid_to``). Versions of a key must not overlap; where they do, the
    one with the latest start (then the latest end) counts, and a row is never repeated. Ranges without a day and
    versions with a NULL key or bound match nothing; a row with a NULL key or date finds nothing. ``how`` is
    ``left`` (every row stays) or ``inner``; repeated rows stay repeated.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    iv_key = iv_key or fact_key
    if select is None:
        select = [c for c in intervals.columns if c not in (iv_key, valid_from, valid_to)]
    renames = select if isinstance(select, dict) else {c: c for c in select}
    lo, hi = F.col(valid_from), F.col(valid_to)
    versions = intervals.where((lo < hi) & F.col(iv_key).isNotNull()).select(
        F.col(iv_key).alias("k"), lo.alias("at"), F.lit(0).alias("kind"), hi.alias("until"), F.lit(0).cast("bigint").alias("u"),
        F.lit(None).cast(fact.schema).alias("f"), F.struct(F.lit(True).alias("found"), *[F.col(a).alias(f"v_{b}") for a, b in renames.items()]).alias("v"))
    rows = fact.select(F.col(fact_key).alias("k"), F.col(fact_date).alias("at"), F.lit(1).alias("kind"),
                       F.lit(None).cast(versions.schema["until"].dataType).alias("until"), F.monotonically_increasing_id().alias("u"),
                       F.struct(*[F.col(c) for c in fact.columns]).alias("f"), F.lit(None).cast(versions.schema["v"].dataType).alias("v"))
    order = ["at", "kind", "until", "u"]
    pinned = pin_ranges(versions.unionByName(rows), [F.col(c) for c in ("k", *order)], num_partitions)

    held = F.when(F.col("kind") == 0, F.struct("k", "until", "v"))
    here = W.partitionBy("_pid", "k").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = pinned.withColumn("own", F.last(held, ignorenulls=True).over(here))
    # One row per range: the last version of the ranges before it, whatever its key.
    ends = pinned.groupBy("_pid").agg(F.max_by(held, F.when(F.col("kind") == 0, F.struct("k", "at", "until"))).alias("end"))
    carry = ends.select(F.col("_pid").alias("_cpid"), F.last("end", ignorenulls=True).over(
        W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)).alias("before"))
    met = local.where("kind = 1").join(F.broadcast(carry), F.col("_pid") == F.col("_cpid"))
    last = F.coalesce("own", F.when(F.col("before.k") == F.col("k"), F.col("before")))
    met = met.select("f", F.when(F.col("at") < last["until"], last["v"]).alias("v"))
    if how == "inner":
        met = met.where("v is not null")
    return met.select("f.*", *[F.col(f"v.v_{c}").alias(c) for c in renames.values()])


def _placed(df: DataFrame, num_partitions: int | None) -> DataFrame:
    """(k, id, lo, hi) with its place ``p`` in the order of starts and ``e``, the number of starts before ``hi``.

    Places are counted over all keys, so the versions that start inside a version's range after it are
    the places ``p + 1 .. e``.
    """
    rows = written(df.withColumn("u", F.monotonically_increasing_id()), "overlap-rows")
    marks = F.array(F.struct(F.col("lo").alias("at"), F.lit(1).alias("opens")), F.struct(F.col("hi").alias("at"), F.lit(0).alias("opens")))
    events = rows.select("*", F.explode(marks).alias("m")).select("k", "m.*", "u", F.when(F.col("m.opens") == 1, F.struct("id", "lo", "hi")).alias("v"))
    order = ["k", "at", "opens", "u"]
    pinned = pin_ranges(events, [F.col(c) for c in order], num_partitions)
    upto = W.partitionBy("_pid").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    carry = pinned.groupBy("_pid").agg(F.sum("opens").alias("n")).select(
        F.col("_pid").alias("_cpid"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    counted = (pinned.withColumn("n", F.sum("opens").over(upto)).join(F.broadcast(carry), F.col("_pid") == F.col("_cpid"))
               .withColumn("n", F.col("n") + F.col("ahead")))
    both = counted.groupBy("u").agg(F.first("k").alias("k"), F.first("v", ignorenulls=True).alias("v"),
                                    F.max(F.when(F.col("opens") == 1, F.col("n"))).alias("p"),
                                    F.max(F.when(F.col("opens") == 0, F.col("n"))).alias("e"))
    return both.select("k", "v.*", "p", "e")


def overlaps(df: DataFrame, key: str, version_id: str, valid_from: str = "valid_from", valid_to: str = "valid_to",
             num_partitions: int | None = None) -> DataFrame:
    """Pairs of different versions of one key whose half-open ranges intersect: ``(key, version_a, version_b)``.

    A pair is returned in both directions; empty means the history is consistent. Each version is placed in the
    order of starts, where its partners are a run of places; the run is listed block by block, so the work grows
    with versions plus pairs. A group holds at most ``CHUNK`` versions and the ``BLOCK`` versions of a block, so that neither
    a long history nor a version that covers all others is one group. A range without a day overlaps the ranges
    that hold its start and end inside them; NULL keys, ids and bounds match nothing; rows that repeat a version pair
    with its partners each.
    """
    rows = df.select(F.col(key).alias("k"), F.col(version_id).alias("id"), F.col(valid_from).alias("lo"), F.col(valid_to).alias("hi")).dropna()
    placed = _placed(rows, num_partitions)

    def block(place):
        return F.floor(place / F.lit(BLOCK))

    first, last = block(F.col("p") + 1), block(F.col("e"))
    spans = F.sequence(F.floor(first / F.lit(SPAN)), F.floor(last / F.lit(SPAN)))
    a = (placed.where("e > p").withColumn("s", F.explode(spans))
         .withColumn("block", F.explode(F.sequence(F.greatest(first, F.col("s") * SPAN), F.least(last, F.col("s") * SPAN + SPAN - 1))))
         .select("block", F.floor(F.col("p") / F.lit(CHUNK)).alias("chunk"), "k", F.col("id").alias("a"), F.col("lo").alias("alo"),
                 F.col("hi").alias("ahi"), F.col("p").alias("ap"), F.col("e").alias("ae")))
    b = placed.select(block(F.col("p")).alias("block"), F.col("id").alias("b"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"), F.col("p").alias("bp"))
    b = b.join(a.select("block", "chunk").distinct(), "block")
    meet = ((F.col("bp") > F.col("ap")) & (F.col("bp") <= F.col("ae")) & (F.col("a") != F.col("b"))
            & (F.col("alo") < F.col("bhi")) & (F.col("blo") < F.col("ahi")))
    both = a.join(b, ["block", "chunk"]).where(meet).select(
        F.col("k").alias(key), F.explode(F.array(F.struct(F.col("a").alias("version_a"), F.col("b").alias("version_b")),
                                                 F.struct(F.col("b").alias("version_a"), F.col("a").alias("version_b")))).alias("pair"))
    return both.select(key, "pair.*")
