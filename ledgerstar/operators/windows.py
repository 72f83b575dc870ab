"""Order-dependent windows that scale: global rank / running sum / ntile, and per-key lag.

Spark runs an unpartitioned window (``Window.orderBy(...)`` without ``partitionBy``) in
a single task, and a window partitioned by a hot key buffers that whole key in one
task. Both are avoided:

* ``global_rank`` cuts the order into buckets of nearly equal size (``selection.buckets``, which moves no
  row and splits equal values by the keys after them), sorts only inside a bucket, and adds the counts and
  sums of the buckets before, one row per bucket. The rows are exchanged once, by bucket.
* ``keyed_lag`` and ``keyed_running_max`` deal rows by ranges of keys and order (the order's tie-breaker lets
  the bounds split a hot key), pin them with a reliable ``checkpoint()``, compute inside ``(_pid, key)``
  groups and carry one or two summary rows per partition over to the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerstar.operators.selection import buckets
from ledgerstar.session import checkpoint_dir, written


def _order_exprs(order: list) -> list[Column]:
    out = []
    for o in order:
        if isinstance(o, Column):
            out.append(o)
        elif isinstance(o, tuple):
            name, direction = o
            out.append(F.col(name).desc() if direction.lower() == "desc" else F.col(name).asc())
        else:
            out.append(F.col(o).asc())
    return out


def pin_ranges(df: DataFrame, sort_exprs: list[Column], num_partitions: int | None) -> DataFrame:
    """``df`` dealt to ranges of the order, each sorted, with the range's number as ``_pid``; written once."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    pinned = (df.repartitionByRange(n, *sort_exprs).sortWithinPartitions(*sort_exprs)
              .withColumn("_pid", F.spark_partition_id()))
    # Reliable checkpoint: range bounds come from sampling, so a recomputation could
    # move rows between partitions; the written copy also survives executor loss.
    return pinned.checkpoint(eager=True)


def ntile_from_rank(rank: Column, n: Column, k: int) -> Column:
    """``ntile(k)`` of the row with 1-based ``rank`` among ``n`` rows (standard SQL buckets:
    the first ``n mod k`` buckets hold one row more)."""
    q = (n / F.lit(k)).cast("bigint")                        # n div k
    m = n - q * k                                            # n mod k
    big = m * (q + 1)                                        # rows in the larger buckets
    first = ((rank + q) / (q + 1)).cast("bigint")            # ceil(rank / (q + 1))
    rest = m + ((rank - big + q - 1) / F.when(q > 0, q)).cast("bigint")     # m + ceil((rank - big) / q)
    return F.when(rank <= big, first).otherwise(rest)


def global_rank(df: DataFrame, order: list, value: str | None = None, ntiles: dict | None = None,
                rank_col: str = "rank", running_col: str = "running", total_col: str = "total",
                count_col: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Add a 1-based global ``row_number`` in ``order``; optionally the running sum of
    ``value`` (rows from the first to the current), the grand total of ``value`` and
    ``ntile`` columns (``ntiles={"name": k}``, computed from the same rank).

    ``order`` (names, or (name, "desc")) must be a strict total order: end it with a unique tie-breaker.
    ``df`` is written first, since the search for the buckets scans it several times.
    """
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = written(df, "rank-rows")
    rows = rows.withColumn("_b", buckets(rows, order, n))
    by = W.partitionBy("_b").orderBy(*_order_exprs(order))
    local = rows.withColumn("_lrn", F.row_number().over(by))
    aggs = [F.count(F.lit(1)).alias("_cnt")]
    if value is not None:
        local = local.withColumn("_lsum", F.sum(value).over(by.rowsBetween(W.unboundedPreceding, W.currentRow)))
        aggs.append(F.sum(value).alias("_psum"))
    # At most ``n`` rows, one per bucket, so they are ordered in one task and broadcast.
    before, every = W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    carry = [F.col("_b").alias("_cb"), F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_ccnt"), F.sum("_cnt").over(every).alias("_n")]
    if value is not None:
        carry += [F.sum("_psum").over(before).alias("_csum"), F.sum("_psum").over(every).alias("_tot")]
    out = local.join(F.broadcast(rows.groupBy("_b").agg(*aggs).select(*carry)), F.col("_b") == F.col("_cb"))
    out = out.withColumn(rank_col, (F.col("_lrn") + F.col("_ccnt")).cast("bigint"))
    if value is not None:
        lsum = F.col("_lsum")
        out = out.withColumn(running_col, F.when(F.col("_csum").isNull(), lsum).otherwise(lsum + F.col("_csum")))
        out = out.withColumn(total_col, F.col("_tot"))
    for name, k in ntiles.items() if ntiles else ():
        out = out.withColumn(name, ntile_from_rank(F.col(rank_col), F.col("_n"), k))
    if count_col:
        out = out.withColumn(count_col, F.col("_n").cast("bigint"))
    return out.drop("_b", "_cb", "_lrn", "_lsum", "_ccnt", "_csum", "_n", "_tot")


def keyed_lag(df: DataFrame, keys: list[str], order: list, cols: list[str], prefix: str = "prev_",
              num_partitions: int | None = None) -> DataFrame:
    """``lag(c, 1) over (partition by keys order by order)`` for every ``c`` in ``cols``; NULL is a key like any other.

    Two-phase form: range partitions over ``keys + order``; the first row of a key in a
    partition takes its lag from the last row of the previous non-empty partition
    when that row has the same key.
    """
    sort_exprs = [F.col(k).asc() for k in keys] + _order_exprs(order)
    pinned = pin_ranges(df, sort_exprs, num_partitions)
    wl = W.partitionBy("_pid", *keys).orderBy(*_order_exprs(order))
    local = pinned.select("*", F.row_number().over(wl).alias("_lrn"),
                          *[F.lag(c, 1).over(wl).alias(prefix + c) for c in cols])
    # Last row of every partition (max of the sort struct), one row per partition.
    if any(not isinstance(o, str) for o in order):
        raise ValueError("keyed_lag: order must be ascending column names")
    sort_struct = F.struct(*[F.col(k) for k in keys], *[F.col(c) for c in order])
    last = pinned.groupBy("_pid").agg(
        F.max_by(F.struct(*[F.col(k).alias("k_" + k) for k in keys], *[F.col(c).alias("v_" + c) for c in cols]),
                 sort_struct).alias("_last"))
    wp = W.orderBy("_pid")
    carry = last.select(F.col("_pid"), F.lag("_last", 1).over(wp).alias("_prev"))
    out = local.join(F.broadcast(carry), "_pid", "left")
    same_key = F.lit(True)
    for k in keys:
        same_key = same_key & F.col("_prev")["k_" + k].eqNullSafe(F.col(k))
    for c in cols:
        out = out.withColumn(prefix + c, F.when((F.col("_lrn") == 1) & F.col("_prev").isNotNull() & same_key, F.col("_prev")["v_" + c])
                             .otherwise(F.col(prefix + c)))
    return out.drop("_pid", "_lrn", "_prev")


def keyed_running_max(df: DataFrame, keys: list[str], order: list[str], value: str, out: str = "prev_max",
                      num_partitions: int | None = None) -> DataFrame:
    """``max(value)`` over the earlier rows of the same key in ``order`` (NULL for a key's first row).

    Two-phase form: range partitions over ``keys + order``; a key that goes on from an earlier
    partition starts with the greatest value found there. Only the first and the last key of a
    partition can go on, so the carry has at most two rows per partition.
    """
    sort_exprs = [F.col(k).asc() for k in keys] + _order_exprs(order)
    pinned = pin_ranges(df, sort_exprs, num_partitions)
    key = F.struct(*[F.col(k) for k in keys])
    wl = W.partitionBy("_pid", *keys).orderBy(*_order_exprs(order)).rowsBetween(W.unboundedPreceding, -1)
    local = pinned.withColumn("_local", F.max(value).over(wl))
    per_key = pinned.groupBy("_pid", *keys).agg(F.max(value).alias("_m"))
    ends = per_key.groupBy("_pid").agg(F.min_by(F.struct(*keys, "_m"), key).alias("a"), F.max_by(F.struct(*keys, "_m"), key).alias("b"))
    edge = ends.select("_pid", F.explode(F.array_distinct(F.array("a", "b"))).alias("e")).select("_pid", "e.*")
    before = W.partitionBy(*keys).orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    carry = edge.select("_pid", *[F.col(k).alias("_c_" + k) for k in keys], F.max("_m").over(before).alias("_carry"))
    carry = carry.withColumnRenamed("_pid", "_cpid")
    cond = F.col("_pid") == F.col("_cpid")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col("_c_" + k))
    joined = local.join(F.broadcast(carry), cond, "left")
    return joined.select(*[F.col(c) for c in df.columns], F.greatest("_local", "_carry").alias(out))
