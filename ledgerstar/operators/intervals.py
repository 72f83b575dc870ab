"""Validity intervals and point-in-time (as-of) joins.

Long histories are swept instead of joined: see :mod:`ledgerstar.operators.sweep`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerstar.functions.columns import BEGIN_OF_TIME, OPEN_END_DATE


def closed_intervals(history: DataFrame, current: DataFrame, key: str, value: str,
                     start: str = "start_date", end: str = "end_date",
                     flag: str = "is_fallback", current_value: str | None = None) -> DataFrame:
    """Interval table ``(key, value, valid_from, valid_to, flag)`` ready for an as-of join.

    * history rows keep their start; an open end (NULL) becomes 9999-12-31; flag false.
    * keys of ``current`` with no history at all get one synthetic row covering
      1900-01-01 .. 9999-12-31 with the current value; flag true.

    The anti join shuffles both sides on ``key`` once; no row is dropped. Of the history it takes each key once, and
    never as a broadcast: a history derived by ``explode`` has the size estimate of what it was derived from.
    """
    hist = history.select(
        F.col(key),
        F.col(value),
        F.col(start).cast("date").alias("valid_from"),
        F.coalesce(F.col(end).cast("date"), F.lit(OPEN_END_DATE).cast("date")).alias("valid_to"),
        F.lit(False).alias(flag),
    )
    cur_value = current_value or value
    fallback = (
        current.join(history.select(key).distinct().hint("merge"), on=key, how="left_anti")
        .select(
            F.col(key),
            F.col(cur_value).alias(value),
            F.lit(BEGIN_OF_TIME).cast("date").alias("valid_from"),
            F.lit(OPEN_END_DATE).cast("date").alias("valid_to"),
            F.lit(True).alias(flag),
        )
    )
    return hist.unionByName(fallback)


def in_interval(d: Column, lo: Column, hi: Column, closed: str = "left") -> Column:
    """``lo <= d < hi`` (closed='left', the default) or ``lo <= d <= hi`` (closed='both')."""
    if closed == "left":
        return (d >= lo) & (d < hi)
    if closed == "both":
        return (d >= lo) & (d <= hi)
    raise ValueError(f"closed must be 'left' or 'both', not {closed!r}")


def asof_join(fact: DataFrame, intervals: DataFrame, fact_key: str, fact_date: str,
              iv_key: str | None = None, valid_from: str = "valid_from", valid_to: str = "valid_to",
              select: list[str] | dict[str, str] | None = None, closed: str = "left",
              how: str = "left", broadcast: bool = False) -> DataFrame:
    """Point-in-time join: equality on the key plus ``valid_from <= date < valid_to``.

    Plans as an equi-join on the key with the range as a residual predicate, so the
    work per fact row is the handful of versions of its key (no binning, no
    Cartesian product). ``select`` names the interval columns to bring (a dict
    renames them). A left join keeps every fact row.
    """
    iv_key = iv_key or fact_key
    if select is None:
        select = [c for c in intervals.columns if c not in (iv_key, valid_from, valid_to)]
    renames = select if isinstance(select, dict) else {c: c for c in select}
    right = intervals.select(
        F.col(iv_key).alias("__iv_key"),
        F.col(valid_from).alias("__iv_from"),
        F.col(valid_to).alias("__iv_to"),
        *[F.col(src).alias(dst) for src, dst in renames.items()],
    )
    if broadcast:
        right = F.broadcast(right)
    cond = (F.col(fact_key) == F.col("__iv_key")) & in_interval(
        F.col(fact_date), F.col("__iv_from"), F.col("__iv_to"), closed)
    return fact.join(right, cond, how).drop("__iv_key", "__iv_from", "__iv_to")

