"""Slowly changing dimensions, type 2, without MERGE.

A snapshot table holds the source columns plus ``version_from`` (timestamp of the run
that captured the version) and ``version_to`` (NULL while the version is open).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstar.functions.columns import BEGIN_OF_TIME, OPEN_END_DATE

VERSION_FROM = "version_from"
VERSION_TO = "version_to"


def scd2_changes(open_: DataFrame | None, source: DataFrame, keys: list[str], check_cols: list[str], run_ts) -> DataFrame:
    """What a run makes of the open versions: the source's columns, ``version_from``, ``version_to`` and ``state``
    (``closed``: an open version that ends now; ``open``: one that begins now; ``same``: one that stays open).

    One null-safe full outer join of the open versions with the source on the key (a single shuffle of both); each
    joined row emits its one or two output rows through one ``explode``, so the join is computed once.
    """
    ts = run_ts.cast("timestamp_ntz") if hasattr(run_ts, "_jc") else F.lit(run_ts).cast("timestamp_ntz")
    cols = source.columns
    never = F.lit(None).cast("timestamp_ntz")
    if open_ is None:
        return source.select(*cols, ts.alias(VERSION_FROM), never.alias(VERSION_TO), F.lit("open").alias("state"))
    o = open_.select(*[F.col(c).alias("o__" + c) for c in [*cols, VERSION_FROM]], F.lit(True).alias("has_o"))
    s = source.select(*[F.col(c).alias("s__" + c) for c in cols], F.lit(True).alias("has_s"))
    same_key = F.lit(True)
    for k in keys:
        same_key = same_key & F.col("o__" + k).eqNullSafe(F.col("s__" + k))
    j = o.join(s, same_key, "full_outer")
    has_o, has_s = F.coalesce("has_o", F.lit(False)), F.coalesce("has_s", F.lit(False))
    differs = F.lit(False)
    for c in check_cols:
        differs = differs | ~F.col("o__" + c).eqNullSafe(F.col("s__" + c))
    changed = has_o & has_s & differs
    old = F.struct(*[F.col("o__" + c).alias(c) for c in [*cols, VERSION_FROM]], F.when(changed, ts).alias(VERSION_TO),
                   F.when(changed, "closed").otherwise("same").alias("state"))
    new = F.struct(*[F.col("s__" + c).alias(c) for c in cols], ts.alias(VERSION_FROM), never.alias(VERSION_TO), F.lit("open").alias("state"))
    emitted = F.array(F.when(has_o, old), F.when(has_s & (~has_o | changed), new))
    return j.select(F.explode(emitted).alias("v")).where(F.col("v").isNotNull()).select("v.*")


def scd2_apply(current: DataFrame | None, source: DataFrame, key: str | list[str],
               check_cols: list[str], run_ts) -> DataFrame:
    """One snapshot run with the 'check' strategy, as a whole table (``history`` stores one that is appended to).

    * first run (``current`` is None): every source row opens a version at ``run_ts``;
    * a key whose open version differs from the source in any check column (NULL-safe)
      gets that version closed at ``run_ts`` and a new open version;
    * new keys open a version; keys missing from the source stay open; NULL is a key like any other;
    * closed history passes through untouched, and a re-run with unchanged input
      changes nothing.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if current is None:
        return scd2_changes(None, source, keys, check_cols, run_ts).drop("state")
    closed = current.where(F.col(VERSION_TO).isNotNull()).select(*source.columns, VERSION_FROM, VERSION_TO)
    return closed.unionByName(scd2_changes(current.where(F.col(VERSION_TO).isNull()), source, keys, check_cols, run_ts).drop("state"))


def expose_versions(snapshot: DataFrame, key: str, version_from: str = VERSION_FROM,
                    version_to: str = VERSION_TO) -> DataFrame:
    """Add ``valid_from`` (first version backdated to 1900-01-01), ``valid_to`` (open end
    9999-12-31) and ``is_current``.

    The first version per key comes from a grouped ``min`` (partial aggregation before
    the shuffle, so a key with many versions is not gathered in one task) joined back
    on the key.
    """
    first = snapshot.groupBy(F.col(key).alias("__key")).agg(F.min(version_from).alias("__first_from"))
    v = snapshot.join(first, F.col(key).eqNullSafe(F.col("__key")), "left").drop("__key")
    return (v.withColumn("valid_from", F.when(F.col(version_from) == F.col("__first_from"),
                                              F.lit(BEGIN_OF_TIME).cast("timestamp_ntz"))
                         .otherwise(F.col(version_from)))
             .withColumn("valid_to", F.coalesce(F.col(version_to),
                                                F.lit(OPEN_END_DATE).cast("timestamp_ntz")))
             .withColumn("is_current", F.col(version_to).isNull())
             .drop("__first_from"))
