"""Star-schema operators: unknown member, foreign-key resolution, allocation, bridge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql import types as T

# A NULL foreign key never matches. In a sort-merge join all NULL keys would still hash to
# one partition (2/3 of the orders have no salesperson), so they get a key far below any
# dimension key instead, spread over this many values.
NULL_SALT_BUCKETS = 1 << 16
NULL_SALT_BASE = -(1 << 62)


def with_unknown_member(df: DataFrame, values: dict) -> DataFrame:
    """Append the one constant 'unknown' row; columns not in ``values`` are NULL.

    Built as a one-row projection of ``spark.range(1)`` cast to the dimension's own
    types, so the union keeps the schema.
    """
    row = df.sparkSession.range(1).select(*[
        (F.lit(values[f.name]) if f.name in values else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in df.schema.fields
    ])
    return df.unionByName(row)


def spread_nulls(fact: DataFrame, key: str, spread_by: str | None = None):
    """``key``, or for NULL keys a salt that matches no dimension key (integral keys only).

    The salt is a hash of one column that differs between rows: ``spread_by``, by default the
    fact's first column (its own id)."""
    by = F.col(f"`{spread_by or fact.columns[0]}`")
    salt = F.lit(NULL_SALT_BASE) - F.pmod(F.xxhash64(by), F.lit(NULL_SALT_BUCKETS))
    return F.coalesce(F.col(key).cast("bigint"), salt)


def resolve_fk(fact: DataFrame, dim: DataFrame, on: dict, sk: str, out: str | None = None,
               unknown=-1, broadcast: bool = False) -> DataFrame:
    """Left join ``fact`` to ``dim`` on ``{fact_col: dim_col}`` and keep ``coalesce(sk, unknown)``.

    No fact row is lost. ``broadcast=True`` only for a dimension whose size has a proven
    bound (e.g. the date spine); otherwise the planner decides from statistics and AQE
    re-plans at run time. The dimension key must be unique (see ``quality.unique``),
    otherwise the join fans the fact out. A single integral key that may be NULL is
    salted (``spread_nulls``) so that NULL keys do not gather in one partition.
    """
    out = out or sk
    tag = f"__{out}"
    right = dim.select(*[F.col(d).alias(f"{tag}_k{i}") for i, d in enumerate(on.values())],
                       F.col(sk).alias(f"{tag}_sk"))
    if broadcast:
        right = F.broadcast(right)
    cond = None
    integral = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    for i, f in enumerate(on.keys()):
        fc = F.col(f) if isinstance(f, str) else f
        if (not broadcast and len(on) == 1 and isinstance(f, str) and fact.schema[f].nullable
                and isinstance(fact.schema[f].dataType, integral)):
            fc = spread_nulls(fact, f)
        c = fc == F.col(f"{tag}_k{i}")
        cond = c if cond is None else cond & c
    j = fact.join(right, cond, "left")
    resolved = F.coalesce(F.col(f"{tag}_sk"), F.lit(unknown).cast(dim.schema[sk].dataType)).alias(out)
    keep = [F.col(f"`{c}`") for c in fact.columns if c != out]
    return j.select(*keep, resolved)      # one projection: add the key, drop the helpers


def resolve_dates(fact: DataFrame, dim_date: DataFrame, roles: dict, date_col: str = "date_actual",
                  sk: str = "sk_date") -> DataFrame:
    """Role-playing date keys: ``{out_sk: fact_date_col}``; one bounded dimension,
    broadcast once and reused by every role."""
    for out, c in roles.items():
        fact = resolve_fk(fact, dim_date, {c: date_col}, sk, out=out, unknown=-1, broadcast=True)
    return fact


def literal_key_join(fact: DataFrame, dim: DataFrame, dim_col: str, value, sk: str, out: str,
                     unknown="-1") -> DataFrame:
    """Left join on a constant (``dim.col = 'USD'``): every fact row gets the same member,
    or the unknown member when the constant is absent.

    The member is looked up once as a scalar subquery (which also fails loudly if the
    constant matches more than one row), so the fact is neither joined nor shuffled:
    a join whose key is a literal would be planned as a nested-loop join.
    """
    member = dim.where(F.col(dim_col) == F.lit(value)).select(F.col(sk)).scalar()
    return fact.withColumn(out, F.coalesce(member, F.lit(unknown).cast(dim.schema[sk].dataType)))


def bridge(pairs: DataFrame, left_key: str, right_key: str, dim: DataFrame, dim_key: str, dim_sk: str,
           sk_name: str, out_sk: str) -> DataFrame:
    """Many-to-many bridge with ``allocation_factor = 1 / (rows of the left key)``.

    The count per left key is a grouped count (map-side partial aggregation) joined back
    on the key, so a left key with very many partners is never gathered in one task.
    """
    from ledgerstar.functions.columns import surrogate_key

    counts = pairs.groupBy(left_key).agg(F.count(F.lit(1)).alias("reason_count"))
    b = pairs.join(counts, left_key, "left")
    b = resolve_fk(b, dim, {right_key: dim_key}, dim_sk, out=out_sk, unknown=-1)
    return b.select(
        surrogate_key(left_key, right_key).alias(sk_name),
        F.col(left_key), F.col(out_sk), F.col("reason_count"),
        (F.lit(1.0) / F.col("reason_count").cast("double")).alias("allocation_factor"),
    )


def weighted_rollup(fact: DataFrame, bridge_df: DataFrame, key: str, by: str, measure: str,
                    factor: str = "allocation_factor", out: str = "weighted") -> DataFrame:
    """``sum(measure * factor)`` through a bridge, grouped by the bridge's other side.

    The fact is first reduced to one row per bridge key (partial aggregation), so the
    join multiplies order totals, not lines.
    """
    per_key = fact.groupBy(key).agg(F.sum(measure).alias("__m"))
    j = bridge_df.join(per_key, key, "inner")
    return j.groupBy(by).agg(F.sum(F.col("__m").cast("double") * F.col(factor)).alias(out))
