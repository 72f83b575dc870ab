"""Data-quality gates. Every check returns the offending rows; empty means pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstar.functions.columns import off_by_more_than
from ledgerstar.session import written


def not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """One pass over the table: ``(column, null_rows)`` for every column with NULLs.

    All columns are counted by a single aggregate (partial per partition), then the
    one-row result is unpivoted with ``stack``.
    """
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return (counts.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, null_rows)")
            .where(F.col("null_rows") > 0))


def declared_checks(df: DataFrame, not_null_cols: list[str], unique_cols: list[str], accepted: dict[str, list] | None = None) -> DataFrame:
    """All column checks declared for one table: ``(check_name, column_name, failures)``, a row per check.

    NULLs and values outside a list are counted by one aggregate over the table. All uniqueness
    checks share one grouped count of (check, hash of the value as text), so the table is exchanged once for them, in 64
    bits a value. Equal values have equal hashes: only values with a repeated hash are then counted themselves.
    """
    accepted = accepted or {}
    one = [("not_null", c, F.count_if(F.col(c).isNull())) for c in not_null_cols]
    one += [("accepted_values", c, F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(v))) for c, v in accepted.items()]
    out = None
    if one:
        counts = df.agg(*[e.alias(f"c{i}") for i, (_, _, e) in enumerate(one)])
        stack = ", ".join(f"'{n}', '{c}', c{i}" for i, (n, c, _) in enumerate(one))
        out = counts.selectExpr(f"stack({len(one)}, {stack}) as (check_name, column_name, failures)")
    if unique_cols:
        values = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(unique_cols)])
        each = df.select(F.explode(values).alias("p")).select("p.*").where("v is not null").withColumn("h", F.xxhash64("i", "v"))
        again = written(each.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"), "repeated-hashes")
        times = each.join(again, "h", "left_semi").groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
        counts = times.agg(*[F.count_if((F.col("i") == i) & (F.col("n") > 1)).alias(f"u{i}") for i in range(len(unique_cols))])
        stack = ", ".join(f"'unique', '{c}', u{i}" for i, c in enumerate(unique_cols))
        twice = counts.selectExpr(f"stack({len(unique_cols)}, {stack}) as (check_name, column_name, failures)")
        out = twice if out is None else out.unionByName(twice)
    return out


def declared_checks_once(df: DataFrame, not_null_cols: list[str], unique_cols: list[str]) -> DataFrame:
    """As :func:`declared_checks`, for a table whose scan costs more than an exchange of its values (landed text): the
    table is read once. One grouped count holds the values of the unique columns and, as number -1, which
    columns of a row are NULL (``1`` at the column's place); rows without NULLs add nothing to the latter."""
    flags = [F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in not_null_cols]
    lost = F.concat(F.lit(""), *flags)
    entries = [F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(unique_cols)]
    entries.append(F.struct(F.lit(-1).alias("i"), F.when(lost.contains("1"), lost).alias("v")))
    times = df.select(F.explode(F.array(*entries)).alias("p")).select("p.*").where("v is not null").groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    counts = times.agg(*[F.coalesce(F.sum(F.when((F.col("i") == -1) & (F.substring("v", j + 1, 1) == "1"), F.col("n"))), F.lit(0)).alias(f"c{j}") for j in range(len(not_null_cols))],
                       *[F.count_if((F.col("i") == i) & (F.col("n") > 1)).alias(f"u{i}") for i in range(len(unique_cols))])
    rows = [f"'not_null', '{c}', c{j}" for j, c in enumerate(not_null_cols)] + [f"'unique', '{c}', u{i}" for i, c in enumerate(unique_cols)]
    return counts.selectExpr(f"stack({len(rows)}, {', '.join(rows)}) as (check_name, column_name, failures)")


def declared_relationships(df: DataFrame, links: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Orphaned values per foreign key: ``(check_name, column_name, failures)``; ``links`` maps the
    key column to (dimension, its key). Keys are reduced to their distinct values before the
    anti join, so a hot key costs one row."""
    out = None
    for fk, (dim, pk) in links.items():
        values = df.where(F.col(fk).isNotNull()).select(F.col(fk).alias("k")).distinct()
        lost = values.join(dim.select(F.col(pk).alias("k")), "k", "left_anti").agg(F.count(F.lit(1)).alias("failures"))
        row = lost.select(F.lit("relationships").alias("check_name"), F.lit(fk).alias("column_name"), "failures")
        out = row if out is None else out.unionByName(row)
    return out


def unique(df: DataFrame, keys: list[str] | str) -> DataFrame:
    """Key values that occur more than once (NULL keys ignored)."""
    keys = [keys] if isinstance(keys, str) else keys
    nn = df
    for k in keys:
        nn = nn.where(F.col(k).isNotNull())
    return nn.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def relationships(df: DataFrame, fk: str, dim: DataFrame, pk: str) -> DataFrame:
    """Non-NULL foreign keys with no parent row, with their row count."""
    orphans = df.where(F.col(fk).isNotNull()).join(
        dim.select(F.col(pk).alias(fk)), fk, "left_anti")
    return orphans.groupBy(fk).agg(F.count(F.lit(1)).alias("n_rows"))


def accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """Distinct values outside the accepted list (NULL is not checked, as not_null does)."""
    return (df.where(F.col(col).isNotNull() & ~F.col(col).isin(values))
              .groupBy(col).agg(F.count(F.lit(1)).alias("n_rows")))


def allocation_gap(lines: DataFrame, header: DataFrame, order_key: str, allocated: str,
                   header_amount: str, net: str, eps: float = 0.01) -> DataFrame:
    """Orders with net > 0 whose allocated amounts do not add up to the header amount."""
    per_order = lines.groupBy(order_key).agg(F.sum(allocated).alias("allocated_total"),
                                             F.sum(net).alias("order_net"))
    j = header.select(order_key, header_amount).join(per_order, order_key, "inner")
    return (j.where((F.col("order_net") > 0) & off_by_more_than(header_amount, "allocated_total", eps))
             .select(order_key, header_amount, "allocated_total",
                     F.round(F.col(header_amount).cast("double") - F.col("allocated_total"), 2).alias("variance")))


def net_gap(lines: DataFrame, header: DataFrame, order_key: str, net: str, subtotal: str,
            eps: float = 0.01) -> DataFrame:
    """Orders whose line nets do not add up to the header subtotal (to the cent)."""
    per_order = lines.groupBy(order_key).agg(F.sum(net).alias("lines_net"))
    j = header.select(order_key, subtotal).join(per_order, order_key, "inner")
    return (j.where(off_by_more_than(subtotal, "lines_net", eps))
             .select(order_key, subtotal, "lines_net",
                     F.round(F.col(subtotal) - F.col("lines_net"), 2).alias("variance")))


def pit_has_effect(fact: DataFrame, dim_product: DataFrame, eps: float = 0.001) -> DataFrame:
    """Returns one row (failure) when no non-fallback line is costed differently from the
    product's current standard cost, i.e. when the point-in-time join did nothing."""
    cmp_ = fact.where(~F.col("is_fallback_cost")).join(
        dim_product.select("sk_product", F.col("standard_cost").alias("current_cost")), "sk_product", "inner")
    n = cmp_.agg(F.count_if(F.abs(F.col("unit_standard_cost") - F.col("current_cost")) > eps)
                 .alias("differing_rows"))
    return n.where(F.col("differing_rows") == 0)


def same_count(fact: DataFrame, source: DataFrame) -> DataFrame:
    """One row when the fact and the source row counts differ."""
    a = fact.agg(F.count(F.lit(1)).alias("fact_rows"))
    b = source.agg(F.count(F.lit(1)).alias("source_rows"))
    # Both sides are one-row aggregates: joining them on a literal key is a 1x1 join.
    return a.withColumn("__k", F.lit(1)).join(b.withColumn("__k", F.lit(1)), "__k") \
        .drop("__k").where(F.col("fact_rows") != F.col("source_rows"))


def same_total(fact: DataFrame, fact_expr, source: DataFrame, source_expr, eps: float = 0.01) -> DataFrame:
    """One row when the two totals differ by more than ``eps``."""
    a = fact.agg(F.sum(fact_expr).alias("fact_revenue")).withColumn("__k", F.lit(1))
    b = source.agg(F.sum(source_expr).alias("source_revenue")).withColumn("__k", F.lit(1))
    j = a.join(b, "__k").drop("__k")
    return j.where(off_by_more_than("fact_revenue", "source_revenue", eps)).withColumn(
        "variance", F.round(F.col("fact_revenue") - F.col("source_revenue"), 2))


def no_overlap(dim: DataFrame, key: str, version_id: str, unknown=-1) -> DataFrame:
    """Versions that start before some earlier version of their key ends.

    Versions are taken in start order (then by id); a version overlaps an earlier one exactly
    when it starts before the greatest end so far, so the running maximum names every such
    version, also one nested inside a long one, without forming pairs. ``covered_until`` is
    that greatest end. The running maximum is the scalable two-phase form.
    """
    from ledgerstar.operators.windows import keyed_running_max

    d = dim.where(F.col(key) != F.lit(unknown)).select(key, version_id, "valid_from", "valid_to")
    run = keyed_running_max(d, [key], ["valid_from", version_id], "valid_to", out="covered_until")
    return run.where(F.col("valid_from") < F.col("covered_until")).select(key, version_id, "covered_until")


def one_current(dim: DataFrame, key: str, unknown=-1) -> DataFrame:
    """Keys with zero or several current versions."""
    return (dim.where(F.col(key) != F.lit(unknown)).groupBy(key)
               .agg(F.count_if(F.col("is_current")).alias("n_current"))
               .where(F.col("n_current") != 1))


def grain(fact: DataFrame, keys: list[str]) -> DataFrame:
    """Grain policy of a fact: its declared key is unique."""
    return unique(fact, keys)


def union_labelled(parts: dict) -> DataFrame:
    """``union all`` of same-shaped results, each tagged with its label."""
    out = None
    for label, df in parts.items():
        d = df.select(F.lit(label).alias("label"), *df.columns)
        out = d if out is None else out.unionByName(d)
    return out
