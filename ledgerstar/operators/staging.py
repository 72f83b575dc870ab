"""Silver staging: declarative column specs and defensive de-duplication."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstar.functions.columns import clean_text, to_int_rounded


@dataclass(frozen=True)
class Col:
    """One silver column: raw source name, silver name, kind.

    kinds: ``i`` int (rounded), ``bi`` bigint, ``v`` text as is, ``t`` trimmed text or
    NULL, ``d`` date, ``ts`` timestamp, ``dec(p,s)`` decimal.
    """

    raw: str
    name: str
    kind: str


def _rounded(src):
    """:func:`to_int_rounded`; the plain text of an int is taken as it is, without a detour by decimals."""
    text = src.cast("string")
    plain = text.try_cast("int")
    return F.when(plain.cast("string") == text, plain).otherwise(to_int_rounded(src))


def typed_column(c: Col):
    src = F.col(f"`{c.raw}`")
    k = c.kind
    if k == "i":
        return _rounded(src).alias(c.name)
    if k == "bi":
        return src.cast("bigint").alias(c.name)
    if k == "v":
        return src.cast("string").alias(c.name)
    if k == "t":
        return clean_text(src.cast("string")).alias(c.name)
    if k == "d":
        return src.cast("date").alias(c.name)
    if k == "ts":
        return src.cast("timestamp_ntz").alias(c.name)
    if k == "b":
        return src.cast("boolean").alias(c.name)
    if k.startswith("dec"):
        return src.cast(k.replace("dec", "decimal")).alias(c.name)
    raise ValueError(f"unknown column kind {k!r}")


def apply_spec(df: DataFrame, spec: list[Col]) -> DataFrame:
    """Rename to snake_case and type every column in one projection; a value that does
    not convert fails the job (ANSI casts), as the load must."""
    return df.select(*[typed_column(c) for c in spec])


def latest_per_key(df: DataFrame, keys: list[str] | str, ts: str, tie: list[str] | None = None) -> DataFrame:
    """Keep one row per key: the latest ``ts``, ties broken by the largest ``tie`` values,
    then by the remaining columns (so the result is deterministic).

    Same result as ``row_number() over (partition by keys order by ts desc, tie desc) = 1``
    but computed as a grouped ``max`` of a struct: partial aggregation runs before the
    shuffle, so a key loaded many times is reduced on the map side instead of being
    gathered in one task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    tie = tie or []
    rest = [c for c in df.columns if c not in keys and c != ts and c not in tie]
    order = [ts, *tie, *rest]
    best = df.groupBy(*keys).agg(F.max(F.struct(*[F.col(c) for c in order])).alias("__best"))
    return best.select(*keys, *[F.col("__best")[c].alias(c) for c in order]).select(*df.columns)
