"""Rows at given ranks without sorting: distributed selection by refining histograms.

Every sort order is written as one text per row whose byte order is the order asked for: numbers and dates as
their distance from the least (ascending) or greatest (descending) value, in digits of fixed width, then
an ascending text as the last key. A round counts the rows by the next characters of the texts that still start like one
of the ranks looked for, for all orders at once, and keeps for each rank the bin that holds it. A round is one
scan with partial counts; the driver sees at most one row per rank and next characters. Bins of a few rows
are fetched in the end. No row is moved.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STEP = 3    # characters by which a round refines
FEW = 64    # rows of a bin that are fetched instead of refined further


def _as_order(order: list) -> list[tuple[str, bool]]:
    """(column, descending) of ``name`` or ``(name, "desc")`` entries."""
    return [(o, False) if isinstance(o, str) else (o[0], o[1].lower() == "desc") for o in order]


def _number(name: str, kind: T.DataType) -> tuple[Column, int]:
    """The column as an exact decimal, and its scale."""
    c = F.col(name)
    if isinstance(kind, T.DecimalType):
        return c, kind.scale
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("decimal(20,0)"), 0
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("decimal(20,0)"), 0
    if isinstance(kind, T.IntegralType):
        return c.cast("decimal(20,0)"), 0
    raise ValueError(f"{name}: no exact order for {kind.simpleString()}")


def _digits(c: Column, scale: int, low: Decimal, high: Decimal, desc: bool) -> Column:
    """Distance from the first value of the order, in digits of fixed width."""
    whole = max(len(str(int(abs(low)))), len(str(int(abs(high)))))
    if whole + scale > 37:
        raise ValueError("values need more than 37 digits")
    kind, width = f"decimal({whole + scale},{scale})", len(str(int(high - low)))
    v = c.cast(kind)
    off = F.lit(high).cast(kind) - v if desc else v - F.lit(low).cast(kind)
    return F.to_char(off.cast(f"decimal({width + scale},{scale})"), F.lit("0" * width + ("D" + "0" * scale if scale else "")))


def order_keys(df: DataFrame, orders: dict[str, list]) -> tuple[int, dict[str, Column]]:
    """The number of rows, and for each named order the text whose byte order it is. One aggregate.

    NULLs stand first in an ascending and last in a descending key, as Spark sorts them. Only the last key may be
    a text, and only ascending; floating-point keys raise ``ValueError``.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    numbers = {}
    for order in orders.values():
        for k, (name, desc) in enumerate(_as_order(order)):
            if not isinstance(kinds[name], T.StringType):
                numbers[name] = _number(name, kinds[name])
            elif desc or k + 1 < len(order):
                raise ValueError(f"{name}: a text can only be the last, ascending key")
    names = list(numbers)
    got = df.agg(F.count(F.lit(1)), *[f(numbers[n][0]) for n in names for f in (F.min, F.max)]).first()
    bounds = {n: (got[1 + 2 * i], got[2 + 2 * i]) for i, n in enumerate(names)}
    keys = {}
    for key, order in orders.items():
        parts = []
        for name, desc in _as_order(order):
            if name in numbers:
                low, high = bounds[name]
                text = F.lit("") if low is None else _digits(*numbers[name], low, high, desc)
            else:
                text = F.col(name)
            null, value = ("1", "0") if desc else ("0", "1")
            parts.append(F.when(F.col(name).isNull(), null).otherwise(F.concat(F.lit(value), text)))
        keys[key] = F.concat(*parts)
    return got[0], keys


def select_keys(df: DataFrame, keys: dict[str, Column], ranks: dict[str, list[int]], slack: int = 0) -> dict[str, list[str]]:
    """For each key the texts at the given ranks (from 1, none beyond the number of rows).

    With ``slack``, a text that has at most that many rows between itself and the rank is enough; it then
    need not be the text of a row.
    """
    names = list(keys)
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("k"), keys[n].alias("key")) for i, n in enumerate(names)])).alias("p")).select("p.*")
    open_ = [[i, rank, "", None] for i, n in enumerate(names) for rank in ranks[n]]  # key, rank inside the prefix, prefix, text
    every, few, length = list(open_), [], 0
    while open_:
        known = F.lit(False)
        for i in {t[0] for t in open_}:
            known = known | ((F.col("k") == i) & F.substring("key", 1, length).isin(sorted({t[2] for t in open_ if t[0] == i})) if length else (F.col("k") == i))
        bins: dict[tuple[int, str], list[tuple[str, int]]] = {}
        for r in pairs.where(known).groupBy("k", F.substring("key", 1, length + STEP).alias("bin")).agg(F.count(F.lit(1)).alias("n")).collect():
            bins.setdefault((r["k"], r["bin"][:length]), []).append((r["bin"], r["n"]))
        for found in bins.values():
            found.sort(key=lambda x: x[0].encode())
        for t in open_:
            for text, n in bins[(t[0], t[2])]:
                if t[1] <= n:
                    break
                t[1] -= n
            t[2] = text
            if len(text) < length + STEP or n <= slack:
                t[3] = text
            elif n <= FEW:
                few.append(t)
        length += STEP
        open_ = [t for t in open_ if t[3] is None and not any(t is f for f in few)]
    if few:
        near = F.lit(False)
        for i, prefix in {(t[0], t[2]) for t in few}:
            near = near | ((F.col("k") == i) & F.col("key").startswith(prefix))
        held = pairs.where(near).collect()
        for t in few:
            t[3] = sorted((r["key"] for r in held if r["k"] == t[0] and r["key"].startswith(t[2])), key=str.encode)[t[1] - 1]
    return {n: [t[3] for t in every if t[0] == i] for i, n in enumerate(names)}


def ntile_starts(n: int, k: int) -> list[int]:
    """The first rank of the tiles 2 .. k that have rows (the first ``n mod k`` tiles hold one row more)."""
    q, m = divmod(n, k)
    return [r for j in range(1, k) if (r := j * q + min(j, m) + 1) <= n]


def ntiles(df: DataFrame, tiles: dict[str, tuple[list, int]]) -> DataFrame:
    """``df`` with ``ntile(k) over (order by ...)`` columns, ``{name: (order, k)}``; the orders must be strict.

    ``df`` is scanned once per round of the selection, so pass a written table. The result is a projection of it.
    """
    n, keys = order_keys(df, {name: order for name, (order, _) in tiles.items()})
    starts = select_keys(df, keys, {name: ntile_starts(n, k) for name, (_, k) in tiles.items()})
    out = {}
    for name in tiles:
        tile = F.lit(1)
        for text in dict.fromkeys(starts[name]):
            tile = tile + (keys[name] >= F.lit(text)).cast("int")
        out[name] = tile.cast("bigint")
    return df.select("*", *[c.alias(name) for name, c in out.items()])


def buckets(df: DataFrame, order: list, count: int) -> Column:
    """The number (from 0) of each row's bucket of ``df``: ``count`` runs of the order of nearly equal size.

    Equal values are split by the keys that follow them. Written as a search tree over the bounds.
    """
    n, keys = order_keys(df, {"b": order})
    ranks = sorted({r for j in range(1, count) if 1 < (r := j * n // count + 1) <= n})
    bounds = sorted(set(select_keys(df, keys, {"b": ranks}, slack=max(1, n // (4 * count)))["b"]), key=str.encode)

    def tree(low: int, high: int) -> Column:
        """Bucket of a row known to be in ``low`` .. ``high``."""
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(keys["b"] < F.lit(bounds[mid]), tree(low, mid)).otherwise(tree(mid + 1, high))

    return tree(0, len(bounds))
