"""Sharding along a Hilbert curve: rows that are close in several metadata columns share a shard.

Each column is quantised to a few bits, the cell's place on the Hilbert curve is its sort key, and the
sorted rows are cut into runs of equal counts (law ``rows``: counts differ by one at most). A reader
that filters on any of the columns skips the shards whose bins lie outside (``manifest``).

Everything is DataFrame expressions. There is no global sort: the curve has a fixed number of cells,
so places are counts of the cells before, plus the place inside the cell. A crowded cell is dealt out to
runs of about ``RUN_ROWS`` rows by a hash of the row, so no task gets a whole cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerstar.llm.common import cut, ident, pack, repeats

BITS = 5          # per dimension
RUN_ROWS = 256
REPEATS = 8      # rows equal in key that a run gets together


# ---- the curve ----------------------------------------------------------------------------------

def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """(digit, next state) for every state and every corner of a ``dims``-dimensional cube.

    A state is an entry corner and a direction. In Gray code order, digit w visits corner gray(w); the
    sub-cube's own entry and direction follow from w (entry: gray of the even number below w; direction:
    the trailing ones), turned by the present state.
    """
    size = 1 << dims

    def turn(x: int, by: int) -> int:
        by %= dims
        return ((x << by) | (x >> (dims - by))) & (size - 1)

    def gray(i: int) -> int:
        return i ^ (i >> 1)

    place = {gray(i): i for i in range(size)}

    def entry(w: int) -> int:
        return 0 if w == 0 else gray(2 * ((w - 1) // 2))

    def ones(i: int) -> int:
        n = 0
        while i & 1:
            n, i = n + 1, i >> 1
        return n

    def direction(w: int) -> int:
        return 0 if w == 0 else ones(w - 1) % dims if w % 2 == 0 else ones(w) % dims

    digit, after = [], []
    for state in range(size * dims):
        e, d = divmod(state, dims)
        for corner in range(size):
            w = place[turn(corner ^ e, -(d + 1))]
            digit.append(w)
            after.append((e ^ turn(entry(w), d + 1)) * dims + (d + direction(w) + 1) % dims)
    return digit, after


def curve_index(bins: list[Column], bits: int = BITS) -> Column:
    """Place on the curve of the cell with these bins (0 to 2 ** bits - 1 each)."""
    dims = len(bins)
    digit, after = (F.array(*[F.lit(x) for x in t]) for t in curve_tables(dims))

    def step(acc: Column, level: Column) -> Column:
        corner = sum((F.floor(b / F.pow(F.lit(2.0), level)).cast("int") % 2) * (1 << k) for k, b in enumerate(bins))
        at = acc["state"] * (1 << dims) + corner
        return F.struct(F.get(after, at).alias("state"), (acc["place"] * (1 << dims) + F.get(digit, at)).alias("place"))

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("place"))
    return F.aggregate(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), start, step, lambda a: a["place"])


def category_bin(c: Column, bits: int = BITS) -> Column:
    """Bin of a text value: equal values share one; NULL has bin 0."""
    return F.when(c.isNull(), 0).otherwise(F.pmod(F.xxhash64(c.cast("string")), F.lit((1 << bits) - 1)).cast("int") + 1)


def size_bin(c: Column, bits: int = BITS, octaves: int = 32) -> Column:
    """Bin of a non-negative number on a logarithmic scale; NULL and below 1: bin 0."""
    top = (1 << bits) - 1
    x = F.floor(F.log2(F.greatest(c.cast("double"), F.lit(1.0))) * (1 << bits) / octaves)
    return F.coalesce(F.least(x, F.lit(top)).cast("int"), F.lit(0))


# ---- shards -------------------------------------------------------------------------------------

def run_of(runs: Column) -> Column:
    """The run of a row in a cell of ``runs`` runs, by its key; rows that repeat a key are dealt on in small packs."""
    return F.pmod(F.xxhash64("key", F.floor(F.col("repeat") / REPEATS)), runs).cast("int")


def assign(df: DataFrame, bins: dict[str, Column], key: list[Column], shards: int, carry: Column, bits: int = BITS) -> DataFrame:
    """(row, bins, place, rank, shard, slot) for every row.

    ``bins``: the quantised columns; ``key``: columns that order rows of one cell (ties beyond them, that
    is repeated rows, take neighbouring slots in any order). ``rank`` counts from 0 along the curve,
    shard = floor(rank * shards / rows), slot counts from 0 inside the shard. Fewer rows than shards leave
    shards empty; an empty table gives an empty result.
    """
    if len(bins) * bits > 18:
        raise ValueError("the table of cells is sent to all executors: at most 2 ** 18 cells")
    src = df.select(carry.alias("row"), F.struct(*key).alias("order"), F.xxhash64(*key).alias("key"), F.struct(*[b.alias(n) for n, b in bins.items()]).alias("bins"))
    src = repeats(src.withColumn("place", curve_index([F.col("bins")[n] for n in bins], bits)), "hilbert-places")
    rows = cut(src, "hilbert-rows")

    cells = rows.groupBy("place").agg(F.count("*").alias("n"))
    # the number of cells is fixed by bits and dimensions, whatever the input
    cells = cut(cells.select("place", "n", F.ceil(F.col("n") / RUN_ROWS).cast("int").alias("runs"),
                             (F.sum("n").over(W.orderBy("place")) - F.col("n")).alias("base"),
                             F.sum("n").over(W.partitionBy(F.lit(0))).alias("total")), "hilbert-cells")
    placed = rows.join(F.broadcast(cells), "place").withColumn("run", run_of(F.col("runs")))
    runs = placed.groupBy("place", "run").agg(F.count("*").alias("m"))
    before = runs.withColumn("before", F.sum("m").over(W.partitionBy("place").orderBy("run")) - F.col("m")).drop("m")
    inside = F.row_number().over(W.partitionBy("place", "run").orderBy("order", "repeat")) - 1
    ranked = (placed.withColumn("inside", inside).join(before, ["place", "run"])
              .withColumn("rank", F.col("base") + F.col("before") + F.col("inside")))
    shard = F.expr(f"(rank * {int(shards)}) div total")
    first = F.expr(f"(shard * total + {int(shards) - 1}) div {int(shards)}")
    return (ranked.withColumn("shard", shard).withColumn("slot", F.col("rank") - first)
            .select("row", "bins", "place", "rank", F.col("shard").cast("int").alias("shard"), "slot"))


def manifest(assigned: DataFrame) -> DataFrame:
    """One row per shard: rows, and the least and greatest bin of every dimension, for pruning."""
    names = assigned.schema["bins"].dataType.names
    aggs = [f(F.col("bins")[n]).alias(f"{n}_{w}") for n in names for w, f in (("min", F.min), ("max", F.max))]
    return assigned.groupBy("shard").agg(F.count("*").alias("n_rows"), *aggs)


def write_shards(assigned: DataFrame, path: str) -> None:
    """Write the carried rows, one folder per shard, files in slot order; bins are stored for pushed-down
    filters. Ranges of (shard, slot) are written by as many tasks as there are shuffle partitions, so a
    shard is several files when it is large."""
    (assigned.select("row", "bins", "shard", "slot").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def shard_documents(df: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
                    category_cols: tuple[str, ...] = ("source", "lang"), carry_rows: bool = False) -> DataFrame:
    """Documents in ``shards`` shards by source, language and text size.

    Returns doc_id, size (UTF-8 bytes of the text, NULL: none, plus 8), text_crc32 (NULL: that of no bytes,
    0), law (``rows``), shard, slot, grown_shard (NULL: another shard count moves rows between all shards),
    place. ``carry_rows`` returns the assignment of whole rows instead, for ``manifest`` and ``write_shards``.
    """
    text = ident(text_col).cast("string")
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8
    crc = F.coalesce(F.crc32(text), F.lit(0)).cast("long")
    bins = {c: category_bin(ident(c)) for c in category_cols} | {"size": size_bin(size)}
    key = [ident(id_col).cast("long").alias("id"), crc.alias("crc"), size.alias("size")]
    out = assign(df, bins, key, shards, pack(df) if carry_rows else F.struct(*key))
    if carry_rows:
        return out
    return out.select(F.col("row.id").alias(id_col), F.col("row.size").alias("size"), F.col("row.crc").alias("text_crc32"),
                      F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "place")
