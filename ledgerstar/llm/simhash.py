"""SimHash near-duplicates: pigeonhole blocks, a join on blocks, then the Hamming distance.

A fingerprint has 64 bits; two documents are linked when at most 3 of them differ. The bits are cut
into 6 blocks. Three differing bits spoil at most three blocks, so a linked pair agrees on some
three of the six: 20 keys of 30 to 33 bits per *distinct* fingerprint find every pair, and unrelated
fingerprints hardly ever share such a key (with 4 blocks of 16 bits the chance matches would grow
with the square of the table).

Copies are folded before anything is paired. A key shared by two fingerprints is one comparison; a
key shared by more is dealt out in tiles of bounded size, and a tile pair returns links that connect
the same fingerprints as all its pairs would, at most one per fingerprint, so a crowded key gives
rows in proportion to its fingerprints. No link is lost: every pair of fingerprints of a key meets in
exactly one tile pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerstar.llm.common import arrow_map, arrow_schema, ascii_ws_words, cut, ident, ident_in, pack
from ledgerstar.llm.graph import components

SEED = 42
BLOCKS = 6          # widths 11, 11, 11, 11, 10, 10
TILE = 1024         # fingerprints in one side of a comparison
_CHUNK = 1 << 16    # shingles whose bits are counted at once


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of a whole text as a signed integer; no words: 0.

    A-Z become lower case; shingles of ``shingle`` words, repeats counted, joined by one space
    (fewer words: the whole sequence). A bit is 1 when it is set in more than half the XXH64 hashes.
    """
    import xxhash

    words = [w.lower() for w in ascii_ws_words(text)]  # bytes.lower() changes A-Z only
    if not words:
        return 0
    xxh = xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _CHUNK):
        h = [xxh(b" ".join(words[i:i + shingle]), SEED) for i in range(at, min(n, at + _CHUNK))]
        octets = np.array(h, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def with_fingerprints(df: DataFrame, carry: Column, text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(row, fp): ``carry`` of every row and the fingerprint of its text."""
    src = df.select(carry.alias("row"), ident(text_col).cast("string").alias("t"))
    out = T.StructType([src.schema["row"], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(out)
        for b in batches:
            seen: dict[str | None, int] = {}
            fps = []
            for t in b.column(1).to_pylist():
                if t not in seen:
                    seen[t] = fingerprint(t, shingle)
                fps.append(seen[t])
            yield pa.RecordBatch.from_arrays([b.column(0).cast(schema.field(0).type), pa.array(fps, pa.int64())], schema=schema)

    return arrow_map(src, run, out)


def _block_masks() -> list[int]:
    widths, at, masks = [11, 11, 11, 11, 10, 10], 0, []
    for w in widths:
        masks.append(((1 << w) - 1) << at)
        at += w
    return masks


def _keys(fp: Column) -> Column:
    """The 20 block keys: which three blocks, and the bits in them."""
    masks = _block_masks()
    triples = [a | b | c for a, b, c in combinations(masks, 3)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in triples]
    return F.explode(F.array(*[F.struct(F.lit(i).cast("tinyint").alias("which"), fp.bitwiseAND(F.lit(m)).alias("bits"))
                               for i, m in enumerate(signed)]))


def spanning_links(a: np.ndarray, b: np.ndarray | None, distance: int) -> list[tuple[int, int]]:
    """Links (small, root) that connect what all pairs within ``distance`` of a, or of a and b, connect.

    Works outward from one fingerprint at a time: each reached fingerprint is compared with those not
    yet reached, so memory is one row of distances and at most one link per fingerprint is returned.
    """
    if b is None:
        nodes, side = a, None
    else:
        nodes, side = np.concatenate([a, b]), np.concatenate([np.zeros(len(a), bool), np.ones(len(b), bool)])
    left = np.arange(len(nodes))
    bits = nodes.view(np.uint64)
    out = []
    while len(left):
        group, frontier = [left[0]], [left[0]]
        left = left[1:]
        while frontier and len(left):
            x = frontier.pop()
            near = np.bitwise_count(bits[left] ^ bits[x]) <= distance
            if side is not None:
                near &= side[left] != side[x]
            if near.any():
                got = left[near]
                left = left[~near]
                group.extend(got)
                frontier.extend(got)
        if len(group) > 1:
            vals = nodes[np.array(group)]
            root = int(vals.min())
            out.extend((int(v), root) for v in vals if v != root)
    return out


def links_of(fps: DataFrame, distance: int = 3) -> DataFrame:
    """(u, v) links over distinct fingerprints ``fp`` that connect all pairs within ``distance`` <= 3 bits."""
    if not 0 <= distance <= BLOCKS - 3:
        raise ValueError(f"the block keys find pairs of up to {BLOCKS - 3} differing bits")
    keyed = fps.select("fp", _keys(F.col("fp")).alias("k")).select("k.which", "k.bits", "fp")
    crowd = keyed.groupBy("which", "bits").agg(F.count("*").alias("n"), F.min("fp").alias("u"), F.max("fp").alias("v"))
    crowd = cut(crowd.filter("n > 1"), "simhash-keys")
    two = crowd.filter("n = 2").select("u", "v").filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance)

    more = crowd.filter("n > 2").select("which", "bits", F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))
    held = (keyed.join(more, ["which", "bits"])
            .withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int"))
            # a fingerprint of tile t is in the pairs (i, t), i <= t, and (t, j), j > t
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
            .select("which", "bits", "fp", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile"))
    pairs = held.groupBy("which", "bits", "i", "j").agg(
        F.collect_list(F.when(F.col("tile") == F.col("i"), F.col("fp"))).alias("a"),
        F.collect_list(F.when(F.col("tile") != F.col("i"), F.col("fp"))).alias("b"))
    out = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = [], []
            for diag, a, b in zip(*[batch.column(k) for k in range(3)]):
                a = np.array(a.values.to_numpy(zero_copy_only=False), dtype=np.int64)
                b = np.array(b.values.to_numpy(zero_copy_only=False), dtype=np.int64)
                for x, y in spanning_links(a, None if diag.as_py() else b, distance):
                    u.append(x)
                    v.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    tiled = pairs.select((F.col("i") == F.col("j")).alias("diag"), "a", "b")
    return two.unionByName(arrow_map(tiled, run, out))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row.

    ``component_id`` is the smallest id reachable over links of at most ``distance`` differing bits,
    the row's own id included. NULL and empty texts have fingerprint 0 and are linked like any other.
    A NULL id stays NULL and never is a component id unless no linked row has one. Repeated rows are
    each returned. Other columns are ignored, so their names cannot clash. Empty table: empty result.
    """
    rows = cut(with_fingerprints(df, ident(id_col).cast("long"), text_col, shingle)
               .select(F.col("row").alias("id"), "fp"), "simhash-rows")
    return _classes(rows, distance).select(F.col("id").alias(id_col), F.col("hex").alias("fingerprint"), F.col("component").alias("component_id"))


def _classes(rows: DataFrame, distance: int) -> DataFrame:
    """(id, fp) rows -> id, fp, hex, component."""
    fps = cut(rows.groupBy("fp").agg(F.min("id").alias("low")), "simhash-fps")
    roots = components(links_of(fps, distance))
    rooted = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component"))
    class_of = rooted.join(lowest, "root").select("fp", "component")
    # a hot fingerprint joins one row of class_of: the large side is split by AQE, or class_of is broadcast when small
    return rows.join(class_of, "fp").select("id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("hex"), "component")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3) -> DataFrame:
    """``df`` with one row of each class of near-duplicates: the row of the smallest id.

    Rows that share the smallest id: the one of the smallest fingerprint, then the first as stored.
    A class without any id keeps one row by the same order. Columns and their order are those of ``df``.
    """
    rows = cut(with_fingerprints(df, pack(df), text_col, shingle)
               .withColumn("id", ident_in("row", id_col).cast("long"))
               .withColumn("at", F.monotonically_increasing_id()), "simhash-rows")  # written, so ``at`` stays
    fps = cut(rows.select("fp").distinct(), "simhash-fps")
    roots = components(links_of(fps, distance))
    rooted = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))
    first = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("fp"), F.col("at"))
    kept = rows.select("id", "fp", "at").join(rooted, "fp").groupBy("root").agg(F.min(first).alias("f"))
    return rows.join(kept.select(F.col("f.at").alias("at")), "at", "left_semi").select("row.*")
