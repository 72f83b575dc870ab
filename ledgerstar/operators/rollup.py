"""Distinct counts that roll up: exact bitmaps per bucket of ids, stored beside additive sums.

A distinct count of a year is not the sum of its months' counts. A stored row keeps, for its group and one bucket of
32,768 neighbouring ids, the sums and a bitmap of the ids; coarser groups merge the bitmaps by OR, so the facts are
not read again and no id is shuffled twice. Ids must be whole numbers; they should be dense (a row costs 4 KB before
compression however few ids its bucket holds), which order numbers are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET, BITS = "id_bucket", "id_bits"


def bitmap_rows(df: DataFrame, by: dict[str, Column], ident: str, sums: list[str]) -> DataFrame:
    """(by..., id_bucket, id_bits, sums...). Rows are first summed per group and id, with partial sums before the
    shuffle; then a group's bucket, at most 32,768 rows, is dealt to one task, and its bitmap is built there.

    Bitmaps are never built before a shuffle: where neighbouring ids lie in many tasks, each task would have a bitmap
    of 4 KB for nearly every group and bucket, so bitmaps would grow with tasks times ids.

    NULL ids have the NULL bucket and an empty bitmap, so their sums stay and they are not counted; NULL groups
    are groups. An empty table gives no rows.
    """
    if not isinstance(df.schema[ident].dataType, T.IntegralType):
        raise ValueError(f"{ident}: bitmaps need whole numbers, not {df.schema[ident].dataType.simpleString()}")
    number = F.col(ident).cast("bigint")
    groups = [c.alias(name) for name, c in by.items()]
    per_id = df.groupBy(*groups, number.alias("__id")).agg(*[F.sum(c).alias(c) for c in sums])
    dealt = per_id.withColumn(BUCKET, F.bitmap_bucket_number("__id")).repartition(*by, BUCKET)
    return dealt.groupBy(*by, BUCKET).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__id")).alias(BITS), *[F.sum(c).alias(c) for c in sums])


def merge_bitmaps(rows: DataFrame, by: list[str], count: str, sums: list[str]) -> DataFrame:
    """(by..., sums..., count): ``rows`` of :func:`bitmap_rows` rolled up to ``by`` (columns of it, maybe none).

    Bitmaps of one bucket are merged, then their ones are counted and added over the buckets, which share no id.
    """
    merged = rows.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS), *[F.sum(c).alias(c) for c in sums])
    ones = F.coalesce(F.sum(F.bitmap_count(BITS)), F.lit(0)).alias(count)
    return merged.groupBy(*by).agg(*[F.sum(c).alias(c) for c in sums], ones)
