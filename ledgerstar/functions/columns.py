"""Column helpers: typing traps, money arithmetic, surrogate keys, dates.

All of them return plain Column expressions, so they fold into whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the warehouse conventions.
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"   # text that stands for NULL inside a hash key
OPEN_END_DATE = "9999-12-31"                         # open end of a validity interval
BEGIN_OF_TIME = "1900-01-01"                         # backdated start of a first version
UNKNOWN_INT = -1                                     # unknown member, integer keys
UNKNOWN_TEXT = "-1"                                  # unknown member, hash / text keys

LINE_QTY = T.DecimalType(10, 0)
LINE_PRICE = T.DecimalType(19, 4)
LINE_DISCOUNT = T.DecimalType(5, 4)
HEADER_MONEY = T.DecimalType(19, 2)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """``nullif(trim(x), '')``."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def to_int_rounded(c) -> Column:
    """Cast text or decimal to int by rounding half up (a plain cast would truncate or fail).

    One rounding, from 18 decimals: 12.49996 is 12."""
    return F.round(col(c).cast(T.DecimalType(38, 18)), 0).cast(T.IntegerType())


def typed(c, spark_type: str) -> Column:
    """Cast under ANSI rules; ``int`` goes through :func:`to_int_rounded`."""
    if spark_type in ("int", "integer"):
        return to_int_rounded(c)
    return col(c).cast(spark_type)


def ratio(a, b) -> Column:
    """``a / nullif(b, 0)`` evaluated in double precision (NULL when b is 0 or NULL)."""
    den = col(b).cast("double")
    return F.when(den != 0, col(a).cast("double") / den)


def surrogate_key(*cols) -> Column:
    """md5 over the text of the columns joined by '-', NULL written as a fixed token.

    Dates and timestamps should be passed through ``date_format`` first when the text
    must agree with another engine.
    """
    parts = [F.coalesce(col(c).cast("string"), F.lit(NULL_KEY_TOKEN)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def gross_amount(qty, price) -> Column:
    return col(qty).cast(LINE_QTY) * col(price).cast(LINE_PRICE)


def discount_amount(qty, price, disc) -> Column:
    return gross_amount(qty, price) * col(disc).cast(LINE_DISCOUNT)


def net_amount(qty, price, disc) -> Column:
    """``qty * price * (1 - disc)`` exact at decimal(37,8).

    The narrow operand types keep Spark from widening past 38 digits (which would cut
    the scale to 6).
    """
    return gross_amount(qty, price) * (F.lit(1) - col(disc).cast(LINE_DISCOUNT))


def days_between(start, end) -> Column:
    """``datediff(day, start, end)`` = end - start in days."""
    return F.datediff(col(end), col(start))


def date_key(d) -> Column:
    """yyyymmdd integer key of a date."""
    return F.date_format(col(d), "yyyyMMdd").cast("int")


def year_quarter(d) -> Column:
    return F.concat(F.year(col(d)).cast("string"), F.lit("-Q"), F.quarter(col(d)).cast("string"))


def day_of_week_sunday0(d) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(col(d)) - 1


def off_by_more_than(a, b, eps: float = 0.01) -> Column:
    return F.abs(col(a) - col(b)) > F.lit(eps)


EXACT = T.DecimalType(38, 8)   # comparison form of money


def canonical(df: DataFrame) -> DataFrame:
    """Comparison form of a result: decimals as exact text of eight decimals, integers as bigint,
    dates and timestamps (to the microsecond) as ISO text, so that another engine's result can be
    hashed against it and no difference is lost in a double."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, T.DecimalType):
            c = c.cast(EXACT).cast("string")
        elif isinstance(t, T.FloatType):
            c = c.cast("double")
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(c.alias(f.name))
    return df.select(*out)
