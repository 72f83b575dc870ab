from decimal import Decimal

from pyspark.sql import types as T

from ledgerstar.functions.columns import (NULL_KEY_TOKEN, canonical, clean_text, day_of_week_sunday0, net_amount,
                                          ratio, surrogate_key, to_int_rounded)


def test_to_int_rounded_rounds_half_up(spark):
    df = spark.createDataFrame([("12.5",), (" 7 ",), ("-2.5",), ("3.49",), ("12.49996",)], "v string")
    out = [r[0] for r in df.select(to_int_rounded("v")).collect()]
    assert out == [13, 7, -3, 3, 12]


def test_clean_text(spark):
    df = spark.createDataFrame([("  a ",), ("   ",), ("",), (None,)], "v string")
    assert [r[0] for r in df.select(clean_text("v")).collect()] == ["a", None, None, None]


def test_surrogate_key_null_token_and_separator(spark):
    df = spark.createDataFrame([(1, None), (1, "x")], "a int, b string")
    out = [r[0] for r in df.select(surrogate_key("a", "b")).collect()]
    import hashlib
    assert out[0] == hashlib.md5(f"1-{NULL_KEY_TOKEN}".encode()).hexdigest()
    assert out[1] == hashlib.md5(b"1-x").hexdigest()


def test_net_amount_is_exact(spark):
    df = spark.createDataFrame([(3, Decimal("19.9999"), Decimal("0.0333"))],
                               "q int, p decimal(19,4), d decimal(19,4)")
    r = df.select(net_amount("q", "p", "d").alias("n"))
    assert r.schema["n"].dataType == T.DecimalType(37, 8)
    assert r.first()["n"] == Decimal("3") * Decimal("19.9999") * (1 - Decimal("0.0333"))


def test_ratio_null_on_zero(spark):
    df = spark.createDataFrame([(1, 0), (1, 4), (1, None)], "a int, b int")
    assert [r[0] for r in df.select(ratio("a", "b")).collect()] == [None, 0.25, None]


def test_week_day_sunday_is_zero(spark):
    df = spark.sql("select date'2024-01-07' d union all select date'2024-01-13'")
    assert [r[0] for r in df.select(day_of_week_sunday0("d")).collect()] == [0, 6]


def test_canonical_types(spark):
    df = spark.sql("select cast(1.5 as decimal(10,2)) m, 3 i, date'2020-01-02' d, "
                   "timestamp_ntz'2020-01-02 03:04:05' t")
    c = canonical(df)
    assert [f.dataType.simpleString() for f in c.schema.fields] == ["string", "bigint", "string", "string"]
    assert tuple(c.first()) == ("1.50000000", 3, "2020-01-02", "2020-01-02 03:04:05.000000")
