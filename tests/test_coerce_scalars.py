"""Edge rows for coercions and scalar expressions (FIXTURES.md §3)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from ledgerline.functions import coerce as C
from ledgerline.functions import scalars as S


def test_safe_int_text(spark):
    df = spark.createDataFrame([("12.5",), (" 12 ",), ("abc",), ("NaT",), ("",), (None,)], "v string")
    got = [r[0] for r in df.select(C.safe_int("v", StringType())).collect()]
    assert got == [None, 12, None, None, None, None]


def test_safe_int_double(spark):
    df = spark.createDataFrame([(12.9,), (-12.9,), (float("nan"),), (3e9,), (None,)], "v double")
    got = [r[0] for r in df.select(C.safe_int("v", DoubleType())).collect()]
    assert got == [12, -12, None, None, None]


def test_safe_str_and_ts(spark):
    df = spark.createDataFrame([("NaT",), ("",), ("x",), ("2024-01-02 03:04:05",), (None,)], "v string")
    rows = df.select(C.safe_str("v", StringType()).alias("s"),
                     C.safe_ts("v", StringType()).alias("t")).collect()
    assert [r.s for r in rows] == [None, "", "x", "2024-01-02 03:04:05", None]
    assert rows[3].t == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert rows[0].t is None and rows[2].t is None


def test_safe_float_nan(spark):
    df = spark.createDataFrame([("1.5",), ("NaN",), ("x",)], "v string")
    assert [r[0] for r in df.select(C.safe_float("v")).collect()] == [1.5, None, None]


def test_store_rounding_half_up_decimal(spark):
    df = spark.createDataFrame([("2.345",), ("-2.345",), ("1000.00",)], "v string")
    got = [r[0] for r in df.select(C.safe_decimal(F.col("v").cast("decimal(10,3)"), 5, 2)).collect()]
    assert got == [Decimal("2.35"), Decimal("-2.35"), None]


def test_half_even_cents(spark):
    df = spark.createDataFrame([(Decimal("2.345"),), (Decimal("2.355"),), (Decimal("19.995"),)],
                               "p decimal(12,3)")
    got = [r[0] for r in df.select(S.cents_half_even("p")).collect()]
    assert got == [Decimal("2.34"), Decimal("2.36"), Decimal("20.00")]


def test_line_amount_example(spark):
    df = spark.createDataFrame([(2, Decimal("19.99"))], "q int, p decimal(12,3)")
    assert df.select(S.line_amount("q", "p")).first()[0] == Decimal("39.98")


def test_order_total_nested(spark):
    df = spark.createDataFrame(
        [([("ABC123", 1, Decimal("999.99")), ("DEF456", 2, Decimal("29.50"))],)],
        "items array<struct<sku:string, qty:int, unit_price:decimal(12,3)>>")
    assert df.select(S.order_total("items")).first()[0] == Decimal("1058.99")


def test_exact_discount(spark):
    df = spark.createDataFrame([(Decimal("1.50"), 2, Decimal("10.00"), Decimal("2.51"))],
                               "p decimal(10,2), q int, di decimal(5,2), do decimal(5,2)")
    v = df.select(S.net_amount("p", "q", "di", "do").alias("v")).first().v
    assert v == Decimal("2.6322300000")
    assert df.select(S.net_amount("p", "q", "di", "do").cast("decimal(15,2)")).first()[0] == Decimal("2.63")


def test_city_and_weekend_and_category(spark):
    df = spark.createDataFrame([("a, b", "Saturday", 5.0), ("solo", "Monday", 5.01), (None, None, None),
                                ("", "Sunday", 1.0)], "addr string, wd string, p double")
    rows = df.select(S.city_of("addr"), S.weekend_flag("wd"), S.price_category("p")).collect()
    assert [tuple(r) for r in rows] == [("a", 1, "Low"), ("solo", 0, "High"), (None, 0, "Low"), ("", 1, "Low")]


def test_parse_long_date(spark):
    df = spark.createDataFrame([("September 25, 2021",), (" August 4, 2017",), ("x",), (None,)], "d string")
    got = [r[0] for r in df.select(S.parse_long_date("d")).collect()]
    assert got == [dt.date(2021, 9, 25), None, None, None]
    trimmed = [r[0] for r in df.select(S.parse_long_date("d", trim=True)).collect()]
    assert trimmed[1] == dt.date(2017, 8, 4)


def test_leading_int_and_remap(spark):
    df = spark.createDataFrame([("90 min", "Movie"), ("2 Seasons", "TV Show"), (None, "Movie")],
                               "d string, t string")
    got = df.select(S.leading_int("d", F.col("t") == "Movie").alias("m"),
                    S.remap("t", {"Movie": "film"}).alias("r")).collect()
    assert [(r.m, r.r) for r in got] == [(90, "film"), (None, "TV Show"), (None, "film")]


def test_normalize_name_and_domains(spark):
    df = spark.createDataFrame([("  anna-maria   SMITH ", "A@X.com", "https://www.X.com/a")],
                               "n string, e string, w string")
    r = df.select(S.normalize_name("n"), S.email_domain("e"), S.url_host("w")).first()
    assert tuple(r) == ("Anna-maria Smith", "x.com", "x.com")


def test_combine_dt_and_redact(spark):
    df = spark.createDataFrame([("2024-03-05", "07:08", "secret"), ("2024-03-05", "7:8", None)],
                               "d string, t string, s string")
    rows = df.select(S.combine_dt("d", "t"), S.redact("s")).collect()
    assert rows[0][0] == "2024-03-05 07:08" and rows[0][1] == "**********"
    assert rows[1][1] is None
