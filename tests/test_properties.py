"""Spark expressions against written-down cases, and properties that hold for
any input (one Spark job per generated batch)."""

from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.types import StringType

from ledgerline.functions import coerce as C
from ledgerline.functions import rules as R
from ledgerline.functions import scalars as S
from ledgerline.plans import validation as V

SETTINGS = settings(max_examples=5, deadline=None, derandomize=True)


def _eval(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[1] for r in df.select("i", expr).orderBy("i").collect()]


NAMES = {"": "", "anna": "Anna", "ANNA": "Anna", "  anna   LEE ": "Anna Lee", "o'NEIL": "O'neil",
         "a-b C-D": "A-b C-d", "x\ty": "X Y", "   ": ""}
SKU_OK = {"ABC": True, "AB1": True, "123": True, "A" * 12: True, "A" * 13: False, "AB": False, "abc": False,
          "AB C": False, "AB-1": False, "": False, "ABC\n": False}
PLACE = {"ABC": None, "AB1": None, "123": V.MSG_SKU_CHARS, "AB": V.MSG_SKU_LEN, "A" * 12: None,
         "A" * 13: V.MSG_SKU_LEN, "abc": V.MSG_SKU_CHARS, "AB-1": V.MSG_SKU_CHARS, "": V.MSG_SKU_CHARS}
DOMAINS = {"a@b.c": "b.c", "A@B.C": "b.c", "a@b@c.D": "c.d", "none": "none", "a@": ""}
INTEGERS = {"7": 7, " 7 ": 7, "-7": -7, "+7": 7, "7.0": None, "7a": None, "": None, " ": None, "007": 7}
HOSTS = {"https://www.X.com/a": "x.com", "http://x.com:8080/p?q=1": "x.com", "https://WWW.x.org": "x.org",
         "https://w.io": "w.io"}


@pytest.mark.parametrize("cases, expr", [
    (NAMES, lambda: S.normalize_name("v")), (SKU_OK, lambda: ~R.sku_format("v")),
    (PLACE, lambda: V.sku_place_error("v")), (DOMAINS, lambda: S.email_domain("v")),
    (INTEGERS, lambda: C.safe_int("v", StringType())), (HOSTS, lambda: S.url_host("v"))])
def test_written_cases(spark, cases, expr):
    got = dict(zip(cases, _eval(spark, list(cases), expr())))
    assert got == cases


def test_written_roundings(spark):
    even = {"2.345": "2.34", "2.355": "2.36", "-2.345": "-2.34", "0.005": "0.00", "1.999": "2.00"}
    got = _eval(spark, [Decimal(v) for v in even], S.cents_half_even("v"), "decimal(12,3)")
    assert got == [Decimal(v) for v in even.values()]
    up = {"2.345": "2.35", "2.344": "2.34", "-2.345": "-2.35", "0.005": "0.01"}
    got = _eval(spark, [Decimal(v) for v in up], C.safe_decimal("v", 5, 2), "decimal(12,3)")
    assert got == [Decimal(v) for v in up.values()]


@SETTINGS
@given(st.lists(st.text(alphabet="abcXYZ019- \t", max_size=30), min_size=1, max_size=50))
def test_normalized_name_is_stable(spark, values):
    once = _eval(spark, values, S.normalize_name("v"))
    assert _eval(spark, once, S.normalize_name("v")) == once
    assert all("  " not in v and v == v.strip() for v in once)


@SETTINGS
@given(st.lists(st.decimals(min_value=-10**6, max_value=10**6, places=3, allow_nan=False),
                min_size=1, max_size=50))
def test_rounding_is_within_half_a_cent(spark, values):
    got = _eval(spark, values, S.cents_half_even("v"), "decimal(12,3)")
    assert all(abs(g - v) <= Decimal("0.005") for g, v in zip(got, values))
