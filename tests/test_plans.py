"""Plan tests: the physical plans have the nodes the design relies on and
no Python evaluation."""

import contextlib
import io
import re

import pytest

from ledgerline.plans.registry import QUERIES
from tests.conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF")


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_of(fn(spark, SF_SMALL)) for name, fn in QUERIES.items()}


def test_no_python_anywhere(plans):
    for name, p in plans.items():
        for node in PYTHON_NODES:
            assert node not in p, f"{name} plans {node}"


def test_marts_have_no_distinct_expansion(plans):
    assert "Expand" not in plans["order_mart"]
    assert "Expand" not in plans["item_mart"]


def test_top_k_is_take_ordered(plans):
    for name in ("top_prices", "top_categories", "top_prices_in_period"):
        assert "TakeOrderedAndProject" in plans[name], name


def test_rank_one_is_group_limited(plans):
    assert "WindowGroupLimit" in plans["top_sales_per_category"]
    assert "WindowGroupLimit" in plans["dim_users"]


def test_filter_and_projection_reach_the_scan(plans):
    p = plans["filter_state"]
    assert "EqualTo(r_name,AMERICA)" in p               # the state filter reaches the region scan
    per = plans["top_prices_in_period"]
    # the period reaches the orders scan through the calendar derivation
    assert "GreaterThanOrEqual(o_orderdate,1998-01-01T00:00)" in per
    assert "LessThan(o_orderdate,1998-02-01T00:00)" in per
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in per


def test_hot_orders_join_splittably(plans):
    # inner join plus the orders without lines, not one outer join
    for name in ("item_mart", "validate_orders", "first_error", "order_totals"):
        assert "LeftAnti" in plans[name] and "LeftOuter" not in plans[name], name


def test_period_weeks_are_a_semi_join(plans):
    assert "LeftSemi" in plans["top_prices_in_period"]


def test_one_pass_histogram(plans):
    assert "Expand" in plans["age_histogram"]          # grouping sets: one scan, two groupings
    assert len(re.findall(r"^\(\d+\) Scan parquet", plans["age_histogram"], re.M)) == 1
