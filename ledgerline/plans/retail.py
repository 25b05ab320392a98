"""Retail tasks over calendar, sales and prices (the 13 DataFrame tasks).
Each task is an independent function of its inputs (no reassigned inputs,
X6/X7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import scalars as S
from ledgerline.operators import aggregates as A
from ledgerline.operators import relational as RL
from ledgerline.sources.files import register


def weekend_flag(calendar: DataFrame) -> DataFrame:
    """1: ``is_weekend`` = 1 on Saturday or Sunday."""
    return calendar.withColumn("is_weekend", S.weekend_flag("weekday"))


def rename_week(calendar: DataFrame) -> DataFrame:
    """2: ``wm_yr_wk`` -> ``week_id``."""
    return calendar.withColumnRenamed("wm_yr_wk", "week_id")


def distinct_weekdays(calendar: DataFrame) -> DataFrame:
    """3."""
    return RL.distinct_values(calendar, "weekday")


def n_stores(sales: DataFrame) -> DataFrame:
    """4: number of distinct stores, as a one-row DataFrame."""
    return RL.n_distinct(sales, "store_id", out="n_stores")


def avg_sales_by_category(sales: DataFrame, day: int = 1) -> DataFrame:
    """5: mean units of day k per category."""
    return A.avg_by(sales, "cat_id", S.day_col(day), out="avg_sales")


def price_int(prices: DataFrame) -> DataFrame:
    """6: ``sell_price_int``: the price truncated to int."""
    return prices.withColumn("sell_price_int", S.to_int("sell_price"))


def top_prices(prices: DataFrame, k: int = 5) -> DataFrame:
    """7: the k most expensive rows (ties broken by the row's keys)."""
    return RL.top_k(prices, [F.col("sell_price").desc(), F.col("store_id"), F.col("item_id"),
                             F.col("wm_yr_wk")], k)


def sql_avg_by_state(sales: DataFrame, day: int = 1, view: str = "sales") -> DataFrame:
    """8: the same mean by SQL, per state."""
    register(sales, view)
    return sales.sparkSession.sql(
        f"SELECT state_id, AVG(d_{int(day)}) AS avg_sales FROM {view} GROUP BY state_id")


def filter_state(sales: DataFrame, state: str) -> DataFrame:
    """9: rows of one state (pushed down to the scan where possible)."""
    return RL.where_eq(sales, state_id=state)


def prices_by_day(prices: DataFrame, calendar: DataFrame) -> DataFrame:
    """Each weekly price once for every day of its week. A week may hold any
    share of the prices."""
    days = calendar.select(F.col("wm_yr_wk").alias("week_id"), "date")
    return RL.join_many(prices, days, [("wm_yr_wk", "week_id")]).drop("week_id")


def top_prices_in_period(prices: DataFrame, calendar: DataFrame, lo: str, hi: str,
                         k: int = 5) -> DataFrame:
    """10: the k highest distinct prices of the weeks that have a day in
    [lo, hi]. The date filter runs on the calendar; a semi join keeps the
    prices of its weeks, each once however many days of its week count."""
    cal = RL.between_dates(calendar.select(F.col("wm_yr_wk").alias("week_id"), "date"),
                           "date", lo, hi)
    j = prices.join(cal, prices.wm_yr_wk == cal.week_id, "left_semi")
    return RL.top_k(j.select("sell_price").distinct(), [F.col("sell_price").desc()], k)


def top_sales_per_category(sales: DataFrame, day: int = 1) -> DataFrame:
    """11: the best-selling rows of day k in each category, ties kept."""
    return RL.top_ranked(sales, ["cat_id"], [S.day_col(day).desc()], n=1, ties=True,
                         rank_col="rank")


def price_category(prices: DataFrame, cut: float = S.PRICE_CUT) -> DataFrame:
    """12: ``High`` above the cut, else ``Low``."""
    return prices.withColumn("price_category", S.price_category("sell_price", cut))


def sum_sales_by_store(sales: DataFrame, day: int = 1) -> DataFrame:
    """13: total units of day k per store."""
    return A.sum_by(sales, "store_id", S.day_col(day), out="total_sales") \
        .withColumn("total_sales", F.col("total_sales").cast("bigint"))
