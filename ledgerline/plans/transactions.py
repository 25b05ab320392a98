"""Tasks over the transactions CSV (user_id, timestamp, item_id, category,
price, quantity, city)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import scalars as S
from ledgerline.operators import relational as RL

# Money is summed as exact decimal: the prices carry cents.
MONEY = "decimal(18,2)"


def _revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("revenue", S.revenue(F.col("price").cast(MONEY), F.col("quantity").cast("int")))


def top_categories(df: DataFrame, k: int = 5) -> DataFrame:
    """1: top-k categories by revenue (price x quantity)."""
    agg = _revenue(df).groupBy("category").agg(
        F.sum("revenue").cast("decimal(20,2)").alias("total_revenue"))
    return RL.top_k(agg, [F.col("total_revenue").desc(), F.col("category")], k)


def multi_category_users(df: DataFrame, n: int = 2) -> DataFrame:
    """2: users who bought in more than n categories, with the sorted set.
    The set per user holds distinct categories only (bounded by their
    number), and partial aggregation builds it map-side."""
    agg = df.groupBy("user_id").agg(F.array_sort(F.collect_set("category")).alias("categories"))
    return (agg.filter(F.size("categories") > n)
            .withColumn("n_categories", F.size("categories")))


def avg_receipt_by_city(df: DataFrame) -> DataFrame:
    """3 (blank in the reference): mean receipt per city, largest first; one
    row is one receipt."""
    agg = _revenue(df).groupBy("city").agg(
        (F.sum("revenue") / F.count(F.lit(1))).cast("double").alias("__avg"))
    return (agg.select("city", F.round("__avg", 6).alias("avg_receipt"))
            .orderBy(F.col("avg_receipt").desc(), F.col("city")))


def top_item_per_category(df: DataFrame) -> DataFrame:
    """4: best-selling item and its units per category, ties kept, by category."""
    units = df.groupBy("category", "item_id").agg(F.sum("quantity").cast("bigint").alias("total_qty"))
    best = RL.top_ranked(units, ["category"], [F.col("total_qty").desc()], n=1, ties=True)
    return best.select("category", "item_id", "total_qty").orderBy("category", "item_id")


def peak_hour(df: DataFrame, ts_col: str = "timestamp") -> DataFrame:
    """5 (blank in the reference): hour of day with the highest revenue,
    that revenue and its share of all revenue. The hour is parsed from the
    timestamp text. At most 24 hourly rows exist, so the total over them is
    a window over 24 rows."""
    hourly = (_revenue(df).groupBy(S.hour_of(ts_col).alias("hour"))
              .agg(F.sum("revenue").cast("decimal(20,2)").alias("revenue")))
    total = F.sum("revenue").over(Window.partitionBy())
    with_total = hourly.withColumn("total_revenue", total.cast("decimal(20,2)"))
    best = RL.top_k(with_total, [F.col("revenue").desc(), F.col("hour")], 1)
    return best.withColumn("share", F.round((F.col("revenue") / F.col("total_revenue")).cast("double"), 6))
