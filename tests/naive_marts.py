"""The order mart in its literal form (join, then distinct counts): the twin
that the tests compare the planned form with."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import scalars as S
from ledgerline.plans.delivery import _mart_keys


def order_mart_naive(orders: DataFrame, items: DataFrame) -> DataFrame:
    """The literal form (join, then distinct counts); test twin of
    :func:`order_mart`."""
    j = orders.join(items, "order_id", "left")
    rev = S.net_amount("item_price", "item_quantity", "item_discount", "order_discount")
    return (j.groupBy(*_mart_keys(orders)).agg(
        F.sum(S.gross_amount("item_price", "item_quantity")).cast("decimal(15,2)").alias("turnover"),
        F.sum(rev).cast("decimal(15,2)").alias("revenue"),
        F.count_distinct("order_id").cast("int").alias("orders_created"),
        F.count_distinct(F.when(F.col("delivered_at").isNotNull(), F.col("order_id"))).cast("int")
        .alias("orders_delivered"),
        F.count_distinct(F.when(F.col("canceled_at").isNotNull(), F.col("order_id"))).cast("int")
        .alias("orders_canceled"),
        F.count_distinct("user_id").cast("int").alias("unique_customers"),
    ))
