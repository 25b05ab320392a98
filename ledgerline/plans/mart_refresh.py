"""E7/E8/P2 by increments: orders and items are kept by load and by day (or month,
``unit``, where a day has few rows), and a refresh computes only the days that a load
touched.

    <root>/orders/load=<n>/day=<date>/   orders new in load n, by day (first of month) of creation
    <root>/items/load=<n>/day=<date>/    items of load n, by the day of their order
    <root>/order_mart/year=/month=/day=/ and item_mart alike (year=/month=/ by month)

A root has one ``unit`` and, from its first load on, one number of buckets (a folder of the
root, ``_buckets=<n>``, says which).

Orders and items are kept in Spark's buckets of order_id. Joins of items to orders and the
sums by order, at storing and at refreshing, thus move no stored row. Items move once, to their
order's bucket, when they are stored, and once a refresh, to the part of their day
that their item belongs to (``PART_ITEMS`` items on average), where the item mart's groups are
whole and are written. All items of one order, and those without order_id, are in one bucket.

A load is written under its own number, so one that stopped is run again and
replaces its own output; a refresh replaces whole days and can be run again too. Loads
are numbered upwards. A day's two marts change one after the other: readers that need
both as one read them after the refresh (or use ``delivery.build_marts``).

Items that come before their order, or whose order has no creation time, are in the
items' partition of no day, which each refresh reads besides the days touched.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from ledgerline.plans import delivery

MARTS = {"order_mart": delivery.order_mart, "item_mart": delivery.item_mart}
# marts that can be laid out for writing by the shuffle that groups them
LAID_OUT = {delivery.item_mart: delivery.item_mart_by}
MART_KEYS = {"day": ["year", "month", "day"], "month": ["year", "month"]}
BUCKETS = 16
BUCKET_BYTES = 64 << 20
PART_ITEMS = 500_000


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def buckets_for(spark: SparkSession, *paths: str) -> int:
    """Buckets for a root whose loads are about as large as these files in all."""
    conf, size = spark._jsc.hadoopConfiguration(), 0
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        size += folder.getFileSystem(conf).getContentSummary(folder).getLength()
    return max(4, -(-size // BUCKET_BYTES))


def _buckets(spark: SparkSession, root: str, first: int | None = None) -> int | None:
    """The root's buckets; ``first`` for a root without loads. None: nothing is stored."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, "_buckets=*")) or ():
        return int(status.getPath().getName().split("=")[1])
    if _exists(spark, f"{root}/orders"):
        raise ValueError(f"{root}: its loads were stored without buckets; store them anew")
    if first is not None:
        files.mkdirs(spark._jvm.org.apache.hadoop.fs.Path(folder, f"_buckets={first}"))
    return first


@contextmanager
def _passing_table(spark: SparkSession) -> Iterator[str]:
    """A name for a table over a folder: bucketed files are written and read through the
    catalog. Its partitions are those of the folder; the name goes, the files stay."""
    name, key = f"ledgerline_{uuid.uuid4().hex}", "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield name
    finally:
        spark.conf.set(key, before)
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def stored(spark: SparkSession, root: str, table: str, schema: StructType, bucketed: bool = False) -> DataFrame:
    """``orders`` or ``items`` of all loads, with ``load`` and ``day``; ``bucketed``: Spark
    knows which files have an order_id."""
    whole = StructType([*schema.fields, StructField("load", IntegerType()), StructField("day", DateType())])
    if not _exists(spark, f"{root}/{table}"):
        return spark.createDataFrame([], whole)
    if not bucketed:
        return spark.read.schema(whole).parquet(f"{root}/{table}")
    columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in whole.fields)
    location = f"{root}/{table}".replace("\\", "\\\\").replace("'", "\\'")
    with _passing_table(spark) as name:
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (load, day) "
                  f"CLUSTERED BY (order_id) INTO {_buckets(spark, root)} BUCKETS LOCATION '{location}'")
        return spark.table(name)


def _write_days(df: DataFrame, path: str, buckets: int) -> None:
    """``df``, which is hash partitioned by order_id into ``buckets``: a file per day and bucket."""
    with _passing_table(df.sparkSession) as name:
        (df.write.format("parquet").mode("overwrite").option("path", path).partitionBy("day")
         .bucketBy(buckets, "order_id").saveAsTable(name))


def store_load(spark: SparkSession, root: str, load: int, orders: DataFrame, items: DataFrame, unit: str = "day",
               buckets: int = BUCKETS) -> None:
    """Keep one load. Of orders with the same id the earliest load's stays (within a
    load the order_id is the key); all items are kept. Of the stored orders only id and day
    are read. ``buckets`` counts for the first load of a root."""
    buckets = _buckets(spark, root, buckets)
    before = stored(spark, root, "orders", orders.schema, True).filter(F.col("load") < load)
    fresh = orders.repartition(buckets, "order_id").join(before.select("order_id"), "order_id", "left_anti").select(
        *orders.columns, F.date_trunc(unit, "created_at").cast("date").alias("day"))
    _write_days(fresh, f"{root}/orders/load={load}", buckets)
    days = stored(spark, root, "orders", orders.schema, True).filter(F.col("load") <= load).select("order_id", "day")
    _write_days(items.repartition(buckets, "order_id").join(days, "order_id", "left").select(*items.columns, "day"),
                f"{root}/items/load={load}", buckets)


def _in_days(days: Sequence[date | None]) -> Column:
    known = F.col("day").isin([d for d in days if d is not None])
    return known | F.col("day").isNull() if None in days else known


def touched_days(spark: SparkSession, root: str, load: int, orders: StructType, items: StructType) -> list[date | None]:
    """Days whose orders or items the load added to: from the folders' names, one
    value per day of the calendar."""
    days = None
    for table, schema in (("orders", orders), ("items", items)):
        of = stored(spark, root, table, schema).filter(F.col("load") == load).select("day").distinct()
        days = of if days is None else days.unionByName(of).distinct()
    return sorted((r.day for r in days.collect()), key=lambda d: (d is None, d or date.min))


def _in_parts(orders: DataFrame, items: DataFrame) -> DataFrame:
    """``orders`` with the number of ``__parts`` that their day's items are dealt into, by the
    rows of the stored files: orders of the day times items per order."""
    n = F.count(F.lit(1))
    per_order = orders.agg(n.alias("__orders")).crossJoin(items.agg(n.alias("__items")))
    parts = orders.groupBy(F.col("day").alias("__of")).agg(n.alias("__n")).crossJoin(per_order).select("__of", F.greatest(
        F.ceil(F.col("__n") / F.col("__orders") * F.col("__items") / PART_ITEMS).cast("int"), F.lit(1)).alias("__parts"))
    return (orders.join(F.broadcast(parts), F.col("day").eqNullSafe(F.col("__of")))
            .select(*orders.columns, "__parts"))


def refresh_marts(spark: SparkSession, root: str, load: int, orders: StructType, items: StructType,
                  unit: str = "day") -> list[date | None]:
    """Compute the days that ``load`` touched, from all loads up to it, and replace
    these days in both marts. Returns the days."""
    days = touched_days(spark, root, load, orders, items)
    if not days:
        return days
    loaded = F.col("load") <= load
    some_orders = stored(spark, root, "orders", orders, True).filter(_in_days(days) & loaded).select(*orders.names, "day")
    some_items = stored(spark, root, "items", items, True).filter(_in_days([*days, None]) & loaded).select(*items.names)
    for name, mart in MARTS.items():
        if mart in LAID_OUT:
            rows = LAID_OUT[mart](_in_parts(some_orders, some_items), some_items)
        else:
            rows = mart(some_orders.drop("day"), some_items).hint("rebalance", *MART_KEYS[unit])
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*MART_KEYS[unit]).parquet(f"{root}/{name}"))
    return days


def read_mart(spark: SparkSession, root: str, name: str, orders: StructType, items: StructType,
              unit: str = "day") -> DataFrame:
    """A mart with the columns that ``delivery`` gives it."""
    empty = MARTS[name](*(spark.createDataFrame([], s) for s in (orders, items)))
    by_day = [f for f in empty.schema.fields if f.name in MART_KEYS[unit]]
    rest = [f for f in empty.schema.fields if f.name not in MART_KEYS[unit]]
    if not _exists(spark, f"{root}/{name}"):
        return empty
    return spark.read.schema(StructType([*rest, *by_day])).parquet(f"{root}/{name}").select(*empty.columns)
