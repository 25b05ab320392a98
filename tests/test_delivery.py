"""Delivery load (P1) and marts (P2) on hand-made rows."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ledgerline.plans import delivery
from ledgerline.session import local_path, scratch_path
from ledgerline.sources import files as IO
from tests.naive_marts import order_mart_naive

T0 = dt.datetime(2024, 5, 6, 10, 0)


def _orders(spark, rows):
    return spark.createDataFrame(rows, "order_id int, user_id int, store_id int, address_text string, "
                                       "created_at timestamp_ntz, delivered_at timestamp_ntz, "
                                       "canceled_at timestamp_ntz, order_discount decimal(5,2)")


def _items(spark, rows):
    return spark.createDataFrame(rows, "order_id int, item_id int, item_title string, item_category string, "
                                       "item_quantity int, item_price decimal(10,2), item_discount decimal(5,2), "
                                       "item_canceled_quantity int")


def test_order_without_items_and_discount(spark):
    orders = _orders(spark, [(1, 10, 7, "Paris, x", T0, T0, None, Decimal("2.51")),
                             (2, 11, 7, "Paris, y", T0, None, T0, None)])
    items = _items(spark, [(1, 100, "t", "c", 2, Decimal("1.50"), Decimal("10.00"), 0)])
    om = delivery.order_mart(orders, items).first()
    assert (om.year, om.month, om.day, om.city, om.store_id) == (2024, 5, 6, "Paris", 7)
    assert om.turnover == Decimal("3.00") and om.revenue == Decimal("2.63")
    assert (om.orders_created, om.orders_delivered, om.orders_canceled, om.unique_customers) == (2, 1, 1, 2)
    im = {r.item_id: r for r in delivery.item_mart(orders, items).collect()}
    assert im[None].orders_with_item == 1 and im[None].item_turnover is None
    assert im[None].orders_with_cancel == 0 and im[None].quantity_ordered is None
    assert im[100].item_turnover == Decimal("2.63") and im[100].orders_with_item == 1


def test_order_mart_matches_naive_twin(spark):
    from ledgerline.plans import fixtures as FX
    sf = "/root/testdata/sf0.001"
    o, i = FX.mart_orders(spark, sf), FX.mart_items(spark, sf)
    a = delivery.order_mart(o, i)
    b = order_mart_naive(o, i)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_item_mart_repeated_item_counts_order_once(spark):
    orders = _orders(spark, [(1, 10, 7, "A", T0, None, None, None)])
    items = _items(spark, [(1, 100, "t", "c", 1, Decimal("1.00"), None, 1),
                           (1, 100, "t", "c", 2, Decimal("1.00"), None, 0)])
    r = delivery.item_mart(orders, items).first()
    assert (r.quantity_ordered, r.quantity_canceled, r.orders_with_item, r.orders_with_cancel) == (3, 1, 1, 1)


WIDE = StructType([StructField("order_id", IntegerType()), StructField("user_id", IntegerType()),
                   StructField("user_phone", StringType()), StructField("item_id", IntegerType())])


def test_first_wins_across_files_and_null_keys(spark, tmp_path):
    d = str(tmp_path / "wide")
    os.makedirs(d)
    spark.createDataFrame([(1, 5, "first", 100), (2, None, "nobody", 101)], WIDE) \
        .coalesce(1).write.parquet(d + "/a_part")
    spark.createDataFrame([(3, 5, "second", 102)], WIDE).coalesce(1).write.parquet(d + "/b_part")
    # gather both files in one folder, names decide the order
    import glob
    import shutil
    flat = str(tmp_path / "flat")
    os.makedirs(flat)
    for tag in ("a", "b"):
        src = glob.glob(f"{d}/{tag}_part/*.parquet")[0]
        shutil.copy(src, f"{flat}/{tag}.parquet")
    wide = IO.scan_parquet_dir(spark, flat, WIDE)
    ordered = wide.withColumn("row_seq", F.struct("_file_name", "_row_index")).drop("_file_name", "_row_index")
    t = delivery.normalize_delivery(ordered, written=False)
    users = {r.user_id: r.user_phone for r in t["users"].collect()}
    assert users == {5: "first"}
    assert t["order_items"].count() == 3          # item rows are all kept, also with NULL user
    assert t["rejects"].count() == 0


def test_optional_column_absent_reads_null(spark, tmp_path):
    p = str(tmp_path / "one")
    spark.createDataFrame([(1, "x")], "a int, b string").write.parquet(p)
    schema = StructType([StructField("a", IntegerType()), StructField("b", StringType()),
                         StructField("c", IntegerType())])
    r = IO.scan_parquet_dir(spark, p, schema).first()
    assert r.c is None and r.a == 1


def test_rejects_row_level(spark):
    wide = spark.createDataFrame([(1, 1, "x" * 30, 9), (2, 2, "ok", 9)],
                                 "order_id int, user_id int, user_phone string, row_seq long")
    t = delivery.normalize_delivery(wide, written=False)
    assert [r.user_id for r in t["users"].collect()] == [2]
    rej = t["rejects"].collect()
    assert len(rej) == 1 and rej[0].load_errors == ["user_phone: longer than 20"]


def test_load_refuses_empty_input(spark):
    out = local_path(scratch_path(spark, "empty_load"))
    empty = spark.createDataFrame([], "order_id int, row_seq long")
    with pytest.raises(ValueError):
        delivery.load_delivery(empty, out)
    assert not os.path.exists(out)


def test_load_delivery_writes_all_tables(spark):
    from ledgerline.plans import fixtures as FX
    out = scratch_path(spark, "load_all")
    paths = delivery.load_delivery(FX.delivery_wide(spark, "/root/testdata/sf0.001"), out, FX.LOAD_ORDER)
    assert set(paths) == set(delivery.DELIVERY_TABLES)
    items = spark.read.parquet(paths["order_items"])
    assert items.count() == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert items.agg(F.min("order_item_id"), F.max("order_item_id")).first() == (1, items.count())
    orders = spark.read.parquet(paths["orders"])
    assert orders.count() == orders.select("order_id").distinct().count()


def test_discounted_sum_exact_for_large_and_negative_nets(spark):
    import random
    from decimal import ROUND_HALF_UP

    from ledgerline.plans.delivery import _discounted_sum
    rnd = random.Random(5)
    rows = []
    for g in range(4):
        for _ in range(30):
            net = rnd.randint(-10**12, 9 * 10**17) if g else rnd.randint(0, 10**9)
            disc = Decimal(rnd.randint(0, 9999)) / 100
            rows.append((g, net, disc))
    df = spark.createDataFrame(rows, "g int, n long, d decimal(5,2)")
    got = {r.g: r.v for r in df.groupBy("g").agg(_discounted_sum("n", "d", "decimal(38,2)").alias("v")).collect()}
    for g in range(4):
        exact = sum(Decimal(n) * (10000 - int(d * 100)) for gg, n, d in rows if gg == g) * Decimal("1E-10")
        assert got[g] == exact.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP), g
