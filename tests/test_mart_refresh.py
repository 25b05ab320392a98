"""Marts refreshed by load: equal to the marts of all rows, only touched days computed."""

import contextlib
import datetime as dt
import io
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import delivery
from ledgerline.plans import mart_refresh as MR
from ledgerline.session import scratch_path

ORDERS = ("order_id int, user_id int, store_id int, address_text string, created_at timestamp_ntz, "
          "delivered_at timestamp_ntz, canceled_at timestamp_ntz, order_discount decimal(5,2)")
ITEMS = ("order_id int, item_id int, item_title string, item_category string, item_quantity int, "
         "item_price decimal(10,2), item_discount decimal(5,2), item_canceled_quantity int")


def order(i, day):
    at = None if day is None else dt.datetime(2024, 3, day, 23, 59, 59)
    return (i, i % 3, 1, "City, x", at, at, None, Decimal("2.50"))


def item(order_id, i):
    return (order_id, i, f"t{i}", "c", 2, Decimal("3.10"), None, i % 2)


LOADS = [
    ([order(i, 1 + i % 4) for i in range(20)] + [order(90, None)],
     [item(i % 20, i % 6) for i in range(200)] + [item(90, 1), item(50, 7), item(None, 1)]),   # 50 comes later
    ([order(50, 9), order(3, 11)], [item(50, 2), item(5, 1)]),          # order 3 is stored, item of day 2
    ([], [item(7, 3)]),
    ([], []),
]


def _frames(spark, rows):
    return spark.createDataFrame(rows[0], ORDERS), spark.createDataFrame(rows[1], ITEMS)


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _expected(spark, loads):
    kept, items = {}, []
    for orders, its in loads:
        for o in orders:
            kept.setdefault(o[0], o)
        items += its
    return _frames(spark, (list(kept.values()), items))


def test_each_load_equals_all_rows(spark):
    root = scratch_path(spark, "test-marts")
    schemas = [f.schema for f in _frames(spark, ([], []))]
    touched = []
    for n, rows in enumerate(LOADS, 1):
        MR.store_load(spark, root, n, *_frames(spark, rows))
        touched.append([d and d.day for d in MR.refresh_marts(spark, root, n, *schemas)])
        orders, items = _expected(spark, LOADS[:n])
        for name, mart in MR.MARTS.items():
            assert _same(MR.read_mart(spark, root, name, *schemas), mart(orders, items)), (n, name)
    assert touched == [[1, 2, 3, 4, None], [2, 9], [4], []]
    # a load or refresh that is run again changes nothing
    MR.store_load(spark, root, 2, *_frames(spark, LOADS[1]))
    MR.refresh_marts(spark, root, 2, *schemas)
    MR.refresh_marts(spark, root, 3, *schemas)
    assert _same(MR.read_mart(spark, root, "order_mart", *schemas), delivery.order_mart(*_expected(spark, LOADS)))


def test_other_days_are_neither_read_nor_written(spark):
    root = scratch_path(spark, "test-marts")
    schemas = [f.schema for f in _frames(spark, ([], []))]
    MR.store_load(spark, root, 1, *_frames(spark, LOADS[0]))
    MR.refresh_marts(spark, root, 1, *schemas)
    folder = root[5:] if root.startswith("file:") else root

    def files():
        return {os.path.join(base, n) for base, _, names in os.walk(f"{folder}/order_mart") for n in names
                if n.endswith(".parquet")}

    before = files()
    MR.store_load(spark, root, 2, *_frames(spark, LOADS[1]))
    days = MR.refresh_marts(spark, root, 2, *schemas)
    gone = {f.split("order_mart/")[1].rsplit("/", 1)[0] for f in before - files()}
    assert gone == {"year=2024/month=3/day=2"}
    rows = MR.stored(spark, root, "orders", schemas[0]).filter(MR._in_days(days))
    assert {r[0].split("day=")[1].split("/")[0] for r in rows.select(F.input_file_name()).distinct().collect()} == {"2024-03-02", "2024-03-09"}
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        rows.explain("formatted")
    assert "PartitionFilters" in buf.getvalue() and "day" in buf.getvalue().split("PartitionFilters")[1].split("\n")[0]


def test_a_refresh_that_stops_is_run_again(spark, monkeypatch):
    root = scratch_path(spark, "test-marts")
    schemas = [f.schema for f in _frames(spark, ([], []))]
    MR.store_load(spark, root, 1, *_frames(spark, LOADS[0]))
    MR.refresh_marts(spark, root, 1, *schemas)
    MR.store_load(spark, root, 2, *_frames(spark, LOADS[1]))

    def stops(orders, items):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setitem(MR.MARTS, "item_mart", stops)
        with pytest.raises(RuntimeError):
            MR.refresh_marts(spark, root, 2, *schemas)
    MR.refresh_marts(spark, root, 2, *schemas)
    for name, mart in MR.MARTS.items():
        assert _same(MR.read_mart(spark, root, name, *schemas), mart(*_expected(spark, LOADS[:2])))


def test_empty(spark):
    root = scratch_path(spark, "test-marts")
    schemas = [f.schema for f in _frames(spark, ([], []))]
    assert MR.read_mart(spark, root, "order_mart", *schemas).count() == 0
    MR.store_load(spark, root, 1, *_frames(spark, ([], [])))
    assert MR.refresh_marts(spark, root, 1, *schemas) == []


@pytest.mark.parametrize("part_items", [3, 500_000])
def test_stored_items_move_once_a_refresh(spark, monkeypatch, part_items):
    monkeypatch.setattr(MR, "PART_ITEMS", part_items)
    root = scratch_path(spark, "test-marts")
    schemas = [f.schema for f in _frames(spark, ([], []))]
    for n, rows in enumerate(LOADS[:2], 1):
        MR.store_load(spark, root, n, *_frames(spark, rows), buckets=3 + n)       # those of the first load count
        MR.refresh_marts(spark, root, n, *schemas)
    for name, mart in MR.MARTS.items():
        assert _same(MR.read_mart(spark, root, name, *schemas), mart(*_expected(spark, LOADS[:2])))
    orders, items = (MR.stored(spark, root, t, s, True).drop("load") for t, s in zip(("orders", "items"), schemas))
    assert orders.select("order_id").exceptAll(MR.stored(spark, root, "orders", schemas[0]).select("order_id")).count() == 0
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    buf = io.StringIO()
    try:
        with contextlib.redirect_stdout(buf):
            delivery.item_mart_by(MR._in_parts(orders, items), items.drop("day")).explain()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    moves = [line for line in buf.getvalue().split("\n") if "Exchange hashpartitioning(" in line]
    assert sum("hashpartitioning(__day" in m for m in moves) == 1
    assert all("hashpartitioning(__day" in m or "hashpartitioning(day" in m or "__of" in m for m in moves), moves
    assert not any("order_id" in m for m in moves)


def test_items_of_a_day_are_dealt_into_parts(spark, monkeypatch):
    monkeypatch.setattr(MR, "PART_ITEMS", 10)
    orders, items = _frames(spark, ([order(i, 1 if i < 9 else None) for i in range(10)], [item(i % 10, i) for i in range(100)]))
    orders = orders.withColumn("day", F.col("created_at").cast("date"))
    parts = {r.day: r.n for r in MR._in_parts(orders, items).groupBy("day").agg(F.max("__parts").alias("n")).collect()}
    assert parts == {dt.date(2024, 3, 1): 9, None: 1}
