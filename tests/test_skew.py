"""Hot keys: one key holds a third of all rows. Results stay whole and
equal to a brute-force form; the plans combine map-side before the shuffle."""

import contextlib
import datetime as dt
import io
import re
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.operators import aggregates as A
from ledgerline.operators import relational as RL
from ledgerline.plans import delivery, retail
from ledgerline.plans import validation as V
from tests.naive_marts import order_mart_naive

N = 3000


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_first_wins_hot_key(spark):
    df = spark.range(0, N, 1, 12).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"),
        (N - F.col("id")).alias("seq"), F.col("id").alias("v"))
    got = RL.first_by_key(df, ["k"], ["seq"])
    hot = got.filter("k = 1").collect()
    assert len(hot) == 1 and hot[0].v == max(i for i in range(N) if i % 3 == 0)
    brute = df.groupBy("k").agg(F.max_by("v", F.col("seq") * -1).alias("v"))
    assert got.select("k", "v").exceptAll(brute).count() == 0
    p = _plan(got)
    # a partial group limit runs before the exchange, a final one after it
    assert re.search(r"WindowGroupLimit.*\n.*Sort.*\n.*Exchange.*\n.*WindowGroupLimit", p), p


def test_marts_hot_order(spark):
    t = dt.datetime(2024, 1, 2)
    orders = spark.createDataFrame(
        [(o, o % 5, 1, f"City{o % 3}, x", t, None, None, Decimal("2.50")) for o in range(50)],
        "order_id int, user_id int, store_id int, address_text string, created_at timestamp_ntz, "
        "delivered_at timestamp_ntz, canceled_at timestamp_ntz, order_discount decimal(5,2)")
    items = spark.range(0, N, 1, 12).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).cast("int").alias("order_id"),
        (F.col("id") % 40).cast("int").alias("item_id"), F.lit("t").alias("item_title"),
        F.lit("c").alias("item_category"), (F.col("id") % 4 + 1).cast("int").alias("item_quantity"),
        (F.col("id") % 997 / 100).cast("decimal(10,2)").alias("item_price"),
        F.lit(Decimal("1.25")).cast("decimal(5,2)").alias("item_discount"),
        (F.col("id") % 2).cast("int").alias("item_canceled_quantity"))
    a = delivery.order_mart(orders, items)
    b = order_mart_naive(orders, items)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    im = delivery.item_mart(orders, items)
    # brute force for the item mart: the literal SQL form
    j = orders.join(items, "order_id", "left")
    from ledgerline.functions import scalars as S
    y, m, d = S.ymd("created_at")
    brute = j.groupBy(y.alias("year"), m.alias("month"), d.alias("day"),
                      S.city_of("address_text").alias("city"), "store_id",
                      F.col("item_category").alias("category"), "item_id", "item_title").agg(
        F.sum(S.net_amount("item_price", "item_quantity", "item_discount", "order_discount"))
        .cast("decimal(15,2)").alias("item_turnover"),
        F.sum("item_quantity").cast("int").alias("quantity_ordered"),
        F.sum("item_canceled_quantity").cast("int").alias("quantity_canceled"),
        F.count_distinct("order_id").cast("int").alias("orders_with_item"),
        F.count_distinct(F.when(F.col("item_canceled_quantity") > 0, F.col("order_id"))).cast("int")
        .alias("orders_with_cancel"))
    assert im.exceptAll(brute).count() == 0 and brute.exceptAll(im).count() == 0


def test_hot_group_histogram_and_quantiles(spark):
    df = spark.range(0, N, 1, 12).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.lit("cold")).alias("g"),
        (F.col("id") % 60 + 18).cast("int").alias("age"))
    h = {(r.g, r.bin): r.n for r in A.histogram(df, "age", list(range(20, 76, 5)), by="g").collect()}
    brute = {(g, b): 0 for g in ("hot", "cold", "all") for b in range(1, 12)}
    for i in range(N):
        g = "hot" if i % 3 == 0 else "cold"
        age = i % 60 + 18
        if 20 <= age <= 75:
            b = min((age - 20) // 5 + 1, 11)
            for key in ((g, b), ("all", b)):
                brute[key] += 1
    assert h == brute
    p = _plan(A.group_quantiles(df, ["g"], "age", method="map"))
    assert "ObjectHashAggregate" in p or "SortAggregate" in p or "HashAggregate" in p
    assert len(re.findall(r"^\(\d+\) Exchange", p, re.M)) == 1   # partial aggregate, one shuffle


def test_session_has_skew_join(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"


def test_sorted_quantiles_equal_exact_on_hot_group(spark):
    df = spark.range(0, N, 1, 12).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 7).cast("string")).alias("g"),
        ((F.col("id") * 7919) % 1000 / 7.0).alias("x"))
    probs = (0.1, 0.25, 0.5, 0.9)
    a = {r.g: tuple(r[1:]) for r in A.group_quantiles(df, ["g"], "x", probs, method="map").collect()}
    b = {r.g: tuple(r[1:]) for r in A.group_quantiles(df, ["g"], "x", probs, method="sorted").collect()}
    assert a.keys() == b.keys()
    for g in a:
        for u, v in zip(a[g], b[g]):
            assert abs(u - v) <= 1e-9 * max(1.0, abs(u)), (g, a[g], b[g])
    one = A.group_quantiles(df.filter("g = 'hot'"), [], "x", (0.5,), method="sorted").first()
    assert abs(one[0] - a["hot"][2]) < 1e-9


def _pairs(left, right):
    return sorted((a, b) for k, a in left for j, b in right if k is not None and k == j)


def test_many_to_many_join_splits_hot_keys(spark):
    """One week holds a third of the prices, another a third of the days."""
    left = [(1 if i % 3 == 0 else i % 40, i) for i in range(900)] + [(None, -1), (77, -2)]
    right = [(2 if i % 3 == 0 else i % 40, i) for i in range(90)] + [(1, 500), (None, -3), (88, -4)] + [(1, 501)] * 2
    a = spark.createDataFrame(left, "k int, v int").repartition(4)
    b = spark.createDataFrame(right, "j int, w int").repartition(3)
    for share in (10, 1000):
        joined = RL.join_many(a, b, [("k", "j")], share)
        assert joined.columns == ["k", "v", "j", "w"]
        assert sorted((r.v, r.w) for r in joined.collect()) == _pairs(left, right)
    heavy = {r.k: r.pieces for r in RL.heavy_keys(a.filter("k IS NOT NULL"), ["k"], 10).collect()}
    assert set(heavy) == {1} and heavy[1] == 4          # 308 of 901 rows: 10 x 308 / 901, rounded up
    # the hot key's rows lie in several cells, which are shuffled apart
    plan = _plan(RL.join_many(a, b, [("k", "j")], 10).hint("merge"))
    assert "__i" in plan and "__j" in plan and "CartesianProduct" not in plan


def test_many_to_many_join_of_empty_sides(spark):
    a = spark.createDataFrame([], "k int, v int")
    b = spark.createDataFrame([(1, 2)], "j int, w int")
    assert RL.join_many(a, b, [("k", "j")]).count() == 0
    assert RL.join_many(b, a, [("j", "k")]).columns == ["j", "w", "k", "v"]


def test_weekly_prices_meet_each_day(spark):
    prices = spark.createDataFrame([(1, 7, 100, 2.5), (1, 8, 100, 3.0), (2, 7, 101, 2.0), (2, 9, 200, 1.0)],
                                   "store_id int, item_id int, wm_yr_wk int, sell_price double")
    days = [(100 + d // 7, dt.date(1998, 1, 5) + dt.timedelta(d)) for d in range(14)]
    calendar = spark.createDataFrame(days, "wm_yr_wk int, date date")
    rows = retail.prices_by_day(prices, calendar).collect()
    assert len(rows) == 21 and rows[0].asDict().keys() == {"store_id", "item_id", "wm_yr_wk", "sell_price", "date"}
    assert sum(r.sell_price for r in rows) == 7 * 7.5


def test_nested_items_of_a_hot_order_are_bounded(spark):
    """One order has a third of all lines: no array passes the bound, and the
    checks equal those of the whole order in one array."""
    rows = [(7 if i % 3 == 0 else i % 50, i, None if i % 31 == 0 else f"SKU{i}", i % 5, Decimal(i % 700) / 1000) for i in range(3000)]
    rows += [(9999, None, None, None, None)] + [(7, 1, "SKU1", 2, Decimal("0.125"))] * 40
    lines = spark.createDataFrame(rows, "order_id long, line_no int, sku string, qty int, unit_price decimal(12,3)")
    item = F.when(F.col("line_no").isNotNull(), F.struct("sku", "qty", "unit_price"))
    pieces = V.nested_pieces(lines.repartition(4), ["order_id"], item, 50)
    assert pieces.agg(F.max(F.size("items"))).first()[0] <= 50 and pieces.filter("order_id = 7").count() >= 20
    whole = V.order_checks_nested(lines.groupBy("order_id").agg(F.collect_list(item).alias("items")))
    got = V.order_checks_pieces(pieces)
    assert got.columns == [c for c in whole.columns if c not in ("items", "first_item_error")]
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.select(*got.columns).collect()))
