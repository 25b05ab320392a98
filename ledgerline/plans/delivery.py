"""Delivery warehouse: wide order lines -> users, stores, drivers, orders,
order items (+ rejects) -> daily order and item marts (survey P1, P2)."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DecimalType, IntegerType, IntegralType, StringType, StructField,
                               StructType,
                               TimestampNTZType)

from ledgerline.functions import rules as R
from ledgerline.functions import scalars as S
from ledgerline.operators.quality import Rule, conform
from ledgerline.operators.relational import first_by_key, row_place, with_row_id
from ledgerline.session import SCRATCH_CODEC, scratch_path
from ledgerline.sources.versions import publish

# ---- fixed values --------------------------------------------------------
# Declared column types and widths of the delivery tables.
WIDE_SCHEMA = StructType([
    StructField("user_id", IntegerType()),
    StructField("user_phone", StringType()),
    StructField("store_id", IntegerType()),
    StructField("store_address", StringType()),
    StructField("driver_id", IntegerType()),
    StructField("driver_phone", StringType()),
    StructField("order_id", IntegerType()),
    StructField("address_text", StringType()),
    StructField("created_at", TimestampNTZType()),
    StructField("paid_at", TimestampNTZType()),
    StructField("delivery_started_at", TimestampNTZType()),
    StructField("delivered_at", TimestampNTZType()),
    StructField("canceled_at", TimestampNTZType()),
    StructField("payment_type", StringType()),
    StructField("order_discount", DecimalType(5, 2)),
    StructField("order_cancellation_reason", StringType()),
    StructField("delivery_cost", DecimalType(10, 2)),
    StructField("item_id", IntegerType()),
    StructField("item_title", StringType()),
    StructField("item_category", StringType()),
    StructField("item_quantity", IntegerType()),
    StructField("item_price", DecimalType(10, 2)),
    StructField("item_discount", DecimalType(5, 2)),
    StructField("item_canceled_quantity", IntegerType()),
    StructField("item_replaced_id", IntegerType()),
])
TEXT_WIDTHS = {"user_phone": 20, "driver_phone": 20, "payment_type": 50,
               "item_title": 255, "item_category": 100}
USER_COLS = ("user_id", "user_phone")
STORE_COLS = ("store_id", "store_address")
DRIVER_COLS = ("driver_id", "driver_phone")
ORDER_COLS = ("order_id", "user_id", "store_id", "driver_id", "address_text", "created_at",
              "paid_at", "delivery_started_at", "delivered_at", "canceled_at", "payment_type",
              "order_discount", "order_cancellation_reason", "delivery_cost")
ITEM_COLS = ("order_item_id", "order_id", "item_id", "item_title", "item_category",
             "item_quantity", "item_price", "item_discount", "item_canceled_quantity",
             "replaced_by_item_id")
MART_KEYS = ("year", "month", "day", "city", "store_id")


# ---- P1: load -------------------------------------------------------------

def _names(order_col: str | Sequence[str]) -> list[str]:
    return [order_col] if isinstance(order_col, str) else list(order_col)


def conform_wide(wide: DataFrame, order_col: str | Sequence[str] = "row_seq") -> DataFrame:
    """B1-B5 + R13: cast every column to its declared type with the null-safe
    coercions and attach the list of load errors (too long text, a value that
    does not fit its type) and a ``load_ok`` flag. An absent optional column
    reads as NULL. A store without address is an error only where a store id
    is given."""
    store_rule = Rule("store_address_required", "store_address: missing",
                      F.col("store_id").isNotNull() & R.required("store_address"))
    return conform(wide, WIDE_SCHEMA, TEXT_WIDTHS, keep=_names(order_col), errors="load_errors",
                   valid="load_ok", extra_rules=[store_rule])


DELIVERY_TABLES = ("users", "stores", "drivers", "orders", "order_items", "rejects")


def normalize_delivery(wide: DataFrame, order_col: str | Sequence[str] = "row_seq",
                       written: bool = True,
                       tables: tuple[str, ...] = DELIVERY_TABLES) -> dict[str, DataFrame]:
    """Wide order lines -> ``users``, ``stores``, ``drivers``, ``orders``,
    ``order_items`` and ``rejects`` (only the ``tables`` asked for).

    * a row with a load error goes to ``rejects`` with its keys and reasons
      and adds nothing anywhere (row-level quarantine);
    * dimensions and orders: first row per key in ``order_col`` order wins,
      NULL keys skipped (one shuffle per key; a hot key is cut map-side);
    * order items: every accepted row; ``order_item_id`` is the row's load
      position: ``order_col`` itself when it is one number column (like a
      sequence that also counts failed rows), else the dense rank of the
      ``order_col`` columns.
    """
    if written and len(tables) > 1:
        return split_conformed(written_conformed(wide, order_col), order_col, tables, written=True)
    return split_conformed(conform_wide(wide, order_col), order_col, tables)


def written_conformed(wide: DataFrame, order_col: str | Sequence[str] = "row_seq") -> DataFrame:
    """The conformed input, written once to the shared scratch folder: several
    outputs read it, and a lost executor does not make the wide join run again."""
    conformed = conform_wide(wide, order_col)
    path = scratch_path(wide.sparkSession, "conformed")
    conformed.write.parquet(path, compression=SCRATCH_CODEC)
    return wide.sparkSession.read.schema(conformed.schema).parquet(path)


def split_conformed(conformed: DataFrame, order_col: str | Sequence[str] = "row_seq",
                    tables: tuple[str, ...] = DELIVERY_TABLES, written: bool = False) -> dict[str, DataFrame]:
    """The P1 outputs from an already conformed wide frame (see
    :func:`normalize_delivery`); ``written``: one that is read from files, whose
    rows' places then order equal items."""
    order_cols = _names(order_col)
    ok = conformed.filter(F.col("load_ok")).drop("load_errors", "load_ok")
    order = [F.col(c) for c in order_cols]
    out: dict[str, DataFrame] = {}
    for name, key, cols in (("users", "user_id", USER_COLS), ("stores", "store_id", STORE_COLS),
                            ("drivers", "driver_id", DRIVER_COLS), ("orders", "order_id", ORDER_COLS)):
        if name in tables:
            out[name] = first_by_key(ok, [key], order, cols)
    if "order_items" in tables:
        item_cols = ["order_id", "item_id", "item_title", "item_category", "item_quantity",
                     "item_price", "item_discount", "item_canceled_quantity",
                     F.col("item_replaced_id").alias("replaced_by_item_id")]
        if len(order_cols) == 1 and isinstance(conformed.schema[order_cols[0]].dataType, IntegralType):
            out["order_items"] = ok.select(F.col(order_cols[0]).cast("long").alias("order_item_id"),
                                           *item_cols)
        else:
            # e.g. (file name, row position): dense ids in that order
            place = row_place() if written else []
            items = conformed.filter(F.col("load_ok")).select(*order_cols, *item_cols, *place)
            out["order_items"] = with_row_id(items, order_cols, "order_item_id", placed=written, drop=order_cols)
    if "rejects" in tables:
        out["rejects"] = (conformed.filter(~F.col("load_ok"))
                          .select(*order_cols, "order_id", "item_id", "load_errors"))
    return out


def load_delivery(wide: DataFrame, out_dir: str,
                  order_col: str | Sequence[str] = "row_seq") -> dict[str, str]:
    """P1 + A5: full refresh of the five tables (and rejects) under
    ``out_dir``, as one (:mod:`ledgerline.sources.versions`): readers see all old
    tables or all new ones, whatever fails. The input is checked first, so an empty
    input fails without touching the output (X5). Returns the tables' paths."""
    conformed = written_conformed(wide, order_col)
    if not conformed.limit(1).collect():
        raise ValueError("no input rows: nothing loaded, output left as it was")
    return publish(wide.sparkSession, out_dir, split_conformed(conformed, order_col, written=True))


# ---- P2: marts -------------------------------------------------------------

def _mart_keys(orders: DataFrame) -> list:
    y, m, d = S.ymd("created_at")
    return [y.alias("year"), m.alias("month"), d.alias("day"),
            S.city_of("address_text").alias("city"), F.col("store_id")]


def _item_units(items: DataFrame) -> DataFrame:
    """Line amounts as exact integers: cents x qty, and the item-discounted
    net in 1e-6 units. 64-bit integer arithmetic runs in generated code
    (38-digit decimals fall back to object arithmetic); with ANSI mode (the
    Spark default, asked for here) an overflow fails the job instead of wrapping,
    which happens only beyond ~9e11 per line or ~9e12 per order."""
    if items.sparkSession.conf.get("spark.sql.ansi.enabled") != "true":
        raise ValueError("the marts need spark.sql.ansi.enabled=true: an overflow must not wrap")
    gross = S.cents("item_price") * F.col("item_quantity").cast("long")
    return items.select("*", gross.alias("__gross_c"),
                        (gross * S.factor_units("item_discount")).alias("__net_u"))


# lo < 10^5 keeps lo x factor below 10^9 per row (no practical group size
# overflows its sum); hi x factor sums overflow only beyond decimal(15,2) range
_SPLIT = 10 ** 5


def _discounted_sum(net_units: str, order_discount: str, scale_out: str = "decimal(15,2)") -> Column:
    """Exact ``sum(net x (1 - order%))`` over the rows of a group, in integer
    arithmetic per row. ``net_units`` is a long in 1e-6 units and the factor a
    long in 1e-4 units, so each product is in 1e-10 units; to stay within 64
    bits the net is split as ``hi * 10^5 + lo`` (integer division) and both
    parts are multiplied and summed separately. The two sums meet in decimal
    once per group: ``(A * 10^5 + B) * 10^-10``, rounded half-up to cents."""
    f = S.factor_units(order_discount)
    hi = F.expr(f"`{net_units}` div {_SPLIT}")
    lo = F.col(net_units) - hi * F.lit(_SPLIT)
    a = F.sum(hi * f).cast("decimal(19,0)")
    b = F.sum(lo * f).cast("decimal(19,0)")
    units = (a * F.lit(_SPLIT).cast("decimal(6,0)") + b).cast("decimal(27,0)")
    return (units * F.lit(Decimal("1E-10")).cast("decimal(10,10)")).cast(scale_out)


def order_mart(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Daily order mart by (year, month, day, city, store).

    ``orders`` holds one row per order_id (its primary key). Items are first
    summed per order (map-side combined), so the join is 1:1 on order_id and a
    hot order cannot skew it; every order-level count is then a plain count,
    and only customers need a distinct count. All arithmetic is exact: the
    item sums in integer units, the order discount in decimal on the order
    rows; the sums are rounded once, to decimal(15,2)."""
    per_order = _item_units(items).groupBy("order_id").agg(
        F.sum("__gross_c").alias("__gross_c"),
        F.sum("__net_u").alias("__net_u"),
    )
    j = orders.join(per_order, "order_id", "left")
    return (j.groupBy(*_mart_keys(orders)).agg(
        S.units_to_decimal(F.sum("__gross_c"), 2, 15).alias("turnover"),
        _discounted_sum("__net_u", "order_discount").alias("revenue"),
        F.count("order_id").cast("int").alias("orders_created"),
        F.count(F.when(F.col("delivered_at").isNotNull(), F.col("order_id"))).cast("int")
        .alias("orders_delivered"),
        F.count(F.when(F.col("canceled_at").isNotNull(), F.col("order_id"))).cast("int")
        .alias("orders_canceled"),
        F.count_distinct("user_id").cast("int").alias("unique_customers"),
    ))


def _order_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with their items, combined map-side per (order, category, item, title); an
    order without items is one row with NULL item keys."""
    item_keys = ["item_category", "item_id", "item_title"]
    per_oi = _item_units(items).groupBy("order_id", *item_keys).agg(
        F.sum("__net_u").alias("__net_u"),
        F.sum("item_quantity").alias("__qty"),
        F.sum("item_canceled_quantity").alias("__canc"),
        F.max(F.when(F.col("item_canceled_quantity") > 0, 1).otherwise(0)).alias("__has_cancel"),
    )
    # inner join + orders without items: both sides of an inner join can be
    # split, so an order with very many items does not stay in one task
    with_items = orders.join(per_oi, "order_id")
    bare = orders.join(items.select("order_id").distinct(), "order_id", "left_anti")
    return with_items.unionByName(bare, allowMissingColumns=True)


def _item_groups(rows: DataFrame, *also: str) -> DataFrame:
    keys = _mart_keys(rows) + [F.col("item_category").alias("category"), F.col("item_id"),
                               F.col("item_title")]
    return (rows.groupBy(*keys, *also).agg(
        _discounted_sum("__net_u", "order_discount").alias("item_turnover"),
        F.sum("__qty").cast("int").alias("quantity_ordered"),
        F.sum("__canc").cast("int").alias("quantity_canceled"),
        F.count("order_id").cast("int").alias("orders_with_item"),
        F.count(F.when(F.col("__has_cancel") > 0, 1)).cast("int").alias("orders_with_cancel"),
    ).drop(*also))


def item_mart(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Daily item mart by the order-mart keys + (category, item, title).

    Items are first combined per (order, category, item, title) map-side, so
    each order appears once per item group: ``orders_with_item`` and
    ``orders_with_cancel`` become plain counts (no distinct expansion). An
    order without items gives one row with NULL item keys, counted once."""
    return _item_groups(_order_items(orders, items))


def item_mart_by(orders: DataFrame, items: DataFrame) -> DataFrame:
    """The item mart by one shuffle that suits its writing by day: ``orders`` also have a
    ``day`` (or another truncation of their time) and in how many ``__parts`` its items are
    dealt. A part is in one task, and so are the groups in it."""
    dealt = _order_items(orders, items).withColumn(
        "__part", F.pmod(F.xxhash64("item_category", "item_id", "item_title"), "__parts").cast("int"))
    # few columns move; grouping before would give no fewer rows
    moved = dealt.select("order_id", "created_at", "address_text", "store_id", "order_discount", "item_category",
                         "item_id", "item_title", "__net_u", "__qty", "__canc", "__has_cancel",
                         F.col("day").alias("__day"), "__part").withColumn(
        "address_text", S.city_of("address_text")).repartition("__day", "__part")
    return _item_groups(moved, "__day", "__part")


def build_marts(orders: DataFrame, items: DataFrame, out_dir: str | None = None,
                partition_by: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Both marts, order mart first. With ``out_dir`` they are refreshed as
    one, optionally partitioned (e.g. by year, month); ``read_published`` reads
    them. ``out_dir`` may be the folder of the loaded tables, which stay."""
    marts = {"order_mart": order_mart(orders, items), "item_mart": item_mart(orders, items)}
    if out_dir:
        publish(orders.sparkSession, out_dir, marts, {name: partition_by for name in marts})
    return marts
