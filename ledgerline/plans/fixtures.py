"""Adapters: the reference's input shapes derived from the driver tables
(see FIXTURES.md §2). Each is a lazy DataFrame over the whole tables; the
joins are left to Catalyst/AQE (nation and region are 25 and 5 rows and get
broadcast by size; lineitem x orders is a shuffle join on the order key)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.relational import with_row_id
from ledgerline.plans.tables import load

# ---- fixed values --------------------------------------------------------
# Fixed values of the adapters (FIXTURES.md §2).
STATUS_DELIVERED, STATUS_CANCELED = "F", "P"
LONG_DATE_FORMAT = "MMMM d, yyyy"
CREDIT_STATUS = ("no checking account", "0<= ... < 200 DM",
                 "... >= 200 DM / salary for at least 1 year", "... < 0 DM")
CREDIT_SAVINGS = {"AUTOMOBILE": "unknown/no savings account", "BUILDING": "... <  100 DM",
                  "FURNITURE": "100 <= ... <  500 DM", "HOUSEHOLD": "500 <= ... < 1000 DM",
                  "MACHINERY": "100 <= ... <  500 DM"}
FIRST_WINS_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    "l_quantity", "l_extendedprice", "l_shipdate")
# the load order travels as flat columns (a struct sort key loses the
# prefix sort and compares row by row)
LOAD_ORDER = tuple(f"load_{c[2:]}" for c in FIRST_WINS_ORDER)


def _t(spark, sf, name):
    return load(spark, sf, name)


def _geo(spark: SparkSession, sf: str) -> DataFrame:
    """customer with its nation and region."""
    c = _t(spark, sf, "customer")
    n = _t(spark, sf, "nation")
    r = _t(spark, sf, "region")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
            .join(r, n.n_regionkey == r.r_regionkey))


def _order_columns(o_status, o_orderdate, o_orderkey) -> list:
    return [
        o_orderdate.alias("created_at"),
        F.when(o_status == STATUS_DELIVERED, o_orderdate).alias("delivered_at"),
        F.when(o_status == STATUS_CANCELED, o_orderdate).alias("canceled_at"),
        (F.when(o_orderkey % 4 == 0, F.lit(10))
         .when(o_orderkey % 4 == 1, F.lit(2.5))).cast("decimal(5,2)").alias("order_discount"),
    ]


def delivery_wide(spark: SparkSession, sf: str, with_seq: bool = False) -> DataFrame:
    """One row per order line: the wide input of the delivery load.
    The ``load_*`` columns give the total load order (the line's sort
    columns); first-wins needs only that order. ``with_seq`` adds its dense
    rank ``row_seq`` 1..n (a distributed sort, see ``with_row_id``)."""
    l = _t(spark, sf, "lineitem")
    o = _t(spark, sf, "orders")
    p = _t(spark, sf, "part")
    s = _t(spark, sf, "supplier")
    g = _geo(spark, sf)
    j = (l.join(o, l.l_orderkey == o.o_orderkey)
         .join(g, F.col("o_custkey") == F.col("c_custkey"))
         .join(p, l.l_partkey == p.p_partkey)
         .join(s, l.l_suppkey == s.s_suppkey))
    null_ts = F.lit(None).cast("timestamp_ntz")
    cols = [
        F.col("l_orderkey").cast("int").alias("order_id"),
        F.col("o_custkey").cast("int").alias("user_id"),
        F.col("c_name").alias("user_phone"),
        F.col("c_nationkey").alias("store_id"),
        F.concat(F.col("n_name"), F.lit(", "), F.col("r_name")).alias("store_address"),
        F.when(F.col("o_orderstatus") != STATUS_CANCELED, F.col("l_suppkey").cast("int")).alias("driver_id"),
        F.col("s_name").alias("driver_phone"),
        F.concat(F.col("r_name"), F.lit(", "), F.col("n_name"), F.lit(", "), F.col("c_name")).alias("address_text"),
        *_order_columns(F.col("o_orderstatus"), F.col("o_orderdate"), F.col("o_orderkey")),
        null_ts.alias("paid_at"),
        null_ts.alias("delivery_started_at"),
        F.col("o_orderpriority").alias("payment_type"),
        F.lit(None).cast("string").alias("order_cancellation_reason"),
        F.lit(None).cast("decimal(10,2)").alias("delivery_cost"),
        F.col("l_partkey").cast("int").alias("item_id"),
        F.col("p_name").alias("item_title"),
        F.col("p_type").alias("item_category"),
        F.col("l_quantity").cast("int").alias("item_quantity"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("item_price"),
        F.when(F.col("l_discount") > 0, F.round(F.col("l_discount") * 100))
        .cast("decimal(5,2)").alias("item_discount"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("item_canceled_quantity"),
        F.lit(None).cast("int").alias("item_replaced_id"),
    ]
    out = j.select(*cols, *[F.col(c).alias(a) for c, a in zip(FIRST_WINS_ORDER, LOAD_ORDER)])
    if not with_seq:
        return out
    return with_row_id(out, list(LOAD_ORDER), out="row_seq")


def mart_orders(spark: SparkSession, sf: str) -> DataFrame:
    """All orders (also those without lines) with the order columns the
    marts read."""
    o = _t(spark, sf, "orders")
    g = _geo(spark, sf)
    j = o.join(g, o.o_custkey == g.c_custkey)
    return j.select(
        F.col("o_orderkey").cast("int").alias("order_id"),
        F.col("o_custkey").cast("int").alias("user_id"),
        F.col("c_nationkey").alias("store_id"),
        F.concat(F.col("r_name"), F.lit(", "), F.col("n_name"), F.lit(", "), F.col("c_name")).alias("address_text"),
        *_order_columns(F.col("o_orderstatus"), F.col("o_orderdate"), F.col("o_orderkey")),
    )


def mart_items(spark: SparkSession, sf: str) -> DataFrame:
    """Order item rows (the item columns of the wide input)."""
    l = _t(spark, sf, "lineitem")
    p = _t(spark, sf, "part")
    j = l.join(p, l.l_partkey == p.p_partkey)
    return j.select(
        F.col("l_orderkey").cast("int").alias("order_id"),
        F.col("l_partkey").cast("int").alias("item_id"),
        F.col("p_name").alias("item_title"),
        F.col("p_type").alias("item_category"),
        F.col("l_quantity").cast("int").alias("item_quantity"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("item_price"),
        F.when(F.col("l_discount") > 0, F.round(F.col("l_discount") * 100))
        .cast("decimal(5,2)").alias("item_discount"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("item_canceled_quantity"),
    )


def _week_id(d):
    return (F.year(d) * 100 + F.weekofyear(d)).cast("int")


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct order dates with week id, weekday name, month, year."""
    d = F.col("o_orderdate").cast("date")
    return (_t(spark, sf, "orders")
            .select(d.alias("date"), _week_id(d).alias("wm_yr_wk"),
                    F.date_format(d, "EEEE").alias("weekday"),
                    F.month(d).alias("month"), F.year(d).alias("year"))
            .distinct())


def prices(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly sell price per (store, item)."""
    l = _t(spark, sf, "lineitem")
    p = _t(spark, sf, "part")
    d = F.col("l_shipdate").cast("date")
    return (l.join(p, l.l_partkey == p.p_partkey)
            .select(F.col("l_suppkey").cast("int").alias("store_id"),
                    F.col("l_partkey").cast("int").alias("item_id"),
                    _week_id(d).alias("wm_yr_wk"),
                    (F.col("p_retailprice") / 100).alias("sell_price"))
            .distinct())


def sales(spark: SparkSession, sf: str, days: int = 12) -> DataFrame:
    """Wide daily sales per (item, dept, cat, store, state): d_k = units
    shipped in month k."""
    l = _t(spark, sf, "lineitem")
    p = _t(spark, sf, "part")
    o = _t(spark, sf, "orders")
    g = _geo(spark, sf)
    j = (l.join(p, l.l_partkey == p.p_partkey)
         .join(o, l.l_orderkey == o.o_orderkey)
         .join(g, F.col("o_custkey") == F.col("c_custkey")))
    m = F.month("l_shipdate")
    return (j.groupBy(F.col("l_partkey").cast("int").alias("item_id"),
                      F.col("p_brand").alias("dept_id"),
                      F.col("p_type").alias("cat_id"),
                      F.col("c_nationkey").alias("store_id"),
                      F.col("r_name").alias("state_id"))
            .agg(*[F.sum(F.when(m == k, F.col("l_quantity")).otherwise(F.lit(0.0)))
                   .cast("int").alias(f"d_{k}") for k in range(1, days + 1)]))


def transactions_text(spark: SparkSession, sf: str) -> DataFrame:
    """The transactions CSV as it reads without a schema: all text."""
    e = _t(spark, sf, "events")
    return e.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").cast("string").alias("timestamp"),
        (F.col("event_id") % 50).cast("string").alias("item_id"),
        F.col("event_type").alias("category"),
        F.col("value").cast("string").alias("price"),
        (F.col("event_id") % 5 + 1).cast("string").alias("quantity"),
        F.concat(F.lit("city_"), (F.col("user_id") % 7).cast("string")).alias("city"),
    )


TRANSACTIONS_SCHEMA = ("user_id bigint, timestamp timestamp_ntz, item_id int, category string, "
                       "price double, quantity int, city string")


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    """Typed transactions (explicit schema instead of all-text columns)."""
    e = _t(spark, sf, "events")
    return e.select(
        F.col("user_id").alias("user_id"),
        F.col("ts").alias("timestamp"),
        (F.col("event_id") % 50).cast("int").alias("item_id"),
        F.col("event_type").alias("category"),
        F.col("value").alias("price"),
        (F.col("event_id") % 5 + 1).cast("int").alias("quantity"),
        F.concat(F.lit("city_"), (F.col("user_id") % 7).cast("string")).alias("city"),
    )


def credit(spark: SparkSession, sf: str) -> DataFrame:
    c = _t(spark, sf, "customer")
    return c.select(
        F.col("c_custkey").alias("client_id"),
        F.element_at(F.array(*map(F.lit, CREDIT_STATUS)), (F.col("c_custkey") % 4 + 1).cast("int")).alias("status"),
        F.element_at(F.create_map(*[F.lit(x) for pair in CREDIT_SAVINGS.items() for x in pair]),
                     F.col("c_mktsegment")).alias("savings"),
        F.when(F.col("c_acctbal") >= 1000, "good").otherwise("bad").alias("credit_risk"),
        F.when(F.col("c_custkey") % 37 != 0, (F.lit(18) + F.col("c_custkey") % 60).cast("int")).alias("age"),
        F.abs(F.col("c_acctbal")).alias("amount"),
        (F.lit(4) + F.col("c_custkey") % 69).cast("int").alias("duration"),
    )


def titles(spark: SparkSession, sf: str) -> DataFrame:
    o = _t(spark, sf, "orders")
    k = F.col("o_orderkey")
    is_movie = (k % 10) < 7
    return o.select(
        k.alias("show_id"),
        F.when(is_movie, "Movie").otherwise("TV Show").alias("type"),
        F.when(k % 5 != 0, F.col("o_orderpriority")).alias("director"),
        F.when(F.col("o_custkey") % 11 != 0,
               F.concat(F.lit("country_"), (F.col("o_custkey") % 17).cast("string"))).alias("country"),
        (F.when(k % 13 == 0, F.lit(None).cast("string"))
         .when(k % 29 == 0, F.lit("unknown"))
         .otherwise(F.date_format(F.col("o_orderdate"), LONG_DATE_FORMAT))).alias("date_added"),
        (F.when(k % 6 == 0, F.lit("TV-MA"))
         .when(k % 400 == 1, F.lit("NC-17"))
         .otherwise(F.col("o_orderpriority"))).alias("rating"),
        (F.when(k % 31 == 0, F.lit(None).cast("string"))
         .when(is_movie, F.concat((F.lit(40) + k % 120).cast("string"), F.lit(" min")))
         .otherwise(F.concat((F.lit(1) + k % 9).cast("string"), F.lit(" Seasons")))).alias("duration"),
    )


def energy(spark: SparkSession, sf: str) -> DataFrame:
    e = _t(spark, sf, "events")
    return e.select(
        F.col("ts").alias("timestep"),
        F.col("value").alias("consumption_eur"),
        (F.col("value") / 2).alias("consumption_sib"),
        F.col("user_id").cast("double").alias("price_eur"),
        (F.col("value") - 5).alias("price_sib"),
    )


def energy_text(spark: SparkSession, sf: str) -> DataFrame:
    """Energy records as they come in: the time as text, not always one, and
    measures that may be negative."""
    e = _t(spark, sf, "events")
    k = F.col("event_id")

    def sign(n: int) -> Column:
        return F.when(k % n == 0, F.lit(-1.0)).otherwise(F.lit(1.0))

    return e.select(
        k.alias("event_id"),
        F.when(k % 71 == 0, F.lit("yesterday")).otherwise(F.col("ts").cast("string")).alias("timestep"),
        (F.col("value") * sign(43)).alias("consumption_eur"),
        (F.col("value") / 2 * sign(47)).alias("consumption_sib"),
        (F.col("user_id") * sign(53)).alias("price_eur"),
        (F.col("value") - 5).alias("price_sib"),
    )


def _uuid_text(k: Column) -> Column:
    """A UUID-like id from a key, for every 31st not one."""
    text = F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(k.cast("string"), 12, "0"))
    return F.when(k % 31 == 0, F.concat(F.lit("user "), k.cast("string"))).otherwise(text)


def raw_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as they come in: some names missing, some prices too large."""
    k = F.col("p_partkey")
    return _t(spark, sf, "part").select(
        k.alias("p_partkey"), F.when(k % 11 != 0, F.col("p_name")).alias("p_name"),
        (F.col("p_retailprice") * F.when(k % 9 == 0, F.lit(10.0)).otherwise(F.lit(1.0))).alias("p_retailprice"))


def signup(spark: SparkSession, sf: str) -> DataFrame:
    c = _t(spark, sf, "customer")
    k = F.col("c_custkey")
    email = F.concat(
        F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("_"))),
        F.when(k % 23 == 0, F.lit("")).otherwise(F.lit("@")),
        F.lit("mail"), (k % 5).cast("string"), F.lit(".example.com"))
    return c.select(
        k.alias("user_key"),
        _uuid_text(k).alias("id"),
        email.alias("email"),
        F.concat(F.lit("  cUSTOMER   "), F.lower(F.col("c_mktsegment")), F.lit(" x")).alias("name"),
        F.substr(F.lit("abcdefghijklmnop"), F.lit(1), (k % 12 + 1).cast("int")).alias("password"),
        F.when(k % 41 == 0, F.lit("ftp://files.example.com"))
        .when(k % 3 != 0, F.concat(F.lit("https://www.mail"), (k % 7).cast("string"),
                                   F.lit(".example.com/x"))).alias("website"),
    )


def order_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Flat order lines: one row per line, and one row with NULL line columns
    for an order without lines. Some values are missing or break a rule."""
    o = _t(spark, sf, "orders")
    l = _t(spark, sf, "lineitem")
    k, p, u = F.col("o_orderkey"), F.col("l_partkey"), F.col("o_custkey")
    status = (F.when(F.col("o_orderstatus") == "P", "paid")
              .when(F.col("o_orderstatus") == "F", "delivered")
              .when(k % 19 == 0, "lost").otherwise("new"))
    email = F.when(u % 29 != 0, F.concat(F.lit("user"), u.cast("string"),
                                         F.when(u % 17 == 0, F.lit(" at ")).otherwise(F.lit("@")),
                                         F.lit("mail.example.com")))
    orders = o.select(k.alias("order_id"), _uuid_text(u).alias("user_id"), email.alias("user_email"),
                      status.alias("status"))
    text = p.cast("string")
    sku = (F.when(p % 47 == 0, F.lit(None).cast("string"))
           .when(p % 50 == 0, F.concat(F.lit("sku-"), text))
           .when(p % 41 == 0, F.concat(F.lit("K"), (p % 10).cast("string")))
           .when(p % 43 == 0, F.concat(F.lit("SKU"), F.lpad(text, 10, "0")))
           .otherwise(F.concat(F.lit("SKU"), text)))
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint") % 100000
    unit_price = (cents * F.lit(0.001).cast("decimal(4,3)")).cast("decimal(12,3)")
    lines = l.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"), sku.alias("sku"),
        F.when(p % 53 != 0, F.col("l_quantity").cast("int") - 1).alias("qty"),
        F.when(p % 37 == 0, -unit_price).when(p % 59 != 0, unit_price).alias("unit_price"))
    # inner join + orders without lines: a hot order can be split
    bare = orders.join(l.select(F.col("l_orderkey").alias("order_id")).distinct(), "order_id", "left_anti")
    return orders.join(lines, "order_id").unionByName(bare, allowMissingColumns=True)
