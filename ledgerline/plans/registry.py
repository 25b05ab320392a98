"""The query register: one callable ``(spark, sf_dir) -> DataFrame`` per
query name of the survey; each reads the whole input tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DecimalType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType)

from ledgerline.functions import coerce as C
from ledgerline.functions import rules as RU
from ledgerline.functions import scalars as SC
from ledgerline.operators import quality as Q
from ledgerline.operators import relational as RL
from ledgerline.operators import schema_rules as SR
from ledgerline.operators import aggregates as AG
from ledgerline.operators import selection as SEL
from ledgerline.plans import delivery, retail
from ledgerline.plans import explore as X
from ledgerline.plans import fixtures as FX
from ledgerline.plans import mart_refresh as MR
from ledgerline.plans import records as REC
from ledgerline.plans import transactions as TX
from ledgerline.plans import validation as V
from ledgerline.plans.tables import load
from ledgerline.session import scratch_path
from ledgerline.sources import files as IO
from ledgerline.sources.versions import read_published
from ledgerline.streaming import intake as ST

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        return fn
    return deco


# ---- delivery marts (P2) ---------------------------------------------------

@query("order_mart")
def q_order_mart(spark, sf):
    return delivery.order_mart(FX.mart_orders(spark, sf), FX.mart_items(spark, sf))


@query("item_mart")
def q_item_mart(spark, sf):
    return delivery.item_mart(FX.mart_orders(spark, sf), FX.mart_items(spark, sf))


# ---- sources and sinks (A) -----------------------------------------------


NATION_SCHEMA = StructType([
    StructField("n_nationkey", IntegerType()),
    StructField("n_name", StringType()),
    StructField("n_regionkey", IntegerType()),
    StructField("n_comment", StringType()),      # optional: absent from the files
])
PART_NAME_WIDTH = 10
PART_SCHEMA = StructType([
    StructField("p_partkey", IntegerType()),
    StructField("p_name", StringType()),
    StructField("p_retailprice", DecimalType(5, 2)),
])


@query("scan_parquet")
def q_scan_parquet(spark, sf):
    return IO.scan_parquet(spark, f"{sf}/lineitem.parquet")


@query("scan_dir")
def q_scan_dir(spark, sf):
    df = IO.scan_parquet_dir(spark, sf, NATION_SCHEMA, glob="n*.parquet")
    return df.select("n_nationkey", "n_name", "n_regionkey", "n_comment",
                     "_file_name", F.col("_row_index").cast("bigint").alias("_row_index"))


@query("sink_overwrite")
def q_sink_overwrite(spark, sf):
    """Full refresh: the order mart written twice to the same place
    (partitioned by year), read back once."""
    mart = delivery.order_mart(FX.mart_orders(spark, sf), FX.mart_items(spark, sf))
    path = scratch_path(spark, "sink_overwrite")
    IO.write_table(mart.filter(F.col("year") % 2 == 0), path, partition_by=("year",))     # an older state
    IO.write_table(mart, path, partition_by=("year",))
    back = spark.read.parquet(path)
    return back.select(*mart.columns)


@query("safe_casts")
def q_safe_casts(spark, sf):
    o = load(spark, sf, "orders")
    st = dict(o.dtypes)
    return o.select(
        F.col("o_orderkey"),
        C.safe_int(F.col("o_orderkey").cast("string")).alias("key_from_text"),
        C.safe_int(F.concat(F.col("o_orderkey").cast("string"), F.lit("x"))).alias("key_from_bad_text"),
        C.safe_int(F.col("o_totalprice") / 1000, o.schema["o_totalprice"].dataType).alias("total_k_int"),
        C.safe_int(F.col("o_totalprice") * 100000, o.schema["o_totalprice"].dataType).alias("total_overflow_int"),
        C.safe_float(F.col("o_totalprice").cast("string")).alias("total_from_text"),
        C.safe_decimal(F.col("o_totalprice") / 100, 5, 2, o.schema["o_totalprice"].dataType).alias("total_dec"),
        C.safe_str(F.when(F.col("o_orderstatus") == "P", F.lit("NaT"))
                   .otherwise(F.col("o_orderstatus"))).alias("status_text"),
        C.safe_ts(F.when(F.col("o_orderstatus") == "O", F.lit("NaT"))
                  .otherwise(F.col("o_orderdate").cast("string"))).alias("created_ts"),
    )


def _conformed_parts(spark, sf):
    return Q.conform(FX.raw_parts(spark, sf), PART_SCHEMA, widths={"p_name": PART_NAME_WIDTH},
                     required=["p_name"], keep=[], errors="errors", valid="ok")


@query("conform_schema")
def q_conform_schema(spark, sf):
    c = _conformed_parts(spark, sf)
    return c.filter(F.col("ok")).drop("errors", "ok")


@query("load_rejects")
def q_load_rejects(spark, sf):
    c = _conformed_parts(spark, sf)
    rej = c.filter(~F.col("ok"))
    raw = FX.raw_parts(spark, sf).select(F.col("p_partkey").cast("int").alias("p_partkey"),
                                         F.col("p_retailprice").alias("raw_price"))
    return (rej.select("p_partkey", F.element_at("errors", 1).alias("reason"))
            .join(raw, "p_partkey"))


CSV_TYPES = StructType([StructField("event_id", LongType()), StructField("category", StringType()),
                        StructField("price", DoubleType()), StructField("day", DateType())])


def _broken_csv(spark, sf) -> str:
    """Events as CSV lines; some have a wrong value, too few or too many cells."""
    e = load(spark, sf, "events")
    k = F.col("event_id")
    price = F.when(k % 53 == 0, "n/a").otherwise((k % 1000).cast("string"))
    day = F.when(k % 67 == 0, "1998-13-01").otherwise("1998-01-31")
    line = F.concat_ws(",", k.cast("string"), F.concat(F.lit('"'), "event_type", F.lit(', x"')), price)
    line = F.when(k % 59 == 0, line).when(k % 61 == 0, F.concat_ws(",", line, day, F.lit("more"))).otherwise(F.concat_ws(",", line, day))
    path = scratch_path(spark, "broken_csv")
    e.select(line.alias("value")).write.text(path)
    return path


@query("scan_csv_rejects")
def q_scan_csv_rejects(spark, sf):
    """A3: lines that don't fit their declared types, with the reasons."""
    return IO.scan_csv_checked(spark, _broken_csv(spark, sf), CSV_TYPES, header=False)[1].select("line", "reasons")


@query("scan_csv_accepted")
def q_scan_csv_accepted(spark, sf):
    """A3: the rows that do fit."""
    return IO.scan_csv_checked(spark, _broken_csv(spark, sf), CSV_TYPES, header=False)[0]


@query("scan_csv_infer")
def q_scan_csv_infer(spark, sf):
    """A4: the transactions read back with inferred types."""
    path = scratch_path(spark, "transactions_infer")
    IO.write_csv(FX.transactions_text(spark, sf), path, drop=())
    return IO.scan_csv(spark, path, infer=True).select(
        F.col("user_id").cast("bigint"), "item_id", "category", "price", "quantity", "city")


@query("write_csv_without_id")
def q_write_csv_without_id(spark, sf):
    """Numbered records written as a CSV without their ids, read back."""
    path = scratch_path(spark, "records_csv")
    IO.write_csv(REC.with_ids(FX.energy(spark, sf)), path)
    return IO.scan_csv(spark, path, ENERGY_SCHEMA)


@query("preview")
def q_preview(spark, sf):
    """The five latest orders."""
    return IO.preview(load(spark, sf, "orders").select("o_orderkey", "o_orderdate"), 5,
                      [F.col("o_orderdate").desc(), F.col("o_orderkey")])


@query("has_key")
def q_has_key(spark, sf):
    """The customers that have an order."""
    keys = load(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return RL.has_key(load(spark, sf, "orders"), keys, "o_custkey")


# a schema document of the orders table; some rows break it on purpose
ORDERS_DOCUMENT = """
{"title": "Order", "type": "object", "required": ["o_orderkey", "o_custkey", "o_comment"],
 "$defs": {"Status": {"type": "string", "enum": ["F", "O"]}},
 "properties": {
   "o_orderkey": {"type": "integer", "minimum": 0},
   "o_custkey": {"type": "integer", "exclusiveMinimum": 0},
   "o_orderstatus": {"$ref": "#/$defs/Status"},
   "o_totalprice": {"type": "number", "minimum": 1000, "exclusiveMaximum": 300000},
   "o_orderpriority": {"anyOf": [{"type": "string", "pattern": "^[1-4]-", "maxLength": 12}, {"type": "null"}]},
   "o_comment": {"type": "string"}}}
"""


@query("schema_summary")
def q_schema_summary(spark, sf):
    """V4: what the orders document says of each field, and how many rows of
    the orders table break it."""
    return SR.schema_summary(load(spark, sf, "orders"), ORDERS_DOCUMENT)


@query("build_marts")
def q_build_marts(spark, sf):
    """Both marts written, their totals read back."""
    out = scratch_path(spark, "marts")
    delivery.build_marts(FX.mart_orders(spark, sf), FX.mart_items(spark, sf), out)
    a = read_published(spark, out, "order_mart").agg(
        F.sum("revenue").cast("decimal(20,2)").alias("amount"), F.count("*").alias("n"))
    b = read_published(spark, out, "item_mart").agg(
        F.sum("item_turnover").cast("decimal(20,2)").alias("amount"), F.count("*").alias("n"))
    return a.select(F.lit("order_mart").alias("mart"), "amount", "n").unionByName(
        b.select(F.lit("item_mart").alias("mart"), "amount", "n"))


def _marts_by_load(spark, sf, name: str) -> DataFrame:
    """The orders up to 2000, without the items of every 50th order, are one load; later
    orders and the late items are the next. By month, as a day has few orders."""
    root = scratch_path(spark, "marts-by-load")
    orders, items = FX.mart_orders(spark, sf), FX.mart_items(spark, sf)
    early, late = F.col("created_at") < F.lit("2001-01-01").cast("timestamp_ntz"), F.col("order_id") % 50 == 0
    buckets = MR.buckets_for(spark, f"{sf}/orders.parquet", f"{sf}/lineitem.parquet")
    for n, (some_orders, some_items) in enumerate(((early, ~late), (~early, late)), 1):
        MR.store_load(spark, root, n, orders.filter(some_orders), items.filter(some_items), "month", buckets)
        MR.refresh_marts(spark, root, n, orders.schema, items.schema, "month")
    return MR.read_mart(spark, root, name, orders.schema, items.schema, "month")


@query("order_mart_by_load")
def q_order_mart_by_load(spark, sf):
    return _marts_by_load(spark, sf, "order_mart")


@query("item_mart_by_load")
def q_item_mart_by_load(spark, sf):
    return _marts_by_load(spark, sf, "item_mart")


@query("refresh_tables")
def q_refresh_tables(spark, sf):
    """P1 + A5: an older state is loaded, then the whole input as one
    refresh; each table's rows, read through the latest manifest."""
    out = scratch_path(spark, "refresh")
    wide = FX.delivery_wide(spark, sf)
    delivery.load_delivery(wide.filter(F.col("order_id") % 4 == 0), out, FX.LOAD_ORDER)
    delivery.load_delivery(wide, out, FX.LOAD_ORDER)
    rows = None
    for name in delivery.DELIVERY_TABLES:
        n = read_published(spark, out, name).agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows"))
        rows = n if rows is None else rows.unionByName(n)
    return rows


@query("delivery_rejects")
def q_delivery_rejects(spark, sf):
    """Wide rows that the load turns away, where every 97th order has a
    payment type that is too long."""
    wide = FX.delivery_wide(spark, sf).withColumn(
        "payment_type", F.when(F.col("order_id") % 97 == 0, F.repeat(F.lit("x"), 51)).otherwise(F.col("payment_type")))
    return delivery.normalize_delivery(wide, FX.LOAD_ORDER, tables=("rejects",))["rejects"] \
        .select("order_id", "item_id", "load_errors")


# ---- delivery load (P1) ----------------------------------------------------

def _p1(spark, sf, table):
    wide = FX.delivery_wide(spark, sf)
    return delivery.normalize_delivery(wide, FX.LOAD_ORDER, written=False, tables=(table,))[table]


@query("dim_users")
def q_dim_users(spark, sf):
    return _p1(spark, sf, "users")


@query("dim_stores")
def q_dim_stores(spark, sf):
    return _p1(spark, sf, "stores")


@query("dim_drivers")
def q_dim_drivers(spark, sf):
    return _p1(spark, sf, "drivers")


@query("fact_orders")
def q_fact_orders(spark, sf):
    return _p1(spark, sf, "orders")


@query("fact_items")
def q_fact_items(spark, sf):
    return _p1(spark, sf, "order_items")


@query("insert_new_keys")
def q_insert_new_keys(spark, sf):
    """Users already stored: customers with an even key; the load adds the
    users of the wide input whose key is new (first row wins)."""
    c = load(spark, sf, "customer")
    existing = c.filter(F.col("c_custkey") % 2 == 0).select(
        F.col("c_custkey").cast("int").alias("user_id"), F.col("c_name").alias("user_phone"))
    wide = FX.delivery_wide(spark, sf)
    incoming = RL.first_by_key(wide, ["user_id"], list(FX.LOAD_ORDER), ["user_id", "user_phone"])
    return RL.insert_new(existing, incoming, ["user_id"])


@query("fk_orphans")
def q_fk_orphans(spark, sf):
    """Orders whose user is not among the customers with a non-negative
    balance."""
    parents = (load(spark, sf, "customer").filter(F.col("c_acctbal") >= 0)
               .select(F.col("c_custkey").cast("int").alias("user_id")))
    orders = FX.mart_orders(spark, sf).select("order_id", "user_id")
    return RL.check_fk(orders, parents, "user_id")


@query("pk_violations")
def q_pk_violations(spark, sf):
    li = load(spark, sf, "lineitem")
    return RL.check_unique(li, ["l_orderkey", "l_linenumber"], out="n_rows")


# ---- retail tasks (calendar, sales, prices) -------------------------------


# Parameters of the registered retail queries (the reference's state and
# January period, mapped onto the fixture's regions and years).
STATE = "AMERICA"
PERIOD = ("1998-01-01", "1998-01-31")


@query("weekend_flag")
def q_weekend_flag(spark, sf):
    return retail.weekend_flag(FX.calendar(spark, sf))


@query("rename_week")
def q_rename_week(spark, sf):
    return retail.rename_week(FX.calendar(spark, sf))


@query("distinct_weekdays")
def q_distinct_weekdays(spark, sf):
    return retail.distinct_weekdays(FX.calendar(spark, sf))


@query("n_stores")
def q_n_stores(spark, sf):
    return retail.n_stores(FX.sales(spark, sf))


@query("avg_sales_by_category")
def q_avg_sales_by_category(spark, sf):
    return retail.avg_sales_by_category(FX.sales(spark, sf))


@query("price_int")
def q_price_int(spark, sf):
    return retail.price_int(FX.prices(spark, sf))


@query("top_prices")
def q_top_prices(spark, sf):
    return retail.top_prices(FX.prices(spark, sf))


@query("sql_avg_by_state")
def q_sql_avg_by_state(spark, sf):
    return retail.sql_avg_by_state(FX.sales(spark, sf))


@query("filter_state")
def q_filter_state(spark, sf):
    return retail.filter_state(FX.sales(spark, sf), STATE)


@query("top_prices_in_period")
def q_top_prices_in_period(spark, sf):
    return retail.top_prices_in_period(FX.prices(spark, sf), FX.calendar(spark, sf), *PERIOD)


@query("prices_by_day")
def q_prices_by_day(spark, sf):
    """Each weekly price with every day of its week."""
    return retail.prices_by_day(FX.prices(spark, sf), FX.calendar(spark, sf))


@query("top_sales_per_category")
def q_top_sales_per_category(spark, sf):
    return retail.top_sales_per_category(FX.sales(spark, sf))


@query("price_category")
def q_price_category(spark, sf):
    return retail.price_category(FX.prices(spark, sf))


@query("sum_sales_by_store")
def q_sum_sales_by_store(spark, sf):
    return retail.sum_sales_by_store(FX.sales(spark, sf))


# ---- transactions ---------------------------------------------------------

@query("scan_csv_roundtrip")
def q_scan_csv_roundtrip(spark, sf):
    """The transactions written as a CSV with a header, read back with an
    explicit schema."""
    path = scratch_path(spark, "transactions_csv")
    IO.write_csv(FX.transactions_text(spark, sf), path, drop=())
    return IO.scan_csv(spark, path, FX.TRANSACTIONS_SCHEMA)


@query("top_categories")
def q_top_categories(spark, sf):
    return TX.top_categories(FX.transactions(spark, sf))


@query("multi_category_users")
def q_multi_category_users(spark, sf):
    return TX.multi_category_users(FX.transactions(spark, sf))


@query("avg_receipt_by_city")
def q_avg_receipt_by_city(spark, sf):
    return TX.avg_receipt_by_city(FX.transactions(spark, sf))


@query("top_item_per_category")
def q_top_item_per_category(spark, sf):
    return TX.top_item_per_category(FX.transactions(spark, sf))


@query("peak_hour")
def q_peak_hour(spark, sf):
    return TX.peak_hour(FX.transactions_text(spark, sf))


# ---- credit and titles exploration -----------------------------------------


NULL_COUNT_COLS = ("director", "country", "date_added", "rating", "duration")


@query("remap_values")
def q_remap_values(spark, sf):
    return X.with_display(FX.credit(spark, sf)) \
        .select("client_id", "status", "status_display", "savings", "savings_display")


@query("crosstab_zero_filled")
def q_crosstab_zero_filled(spark, sf):
    return X.crosstab_zero_filled(X.with_display(FX.credit(spark, sf)), "savings_display", X.SAVINGS_ORDER)


@query("age_quartiles")
def q_age_quartiles(spark, sf):
    return X.age_quartiles(X.with_display(FX.credit(spark, sf)))


@query("age_histogram")
def q_age_histogram(spark, sf):
    return X.age_histogram(FX.credit(spark, sf))


@query("scatter_points")
def q_scatter_points(spark, sf):
    return X.scatter_points(FX.credit(spark, sf), "amount", "duration", "age", "credit_risk")


@query("null_counts")
def q_null_counts(spark, sf):
    return X.null_counts(FX.titles(spark, sf), NULL_COUNT_COLS)


@query("top_countries_missing")
def q_top_countries_missing(spark, sf):
    return X.top_countries_missing(FX.titles(spark, sf))


@query("top_countries")
def q_top_countries(spark, sf):
    return X.top_countries(FX.titles(spark, sf))


@query("top_countries_share")
def q_top_countries_share(spark, sf):
    return X.top_countries_share(FX.titles(spark, sf)) \
        .withColumn("share", F.round("share", 9))


@query("ratings_min_count")
def q_ratings_min_count(spark, sf):
    return X.ratings_min_count(FX.titles(spark, sf))


@query("top_countries_rated")
def q_top_countries_rated(spark, sf):
    return X.top_countries_rated(FX.titles(spark, sf))


@query("parse_long_date")
def q_parse_long_date(spark, sf):
    return X.parse_long_date(FX.titles(spark, sf))


@query("monthly_mean_count")
def q_monthly_mean_count(spark, sf):
    return X.monthly_mean_count(FX.titles(spark, sf)) \
        .withColumn("avg_count", F.round("avg_count", 9))


@query("titles_per_year")
def q_titles_per_year(spark, sf):
    return X.titles_per_year(FX.titles(spark, sf))


@query("duration_split")
def q_duration_split(spark, sf):
    return X.duration_split(FX.titles(spark, sf))


@query("duration_histogram")
def q_duration_histogram(spark, sf):
    h = X.duration_histogram(FX.titles(spark, sf))
    return h.withColumn("bin_lo", F.round("bin_lo", 6)).withColumn("bin_hi", F.round("bin_hi", 6))


@query("box_stats")
def q_box_stats(spark, sf):
    return X.box_stats(FX.titles(spark, sf))


@query("avg_duration_by_year")
def q_avg_duration_by_year(spark, sf):
    return X.avg_duration_by_year(FX.titles(spark, sf)) \
        .withColumn("avg_duration", F.round("avg_duration", 9))


# ---- validation (orders, sign-up, energy) -----------------------------------


TIMEOUT_RANGE = (1, 60)


def _lines_only(spark, sf):
    return FX.order_lines(spark, sf).filter(F.col("line_no").isNotNull())


@query("validate_orders")
def q_validate_orders(spark, sf):
    return V.validate_orders(V.order_checks_flat(FX.order_lines(spark, sf)))


@query("first_error")
def q_first_error(spark, sf):
    return V.order_result(V.order_checks_flat(FX.order_lines(spark, sf)))


@query("order_totals")
def q_order_totals(spark, sf):
    return V.order_checks_flat(FX.order_lines(spark, sf)).select("order_id", "n_items", "total")


@query("line_amount")
def q_line_amount(spark, sf):
    return _lines_only(spark, sf).select(
        "order_id", "line_no", "qty",
        SC.cents_half_even("unit_price").cast("decimal(12,2)").alias("price"),
        SC.line_amount("qty", "unit_price").cast("decimal(18,2)").alias("amount"))


@query("rule_sku")
def q_rule_sku(spark, sf):
    return _lines_only(spark, sf).select(
        "order_id", "line_no", "sku", (~RU.sku_format("sku")).alias("sku_ok"))


@query("rule_sku_place")
def q_rule_sku_place(spark, sf):
    return _lines_only(spark, sf).select(
        "order_id", "line_no", "sku", V.sku_place_error("sku").alias("error"))


@query("rule_password")
def q_rule_password(spark, sf):
    s = FX.signup(spark, sf)
    return s.select("user_key", (~RU.too_short("password")).alias("password_ok"),
                    SC.redact("password").alias("password"))


@query("rule_email")
def q_rule_email(spark, sf):
    return V.signup_checks(FX.signup(spark, sf)).select("user_key", "email_ok", "website_ok", "id_ok")


@query("signup")
def q_signup(spark, sf):
    return V.signup(FX.signup(spark, sf))


@query("user_out")
def q_user_out(spark, sf):
    users = Q.fill_defaults(FX.signup(spark, sf).select("id", "email"), {"is_active": True})
    return V.user_out(users)


@query("place_order")
def q_place_order(spark, sf):
    return V.place_order(_lines_only(spark, sf).drop("user_email", "status"))


@query("order_totals_nested")
def q_order_totals_nested(spark, sf):
    """B26 on nested orders: the items in arrays of bounded length, the
    totals of an order's arrays added."""
    item = F.when(F.col("line_no").isNotNull(),
                  F.struct("line_no", "sku", F.coalesce("qty", F.lit(0)).alias("qty"),
                           F.coalesce("unit_price", F.lit(0).cast("decimal(12,3)")).alias("unit_price")))
    pieces = V.nested_pieces(FX.order_lines(spark, sf), ["order_id"], item)
    return V.order_checks_pieces(pieces).select("order_id", "n_items", "total")


@query("domain_rule")
def q_domain_rule(spark, sf):
    s = FX.signup(spark, sf)
    ok = ~F.coalesce(RU.site_equals_mail("email", "website"), F.lit(False))
    return s.select("user_key", SC.email_domain("email").alias("email_domain"),
                    SC.url_host("website").alias("site_host"), ok.alias("domain_ok"))


@query("normalize_name")
def q_normalize_name(spark, sf):
    return FX.signup(spark, sf).select("user_key", "name",
                                       SC.normalize_name("name").alias("name_normalized"))


@query("redact")
def q_redact(spark, sf):
    return FX.signup(spark, sf).select("user_key", SC.redact("password").alias("password"), "website")


@query("rule_range")
def q_rule_range(spark, sf):
    c = FX.credit(spark, sf)
    bad = RU.out_of_range("duration", *TIMEOUT_RANGE)
    return c.select("client_id", "duration", (~bad).alias("duration_ok"),
                    F.when(bad, F.lit(f"duration: {V.MSG_RANGE} {TIMEOUT_RANGE[0]}-{TIMEOUT_RANGE[1]}"))
                    .alias("error"))


@query("rule_energy")
def q_rule_energy(spark, sf):
    return Q.annotate(V.parsed_energy(FX.energy_text(spark, sf)), V.energy_rules(), "errors", valid="valid")


@query("fill_defaults")
def q_fill_defaults(spark, sf):
    items = FX.mart_items(spark, sf).select("order_id", "item_id", "item_discount")
    return Q.fill_defaults(items, {"item_discount": 0, "is_active": True})


# ---- energy records ----------------------------------------------------------

SPLIT_TS = "2024-01-15 00:00:00"


@query("row_ids")
def q_row_ids(spark, sf):
    return REC.with_ids(FX.energy(spark, sf))


@query("append_records")
def q_append_records(spark, sf):
    """Two appends, each of records that are earlier than the stored ones."""
    e = FX.energy(spark, sf)
    cut = F.lit(SPLIT_TS).cast("timestamp_ntz")
    existing = REC.with_ids(e.filter(F.col("timestep") >= cut))
    late = F.col("consumption_eur") >= 50
    once = REC.append(existing, e.filter((F.col("timestep") < cut) & late))
    return REC.append(once, e.filter((F.col("timestep") < cut) & ~late))


@query("delete_records")
def q_delete_records(spark, sf):
    """The records that break the energy rules are deleted by id."""
    current = REC.with_ids(FX.energy(spark, sf))
    bad = current.filter(Q.any_failed(V.energy_rules())).select("id")
    return REC.delete(current, bad)


@query("unpivot_energy")
def q_unpivot_energy(spark, sf):
    return REC.long_form(FX.energy(spark, sf))


@query("combine_dt")
def q_combine_dt(spark, sf):
    return REC.minute_text(FX.energy(spark, sf))


# ---- very many distinct values ------------------------------------------------


@query("price_quartiles")
def q_price_quartiles(spark, sf):
    """Quartiles of all line prices by return flag."""
    return AG.group_quantiles(load(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice",
                              names=["q1", "median", "q3"], method="select")


@query("price_box")
def q_price_box(spark, sf):
    """Box statistics of all line prices."""
    return AG.box_stats(load(spark, sf, "lineitem"), "l_extendedprice", method="select")


@query("top_parts")
def q_top_parts(spark, sf):
    """The 20 parts with most order lines."""
    return SEL.top_values(load(spark, sf, "lineitem"), "l_partkey", 20)


# ---- streams -----------------------------------------------------------------


ENERGY_SCHEMA = StructType([StructField("timestep", TimestampNTZType())]
                           + [StructField(m, DoubleType()) for m in REC.MEASURES])
USERS_SCHEMA = StructType([StructField("user_id", IntegerType()), StructField("user_phone", StringType()),
                           StructField("load_orderkey", LongType()), StructField("load_linenumber", IntegerType()),
                           StructField("load_partkey", LongType()), StructField("load_suppkey", LongType()),
                           StructField("load_quantity", DoubleType()),
                           StructField("load_extendedprice", DoubleType()),
                           StructField("load_shipdate", TimestampNTZType())])
STREAM_FILE_ROWS = 2500          # several files, so several micro-batches, at the test sizes
STREAM_FILES = 4                 # files of a micro-batch, or more where the backlog is longer
STREAM_BATCHES = 16              # micro-batches that a backlog is drained in
STREAM_FILE_MOST = 250_000       # rows of a file


def _backlog(df: DataFrame, n: int, file_rows: int, src: str) -> int:
    """Drop some ``n`` rows as files into a folder: of ``file_rows`` rows, and of more
    where that would make a great many. Returns the files of a micro-batch."""
    file_rows = min(max(file_rows, n // (STREAM_FILES * STREAM_BATCHES)), STREAM_FILE_MOST)
    df.write.option("maxRecordsPerFile", file_rows).parquet(src)
    return ST.files_per_batch(df.sparkSession, src, STREAM_FILES, STREAM_BATCHES)


def _taken_in(spark, sf) -> str:
    base = scratch_path(spark, "stream_intake")
    src = f"{base}/in"
    files = _backlog(FX.energy(spark, sf), load(spark, sf, "events").count(), STREAM_FILE_ROWS, src)
    ST.stream_records(spark, src, ENERGY_SCHEMA, V.energy_rules(), f"{base}/out", f"{base}/checkpoint",
                      max_files_per_trigger=files)
    return f"{base}/out"


@query("stream_intake")
def q_stream_intake(spark, sf):
    """Energy records dropped as files in a folder, taken in by a stream:
    the good rows."""
    return ST.accepted(spark, _taken_in(spark, sf))


@query("stream_rejects")
def q_stream_rejects(spark, sf):
    """The rows that the intake rejects, with their errors."""
    return ST.rejected(spark, _taken_in(spark, sf))


@query("stream_dedup_keys")
def q_stream_dedup_keys(spark, sf):
    """Wide order-line files loaded in turn; each user kept once."""
    base = scratch_path(spark, "stream_dedup")
    src = f"{base}/in"
    wide = FX.delivery_wide(spark, sf).select("user_id", "user_phone", *FX.LOAD_ORDER)
    files = _backlog(wide, load(spark, sf, "lineitem").count(), STREAM_FILE_ROWS * 4, src)
    ST.stream_first_by_key(spark, src, USERS_SCHEMA, ["user_id"], list(FX.LOAD_ORDER),
                           f"{base}/out", f"{base}/checkpoint", max_files_per_trigger=files)
    return ST.first_rows(spark, f"{base}/out").select("user_id", "user_phone")
