"""DuckDB oracle SQL for every registered query.

Written independently of the Spark code: the fixtures of FIXTURES.md §2 as
SQL views (CTEs) over the driver tables, then each query in plain SQL. Every
output column is cast on this side to the Spark type of the same column.
"""

from __future__ import annotations

# name -> (dependencies, SQL body)
FIXTURES: dict[str, tuple[tuple[str, ...], str]] = {
    "geo": ((), """
        SELECT * FROM customer c
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        JOIN region r ON n.n_regionkey = r.r_regionkey"""),
    "mart_orders": (("geo",), """
        SELECT CAST(o.o_orderkey AS INTEGER) AS order_id,
               CAST(o.o_custkey AS INTEGER) AS user_id,
               g.c_nationkey AS store_id,
               g.r_name || ', ' || g.n_name || ', ' || g.c_name AS address_text,
               o.o_orderdate AS created_at,
               CASE WHEN o.o_orderstatus = 'F' THEN o.o_orderdate END AS delivered_at,
               CASE WHEN o.o_orderstatus = 'P' THEN o.o_orderdate END AS canceled_at,
               CAST(CASE WHEN o.o_orderkey % 4 = 0 THEN 10 WHEN o.o_orderkey % 4 = 1 THEN 2.5 END
                    AS DECIMAL(5,2)) AS order_discount
        FROM orders o JOIN geo g ON o.o_custkey = g.c_custkey"""),
    "mart_items": ((), """
        SELECT CAST(l.l_orderkey AS INTEGER) AS order_id,
               CAST(l.l_partkey AS INTEGER) AS item_id,
               p.p_name AS item_title, p.p_type AS item_category,
               CAST(l.l_quantity AS INTEGER) AS item_quantity,
               CAST(p.p_retailprice AS DECIMAL(10,2)) AS item_price,
               CAST(CASE WHEN l.l_discount > 0 THEN round(l.l_discount * 100) END AS DECIMAL(5,2))
                    AS item_discount,
               CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS item_canceled_quantity
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey"""),
}


def with_fixtures(needs: tuple[str, ...], body: str) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first). A body
    starting with ``,`` continues the CTE list."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in FIXTURES[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return body
    ctes = ",\n".join(f"{n} AS ({FIXTURES[n][1]})" for n in order)
    return f"WITH {ctes}\n{body.lstrip()}"


def factor(col: str) -> str:
    """exact ``1 - coalesce(d,0)/100`` as DECIMAL(7,4)"""
    return f"CAST(1 - CAST(COALESCE({col}, 0) AS DECIMAL(9,4)) * 0.01 AS DECIMAL(7,4))"


# The marts by another way than the Spark plan: counts from the orders alone,
# amounts from one total per order (or per order and item).
FIXTURES["orders_by_day"] = (("mart_orders",), f"""
        SELECT order_id, user_id, store_id, split_part(address_text, ',', 1) AS city,
               CAST(date_part('year', created_at) AS INTEGER) AS year,
               CAST(date_part('month', created_at) AS INTEGER) AS month,
               CAST(date_part('day', created_at) AS INTEGER) AS day,
               delivered_at IS NOT NULL AS is_delivered, canceled_at IS NOT NULL AS is_canceled,
               {factor('order_discount')} AS kept
        FROM mart_orders""")
FIXTURES["item_totals"] = (("mart_items",), f"""
        SELECT order_id, item_category AS category, item_id, item_title,
               CAST(SUM(item_price * item_quantity) AS DECIMAL(20,2)) AS gross,
               CAST(SUM(item_price * item_quantity * {factor('item_discount')}) AS DECIMAL(20,6)) AS net,
               SUM(item_quantity) AS pieces, SUM(item_canceled_quantity) AS canceled
        FROM mart_items GROUP BY ALL""")

ORACLE: dict[str, str] = {}

ORACLE["order_mart"] = with_fixtures(("orders_by_day", "item_totals"), """
, amounts AS (SELECT d.year, d.month, d.day, d.city, d.store_id, SUM(t.gross) AS gross, SUM(t.net * d.kept) AS net
              FROM orders_by_day d JOIN item_totals t ON t.order_id = d.order_id GROUP BY ALL),
counts AS (SELECT year, month, day, city, store_id, COUNT(*) AS n, COUNT(*) FILTER (is_delivered) AS n_delivered,
                  COUNT(*) FILTER (is_canceled) AS n_canceled, COUNT(DISTINCT user_id) AS n_users
           FROM orders_by_day GROUP BY ALL)
SELECT year, month, day, city, store_id,
       CAST(a.gross AS DECIMAL(15,2)) AS turnover, CAST(a.net AS DECIMAL(15,2)) AS revenue,
       CAST(n AS INTEGER) AS orders_created, CAST(n_delivered AS INTEGER) AS orders_delivered,
       CAST(n_canceled AS INTEGER) AS orders_canceled, CAST(n_users AS INTEGER) AS unique_customers
FROM counts c LEFT JOIN amounts a USING (year, month, day, city, store_id)""")

ORACLE["item_mart"] = with_fixtures(("orders_by_day", "item_totals"), """
, parts AS (SELECT d.*, t.category, t.item_id, t.item_title, t.net, t.pieces, t.canceled
            FROM orders_by_day d JOIN item_totals t ON t.order_id = d.order_id
            UNION ALL
            SELECT d.*, NULL, NULL, NULL, NULL, NULL, NULL FROM orders_by_day d
            WHERE d.order_id NOT IN (SELECT order_id FROM item_totals))
SELECT year, month, day, city, store_id, category, item_id, item_title,
       CAST(SUM(net * kept) AS DECIMAL(15,2)) AS item_turnover,
       CAST(SUM(pieces) AS INTEGER) AS quantity_ordered, CAST(SUM(canceled) AS INTEGER) AS quantity_canceled,
       CAST(COUNT(*) AS INTEGER) AS orders_with_item,
       CAST(COUNT(*) FILTER (canceled > 0) AS INTEGER) AS orders_with_cancel
FROM parts GROUP BY ALL""")


FIXTURES["delivery_wide"] = (("geo",), """
        SELECT CAST(l.l_orderkey AS INTEGER) AS order_id,
               CAST(o.o_custkey AS INTEGER) AS user_id,
               g.c_name AS user_phone,
               g.c_nationkey AS store_id,
               g.n_name || ', ' || g.r_name AS store_address,
               CASE WHEN o.o_orderstatus <> 'P' THEN CAST(l.l_suppkey AS INTEGER) END AS driver_id,
               s.s_name AS driver_phone,
               g.r_name || ', ' || g.n_name || ', ' || g.c_name AS address_text,
               o.o_orderdate AS created_at,
               CAST(NULL AS TIMESTAMP) AS paid_at,
               CAST(NULL AS TIMESTAMP) AS delivery_started_at,
               CASE WHEN o.o_orderstatus = 'F' THEN o.o_orderdate END AS delivered_at,
               CASE WHEN o.o_orderstatus = 'P' THEN o.o_orderdate END AS canceled_at,
               o.o_orderpriority AS payment_type,
               CAST(CASE WHEN o.o_orderkey % 4 = 0 THEN 10 WHEN o.o_orderkey % 4 = 1 THEN 2.5 END
                    AS DECIMAL(5,2)) AS order_discount,
               CAST(NULL AS VARCHAR) AS order_cancellation_reason,
               CAST(NULL AS DECIMAL(10,2)) AS delivery_cost,
               CAST(l.l_partkey AS INTEGER) AS item_id,
               p.p_name AS item_title, p.p_type AS item_category,
               CAST(l.l_quantity AS INTEGER) AS item_quantity,
               CAST(p.p_retailprice AS DECIMAL(10,2)) AS item_price,
               CAST(CASE WHEN l.l_discount > 0 THEN round(l.l_discount * 100) END AS DECIMAL(5,2))
                    AS item_discount,
               CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS item_canceled_quantity,
               CAST(NULL AS INTEGER) AS item_replaced_id,
               row_number() OVER (ORDER BY l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
                                  l.l_quantity, l.l_extendedprice, l.l_shipdate) AS row_seq
        FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN geo g ON o.o_custkey = g.c_custkey
        JOIN part p ON l.l_partkey = p.p_partkey
        JOIN supplier s ON l.l_suppkey = s.s_suppkey""")


def first_wins(key: str, cols: str) -> str:
    return with_fixtures(("delivery_wide",), f"""
SELECT {cols} FROM (
    SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY row_seq) AS rn
    FROM delivery_wide WHERE {key} IS NOT NULL) t
WHERE rn = 1""")


ORACLE["scan_parquet"] = "SELECT * FROM lineitem"

ORACLE["scan_dir"] = """
SELECT n_nationkey, n_name, n_regionkey, CAST(NULL AS VARCHAR) AS n_comment,
       'nation.parquet' AS _file_name, CAST(row_number() OVER () - 1 AS BIGINT) AS _row_index
FROM nation"""

ORACLE["sink_overwrite"] = ORACLE["order_mart"]

ORACLE["safe_casts"] = """
SELECT o_orderkey,
    TRY_CAST(CAST(o_orderkey AS VARCHAR) AS INTEGER) AS key_from_text,
    CAST(NULL AS INTEGER) AS key_from_bad_text,
    CASE WHEN trunc(o_totalprice / 1000) BETWEEN -2147483648 AND 2147483647
         THEN CAST(trunc(o_totalprice / 1000) AS INTEGER) END AS total_k_int,
    CASE WHEN trunc(o_totalprice * 100000) BETWEEN -2147483648 AND 2147483647
         THEN CAST(trunc(o_totalprice * 100000) AS INTEGER) END AS total_overflow_int,
    o_totalprice AS total_from_text,
    TRY_CAST(CAST(o_totalprice / 100 AS VARCHAR) AS DECIMAL(5,2)) AS total_dec,
    CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status_text,
    CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderdate END AS created_ts
FROM orders"""

FIXTURES["raw_parts"] = ((), """
        SELECT p_partkey, CASE WHEN p_partkey % 11 <> 0 THEN p_name END AS p_name,
               p_retailprice * CASE WHEN p_partkey % 9 = 0 THEN 10.0 ELSE 1.0 END AS p_retailprice FROM part""")
ORACLE["conform_schema"] = with_fixtures(("raw_parts",), """
SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name,
       TRY_CAST(p_retailprice AS DECIMAL(5,2)) AS p_retailprice
FROM raw_parts
WHERE TRY_CAST(p_retailprice AS DECIMAL(5,2)) IS NOT NULL AND length(p_name) <= 10""")

ORACLE["load_rejects"] = with_fixtures(("raw_parts",), """
SELECT CAST(p_partkey AS INTEGER) AS p_partkey,
       CASE WHEN TRY_CAST(p_retailprice AS DECIMAL(5,2)) IS NULL
            THEN 'p_retailprice: value does not fit decimal(5,2)'
            WHEN p_name IS NULL THEN 'p_name: missing' ELSE 'p_name: longer than 10' END AS reason,
       p_retailprice AS raw_price
FROM raw_parts
WHERE TRY_CAST(p_retailprice AS DECIMAL(5,2)) IS NULL OR p_name IS NULL OR length(p_name) > 10""")

ORACLE["scan_csv_infer"] = """
SELECT user_id, CAST(event_id % 50 AS INTEGER) AS item_id, event_type AS category, value AS price,
       CAST(event_id % 5 + 1 AS INTEGER) AS quantity, 'city_' || CAST(user_id % 7 AS VARCHAR) AS city
FROM events"""
ORACLE["write_csv_without_id"] = """
SELECT ts AS timestep, value AS consumption_eur, value / 2 AS consumption_sib,
       CAST(user_id AS DOUBLE) AS price_eur, value - 5 AS price_sib FROM events"""
ORACLE["preview"] = "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 5"
ORACLE["has_key"] = """
SELECT c_custkey AS o_custkey FROM customer
WHERE EXISTS (SELECT 1 FROM orders WHERE orders.o_custkey = customer.c_custkey)"""
ORACLE["schema_summary"] = "\nUNION ALL\n".join(
    f"""SELECT '{field}' AS field, '{kind}' AS type, 6 AS n_fields, COUNT(*) AS n_rows,
           COUNT(*) FILTER ({null}) AS n_nulls, COUNT(*) FILTER ({bad}) AS n_violations FROM orders"""
    for field, kind, null, bad in (
        ("o_orderkey", "integer", "o_orderkey IS NULL", "o_orderkey IS NULL OR o_orderkey < 0"),
        ("o_custkey", "integer", "o_custkey IS NULL", "o_custkey IS NULL OR o_custkey <= 0"),
        ("o_orderstatus", "string", "o_orderstatus IS NULL", "o_orderstatus NOT IN ('F', 'O')"),
        ("o_totalprice", "number", "o_totalprice IS NULL", "o_totalprice < 1000 OR o_totalprice >= 300000"),
        ("o_orderpriority", "string", "o_orderpriority IS NULL",
         "NOT regexp_matches(o_orderpriority, '^[1-4]-') OR length(o_orderpriority) > 12"),
        ("o_comment", "string", "TRUE", "TRUE")))
_BROKEN_LINES = """
WITH cells AS (
  SELECT event_id, event_type || ', x' AS category,
         CASE WHEN event_id % 53 = 0 THEN 'n/a' ELSE CAST(event_id % 1000 AS VARCHAR) END AS price,
         CASE WHEN event_id % 67 = 0 THEN '1998-13-01' ELSE '1998-01-31' END AS day,
         event_id % 59 = 0 AS few, event_id % 59 <> 0 AND event_id % 61 = 0 AS many FROM events),
lines AS (
  SELECT *, CAST(event_id AS VARCHAR) || ',"' || category || '",' || price || CASE WHEN few THEN '' ELSE ',' || day END
            || CASE WHEN many THEN ',more' ELSE '' END AS line,
         price = 'n/a' AS bad_price, day = '1998-13-01' AS bad_day FROM cells)"""
ORACLE["scan_csv_rejects"] = _BROKEN_LINES + """
SELECT line, CASE WHEN few THEN ['3 cells, 4 expected'] WHEN many THEN ['5 cells, 4 expected']
                  ELSE list_concat(CASE WHEN bad_price THEN ['price: value does not fit double'] ELSE [] END,
                                   CASE WHEN bad_day THEN ['day: value does not fit date'] ELSE [] END) END AS reasons
FROM lines WHERE few OR many OR bad_price OR bad_day"""
ORACLE["scan_csv_accepted"] = _BROKEN_LINES + """
SELECT event_id, category, CAST(price AS DOUBLE) AS price, CAST(day AS DATE) AS day
FROM lines WHERE NOT (few OR many OR bad_price OR bad_day)"""
ORACLE["build_marts"] = f"""
SELECT 'order_mart' AS mart, CAST(SUM(revenue) AS DECIMAL(20,2)) AS amount, COUNT(*) AS n
FROM ({ORACLE["order_mart"]}) a
UNION ALL
SELECT 'item_mart', CAST(SUM(item_turnover) AS DECIMAL(20,2)), COUNT(*) FROM ({ORACLE["item_mart"]}) b"""
ORACLE["delivery_rejects"] = """
SELECT CAST(l_orderkey AS INTEGER) AS order_id, CAST(l_partkey AS INTEGER) AS item_id,
       ['payment_type: longer than 50'] AS load_errors
FROM lineitem WHERE l_orderkey % 97 = 0"""

ORACLE["dim_users"] = first_wins("user_id", "user_id, user_phone")
ORACLE["dim_stores"] = first_wins("store_id", "store_id, store_address")
ORACLE["dim_drivers"] = first_wins("driver_id", "driver_id, driver_phone")
ORACLE["fact_orders"] = first_wins(
    "order_id",
    "order_id, user_id, store_id, driver_id, address_text, created_at, paid_at, "
    "delivery_started_at, delivered_at, canceled_at, payment_type, order_discount, "
    "order_cancellation_reason, delivery_cost")
ORACLE["fact_items"] = with_fixtures(("delivery_wide",), """
SELECT row_seq AS order_item_id, order_id, item_id, item_title, item_category, item_quantity,
       item_price, item_discount, item_canceled_quantity, item_replaced_id AS replaced_by_item_id
FROM delivery_wide""")

ORACLE["refresh_tables"] = "\nUNION ALL\n".join(
    f"SELECT '{table}' AS table_name, COUNT(*) AS n_rows FROM ({ORACLE[name]}) t" for table, name in (
        ("users", "dim_users"), ("stores", "dim_stores"), ("drivers", "dim_drivers"), ("orders", "fact_orders"),
        ("order_items", "fact_items"))) + "\nUNION ALL SELECT 'rejects', 0"

ORACLE["insert_new_keys"] = with_fixtures(("delivery_wide",), """
, existing AS (SELECT CAST(c_custkey AS INTEGER) AS user_id, c_name AS user_phone
               FROM customer WHERE c_custkey % 2 = 0),
incoming AS (SELECT user_id, user_phone FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY row_seq) AS rn
    FROM delivery_wide WHERE user_id IS NOT NULL) t WHERE rn = 1)
SELECT * FROM existing
UNION ALL
SELECT i.* FROM incoming i WHERE i.user_id NOT IN (SELECT user_id FROM existing)""")

ORACLE["fk_orphans"] = with_fixtures(("mart_orders",), """
SELECT order_id, user_id FROM mart_orders o
WHERE user_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_acctbal >= 0
                  AND CAST(c.c_custkey AS INTEGER) = o.user_id)""")

ORACLE["pk_violations"] = """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1"""


# ---- retail fixtures and tasks ----------------------------------------------

FIXTURES["calendar"] = ((), """
        SELECT DISTINCT CAST(o_orderdate AS DATE) AS date,
               CAST(year(o_orderdate) * 100 + weekofyear(o_orderdate) AS INTEGER) AS wm_yr_wk,
               dayname(o_orderdate) AS weekday,
               CAST(month(o_orderdate) AS INTEGER) AS month,
               CAST(year(o_orderdate) AS INTEGER) AS year
        FROM orders""")
FIXTURES["prices"] = ((), """
        SELECT DISTINCT CAST(l.l_suppkey AS INTEGER) AS store_id,
               CAST(l.l_partkey AS INTEGER) AS item_id,
               CAST(year(l.l_shipdate) * 100 + weekofyear(l.l_shipdate) AS INTEGER) AS wm_yr_wk,
               p.p_retailprice / 100 AS sell_price
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""")
FIXTURES["sales"] = (("geo",), """
        SELECT CAST(l.l_partkey AS INTEGER) AS item_id, p.p_brand AS dept_id, p.p_type AS cat_id,
               g.c_nationkey AS store_id, g.r_name AS state_id,
               """ + ", ".join(
    f"CAST(SUM(CASE WHEN month(l.l_shipdate) = {k} THEN l.l_quantity ELSE 0 END) AS INTEGER) AS d_{k}"
    for k in range(1, 13)) + """
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN geo g ON o.o_custkey = g.c_custkey
        GROUP BY 1, 2, 3, 4, 5""")

ORACLE["weekend_flag"] = with_fixtures(("calendar",), """
SELECT *, CASE WHEN weekday IN ('Saturday', 'Sunday') THEN 1 ELSE 0 END AS is_weekend FROM calendar""")
ORACLE["rename_week"] = with_fixtures(("calendar",), """
SELECT date, wm_yr_wk AS week_id, weekday, month, year FROM calendar""")
ORACLE["distinct_weekdays"] = with_fixtures(("calendar",), "SELECT DISTINCT weekday FROM calendar")
ORACLE["n_stores"] = with_fixtures(("sales",), "SELECT COUNT(DISTINCT store_id) AS n_stores FROM sales")
ORACLE["avg_sales_by_category"] = with_fixtures(("sales",), """
SELECT cat_id, AVG(d_1) AS avg_sales FROM sales GROUP BY cat_id""")
ORACLE["price_int"] = with_fixtures(("prices",), """
SELECT *, CAST(trunc(sell_price) AS INTEGER) AS sell_price_int FROM prices""")
ORACLE["top_prices"] = with_fixtures(("prices",), """
SELECT * FROM prices ORDER BY sell_price DESC, store_id, item_id, wm_yr_wk LIMIT 5""")
ORACLE["sql_avg_by_state"] = with_fixtures(("sales",), """
SELECT state_id, AVG(d_1) AS avg_sales FROM sales GROUP BY state_id""")
ORACLE["filter_state"] = with_fixtures(("sales",), "SELECT * FROM sales WHERE state_id = 'AMERICA'")
ORACLE["top_prices_in_period"] = with_fixtures(("prices", "calendar"), """
SELECT DISTINCT p.sell_price FROM prices p JOIN calendar c ON p.wm_yr_wk = c.wm_yr_wk
WHERE c.date BETWEEN DATE '1998-01-01' AND DATE '1998-01-31'
ORDER BY sell_price DESC LIMIT 5""")
ORACLE["prices_by_day"] = with_fixtures(("prices", "calendar"), """
SELECT p.store_id, p.item_id, p.wm_yr_wk, p.sell_price, c.date
FROM prices p JOIN calendar c ON p.wm_yr_wk = c.wm_yr_wk""")
ORACLE["top_sales_per_category"] = with_fixtures(("sales",), """
SELECT * FROM (
  SELECT *, CAST(rank() OVER (PARTITION BY cat_id ORDER BY d_1 DESC) AS INTEGER) AS rank FROM sales) t
WHERE rank = 1""")
ORACLE["price_category"] = with_fixtures(("prices",), """
SELECT *, CASE WHEN sell_price > 5 THEN 'High' ELSE 'Low' END AS price_category FROM prices""")
ORACLE["sum_sales_by_store"] = with_fixtures(("sales",), """
SELECT store_id, CAST(SUM(d_1) AS BIGINT) AS total_sales FROM sales GROUP BY store_id""")

# ---- transactions --------------------------------------------------------------

FIXTURES["transactions"] = ((), """
        SELECT user_id, ts AS timestamp, CAST(event_id % 50 AS INTEGER) AS item_id,
               event_type AS category, value AS price, CAST(event_id % 5 + 1 AS INTEGER) AS quantity,
               'city_' || CAST(user_id % 7 AS VARCHAR) AS city,
               CAST(value AS DECIMAL(18,2)) * CAST(event_id % 5 + 1 AS INTEGER) AS revenue
        FROM events""")

ORACLE["scan_csv_roundtrip"] = with_fixtures(("transactions",), """
SELECT user_id, timestamp, item_id, category, price, quantity, city FROM transactions""")
ORACLE["top_categories"] = with_fixtures(("transactions",), """
SELECT category, CAST(SUM(revenue) AS DECIMAL(20,2)) AS total_revenue
FROM transactions GROUP BY category ORDER BY total_revenue DESC, category LIMIT 5""")
ORACLE["multi_category_users"] = with_fixtures(("transactions",), """
SELECT user_id, list_sort(list(DISTINCT category)) AS categories,
       CAST(COUNT(DISTINCT category) AS INTEGER) AS n_categories
FROM transactions GROUP BY user_id HAVING COUNT(DISTINCT category) > 2""")
ORACLE["avg_receipt_by_city"] = with_fixtures(("transactions",), """
SELECT city, round(CAST(SUM(revenue) AS DOUBLE) / COUNT(*), 6) AS avg_receipt
FROM transactions GROUP BY city""")
ORACLE["top_item_per_category"] = with_fixtures(("transactions",), """
SELECT category, item_id, total_qty FROM (
  SELECT category, item_id, CAST(SUM(quantity) AS BIGINT) AS total_qty,
         rank() OVER (PARTITION BY category ORDER BY SUM(quantity) DESC) AS rk
  FROM transactions GROUP BY category, item_id) t
WHERE rk = 1""")
ORACLE["peak_hour"] = with_fixtures(("transactions",), """
, hourly AS (SELECT CAST(hour(timestamp) AS INTEGER) AS hour,
                    CAST(SUM(revenue) AS DECIMAL(20,2)) AS revenue
             FROM transactions GROUP BY 1)
SELECT hour, revenue, CAST((SELECT SUM(revenue) FROM hourly) AS DECIMAL(20,2)) AS total_revenue,
       round(CAST(revenue AS DOUBLE) / CAST((SELECT SUM(revenue) FROM hourly) AS DOUBLE), 6) AS share
FROM hourly ORDER BY revenue DESC, hour LIMIT 1""")


# ---- credit and titles ---------------------------------------------------------

FIXTURES["credit"] = ((), """
        SELECT c_custkey AS client_id,
               CASE c_custkey % 4 WHEN 0 THEN 'no checking account' WHEN 1 THEN '0<= ... < 200 DM'
                    WHEN 2 THEN '... >= 200 DM / salary for at least 1 year' ELSE '... < 0 DM' END AS status,
               CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'unknown/no savings account'
                    WHEN 'BUILDING' THEN '... <  100 DM' WHEN 'HOUSEHOLD' THEN '500 <= ... < 1000 DM'
                    WHEN 'FURNITURE' THEN '100 <= ... <  500 DM'
                    WHEN 'MACHINERY' THEN '100 <= ... <  500 DM' END AS savings,
               replace(savings, '<  ', '< ') AS savings_display,
               CASE WHEN c_acctbal >= 1000 THEN 'good' ELSE 'bad' END AS credit_risk,
               CASE WHEN c_custkey % 37 <> 0 THEN CAST(18 + c_custkey % 60 AS INTEGER) END AS age, abs(c_acctbal) AS amount,
               CAST(4 + c_custkey % 69 AS INTEGER) AS duration
        FROM customer""")
FIXTURES["titles"] = ((), """
        SELECT o_orderkey AS show_id,
               CASE WHEN o_orderkey % 10 < 7 THEN 'Movie' ELSE 'TV Show' END AS type,
               CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS director,
               CASE WHEN o_custkey % 11 <> 0 THEN 'country_' || CAST(o_custkey % 17 AS VARCHAR) END AS country,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN 'unknown'
                    ELSE strftime(o_orderdate, '%B %-d, %Y') END AS date_added,
               CASE WHEN o_orderkey % 6 = 0 THEN 'TV-MA' WHEN o_orderkey % 400 = 1 THEN 'NC-17'
                    ELSE o_orderpriority END AS rating,
               CASE WHEN o_orderkey % 31 = 0 THEN NULL
                    WHEN o_orderkey % 10 < 7 THEN CAST(40 + o_orderkey % 120 AS VARCHAR) || ' min'
                    ELSE CAST(1 + o_orderkey % 9 AS VARCHAR) || ' Seasons' END AS duration,
               CAST(try_strptime(CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 29 = 0
                    THEN 'unknown' ELSE strftime(o_orderdate, '%B %-d, %Y') END, '%B %-d, %Y') AS DATE)
                    AS added_date,
               CASE WHEN o_orderkey % 31 <> 0 AND o_orderkey % 10 < 7
                    THEN CAST(40 + o_orderkey % 120 AS INTEGER) END AS min,
               CASE WHEN o_orderkey % 31 <> 0 AND o_orderkey % 10 >= 7
                    THEN CAST(1 + o_orderkey % 9 AS INTEGER) END AS season
        FROM orders""")

ORACLE["remap_values"] = with_fixtures(("credit",), """
SELECT client_id, status,
       CASE status WHEN '0<= ... < 200 DM' THEN '0< ... < 200 DM'
                   WHEN '... >= 200 DM / salary for at least 1 year' THEN '>=200 DM / salary for at least 1 year'
                   WHEN '... < 0 DM' THEN '< 0 DM' ELSE status END AS status_display,
       savings, savings_display
FROM credit""")
ORACLE["crosstab_zero_filled"] = with_fixtures(("credit",), """
, dom AS (SELECT * FROM (VALUES (1, 'unknown/no savings account'), (2, '... < 100 DM'),
                               (3, '100 <= ... < 500 DM'), (4, '... >= 1000 DM'),
                               (5, '500 <= ... < 1000 DM')) v(position, savings_display))
SELECT CAST(d.position AS INTEGER) AS position, d.savings_display,
       CAST(COUNT(c.client_id) FILTER (WHERE c.credit_risk = 'good') AS BIGINT) AS good,
       CAST(COUNT(c.client_id) FILTER (WHERE c.credit_risk = 'bad') AS BIGINT) AS bad
FROM dom d LEFT JOIN credit c ON c.savings_display = d.savings_display
GROUP BY d.position, d.savings_display""")
ORACLE["age_quartiles"] = with_fixtures(("credit",), """
SELECT savings_display, credit_risk, quantile_cont(age, 0.25) AS q1, quantile_cont(age, 0.5) AS median,
       quantile_cont(age, 0.75) AS q3
FROM credit WHERE age IS NOT NULL GROUP BY savings_display, credit_risk""")
ORACLE["age_histogram"] = with_fixtures(("credit",), """
, people AS (SELECT credit_risk, age FROM credit UNION ALL SELECT 'all', age FROM credit),
bins AS (SELECT CAST(i AS INTEGER) AS bin FROM range(1, 12) r(i)),
classes AS (SELECT DISTINCT credit_risk FROM people)
SELECT c.credit_risk, b.bin, CAST(15 + 5 * b.bin AS DOUBLE) AS bin_lo, CAST(20 + 5 * b.bin AS DOUBLE) AS bin_hi,
       (SELECT COUNT(*) FROM people p WHERE p.credit_risk = c.credit_risk AND p.age >= 15 + 5 * b.bin
           AND (p.age < 20 + 5 * b.bin OR (b.bin = 11 AND p.age = 75))) AS n
FROM classes c, bins b""")
ORACLE["scatter_points"] = with_fixtures(("credit",), "SELECT amount, duration, age, credit_risk FROM credit")
ORACLE["null_counts"] = with_fixtures(("titles",), """
SELECT COUNT(*) FILTER (WHERE director IS NULL) AS director,
       COUNT(*) FILTER (WHERE country IS NULL) AS country,
       COUNT(*) FILTER (WHERE date_added IS NULL) AS date_added,
       COUNT(*) FILTER (WHERE rating IS NULL) AS rating,
       COUNT(*) FILTER (WHERE duration IS NULL) AS duration
FROM titles""")
ORACLE["top_countries_missing"] = with_fixtures(("titles",), """
SELECT country, COUNT(*) AS n FROM titles WHERE director IS NULL AND country IS NOT NULL
GROUP BY country ORDER BY n DESC, country LIMIT 5""")
ORACLE["top_countries"] = with_fixtures(("titles",), """
SELECT country, COUNT(*) AS n FROM titles WHERE country IS NOT NULL
GROUP BY country ORDER BY n DESC, country LIMIT 5""")
ORACLE["top_countries_share"] = with_fixtures(("titles",), """
, top AS (SELECT country, COUNT(*) AS n FROM titles WHERE country IS NOT NULL
          GROUP BY country ORDER BY n DESC, country LIMIT 5)
SELECT country, n, round(n / (SELECT SUM(n) FROM top), 9) AS share FROM top""")
ORACLE["ratings_min_count"] = with_fixtures(("titles",), """
SELECT rating, COUNT(*) AS n FROM titles WHERE type = 'Movie' AND rating IS NOT NULL
GROUP BY rating HAVING COUNT(*) >= 50""")
ORACLE["top_countries_rated"] = with_fixtures(("titles",), """
SELECT country, COUNT(*) AS n FROM titles
WHERE type = 'Movie' AND rating = 'TV-MA' AND country IS NOT NULL
GROUP BY country ORDER BY n DESC, country LIMIT 3""")
ORACLE["parse_long_date"] = with_fixtures(("titles",), "SELECT show_id, date_added, added_date FROM titles")
ORACLE["monthly_mean_count"] = with_fixtures(("titles",), """
SELECT CAST(m AS INTEGER) AS month, round(AVG(n), 9) AS avg_count FROM (
  SELECT year(added_date) AS y, month(added_date) AS m, COUNT(*) AS n
  FROM titles WHERE type = 'Movie' AND added_date IS NOT NULL GROUP BY 1, 2) t
GROUP BY m""")
ORACLE["titles_per_year"] = with_fixtures(("titles",), """
SELECT CAST(year(added_date) AS INTEGER) AS year, COUNT(*) AS n
FROM titles WHERE type = 'Movie' AND added_date IS NOT NULL GROUP BY 1""")
ORACLE["duration_split"] = with_fixtures(("titles",), "SELECT show_id, type, duration, min, season FROM titles")
ORACLE["duration_histogram"] = with_fixtures(("titles",), """
, v AS (SELECT 'min' AS kind, CAST(min AS DOUBLE) AS x, 30 AS nb FROM titles WHERE min IS NOT NULL
        UNION ALL
        SELECT 'season', CAST(season AS DOUBLE), 20 FROM titles WHERE season IS NOT NULL),
s AS (SELECT kind, MIN(x) AS lo, MAX(x) AS hi, MAX(nb) AS nb FROM v GROUP BY kind),
b AS (SELECT v.kind, s.lo, s.hi, s.nb,
             CAST(CASE WHEN s.hi = s.lo THEN 1 WHEN v.x >= s.hi THEN s.nb
                       ELSE floor((v.x - s.lo) / ((s.hi - s.lo) / s.nb)) + 1 END AS INTEGER) AS bin
      FROM v JOIN s ON v.kind = s.kind)
SELECT s.kind, CAST(r.i AS INTEGER) AS bin, round(s.lo + (r.i - 1) * ((s.hi - s.lo) / s.nb), 6) AS bin_lo,
       round(s.lo + r.i * ((s.hi - s.lo) / s.nb), 6) AS bin_hi,
       (SELECT COUNT(*) FROM b WHERE b.kind = s.kind AND b.bin = r.i) AS n
FROM s, range(1, 31) r(i) WHERE r.i <= s.nb""")
ORACLE["box_stats"] = with_fixtures(("titles",), """
, q AS (SELECT quantile_cont(min, 0.25) AS q1, quantile_cont(min, 0.5) AS median,
               quantile_cont(min, 0.75) AS q3 FROM titles WHERE min IS NOT NULL),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)
SELECT f.q1, f.median, f.q3, f.iqr,
       MIN(CASE WHEN t.min BETWEEN f.lo_f AND f.hi_f THEN CAST(t.min AS DOUBLE) END) AS whisker_lo,
       MAX(CASE WHEN t.min BETWEEN f.lo_f AND f.hi_f THEN CAST(t.min AS DOUBLE) END) AS whisker_hi,
       CAST(COUNT(*) FILTER (WHERE NOT (t.min BETWEEN f.lo_f AND f.hi_f)) AS BIGINT) AS n_outliers,
       COUNT(*) AS n
FROM titles t, f WHERE t.min IS NOT NULL
GROUP BY f.q1, f.median, f.q3, f.iqr""")
ORACLE["avg_duration_by_year"] = with_fixtures(("titles",), """
SELECT CAST(year(added_date) AS INTEGER) AS year, type, round(AVG(COALESCE(min, season)), 9) AS avg_duration
FROM titles WHERE year(added_date) >= 2000 AND COALESCE(min, season) IS NOT NULL
GROUP BY 1, 2""")


# ---- validation ------------------------------------------------------------------

FIXTURES["order_lines"] = ((), """
        SELECT o.o_orderkey AS order_id,
               CASE WHEN o.o_custkey % 31 = 0 THEN 'user ' || CAST(o.o_custkey AS VARCHAR)
                    ELSE '00000000-0000-4000-8000-' || lpad(CAST(o.o_custkey AS VARCHAR), 12, '0') END AS user_id,
               CASE WHEN o.o_custkey % 29 <> 0 THEN 'user' || CAST(o.o_custkey AS VARCHAR)
                    || CASE WHEN o.o_custkey % 17 = 0 THEN ' at ' ELSE '@' END || 'mail.example.com' END AS user_email,
               CASE WHEN o.o_orderstatus = 'P' THEN 'paid' WHEN o.o_orderstatus = 'F' THEN 'delivered'
                    WHEN o.o_orderkey % 19 = 0 THEN 'lost' ELSE 'new' END AS status,
               l.l_linenumber AS line_no,
               CASE WHEN l.l_partkey % 47 = 0 THEN NULL
                    WHEN l.l_partkey % 50 = 0 THEN 'sku-' || CAST(l.l_partkey AS VARCHAR)
                    WHEN l.l_partkey % 41 = 0 THEN 'K' || CAST(l.l_partkey % 10 AS VARCHAR)
                    WHEN l.l_partkey % 43 = 0 THEN 'SKU' || lpad(CAST(l.l_partkey AS VARCHAR), 10, '0')
                    ELSE 'SKU' || CAST(l.l_partkey AS VARCHAR) END AS sku,
               CASE WHEN l.l_partkey % 53 <> 0 THEN CAST(l.l_quantity AS INTEGER) - 1 END AS qty,
               CASE WHEN l.l_partkey % 37 = 0 THEN -1 WHEN l.l_partkey % 59 <> 0 THEN 1 END
                 * CAST((CAST(round(l.l_extendedprice * 100) AS BIGINT) % 100000) * CAST(0.001 AS DECIMAL(4,3))
                        AS DECIMAL(12,3)) AS unit_price
        FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey""")
# one row per order line and rule that it breaks, rules numbered in field order
FIXTURES["line_errors"] = (("order_lines",), """
        SELECT order_id, line_no, 1 AS rule, 'sku: missing' AS message
        FROM order_lines WHERE line_no IS NOT NULL AND sku IS NULL
        UNION ALL SELECT order_id, line_no, 2, 'sku: 3 to 12 capital letters or digits'
        FROM order_lines WHERE NOT regexp_full_match(sku, '[A-Z0-9]{3,12}')
        UNION ALL SELECT order_id, line_no, 3, 'qty: missing'
        FROM order_lines WHERE line_no IS NOT NULL AND qty IS NULL
        UNION ALL SELECT order_id, line_no, 4, 'qty: must be greater than 0' FROM order_lines WHERE qty <= 0
        UNION ALL SELECT order_id, line_no, 5, 'unit_price: missing'
        FROM order_lines WHERE line_no IS NOT NULL AND unit_price IS NULL
        UNION ALL SELECT order_id, line_no, 6, 'price: must not be negative'
        FROM order_lines WHERE unit_price < 0""")
FIXTURES["order_checks"] = (("order_lines",), """
        SELECT order_id, status, user_email, COUNT(line_no) AS n_items,
               CAST(round_even(COALESCE(SUM(qty * round_even(unit_price, 2)), 0), 2) AS DECIMAL(18,2)) AS total
        FROM order_lines GROUP BY order_id, status, user_email""")
FIXTURES["order_fields"] = (("order_checks", "line_errors"), """
        SELECT c.*,
               CASE WHEN user_email IS NULL THEN ['user_email: missing']
                    WHEN NOT regexp_full_match(user_email, '[^@\\s]+@[^@\\s]+\\.[^@\\s]+')
                    THEN ['user_email: not an e-mail address'] ELSE [] END AS email_errors,
               COALESCE((SELECT list(message ORDER BY rule) FROM
                         (SELECT DISTINCT rule, message FROM line_errors e WHERE e.order_id = c.order_id)), [])
                   AS item_errors,
               (SELECT arg_min(message, line_no * 10 + rule) FROM line_errors e WHERE e.order_id = c.order_id)
                   AS first_item,
               CASE WHEN status NOT IN ('new', 'paid', 'delivered', 'canceled') THEN ['status: unknown'] ELSE [] END
                   AS status_errors
        FROM order_checks c""")
FIXTURES["order_errors"] = (("order_fields",), """
        SELECT *, CASE WHEN len(email_errors) + len(item_errors) + len(status_errors) > 0
                       THEN list_concat(list_concat(email_errors, item_errors), status_errors)
                       WHEN n_items = 0 THEN ['items: must not be empty']
                       WHEN status IN ('paid', 'delivered') AND total = 0
                       THEN ['status ' || chr(39) || status || chr(39) || ' needs a total above 0'] ELSE [] END AS errors
        FROM order_fields""")
FIXTURES["signup"] = ((), """
        SELECT c_custkey AS user_key,
               CASE WHEN c_custkey % 31 = 0 THEN 'user ' || CAST(c_custkey AS VARCHAR)
                    ELSE '00000000-0000-4000-8000-' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') END AS id,
               lower(replace(c_name, '#', '_')) || CASE WHEN c_custkey % 23 = 0 THEN '' ELSE '@' END
                   || 'mail' || CAST(c_custkey % 5 AS VARCHAR) || '.example.com' AS email,
               '  cUSTOMER   ' || lower(c_mktsegment) || ' x' AS name,
               substr('abcdefghijklmnop', 1, CAST(c_custkey % 12 + 1 AS INTEGER)) AS password,
               CASE WHEN c_custkey % 41 = 0 THEN 'ftp://files.example.com' WHEN c_custkey % 3 <> 0
                    THEN 'https://www.mail' || CAST(c_custkey % 7 AS VARCHAR) || '.example.com/x' END AS website
        FROM customer""")
FIXTURES["energy"] = ((), """
        SELECT ts AS timestep, value AS consumption_eur, value / 2 AS consumption_sib,
               CAST(user_id AS DOUBLE) AS price_eur, value - 5 AS price_sib
        FROM events""")
FIXTURES["energy_checked"] = (("energy",), """
        SELECT *, list_filter([
                 CASE WHEN consumption_eur < 0 THEN 'consumption_eur: must not be negative' END,
                 CASE WHEN consumption_sib < 0 THEN 'consumption_sib: must not be negative' END,
                 CASE WHEN price_eur < 0 THEN 'price_eur: must not be negative' END,
                 CASE WHEN price_sib < 0 THEN 'price_sib: must not be negative' END,
                 CASE WHEN timestep IS NULL THEN 'timestep: not a timestamp' END],
               lambda x: x IS NOT NULL) AS errors
        FROM energy""")

ORACLE["validate_orders"] = with_fixtures(("order_errors",), """
SELECT order_id, status, n_items, total, errors, len(errors) = 0 AS valid FROM order_errors""")
ORACLE["first_error"] = with_fixtures(("order_errors",), """
SELECT order_id, len(errors) = 0 AS ok,
       CASE WHEN len(errors) = 0 THEN 'total=' || CAST(total AS VARCHAR)
            ELSE COALESCE(email_errors[1], first_item, errors[1]) END AS message
FROM order_errors""")
ORACLE["order_totals"] = with_fixtures(("order_checks",), "SELECT order_id, n_items, total FROM order_checks")
ORACLE["line_amount"] = with_fixtures(("order_lines",), """
SELECT order_id, line_no, qty, CAST(round_even(unit_price, 2) AS DECIMAL(12,2)) AS price,
       CAST(qty * round_even(unit_price, 2) AS DECIMAL(18,2)) AS amount
FROM order_lines WHERE line_no IS NOT NULL""")
ORACLE["rule_sku"] = with_fixtures(("order_lines",), """
SELECT order_id, line_no, sku, regexp_full_match(sku, '[A-Z0-9]{3,12}') AS sku_ok
FROM order_lines WHERE line_no IS NOT NULL""")
ORACLE["rule_sku_place"] = with_fixtures(("order_lines",), r"""
SELECT order_id, line_no, sku,
       CASE WHEN NOT (upper(sku) = sku AND lower(sku) <> sku AND regexp_full_match(sku, '[\p{L}\p{N}]+'))
            THEN 'sku: capital letters and digits only'
            WHEN length(sku) < 3 OR length(sku) > 12 THEN 'sku: 3 to 12 characters' END AS error
FROM order_lines WHERE line_no IS NOT NULL""")
ORACLE["rule_password"] = with_fixtures(("signup",), """
SELECT user_key, length(password) >= 8 AS password_ok,
       CASE WHEN password IS NOT NULL THEN '**********' END AS password
FROM signup""")
ORACLE["rule_email"] = with_fixtures(("signup",), r"""
SELECT user_key, regexp_full_match(email, '[^@\s]+@[^@\s]+\.[^@\s]+') AS email_ok,
       CASE WHEN website IS NULL THEN true ELSE regexp_full_match(website, 'https?://[^/?#\s]+.*') END
           AS website_ok,
       regexp_full_match(id, '[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}') AS id_ok
FROM signup""")
ORACLE["signup"] = with_fixtures(("signup",), r"""
, f AS (SELECT *, list_filter([
              CASE WHEN NOT regexp_full_match(id, '[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}')
                   THEN 'id: not a UUID' END,
              CASE WHEN NOT regexp_full_match(email, '[^@\s]+@[^@\s]+\.[^@\s]+')
                   THEN 'email: not an e-mail address' END,
              CASE WHEN length(password) < 8 THEN 'password: too short' END,
              CASE WHEN NOT regexp_full_match(website, 'https?://[^/?#\s]+.*')
                   THEN 'website: not an http(s) URL' END], lambda x: x IS NOT NULL) AS field_errors
        FROM signup)
SELECT user_key, array_to_string(list_transform(string_split(trim(regexp_replace(name, '\s+', ' ', 'g')), ' '),
                                                lambda w: upper(w[1]) || lower(w[2:])), ' ') AS name,
       email, '**********' AS password, website,
       CASE WHEN len(field_errors) > 0 THEN field_errors
            WHEN website = 'https://www.' || string_split(email, '@')[2] || '/x'
            THEN ['website: must not be the e-mail domain'] ELSE [] END AS errors,
       len(errors) = 0 AS valid
FROM f""")
ORACLE["user_out"] = with_fixtures(("signup",), r"""
SELECT id, email, true AS is_active FROM signup
WHERE starts_with(id, '00000000') AND email LIKE '%@%'""")
ORACLE["place_order"] = with_fixtures(("order_lines",), r"""
, e AS (SELECT *, CASE WHEN starts_with(user_id, 'user') THEN 'user_id: not a UUID'
                       WHEN sku IS NULL THEN 'sku: missing' WHEN qty IS NULL THEN 'qty: missing'
                       WHEN unit_price IS NULL THEN 'unit_price: missing'
                       WHEN NOT (upper(sku) = sku AND lower(sku) <> sku AND regexp_full_match(sku, '[\p{L}\p{N}]+'))
                       THEN 'sku: capital letters and digits only'
                       WHEN length(sku) NOT BETWEEN 3 AND 12 THEN 'sku: 3 to 12 characters'
                       WHEN qty <= 0 THEN 'qty: must be greater than 0'
                       WHEN unit_price < 0 THEN 'price: must not be negative' END AS error
        FROM order_lines WHERE line_no IS NOT NULL)
SELECT order_id, line_no, error, CASE WHEN error IS NULL THEN user_id END AS user_id,
       CASE WHEN error IS NULL THEN sku END AS sku, CASE WHEN error IS NULL THEN qty END AS qty,
       CASE WHEN error IS NULL THEN CAST(round_even(unit_price, 2) AS DECIMAL(12,2)) END AS price,
       CASE WHEN error IS NULL THEN CAST(qty * round_even(unit_price, 2) AS DECIMAL(18,2)) END AS amount
FROM e""")
ORACLE["order_totals_nested"] = with_fixtures(("order_checks",), "SELECT order_id, n_items, total FROM order_checks")
ORACLE["domain_rule"] = with_fixtures(("signup",), r"""
, d AS (SELECT user_key, email, website, lower(string_split(email, '@')[-1]) AS email_domain,
               regexp_replace(lower(regexp_extract(website, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/:?#@]+)', 1)),
                              '^www\.', '') AS site_host
        FROM signup)
SELECT user_key, email_domain, site_host,
       NOT COALESCE(email IS NOT NULL AND website IS NOT NULL AND site_host = email_domain, false) AS domain_ok
FROM d""")
ORACLE["normalize_name"] = with_fixtures(("signup",), r"""
SELECT user_key, name,
       array_to_string(list_transform(string_split(trim(regexp_replace(name, '\s+', ' ', 'g')), ' '),
                                      lambda w: upper(w[1]) || lower(w[2:])), ' ') AS name_normalized
FROM signup""")
ORACLE["redact"] = with_fixtures(("signup",), """
SELECT user_key, CASE WHEN password IS NOT NULL THEN '**********' END AS password, website FROM signup""")
ORACLE["rule_range"] = with_fixtures(("credit",), """
SELECT client_id, duration, duration BETWEEN 1 AND 60 AS duration_ok,
       CASE WHEN NOT (duration BETWEEN 1 AND 60) THEN 'duration: out of range 1-60' END AS error
FROM credit""")
ORACLE["rule_energy"] = """
WITH t AS (SELECT event_id, CASE WHEN event_id % 71 <> 0 THEN ts END AS timestep,
                  value * CASE WHEN event_id % 43 = 0 THEN -1 ELSE 1 END AS consumption_eur,
                  value / 2 * CASE WHEN event_id % 47 = 0 THEN -1 ELSE 1 END AS consumption_sib,
                  CAST(user_id * CASE WHEN event_id % 53 = 0 THEN -1 ELSE 1 END AS DOUBLE) AS price_eur,
                  value - 5 AS price_sib FROM events)
SELECT *, list_filter([CASE WHEN consumption_eur < 0 THEN 'consumption_eur: must not be negative' END,
                       CASE WHEN consumption_sib < 0 THEN 'consumption_sib: must not be negative' END,
                       CASE WHEN price_eur < 0 THEN 'price_eur: must not be negative' END,
                       CASE WHEN price_sib < 0 THEN 'price_sib: must not be negative' END,
                       CASE WHEN timestep IS NULL THEN 'timestep: not a timestamp' END],
                      lambda x: x IS NOT NULL) AS errors, len(errors) = 0 AS valid
FROM t"""
ORACLE["fill_defaults"] = with_fixtures(("mart_items",), """
SELECT order_id, item_id, CAST(COALESCE(item_discount, 0) AS DECIMAL(5,2)) AS item_discount,
       true AS is_active
FROM mart_items""")

# ---- energy records ------------------------------------------------------------

ENERGY_ORDER = "timestep, consumption_eur, consumption_sib, price_eur, price_sib"
ORACLE["row_ids"] = with_fixtures(("energy",), f"""
SELECT row_number() OVER (ORDER BY {ENERGY_ORDER}) AS id, * FROM energy""")
ORACLE["append_records"] = with_fixtures(("energy",), f"""
SELECT row_number() OVER (ORDER BY CASE WHEN timestep >= TIMESTAMP '2024-01-15 00:00:00' THEN 0
                                        WHEN consumption_eur >= 50 THEN 1 ELSE 2 END,
                          {ENERGY_ORDER}) AS id, * FROM energy""")
ORACLE["delete_records"] = with_fixtures(("energy_checked",), f"""
SELECT row_number() OVER (ORDER BY {ENERGY_ORDER}) AS id,
       timestep, consumption_eur, consumption_sib, price_eur, price_sib
FROM energy_checked WHERE len(errors) = 0""")
ORACLE["unpivot_energy"] = with_fixtures(("energy",), """
SELECT timestep, 'consumption_eur' AS variable, consumption_eur AS value FROM energy
UNION ALL SELECT timestep, 'consumption_sib', consumption_sib FROM energy
UNION ALL SELECT timestep, 'price_eur', price_eur FROM energy
UNION ALL SELECT timestep, 'price_sib', price_sib FROM energy""")
ORACLE["combine_dt"] = with_fixtures(("energy",), """
SELECT timestep, strftime(timestep, '%Y-%m-%d %H:%M') AS combined FROM energy""")
ORACLE["stream_intake"] = with_fixtures(("energy_checked",), """
SELECT timestep, consumption_eur, consumption_sib, price_eur, price_sib
FROM energy_checked WHERE len(errors) = 0""")
ORACLE["stream_rejects"] = with_fixtures(("energy_checked",), """
SELECT timestep, consumption_eur, consumption_sib, price_eur, price_sib, errors
FROM energy_checked WHERE len(errors) > 0""")
ORACLE["stream_dedup_keys"] = ORACLE["dim_users"]

ORACLE["price_quartiles"] = """
SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
       quantile_cont(l_extendedprice, 0.75) AS q3
FROM lineitem GROUP BY l_returnflag"""
ORACLE["price_box"] = """
WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
                  quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT q1, median, q3, iqr, MIN(l_extendedprice) FILTER (WHERE l_extendedprice BETWEEN lo AND hi) AS whisker_lo,
       MAX(l_extendedprice) FILTER (WHERE l_extendedprice BETWEEN lo AND hi) AS whisker_hi,
       COUNT(*) FILTER (WHERE NOT l_extendedprice BETWEEN lo AND hi) AS n_outliers, COUNT(l_extendedprice) AS n
FROM lineitem, f GROUP BY q1, median, q3, iqr"""
ORACLE["top_parts"] = """
SELECT l_partkey, COUNT(*) AS n FROM lineitem WHERE l_partkey IS NOT NULL
GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 20"""
ORACLE["order_mart_by_load"] = ORACLE["order_mart"]
ORACLE["item_mart_by_load"] = ORACLE["item_mart"]
