"""Rule predicates and the validator."""

from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.functions import rules as R
from ledgerline.operators.quality import Rule, annotate, first_error, validate
from ledgerline.plans import validation as V


def test_sku_rules(spark):
    df = spark.createDataFrame([("ABC123",), ("123",), ("AB",), ("abc",), ("ABC1\n",)], "s string")
    rows = df.select((~R.sku_format("s")).alias("ok"), V.sku_place_error("s").alias("e")).collect()
    assert [r.ok for r in rows] == [True, True, False, False, False]
    assert rows[0].e is None
    assert rows[1].e == V.MSG_SKU_CHARS          # no letter: not upper case
    assert rows[2].e == V.MSG_SKU_LEN
    assert rows[3].e == V.MSG_SKU_CHARS


def test_site_equals_mail(spark):
    df = spark.createDataFrame([("a@x.com", "https://www.X.com/"), ("a@x.com", None),
                                ("a@y.com", "https://x.com")], "e string, w string")
    got = [r[0] for r in df.select(F.coalesce(R.site_equals_mail("e", "w"), F.lit(False))).collect()]
    assert got == [True, False, False]


def test_email_url_uuid(spark):
    df = spark.createDataFrame([("a@b.co", "https://h.io/x", "123e4567-e89b-12d3-a456-426614174000"),
                                ("nope", "ftp://h.io", "xyz")], "e string, w string, u string")
    rows = df.select(R.bad_email("e"), R.bad_url("w"), R.bad_uuid("u")).collect()
    assert tuple(rows[0]) == (False, False, False)
    assert tuple(rows[1]) == (True, True, True)


def test_validate_split_and_first_error(spark):
    df = spark.createDataFrame([(1, 5), (2, -1), (3, None)], "id int, q int")
    rules = [Rule("q_pos", "q must be > 0", R.not_positive("q")),
             Rule("q_req", "q missing", R.required("q"))]
    valid, rejects = validate(df, rules)
    assert [r.id for r in valid.collect()] == [1]
    rej = {r.id: r.errors for r in rejects.collect()}
    assert rej == {2: ["q must be > 0"], 3: ["q missing"]}
    ok, text = first_error("errors", F.lit("fine"))
    got = annotate(df, rules).select("id", ok.alias("ok"), text.alias("t")).orderBy("id").collect()
    assert [(r.ok, r.t) for r in got] == [(True, "fine"), (False, "q must be > 0"), (False, "q missing")]


ITEMS = "items array<struct<sku:string, qty:int, unit_price:decimal(12,3)>>"
FLAT = ("order_id int, status string, user_email string, line_no int, sku string, qty int, "
        "unit_price decimal(12,3)")
MAIL = "a@mail.example.com"


def _both(spark, rows):
    """Results of the nested and the flat form for (order_id, status, email, items)."""
    nested = V.order_checks_nested(
        spark.createDataFrame(rows, f"order_id int, status string, user_email string, {ITEMS}"))
    flat_rows = [(oid, st, mail, n, *item) for oid, st, mail, items in rows
                 for n, item in (enumerate(items, 1) if items else [(None, (None, None, None))])]
    flat = V.order_checks_flat(spark.createDataFrame(flat_rows, FLAT))
    out = []
    for checks in (nested, flat):
        lists = {r.order_id: (r.valid, r.errors, r.total) for r in V.validate_orders(checks).collect()}
        first = {r.order_id: (r.ok, r.message) for r in V.order_result(checks).collect()}
        out.append((lists, first))
    return out


def test_orders_nested_and_flat_agree(spark):
    nothing = Decimal("0.000")
    rows = [
        (1, "paid", MAIL, [("ABC123", 1, nothing)]),                    # paid with total 0
        (2, "new", MAIL, [("ABC123", 1, nothing)]),                     # fine
        (3, "new", MAIL, []),                                           # no items
        (4, "delivered", MAIL, [("ABC", 0, nothing), ("abc", 1, Decimal("1.00"))]),
        (5, "lost", MAIL, [("ABC123", 1, Decimal("999.99")), ("DEF456", 2, Decimal("29.50"))]),
        (6, "paid", MAIL, [("abc", 1, nothing)]),                       # total rule not checked
        (7, "new", None, [("ABC", None, None), (None, 1, Decimal("-1.000"))]),
        (8, "new", "nobody", []),
    ]
    nested, flat = _both(spark, rows)
    assert nested == flat
    lists, first = flat
    assert lists[1] == (False, ["status 'paid' needs a total above 0"], Decimal("0.00"))
    assert lists[2] == (True, [], Decimal("0.00")) and first[2] == (True, "total=0.00")
    assert lists[3][1] == [V.MSG_NO_ITEMS]
    assert lists[4][1] == [V.MSG_SKU, V.MSG_QTY]
    assert first[4] == (False, V.MSG_QTY)             # line 1 comes first, whatever the rule
    assert lists[5] == (False, [V.MSG_STATUS], Decimal("1058.99"))
    assert lists[6][1] == [V.MSG_SKU]
    assert lists[7][1] == ["user_email: missing", "sku: missing", "qty: missing", "unit_price: missing",
                           V.MSG_PRICE]
    assert first[7] == (False, "user_email: missing")
    assert lists[8][1] == ["user_email: not an e-mail address"]


def test_place_order(spark):
    good = "123e4567-e89b-12d3-a456-426614174000"
    rows = [(1, good, "ABC123", 2, Decimal("19.995")), (2, "me", "abc", 0, Decimal("1")),
            (3, good, "ABCDEFGHIJKLM", 1, Decimal("1")), (4, good, "ABC", 1, Decimal("-0.010")),
            (5, good, "ABC", None, Decimal("1"))]
    df = spark.createDataFrame(rows, "k int, user_id string, sku string, qty int, unit_price decimal(12,3)")
    got = {r.k: r for r in V.place_order(df).collect()}
    assert (got[1].error, got[1].price, got[1].amount) == (None, Decimal("20.00"), Decimal("40.00"))
    assert [got[k].error for k in (2, 3, 4, 5)] == ["user_id: not a UUID", V.MSG_SKU_LEN, V.MSG_PRICE, "qty: missing"]
    assert got[4].amount is None and got[4].sku is None


def test_signup(spark):
    rows = [(1, None, "a@x.com", " aNNA  lee ", "12345678", "https://y.com"),
            (2, "zz", None, "b", "short", "ftp://h.io"),
            (3, None, "a@x.com", "c", "12345678", "https://www.x.com/")]
    df = spark.createDataFrame(rows, "user_key int, id string, email string, name string, password string, website string")
    got = {r.user_key: r for r in V.signup(df).collect()}
    assert (got[1].valid, got[1].name, got[1].password) == (True, "Anna Lee", "**********")
    assert got[2].errors == [V.MSG_UUID, "email: missing", V.MSG_PASSWORD, V.MSG_WEBSITE]
    assert got[3].errors == [V.MSG_SITE_IS_MAIL]


def test_every_rule_message_fires_on_the_fixtures(spark):
    from ledgerline.plans.registry import QUERIES
    sf = "/root/testdata/sf0.01"

    def messages(query, column="errors"):
        df = QUERIES[query](spark, sf)
        one = F.explode(column) if dict(df.dtypes)[column].startswith("array") else F.col(column)
        return {r[0] for r in df.select(one.alias("m")).distinct().collect()}

    assert {m for _, m in V.ITEM_RULES} | {V.MSG_STATUS, V.MSG_NO_ITEMS, "user_email: missing"} \
        <= messages("validate_orders")
    assert {V.MSG_SKU_CHARS, V.MSG_SKU_LEN} <= messages("rule_sku_place", "error")
    assert {V.MSG_UUID, V.MSG_EMAIL, V.MSG_PASSWORD, V.MSG_WEBSITE, V.MSG_SITE_IS_MAIL} <= messages("signup")
    assert len(messages("rule_energy")) == 5
    assert len(messages("load_rejects", "reason")) == 3


def test_energy_rules(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", 1.0, 1.0, 1.0, -0.5)],
                               "timestep string, consumption_eur double, consumption_sib double, "
                               "price_eur double, price_sib double") \
        .withColumn("timestep", F.col("timestep").cast("timestamp_ntz"))
    r = annotate(df, V.energy_rules()).first()
    assert r.errors == ["price_sib: must not be negative"]
