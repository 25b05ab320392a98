"""Order and sign-up validation as Spark jobs (survey V1-V4, R1-R12).

Orders come either flat (one row per order line; the scalable path: the
per-order checks are aggregates, map-side combined, so an order with very
many lines is never gathered into one list) or nested (an ``items`` array
per order, checked with array functions)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import rules as R
from ledgerline.functions import scalars as S
from ledgerline.operators import relational as RL
from ledgerline.operators.quality import Rule, annotate, any_failed

# ---- fixed values --------------------------------------------------------
MSG_SKU = "sku: 3 to 12 capital letters or digits"
MSG_SKU_CHARS = "sku: capital letters and digits only"
MSG_SKU_LEN = "sku: 3 to 12 characters"
MSG_QTY = "qty: must be greater than 0"
MSG_PRICE = "price: must not be negative"
MSG_STATUS = "status: unknown"
MSG_NO_ITEMS = "items: must not be empty"
MSG_PASSWORD = "password: too short"
MSG_EMAIL = "email: not an e-mail address"
MSG_WEBSITE = "website: not an http(s) URL"
MSG_SITE_IS_MAIL = "website: must not be the e-mail domain"
MSG_UUID = "id: not a UUID"
MSG_NEGATIVE = "must not be negative"
MSG_RANGE = "out of range"
MISSING = "missing"

# Rules of an order line, in the order they are checked: name, message.
ITEM_RULES = (("sku_missing", f"sku: {MISSING}"), ("sku", MSG_SKU), ("qty_missing", f"qty: {MISSING}"),
              ("qty", MSG_QTY), ("price_missing", f"unit_price: {MISSING}"), ("price", MSG_PRICE))
_PER_LINE = 10                                   # more than the rules of a line


def _item_fails(sku: Column, qty: Column, price: Column) -> list[Column]:
    """Whether each of ``ITEM_RULES`` fails (never NULL)."""
    fails = [R.required(sku), R.sku_format(sku), R.required(qty), R.not_positive(qty),
             R.required(price), R.negative(price)]
    return [F.coalesce(f, F.lit(False)) for f in fails]


def _first_failed(fails: list[Column]) -> Column:
    """Number of the first failing rule, NULL when none fails."""
    return F.coalesce(*[F.when(f, F.lit(i)) for i, f in enumerate(fails)])


def order_checks_flat(lines: DataFrame, key: str = "order_id", status: str = "status",
                      email: str = "user_email", line: str = "line_no") -> DataFrame:
    """Per order: item count, total (B26), which item rules some line breaks,
    and the first error of the lines (by line, then rule) as
    ``line * 10 + rule``. A row with NULL line columns stands for an order
    without items. All aggregates are map-side combined."""
    amount = S.line_amount("qty", "unit_price")
    is_line = F.col(line).isNotNull()
    fails = [is_line & f for f in _item_fails(F.col("sku"), F.col("qty"), F.col("unit_price"))]
    return lines.groupBy(key, status, email).agg(
        F.count(line).alias("n_items"),
        F.bround(F.coalesce(F.sum(amount), F.lit(0)), 2).cast("decimal(18,2)").alias("total"),
        *[F.bool_or(f).alias(f"bad_{name}") for (name, _), f in zip(ITEM_RULES, fails)],
        F.min(F.col(line).cast("long") * _PER_LINE + _first_failed(fails)).alias("first_item_error"),
    )


def order_checks_nested(orders: DataFrame, items: str = "items") -> DataFrame:
    """The same per-order columns from an ``items`` array of
    struct<sku, qty, unit_price>."""
    it = F.coalesce(F.col(items), F.array())

    def fails(x: Column) -> list[Column]:
        return _item_fails(x["sku"], x["qty"], x["unit_price"])

    def fails_rule(i: int):
        return lambda x: fails(x)[i]

    first = F.array_min(F.transform(it, lambda x, i: i.cast("long") * _PER_LINE + _first_failed(fails(x))))
    return orders.select(
        "*",
        F.size(it).cast("bigint").alias("n_items"),
        S.order_total(it).cast("decimal(18,2)").alias("total"),
        *[R.any_element(it, fails_rule(i)).alias(f"bad_{name}") for i, (name, _) in enumerate(ITEM_RULES)],
        first.alias("first_item_error"),
    )


PIECE_ITEMS = 1000


def nested_pieces(lines: DataFrame, keys: Sequence[str], item: Column, piece_items: int = PIECE_ITEMS) -> DataFrame:
    """Lines nested by ``keys`` in pieces: one row per key and run of ``piece_items`` places in
    a written file, with an ``items`` array of at most that many. A hot order is
    spread over many rows and tasks. A null ``item`` is no item."""
    piece = F.struct("__file", F.floor(F.col("__row") / piece_items).alias("run"))
    return (RL.placed_rows(lines).groupBy(*keys, piece.alias("__piece"))
            .agg(F.collect_list(item).alias("items")).drop("__piece"))


def order_checks_pieces(pieces: DataFrame, keys: Sequence[str] = ("order_id",)) -> DataFrame:
    """B26, B27, R9, R10 per order, from pieces of its items: item count, total and one
    flag per item rule. Totals of pieces are whole cents, so their sum is the total."""
    checked = order_checks_nested(pieces)
    return checked.groupBy(*keys).agg(
        F.sum("n_items").alias("n_items"), F.sum("total").cast("decimal(18,2)").alias("total"),
        *[F.bool_or(f"bad_{name}").alias(f"bad_{name}") for name, _ in ITEM_RULES])


def field_rules(status: str = "status", email: str = "user_email") -> list[Rule]:
    """The rules of single fields, in field order: e-mail, lines, status."""
    return [
        Rule("email_missing", f"user_email: {MISSING}", R.required(email)),
        Rule("email", f"user_{MSG_EMAIL}", R.bad_email(email)),
        *[Rule(name, message, F.col(f"bad_{name}")) for name, message in ITEM_RULES],
        Rule("status", MSG_STATUS, R.status_unknown(status)),
    ]


def order_rules(status: str = "status", email: str = "user_email") -> list[Rule]:
    """All rules of an order. The rules of the whole order (R9, R10) are
    checked only where all its fields are valid."""
    fields = field_rules(status, email)
    valid = ~any_failed(fields)
    st = F.col(status)
    return [
        *fields,
        Rule("items", MSG_NO_ITEMS, valid & (F.col("n_items") == 0)),
        Rule("paid_zero", F.concat(F.lit("status '"), st, F.lit("' needs a total above 0")),
             valid & (F.col("n_items") > 0) & R.paid_with_zero_total(st, F.col("total"))),
    ]


def validate_orders(checks: DataFrame, key: str = "order_id") -> DataFrame:
    """V1: every order with its error list and a valid flag."""
    a = annotate(checks, order_rules(), "errors", valid="valid")
    return a.select(key, "status", "n_items", "total", "errors", "valid")


def order_result(checks: DataFrame, key: str = "order_id") -> DataFrame:
    """V2: ``(ok, text)`` per order: ``total=<amount>`` or the first error in
    the order of the fields, the lines in turn."""
    a = annotate(checks, order_rules(), "errors")
    ok = F.size("errors") == 0
    names = [r.name for r in field_rules()[:2]]
    of_email = F.coalesce(*[F.when(F.coalesce(r.fails, F.lit(False)), r.message_col())
                            for r in field_rules() if r.name in names])
    texts = F.array(*[F.lit(message) for _, message in ITEM_RULES])
    of_item = F.when(F.col("first_item_error").isNotNull(),
                     F.element_at(texts, (F.col("first_item_error") % _PER_LINE + 1).cast("int")))
    text = F.when(ok, F.concat(F.lit("total="), F.col("total").cast("string"))) \
        .otherwise(F.coalesce(of_email, of_item, F.element_at("errors", 1)))
    return a.select(key, ok.alias("ok"), text.alias("message"))


def sku_place_error(col: str = "sku") -> Column:
    """R2: the first failing message of the place-order SKU checks, or NULL."""
    return (F.when(R.sku_chars(col), F.lit(MSG_SKU_CHARS))
            .when(R.sku_length(col), F.lit(MSG_SKU_LEN)))


def place_order(calls: DataFrame, user: str = "user_id", sku: str = "sku", qty: str = "qty",
                price: str = "unit_price") -> DataFrame:
    """One placed order per row: the first error, or the order with its
    price rounded half-even and its amount. Missing values and the user's UUID
    come first, then SKU (R2), quantity (R3) and price (R4)."""
    missing = [F.when(R.required(c), F.lit(f"{c}: {MISSING}")) for c in (user, sku, qty, price)]
    error = F.coalesce(F.when(R.bad_uuid(user), F.lit(f"{user}: not a UUID")), *missing, sku_place_error(sku),
                       F.when(R.not_positive(qty), F.lit(MSG_QTY)), F.when(R.negative(price), F.lit(MSG_PRICE)))
    rounded = S.cents_half_even(price).cast("decimal(12,2)")
    ok = F.col("error").isNull()
    return calls.withColumn("error", error).select(
        *[c for c in calls.columns if c not in (user, sku, qty, price)],
        "error", *[F.when(ok, F.col(c)).alias(c) for c in (user, sku, qty)],
        F.when(ok, rounded).alias("price"),
        F.when(ok, S.line_amount(qty, price).cast("decimal(18,2)")).alias("amount"))


def signup_rules() -> list[Rule]:
    """R5-R7 in field order; the rule across fields (R6) only where the fields
    are valid."""
    fields = [
        Rule("id", MSG_UUID, R.bad_uuid("id")),
        Rule("email_missing", f"email: {MISSING}", R.required("email")),
        Rule("email", MSG_EMAIL, R.bad_email("email")),
        Rule("password_missing", f"password: {MISSING}", R.required("password")),
        Rule("password", MSG_PASSWORD, R.too_short("password")),
        Rule("website", MSG_WEBSITE, R.bad_url("website")),
    ]
    return [*fields, Rule("site_is_mail", MSG_SITE_IS_MAIL,
                          ~any_failed(fields) & R.site_equals_mail("email", "website"))]


def signup(df: DataFrame) -> DataFrame:
    """Sign-up rows with their error list, the normalised name and the
    hidden password."""
    a = annotate(df, signup_rules(), "errors", valid="valid")
    return a.select("user_key", S.normalize_name("name").alias("name"), "email",
                    S.redact("password").alias("password"), "website", "errors", "valid")


def signup_checks(df: DataFrame) -> DataFrame:
    """R5-R7 on sign-up rows, one flag per rule."""
    return df.select(
        "user_key",
        (~F.coalesce(R.too_short("password"), F.lit(False))).alias("password_ok"),
        (~F.coalesce(R.bad_email("email"), F.lit(False))).alias("email_ok"),
        (~F.coalesce(R.bad_url("website"), F.lit(False))).alias("website_ok"),
        (~F.coalesce(R.bad_uuid("id"), F.lit(False))).alias("id_ok"),
        (~F.coalesce(R.site_equals_mail("email", "website"), F.lit(False))).alias("domain_ok"),
    )


def user_out(users: DataFrame) -> DataFrame:
    """The stored user as it goes out: id (a UUID), e-mail, is_active;
    rows whose id or e-mail is not one are left out."""
    bad = [Rule("id", MSG_UUID, R.required("id") | R.bad_uuid("id")),
           Rule("email", MSG_EMAIL, R.required("email") | R.bad_email("email"))]
    return users.filter(~any_failed(bad)).select(F.lower("id").alias("id"), "email", "is_active")


def energy_rules(measures=("consumption_eur", "consumption_sib", "price_eur", "price_sib"),
                 ts: str = "timestep") -> list[Rule]:
    """R11 (one rule per measure) and R14."""
    rules = [Rule(f"{m}_negative", f"{m}: {MSG_NEGATIVE}", R.negative(m)) for m in measures]
    rules.append(Rule("timestep", "timestep: not a timestamp", F.col(ts).isNull()))
    return rules


def parsed_energy(raw: DataFrame) -> DataFrame:
    """Energy records with the time as text, parsed (NULL if unparsable)."""
    return raw.withColumn("timestep", S.parse_ts_text("timestep"))
