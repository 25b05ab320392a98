"""Scalar column expressions (survey B6-B28). All built-in functions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---- fixed values --------------------------------------------------------
# Fixed values that must equal the reference's for right results.
WEEKEND_DAYS = ("Saturday", "Sunday")
PRICE_CUT = 5
PRICE_HIGH, PRICE_LOW = "High", "Low"
REDACTED = "**********"
LONG_DATE_FORMAT = "MMMM d, yyyy"
DATETIME_MINUTE_FORMAT = "yyyy-MM-dd HH:mm"


def to_int(col: str | Column) -> Column:
    """Number to int, truncating toward zero (9.99 -> 9); NULL when the
    value does not fit."""
    return _c(col).try_cast("int")


def weekend_flag(col: str | Column, days: tuple[str, ...] = WEEKEND_DAYS) -> Column:
    """1 on a weekend day name, else 0 (NULL name gives 0)."""
    return F.when(_c(col).isin(*days), F.lit(1)).otherwise(F.lit(0))


def price_category(col: str | Column, cut: float = PRICE_CUT) -> Column:
    """``High`` when the price is above ``cut``, else ``Low`` (NULL is Low)."""
    return F.when(_c(col) > F.lit(cut), F.lit(PRICE_HIGH)).otherwise(F.lit(PRICE_LOW))


def remap(col: str | Column, mapping: Mapping[str, str]) -> Column:
    """Replace values found in ``mapping``; others pass unchanged."""
    if not mapping:
        return _c(col)
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(m, _c(col)), _c(col))


def city_of(col: str | Column) -> Column:
    """Text before the first comma (whole text without comma)."""
    return F.split_part(_c(col), F.lit(","), F.lit(1))


def ymd(col: str | Column) -> tuple[Column, Column, Column]:
    """Year, month, day of month (ints)."""
    c = _c(col)
    return F.year(c), F.month(c), F.dayofmonth(c)


def parse_ts_text(col: str | Column) -> Column:
    """Timestamp text to timestamp without zone; NULL when it does not parse.
    No session time zone is involved."""
    return _c(col).cast("string").try_cast("timestamp_ntz")


def hour_of(col: str | Column) -> Column:
    """Hour of a timestamp or timestamp text."""
    return F.hour(parse_ts_text(col))


def parse_long_date(col: str | Column, trim: bool = False) -> Column:
    """``'September 25, 2021'`` to a date; anything else gives NULL. With
    ``trim=False`` (default) a leading blank does not parse."""
    c = _c(col)
    if trim:
        c = F.trim(c)
    return F.try_to_date(c, LONG_DATE_FORMAT)


def combine_dt(date: str | Column, time: str | Column) -> Column:
    """Date + time to a ``yyyy-MM-dd HH:mm`` text."""
    ts = F.concat_ws(" ", _c(date).cast("string"), _c(time).cast("string")).try_cast("timestamp_ntz")
    return F.date_format(ts, DATETIME_MINUTE_FORMAT)


def leading_int(col: str | Column, when: Column | None = None) -> Column:
    """The leading whitespace-separated number of a text, as int; only
    where ``when`` holds, else NULL."""
    first = F.element_at(F.split(F.trim(_c(col)), r"\s+"), 1)
    v = first.try_cast("int")
    return v if when is None else F.when(when, v)


def decimal_factor(discount_pct: str | Column) -> Column:
    """``1 - coalesce(d, 0)/100`` as an exact decimal(7,4) for a NUMERIC(5,2)
    percentage, so later products and sums stay exact (survey H1)."""
    d = F.coalesce(_c(discount_pct), F.lit(0).cast("decimal(5,2)"))
    return (F.lit(1) - d / F.lit(100)).cast("decimal(7,4)")


def cents(price: str | Column) -> Column:
    """Money as an exact count of cents (long); other types and scales are
    first rounded half-up to cents, as the store does."""
    return (_c(price).cast("decimal(18,2)") * F.lit(100)).cast("long")


def factor_units(discount_pct: str | Column) -> Column:
    """``1 - coalesce(d, 0)/100`` in exact units of 1e-4 (long) for a
    NUMERIC(5,2) percentage: 2.51 % -> 9749. Other types and scales are first
    rounded half-up to two places."""
    d = F.coalesce(_c(discount_pct).cast("decimal(5,2)"), F.lit(0).cast("decimal(5,2)"))
    return F.lit(10000) - (d * F.lit(100)).cast("long")


def units_to_decimal(units: str | Column, scale: int, precision: int = 28) -> Column:
    """An exact integer count of 10^-scale units back to decimal(p, scale)."""
    from decimal import Decimal
    step = F.lit(Decimal(1).scaleb(-scale))
    return (_c(units).cast("decimal(20,0)") * step).cast(f"decimal({precision},{scale})")


def gross_amount(price: str | Column, qty: str | Column) -> Column:
    """Price x quantity."""
    return _c(price) * _c(qty)


def net_amount(price: str | Column, qty: str | Column,
               item_discount: str | Column, order_discount: str | Column | None = None) -> Column:
    """Price x qty x (1 - item%) [x (1 - order%)], exact decimal."""
    v = gross_amount(price, qty) * decimal_factor(item_discount)
    if order_discount is not None:
        v = v * decimal_factor(order_discount)
    return v


def revenue(price: str | Column, qty: str | Column) -> Column:
    """Price x quantity."""
    return _c(price) * _c(qty)


def cents_half_even(col: str | Column) -> Column:
    """Half-even rounding to 0.01 (validators' rounding, survey H5)."""
    return F.bround(_c(col), 2)


def line_amount(qty: str | Column, price: str | Column) -> Column:
    """Quantity x price rounded half-even to cents."""
    return _c(qty) * cents_half_even(price)


def normalize_name(col: str | Column) -> Column:
    """Collapse blanks, capitalise each word, lower the rest."""
    return F.initcap(F.trim(F.regexp_replace(_c(col), r"\s+", " ")))


def email_domain(col: str | Column) -> Column:
    """Text after the last ``@``, lower case."""
    return F.lower(F.element_at(F.split(_c(col), "@"), -1))


def url_host(col: str | Column) -> Column:
    """Host of a URL, lower case, leading ``www.`` cut."""
    host = F.lower(F.try_parse_url(_c(col), F.lit("HOST")))
    return F.regexp_replace(host, r"^www\.", "")


def redact(col: str | Column) -> Column:
    """Hide a secret; NULL stays NULL."""
    return F.when(_c(col).isNotNull(), F.lit(REDACTED))


def order_total(items: str | Column, qty: str = "qty", price: str = "unit_price") -> Column:
    """Sum of qty x price over an array of structs; each price rounded
    half-even to cents first, the total rounded half-even too. An item without
    quantity or price adds nothing."""
    zero = F.lit(0).cast("decimal(38,2)")
    total = F.aggregate(
        _c(items), zero,
        lambda acc, x: (acc + F.coalesce(x[qty] * F.bround(x[price], 2), F.lit(0))).cast("decimal(38,2)"),
    )
    return F.bround(total, 2)


def n_items(col: str | Column) -> Column:
    """Number of array elements."""
    return F.size(_c(col))


def day_col(k: int) -> Column:
    """The k-th day column of the wide sales table."""
    return F.col(f"d_{int(k)}")
