"""Rule predicates for the validator (survey R1-R14).

Each function returns a Column that is TRUE when the row *fails* the rule.
A NULL input gives NULL, which the validator treats as passing; use
``required`` for presence rules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions import scalars as S

# ---- fixed values --------------------------------------------------------
# Fixed values that must equal the reference's for right results.
SKU_PATTERN = r"^[A-Z0-9]{3,12}\z"          # strict end: a trailing newline fails
SKU_MIN_LEN, SKU_MAX_LEN = 3, 12
PASSWORD_MIN_LEN = 8
ORDER_STATUSES = ("new", "paid", "delivered", "canceled")
PAID_STATUSES = ("paid", "delivered")
# Simple documented forms, not a full e-mail/URL grammar.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+\z"
UUID_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\z"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def required(col: str | Column) -> Column:
    """Value missing."""
    return _c(col).isNull()


def sku_format(col: str | Column) -> Column:
    """Not 3-12 characters of A-Z and 0-9."""
    return ~_c(col).rlike(SKU_PATTERN)


def sku_chars(col: str | Column) -> Column:
    """R2 (first message): not upper case, or not only letters and digits.
    Upper case means: no lower-case letter and at least one cased letter."""
    c = _c(col)
    is_upper = (F.upper(c) == c) & (F.lower(c) != c)
    is_alnum = c.rlike(r"^[\p{L}\p{N}]+\z")
    return ~(is_upper & is_alnum)


def sku_length(col: str | Column, lo: int = SKU_MIN_LEN, hi: int = SKU_MAX_LEN) -> Column:
    """R2 (second message): length outside lo..hi."""
    n = F.length(_c(col))
    return (n < lo) | (n > hi)


def not_positive(col: str | Column) -> Column:
    """Quantity <= 0."""
    return _c(col) <= 0


def negative(col: str | Column) -> Column:
    """Value < 0."""
    return _c(col) < 0


def too_short(col: str | Column, n: int = PASSWORD_MIN_LEN) -> Column:
    """Text shorter than n."""
    return F.length(_c(col)) < n


def too_long(col: str | Column, n: int) -> Column:
    """Text longer than n."""
    return F.length(_c(col)) > n


def site_equals_mail(email: str | Column, website: str | Column) -> Column:
    """Site host (no www.) equals the mail domain; only when both exist."""
    return F.when(_c(email).isNotNull() & _c(website).isNotNull(),
                  S.url_host(website) == S.email_domain(email))


def bad_email(col: str | Column) -> Column:
    """Not an e-mail address (simple form)."""
    return ~_c(col).rlike(EMAIL_PATTERN)


def bad_url(col: str | Column) -> Column:
    """Not an http(s) URL with a host."""
    c = _c(col)
    proto = F.lower(F.try_parse_url(c, F.lit("PROTOCOL")))
    host = F.try_parse_url(c, F.lit("HOST"))
    return F.when(c.isNotNull(), ~(proto.isin("http", "https") & host.isNotNull() & (host != F.lit(""))))


def bad_uuid(col: str | Column) -> Column:
    """Not a UUID text."""
    return ~_c(col).rlike(UUID_PATTERN)


def status_unknown(col: str | Column, allowed: tuple[str, ...] = ORDER_STATUSES) -> Column:
    """Status outside the allowed set."""
    return ~_c(col).isin(*allowed)


def paid_with_zero_total(status: str | Column, total: Column) -> Column:
    """Paid or delivered while the total is 0."""
    return _c(status).isin(*PAID_STATUSES) & (total == 0)


def out_of_range(col: str | Column, lo, hi) -> Column:
    """Number outside the closed range lo..hi."""
    return ~_c(col).between(lo, hi)


def unparsable(raw: str | Column, parsed: Column) -> Column:
    """A present input whose parse/cast gave NULL."""
    return _c(raw).isNotNull() & parsed.isNull()


def any_element(items: str | Column, pred) -> Column:
    """An element rule over an array fails the whole row."""
    return F.exists(_c(items), pred)
