"""Null-safe coercions (survey B1-B4): a value that is missing or does not
parse becomes NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, FractionalType, NumericType, StringType, StructField


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _not_nan(c: Column, dtype: DataType | None) -> Column:
    # NaN only exists for float/double input.
    if isinstance(dtype, FractionalType):
        return F.when(~F.isnan(c), c)
    return c


def safe_int(col: str | Column, dtype: DataType | None = None) -> Column:
    """B1: to 32-bit int. Fractions truncate toward zero, text such as
    ``'12.5'`` or ``'abc'`` and out-of-range values give NULL, NaN gives NULL,
    surrounding blanks are ignored."""
    c = _not_nan(_c(col), dtype)
    return c.try_cast("int")


def safe_float(col: str | Column, dtype: DataType | None = None) -> Column:
    """B2: to double; NaN and unparsable text give NULL."""
    c = _c(col).try_cast("double")
    return F.when(~F.isnan(c), c)


def safe_decimal(col: str | Column, precision: int, scale: int,
                 dtype: DataType | None = None) -> Column:
    """To decimal(p,s), rounding half away from zero on store; a value
    that does not fit or does not parse gives NULL."""
    c = _not_nan(_c(col), dtype)
    return c.try_cast(f"decimal({precision},{scale})")


def safe_str(col: str | Column, dtype: DataType | None = None) -> Column:
    """To text; the text ``'NaT'`` gives NULL, an empty text stays."""
    c = _not_nan(_c(col), dtype).cast("string")
    return F.when(c != F.lit("NaT"), c)


def safe_ts(col: str | Column, dtype: DataType | None = None) -> Column:
    """To timestamp without time zone; ``'NaT'`` and unparsable text give
    NULL, timestamps pass through."""
    c = _c(col)
    if dtype is not None and not isinstance(dtype, StringType):
        return c.try_cast("timestamp_ntz")
    return F.when(c.cast("string") != F.lit("NaT"), c.cast("string").try_cast("timestamp_ntz"))


def coerce_field(col: str | Column, target: StructField, source: DataType | None = None) -> Column:
    """Coerce one column to the declared field type with the null-safe rules."""
    t = target.dataType.simpleString()
    if t == "int":
        return safe_int(col, source)
    if t in ("double", "float"):
        return safe_float(col, source)
    if t.startswith("decimal"):
        return safe_decimal(col, target.dataType.precision, target.dataType.scale, source)
    if t == "string":
        return safe_str(col, source)
    if t in ("timestamp_ntz", "timestamp"):
        return safe_ts(col, source)
    if isinstance(target.dataType, NumericType):
        return _c(col).try_cast(t)
    return _c(col).try_cast(t)
