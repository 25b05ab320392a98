"""Column expressions: everything here returns a ``Column`` and runs inside
whole-stage codegen (no Python UDF anywhere)."""

from ledgerline.functions.coerce import (  # noqa: F401
    safe_decimal, safe_float, safe_int, safe_str, safe_ts,
)
from ledgerline.functions import scalars, rules  # noqa: F401
