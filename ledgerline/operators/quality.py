"""Rule engine (survey V1-V3): every rule is evaluated in one projection;
the row keeps the list of failed rule messages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


@dataclass(frozen=True)
class Rule:
    """``fails`` is TRUE when the row breaks the rule; NULL counts as passing.
    ``message`` is a text or a Column (a message built from the row)."""
    name: str
    message: str | Column
    fails: Column

    def message_col(self) -> Column:
        return self.message if isinstance(self.message, Column) else F.lit(self.message)


def errors_column(rules: Sequence[Rule]) -> Column:
    """Messages of the failed rules, in rule order. Built as a concat of
    one-element arrays, which stays in generated code (a lambda ``filter``
    over the array would be evaluated row by row, interpreted)."""
    empty = F.array().cast("array<string>")
    if not rules:
        return empty
    parts = [F.when(F.coalesce(r.fails, F.lit(False)), F.array(r.message_col())).otherwise(empty)
             for r in rules]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def any_failed(rules: Sequence[Rule]) -> Column:
    """TRUE when at least one rule fails (a cheap boolean: use it to split
    rows rather than the size of the error list)."""
    if not rules:
        return F.lit(False)
    out = F.coalesce(rules[0].fails, F.lit(False))
    for r in rules[1:]:
        out = out | F.coalesce(r.fails, F.lit(False))
    return out


def annotate(df: DataFrame, rules: Sequence[Rule], errors: str = "errors",
             valid: str | None = None) -> DataFrame:
    """V1: add the error list (one projection, no shuffle); with ``valid``
    also a boolean column that is TRUE when no rule failed."""
    out = df.withColumn(errors, errors_column(rules))
    if valid:
        out = out.withColumn(valid, ~any_failed(rules))
    return out


def validate(df: DataFrame, rules: Sequence[Rule], errors: str = "errors") -> tuple[DataFrame, DataFrame]:
    """V1: split into valid rows and rejects (rejects keep the error list).
    Both outputs share one plan; cache or write the input when both are
    consumed."""
    bad = any_failed(rules)
    valid = df.filter(~bad)
    rejects = df.filter(bad).withColumn(errors, errors_column(rules))
    return valid, rejects


def first_error(errors: str | Column, ok_text: Column) -> tuple[Column, Column]:
    """V2: ``(ok, text)``: ``ok_text`` when no rule failed, else the first
    failed rule's message."""
    e = F.col(errors) if isinstance(errors, str) else errors
    ok = F.size(e) == 0
    return ok, F.when(ok, ok_text).otherwise(F.element_at(e, 1))


def conform(df: DataFrame, schema, widths: dict[str, int] | None = None,
            required: Sequence[str] = (), keep: Sequence[str] = (),
            errors: str = "errors", valid: str | None = None,
            extra_rules: Sequence[Rule] = ()) -> DataFrame:
    """B5 + R13: cast every column of ``schema`` with the null-safe coercions
    and list what breaks the declared types: a present value that does not
    fit (NULL after the cast), text longer than its width, a required value
    missing. ``keep`` columns pass through unchanged (keys, load order).
    ``extra_rules`` are checked on the conformed columns; ``valid`` names a
    boolean column for splitting good rows from rejects."""
    from ledgerline.functions import rules as R
    from ledgerline.functions.coerce import coerce_field

    src = dict((f.name, f.dataType) for f in df.schema.fields)
    cols, checks, misfits = [], [], []
    for f in schema.fields:
        if f.name in src and src[f.name] == f.dataType and not isinstance(f.dataType, StringType):
            c = F.col(f.name)                       # already the declared type: nothing to check
        elif f.name in src:
            raw = F.col(f.name)
            c = coerce_field(raw, f, src[f.name])
            # judged on the raw value, before the cast one takes its name
            misfits.append(R.unparsable(raw, c).alias(f"__misfit_{f.name}"))
            checks.append(Rule(f"{f.name}_type",
                               f"{f.name}: value does not fit {f.dataType.simpleString()}",
                               F.col(f"__misfit_{f.name}")))
        else:
            c = F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    out = df.select(*[F.col(k) for k in keep], *cols, *misfits)
    for name, n in (widths or {}).items():
        checks.append(Rule(f"{name}_len", f"{name}: longer than {n}", R.too_long(name, n)))
    for name in required:
        checks.append(Rule(f"{name}_required", f"{name}: missing", R.required(name)))
    checks.extend(extra_rules)
    return annotate(out, checks, errors, valid).drop(*[f"__misfit_{f.name}" for f in schema.fields])


def fill_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Missing values take a default (a value or a Column)."""
    out = df
    for name, v in defaults.items():
        d = v if isinstance(v, Column) else F.lit(v)
        if name in df.columns:
            out = out.withColumn(name, F.coalesce(F.col(name), d.cast(df.schema[name].dataType)))
        else:
            out = out.withColumn(name, d)
    return out
