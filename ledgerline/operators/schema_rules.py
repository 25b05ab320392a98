"""V4 / V1: a JSON schema document put to use.

``compile_schema`` turns the document into validator rules (TRUE = fails), one a
key word and field, for any table whose columns bear the fields' names; ``schema_summary``
runs them over a table in one pass. Understood are ``required``, ``type``, ``enum``, ``const``,
``minLength``, ``maxLength``, ``pattern`` (found anywhere, as JSON schema has it),
``minimum``, ``maximum``, ``exclusiveMinimum``, ``exclusiveMaximum``, ``multipleOf``, ``minItems``,
``maxItems``, ``items``, nested ``properties`` and ``$ref`` into the document;
``anyOf`` with ``null`` makes a field optional. Other key words that restrict
values are an error, so that no rule is left out unseen.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DataType, DateType, FractionalType, IntegralType, NumericType, StringType,
                               StructType, TimestampNTZType, TimestampType)

from ledgerline.operators.quality import Rule, any_failed

_NO_RULE = {"title", "description", "default", "examples", "format", "$defs", "definitions", "$schema", "$id",
            "additionalProperties", "properties", "required", "type", "items", "anyOf", "$ref"}
# key word -> (the rule's text, the column that is TRUE where a value breaks it)
_CHECKS: dict[str, tuple[str, Callable[[Column, object], Column]]] = {
    "enum": ("not one of {}", lambda c, v: ~c.isin(*v)),
    "const": ("not {}", lambda c, v: c != F.lit(v)),
    "minLength": ("shorter than {}", lambda c, v: F.length(c) < v),
    "maxLength": ("longer than {}", lambda c, v: F.length(c) > v),
    "pattern": ("does not match {}", lambda c, v: ~c.rlike(v)),
    "minimum": ("below {}", lambda c, v: c < v),
    "maximum": ("above {}", lambda c, v: c > v),
    "exclusiveMinimum": ("not above {}", lambda c, v: c <= v),
    "exclusiveMaximum": ("not below {}", lambda c, v: c >= v),
    "multipleOf": ("not a multiple of {}", lambda c, v: c % v != 0),
    "minItems": ("fewer than {} items", lambda c, v: F.size(c) < v),
    "maxItems": ("more than {} items", lambda c, v: F.size(c) > v),
}


def _holds(kind: str, data_type: DataType) -> bool:
    """Whether a column of ``data_type`` holds values of the schema type."""
    classes = {"string": (StringType, DateType, TimestampType, TimestampNTZType), "integer": IntegralType, "number": NumericType,
               "boolean": BooleanType, "array": ArrayType, "object": StructType}
    return isinstance(data_type, classes[kind])


def _resolved(node: Mapping, document: Mapping) -> tuple[dict, bool]:
    """The node with its reference followed, and whether null is allowed."""
    optional = False
    node = dict(node)
    for _ in range(100):
        if "$ref" in node:
            target = document
            for step in node.pop("$ref").lstrip("#/").split("/"):
                target = target[step]
            node = dict(target) | node
        elif "anyOf" in node:
            options = [o for o in node.pop("anyOf") if o.get("type") != "null"]
            if len(options) != 1:
                raise ValueError("anyOf is understood with one type and null")
            optional, node = True, dict(options[0]) | node
        elif isinstance(node.get("type"), list):
            kinds = [k for k in node["type"] if k != "null"]
            if len(kinds) != 1:
                raise ValueError("several types of one field")
            optional, node["type"] = optional or "null" in node["type"], kinds[0]
        else:
            return node, optional
    raise ValueError("references go round in a circle")


def _value_rules(node: Mapping, document: Mapping, value: Column, data_type: DataType, path: str) -> Iterator[Rule]:
    """Rules of a value that is present."""
    unknown = set(node) - set(_CHECKS) - _NO_RULE
    if unknown:
        raise ValueError(f"{path}: {', '.join(sorted(unknown))} is not understood")
    kind = node.get("type")
    if kind and not _holds(kind, data_type):
        whole = kind == "integer" and isinstance(data_type, FractionalType)
        yield Rule(f"{path}:type", f"{path}: not of type {kind}", (value != F.floor(value)) if whole else value.isNotNull())
        if not whole:
            return
    for word in (w for w in node if w in _CHECKS):
        text, fails = _CHECKS[word]
        shown = json.dumps(node[word], ensure_ascii=False) if word in ("enum", "const") else node[word]
        yield Rule(f"{path}:{word}", f"{path}: {text.format(shown)}", fails(value, node[word]))
    if "properties" in node:
        yield from _object_rules(node, document, value, data_type, path + ".")
    if "items" in node and isinstance(data_type, ArrayType):
        item, _ = _resolved(node["items"], document)

        def of_item(x: Column) -> list[Rule]:
            return list(_value_rules(item, document, x, data_type.elementType, f"{path}[]"))

        def broken(n: int) -> Callable[[Column], Column]:
            return lambda x: F.coalesce(of_item(x)[n].fails, F.lit(False))
        for n, rule in enumerate(of_item(F.lit(None).cast(data_type.elementType))):
            yield Rule(rule.name, rule.message, F.exists(value, broken(n)))


def _object_rules(node: Mapping, document: Mapping, whole: Column | None, schema: StructType, prefix: str = "") -> Iterator[Rule]:
    required = set(node.get("required", ()))
    types = {f.name: f.dataType for f in schema.fields}
    for name, field in node.get("properties", {}).items():
        path, (field, optional) = prefix + name, _resolved(field, document)
        if name not in types:
            if name in required:
                there = F.lit(True) if whole is None else whole.isNotNull()
                yield Rule(f"{path}:required", f"{path}: missing", there)
            continue
        value = F.col(f"`{name}`") if whole is None else whole.getField(name)
        if name in required and not optional:
            there = F.lit(True) if whole is None else whole.isNotNull()
            yield Rule(f"{path}:required", f"{path}: missing", value.isNull() & there)
        yield from _value_rules(field, document, value, types[name], path)


def compile_schema(document: str | Mapping, schema: StructType) -> list[Rule]:
    """The rules of the JSON schema ``document`` for a table of ``schema``."""
    document = json.loads(document) if isinstance(document, str) else document
    return list(_object_rules(document, document, None, schema))


def schema_summary(df: DataFrame, document: str | Mapping) -> DataFrame:
    """V4: one row per field of the document: field, type, n_fields (of the document),
    n_rows, n_nulls and n_violations (rows that break a rule of the field), counted in one pass
    over the columns that the rules need. A field that the table lacks is null
    in every row."""
    document = json.loads(document) if isinstance(document, str) else document
    rules = compile_schema(document, df.schema)
    fields = document.get("properties", {})
    if not fields:
        raise ValueError("the document has no properties")
    sums = [F.count(F.lit(1)).alias("n_rows")]
    for i, name in enumerate(fields):
        own = [r for r in rules if r.name.split(":")[0].split(".")[0].split("[]")[0] == name]
        null = F.col(f"`{name}`").isNull() if name in df.columns else F.lit(True)
        sums += [F.count(F.when(null, 1)).alias(f"nulls_{i}"), F.count(F.when(any_failed(own), 1)).alias(f"bad_{i}")]
    counted = df.agg(*sums)
    kinds = [_resolved(node, document)[0].get("type") for node in fields.values()]
    rows = F.explode(F.array(*[
        F.struct(F.lit(name).alias("field"), F.lit(kind).alias("type"), F.lit(len(fields)).alias("n_fields"), F.col("n_rows"),
                 F.col(f"nulls_{i}").alias("n_nulls"), F.col(f"bad_{i}").alias("n_violations"))
        for i, (name, kind) in enumerate(zip(fields, kinds))]))
    return counted.select(rows.alias("r")).select("r.*")
