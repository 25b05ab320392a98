"""Relational and aggregate operators on hand-made rows."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import aggregates as A
from ledgerline.operators import relational as RL
from ledgerline.operators import schema_rules as SR
from ledgerline.operators.quality import annotate


def test_histogram_edges_and_empty_bins(spark):
    df = spark.createDataFrame([(a, "g") for a in (19, 20, 74, 75, 76)] + [(22, "b")],
                               "age int, risk string")
    h = A.histogram(df, "age", list(range(20, 76, 5)), by="risk", total=True).collect()
    assert len(h) == 3 * 11                       # every bin of both classes and overall
    got = sorted((r.risk, r.bin, r.n) for r in h if r.n)
    assert got == [("all", 1, 2), ("all", 11, 2), ("b", 1, 1), ("g", 1, 1), ("g", 11, 2)]


def test_histogram_null_class_and_values(spark):
    rows = [(21.0, None), (22.0, "x"), (None, "x"), (float("nan"), "x"), (None, "y")]
    df = spark.createDataFrame(rows, "age double, risk string")
    got = sorted((r.risk or "-", r.bin, r.n) for r in A.histogram(df, "age", [20, 25, 30], by="risk").collect())
    assert got == [("-", 1, 1), ("-", 2, 0), ("all", 1, 2), ("all", 2, 0), ("x", 1, 1), ("x", 2, 0),
                   ("y", 1, 0), ("y", 2, 0)]


def test_histogram_n(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,), (float("nan"),)], "x double")
    r = sorted((x.bin, x.n) for x in A.histogram_n(df, "x", 10).collect())
    assert r == [(1, 2)] + [(i, 0) for i in range(2, 11)]
    two = spark.createDataFrame([("a", 0.0), ("a", 4.0), ("b", 1.0), ("b", 1.0), ("c", 9.0)], "k string, x double")
    got = sorted((x.k, x.bin, x.bin_lo, x.n) for x in A.histogram_n(two, "x", {"a": 4, "b": 2}, by="k").collect())
    assert got == [("a", 1, 0.0, 1), ("a", 2, 1.0, 0), ("a", 3, 2.0, 0), ("a", 4, 3.0, 1),
                   ("b", 1, 1.0, 2), ("b", 2, 1.0, 0)]


def test_box_stats_keep_null_group(spark):
    df = spark.createDataFrame([(None, x) for x in (1, 2, 3)] + [("a", 5)], "g string, x int")
    got = {r.g: (r.median, r.n) for r in A.box_stats(df, "x", by=["g"]).collect()}
    assert got == {None: (2.0, 3), "a": (5.0, 1)}


def test_ties_kept_by_rank(spark):
    df = spark.createDataFrame([("c", 1, 5), ("c", 2, 5), ("c", 3, 1)], "cat string, item int, q int")
    got = RL.top_ranked(df, ["cat"], [F.col("q").desc()], n=1).collect()
    assert sorted(r.item for r in got) == [1, 2]


def test_period_end_included(spark):
    df = spark.createDataFrame([(dt.datetime(2016, 1, 31, 10, 0),), (dt.datetime(2016, 2, 1, 0, 0),)],
                               "ts timestamp_ntz")
    got = RL.between_dates(df, "ts", "2016-01-01", "2016-01-31").collect()
    assert len(got) == 1


def test_row_ids_and_delete(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, v string").repartition(3)
    ids = RL.with_row_id(df, ["k"]).orderBy("id").collect()
    assert [(r.id, r.v) for r in ids] == [(1, "a"), (2, "b"), (3, "c")]
    withid = RL.with_row_id(df, ["k"])
    left = RL.delete_records(withid, spark.createDataFrame([(2,)], "id long"))
    assert [(r.id, r.v) for r in left.orderBy("id").collect()] == [(1, "a"), (2, "c")]
    with pytest.raises(KeyError):
        RL.delete_records(withid, spark.createDataFrame([(9,)], "id long"))


def test_row_ids_many_partitions(spark):
    df = spark.range(0, 5000, 1, 16).select((F.col("id") * 7 % 5000).alias("k"))
    got = RL.with_row_id(df, ["k"])
    assert got.filter(F.col("id") != F.col("k") + 1).count() == 0
    assert got.count() == 5000


def test_two_appends_keep_stored_ids(spark):
    rows = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k int")
    stored = RL.with_row_id(rows(5, 7), ["k"])
    stored = RL.append_records(stored, rows(1), ["k"])
    stored = RL.append_records(stored, rows(9), ["k"])
    assert {r.k: r.id for r in stored.collect()} == {5: 1, 7: 2, 1: 3, 9: 4}
    # a delete keeps the stored order, whatever the keys are
    left = RL.delete_records(stored, spark.createDataFrame([(2,)], "id long"))
    assert {r.k: r.id for r in left.collect()} == {5: 1, 1: 2, 9: 3}


def test_insert_new_and_fk(spark):
    existing = spark.createDataFrame([(1, "a")], "id int, v string")
    incoming = spark.createDataFrame([(1, "x"), (2, "b"), (None, "n")], "id int, v string")
    got = sorted(tuple(r) for r in RL.insert_new(existing, incoming, ["id"]).collect())
    assert got == [(1, "a"), (2, "b")]
    child = spark.createDataFrame([(10, 1), (11, 3), (12, None)], "oid int, id int")
    orphans = RL.check_fk(child, existing, "id").collect()
    assert [r.oid for r in orphans] == [11]


def test_crosstab_zero_fill_and_duplicates(spark):
    df = spark.createDataFrame([("a", "good"), ("a", "bad"), ("a", "good")], "s string, r string")
    got = [tuple(r) for r in A.crosstab(df, "s", "r", ["b", "a"], ["good", "bad"]).orderBy("position").collect()]
    assert got == [(1, "b", 0, 0), (2, "a", 2, 1)]
    with pytest.raises(ValueError):
        A.crosstab(df, "s", "r", ["a", "a"], ["good"])


def test_quantiles_and_box(spark):
    df = spark.createDataFrame([(x,) for x in (1, 2, 3, 4, 100)], "x int")
    q = A.group_quantiles(df.filter("x < 10"), [], "x", names=["a", "b", "c"]).first()
    assert (q.a, q.b, q.c) == (1.75, 2.5, 3.25)
    b = A.box_stats(df, "x").first()
    assert b.n_outliers == 1 and b.whisker_hi == 4.0 and b.whisker_lo == 1.0


def test_value_counts_and_share(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), ("c",)], "c string")
    vc = [(r.c, r.n) for r in A.value_counts(df, "c", k=2).collect()]
    assert vc == [("a", 2), ("b", 1)]
    sh = {r.c: r.share for r in A.top_k_share(df, "c", 2).collect()}
    assert sh == {"a": 2 / 3, "b": 1 / 3}


def test_monthly_mean_skips_empty_months(spark):
    rows = [(dt.date(2020, 1, 5),), (dt.date(2020, 1, 6),), (dt.date(2021, 1, 1),), (None,)]
    df = spark.createDataFrame(rows, "d date")
    got = [(r.month, r.avg_count) for r in A.monthly_mean_count(df, "d").collect()]
    assert got == [(1, 1.5)]


def test_row_ids_hot_key_spread(spark):
    df = spark.range(0, 4000, 1, 8).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    got = RL.with_row_id(df, ["k"])
    assert got.select(F.min("id"), F.max("id"), F.countDistinct("id")).first() == (1, 4000, 4000)
    # equal keys keep their input order
    assert got.filter(F.col("id") != F.col("v") + 1).count() == 0


DOCUMENT = {
    "title": "Order", "required": ["id", "items", "sku", "gone"],
    "$defs": {"Item": {"type": "object", "required": ["qty"], "properties": {
        "qty": {"type": "integer", "exclusiveMinimum": 0}, "code": {"type": "string", "pattern": "^[A-Z]+$"}}}},
    "properties": {
        "id": {"type": "integer", "minimum": 1, "maximum": 9}, "sku": {"type": ["string", "null"], "minLength": 3, "maxLength": 5},
        "status": {"enum": ["new", "paid"]}, "price": {"type": "number", "multipleOf": 0.5}, "whole": {"type": "integer"},
        "items": {"type": "array", "minItems": 1, "maxItems": 2, "items": {"$ref": "#/$defs/Item"}},
        "home": {"anyOf": [{"$ref": "#/$defs/Home"}, {"type": "null"}]}, "gone": {"type": "string"}, "flag": {"const": True}}}
DOCUMENT["$defs"]["Home"] = {"type": "object", "required": ["city"], "properties": {"city": {"type": "string", "maxLength": 4}}}
ORDER_TYPE = ("id int, sku string, status string, price double, whole double, items array<struct<qty:int,code:string>>, "
              "home struct<city:string>, flag boolean")


def test_rules_of_a_schema_document(spark):
    good = (1, "abc", "new", 1.5, 2.0, [(1, "A")], ("Rome",), True)
    def broken(**changes):
        names = [c.split()[0] for c in ORDER_TYPE.replace("struct<qty:int,code:string>", "x").split(", ")]
        return tuple(changes.get(n, v) for n, v in zip(names, good))
    cases = [({}, []), ({"id": 0}, ["id: below 1"]), ({"id": 10}, ["id: above 9"]), ({"id": None}, ["id: missing"]),
             ({"sku": None}, []), ({"sku": "ab"}, ["sku: shorter than 3"]), ({"sku": "abcdef"}, ["sku: longer than 5"]),
             ({"status": "old"}, ['status: not one of ["new", "paid"]']), ({"status": None}, []),
             ({"price": 1.25}, ["price: not a multiple of 0.5"]), ({"whole": 2.5}, ["whole: not of type integer"]),
             ({"items": []}, ["items: fewer than 1 items"]), ({"items": None}, ["items: missing"]),
             ({"items": [(1, "A")] * 3}, ["items: more than 2 items"]), ({"items": [(1, None), (0, "A")]}, ["items[].qty: not above 0"]),
             ({"items": [(None, "a")]}, ["items[].qty: missing", "items[].code: does not match ^[A-Z]+$"]),
             ({"home": None}, []), ({"home": (None,)}, ["home.city: missing"]), ({"home": ("Paris",)}, ["home.city: longer than 4"]),
             ({"flag": False}, ["flag: not true"])]
    df = spark.createDataFrame([broken(**c) for c, _ in cases], ORDER_TYPE)
    got = annotate(df, SR.compile_schema(json.dumps(DOCUMENT), df.schema)).collect()
    for row, (case, errors) in zip(got, cases):
        assert sorted(row.errors) == sorted([*errors, "gone: missing"]), case
    summary = {r.field: r for r in SR.schema_summary(df, DOCUMENT).collect()}
    assert list(summary) == list(DOCUMENT["properties"]) and summary["id"].n_fields == 9
    assert (summary["id"].n_rows, summary["id"].n_nulls, summary["id"].n_violations) == (20, 1, 3)
    assert summary["items"].n_violations == 5 and summary["gone"].n_nulls == 20 and summary["home"].n_violations == 2


def test_schema_documents_that_are_not_understood(spark):
    schema = spark.createDataFrame([], "a string").schema
    for node in ({"type": "string", "contains": 1}, {"anyOf": [{"type": "string"}, {"type": "integer"}]}, {"$ref": "#/properties/a"}):
        with pytest.raises(ValueError):
            SR.compile_schema({"properties": {"a": node}}, schema)
    with pytest.raises(ValueError):
        SR.schema_summary(spark.createDataFrame([], "a string"), {})
    empty = SR.schema_summary(spark.createDataFrame([], "a string"), {"properties": {"a": {"type": "integer"}}}).first()
    assert (empty.n_rows, empty.n_violations) == (0, 0)


def test_money_units_round_other_types(spark):
    from decimal import Decimal

    from ledgerline.functions import scalars as S
    df = spark.createDataFrame([(0.29, 2.5), (1.005, 12.345)], "p double, d double")
    got = [tuple(r) for r in df.select(S.cents("p"), S.factor_units("d")).collect()]
    assert got == [(29, 9750), (101, 8765)]
    exact = spark.createDataFrame([(Decimal("0.29"),)], "p decimal(10,2)").select(S.cents("p")).first()[0]
    assert exact == 29


def _plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [1, 64, 65, 4096, 4097, 20_000])
def test_delete_against_brute_force(spark, n):
    """Deletions at the ends of words and blocks, runs of them, and none."""
    stored = spark.range(1, n + 1).select("id", (F.col("id") * 10).alias("v"))
    edges = {1, 2, 63, 64, 65, 128, 4095, 4096, 4097, 8192, 8193, n} | set(range(5000, 5300)) | set(range(9000, 13_500))
    for gone in (set(), {n}, {i for i in edges if i <= n}, set(range(1, n + 1)), {i for i in range(1, n + 1) if i % 3}):
        ids = spark.createDataFrame([(i,) for i in gone] * 2, "id long")          # repeated ids count once
        got = sorted((r.id, r.v) for r in RL.delete_records(stored, ids).collect())
        assert got == [(k + 1, i * 10) for k, i in enumerate(i for i in range(1, n + 1) if i not in gone)]


def test_delete_neither_sorts_nor_writes_the_stored_rows(spark):
    stored = spark.range(1, 50_001).select("id", (F.col("id") % 7).alias("v"))
    left = RL.delete_records(stored, spark.createDataFrame([(5,), (49_999,)], "id long"))
    plan = _plan_of(left)
    assert "rangepartitioning" not in plan and "Scan ExistingRDD" not in plan.split("Range (1, 50001")[0][-400:]
    assert left.agg(F.min("id"), F.max("id"), F.count_distinct("id")).first() == (1, 49_998, 49_998)


def test_delete_of_unknown_and_sparse_ids(spark):
    stored = spark.createDataFrame([(i, i) for i in (1, 2, 3)], "id long, v int")
    for bad in (0, 4, None):
        with pytest.raises(KeyError):
            RL.delete_records(stored, spark.createDataFrame([(bad,)], "id long"))
    assert RL.delete_records(stored, spark.createDataFrame([(9,), (2,)], "id long"), check=False).count() == 2
    sparse = spark.createDataFrame([(10, 1), (20, 2), (30, 3)], "id long, v int")        # numbered anew
    assert sorted(map(tuple, RL.delete_records(sparse, spark.createDataFrame([(20,)], "id long")).collect())) == [(1, 1), (2, 3)]
    doubled = spark.createDataFrame([(1, 1), (1, 2), (4, 3), (4, 4)], "id long, v int")  # count, bounds and sum as of 1..4
    assert sorted(r.id for r in RL.delete_records(doubled, spark.createDataFrame([(4,)], "id long")).collect()) == [1, 2]
    none = spark.createDataFrame([], "id long, v int")
    assert RL.delete_records(none, spark.createDataFrame([], "id long")).count() == 0
    whole = spark.createDataFrame([(1, 1), (2, 2)], "id int, v int")
    assert RL.delete_records(whole, spark.createDataFrame([(1,)], "id long")).schema == whole.schema


def test_row_ids_need_no_uncompressed_copy(spark, tmp_path):
    """Ids of rows in written files: one compressed, sorted copy, no checkpoint and no second staging."""
    import os

    from ledgerline.session import ensure_checkpoint_dir, local_path
    folder = local_path(ensure_checkpoint_dir(spark))

    def held():
        return {os.path.relpath(os.path.join(b, d), folder) for b, ds, _ in os.walk(folder) for d in ds
                if d.startswith(("rdd-", "row-ids-", "ordered-"))}

    df = spark.range(0, 5000, 1, 7).selectExpr("cast(id % 300 as int) k", "id v", "cast(null as string) z")
    df.write.parquet(str(tmp_path / "in"))
    rows = spark.read.schema(df.schema).parquet(str(tmp_path / "in")).select("*", *RL.row_place())
    before = held()
    got = RL.with_row_id(rows, ["k"], "n", placed=True)
    assert got.columns == ["n", "k", "v", "z"]
    found = sorted((r.n, r.k, r.v) for r in got.collect())
    assert [n for n, _, _ in found] == list(range(1, 5001))
    assert [k for _, k, _ in found] == sorted(i % 300 for i in range(5000))
    assert sorted(v for _, _, v in found) == list(range(5000))
    assert [n.split("/")[-1].split("-")[0] for n in held() - before] == ["ordered"]
    assert RL.with_row_id(df, ["k"], drop=["k"]).columns == ["id", "v", "z"]
    assert not any(n.split("/")[-1].startswith("rdd-") for n in held() - before)
