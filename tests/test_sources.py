"""Scans and sinks."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.session import local_path, scratch_path
from ledgerline.sources import files as IO
from ledgerline.sources import versions as VE


def test_csv_roundtrip_schema_text_and_infer(spark):
    path = scratch_path(spark, "csv_t")
    df = spark.createDataFrame([(1, "a", 2.5), (2, "b", None)], "id int, name string, v double")
    IO.write_csv(df, path, drop=("id",))
    text = IO.scan_csv(spark, path)
    assert text.columns == ["name", "v"] and dict(text.dtypes)["v"] == "string"
    typed = IO.scan_csv(spark, path, "name string, v double")
    assert sorted((r.name, r.v) for r in typed.collect()) == [("a", 2.5), ("b", None)]
    inferred = IO.scan_csv(spark, path, infer=True)
    assert dict(inferred.dtypes)["v"] == "double"


def test_overwrite_sink_partitioned(spark):
    path = scratch_path(spark, "sink_t")
    df = spark.createDataFrame([(2024, 1), (2025, 2)], "year int, v int")
    IO.write_table(df, path, partition_by=("year",))
    IO.write_table(df.filter("year = 2025"), path, partition_by=("year",))
    back = spark.read.parquet(path)
    assert [(r.year, r.v) for r in back.collect()] == [(2025, 2)]       # full refresh
    assert glob.glob(local_path(path) + "/year=2025/*.parquet")


def test_preview_and_register(spark):
    df = spark.range(10).select(F.col("id").alias("k"))
    assert [r.k for r in IO.preview(df, 3, order_by=[F.col("k").desc()]).collect()] == [9, 8, 7]
    IO.register(df, "ledgerline_test_view")
    assert spark.sql("SELECT count(*) AS n FROM ledgerline_test_view").first().n == 10


def test_empty_folder_is_an_error(spark, tmp_path):
    import pytest
    with pytest.raises(FileNotFoundError):
        IO.scan_parquet_dir(spark, str(tmp_path), spark.range(1).schema)


def test_declared_table_schemas_match_files(spark):
    from ledgerline.plans.tables import SCHEMAS
    for name, schema in SCHEMAS.items():
        for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
            assert spark.read.parquet(f"{sf}/{name}.parquet").schema.simpleString() == \
                schema.simpleString(), (name, sf)


# ---- A5: several tables refreshed as one ---------------------------------------

def _numbers(spark, n, start=0):
    return spark.range(start, start + n).withColumnRenamed("id", "v")


def _breaks(spark):
    """A table whose write fails in a task."""
    return spark.range(10).select(F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("broken table")).cast("long")).alias("v"))


def test_a_failing_table_leaves_all_old_ones(spark):
    root = scratch_path(spark, "published")
    names = ("users", "stores", "drivers", "orders", "order_items")
    VE.publish(spark, root, {n: _numbers(spark, i + 1) for i, n in enumerate(names)})
    before = VE.published(spark, root)
    new = {n: _breaks(spark) if n == "orders" else _numbers(spark, 100) for n in names}
    with pytest.raises(Exception, match="broken table"):
        VE.publish(spark, root, new)
    assert VE.published(spark, root) == before and VE.versions(spark, root) == [1]
    assert [VE.read_published(spark, root, n).count() for n in names] == [1, 2, 3, 4, 5]
    assert len(os.listdir(f"{local_path(root)}/data")) == 1              # nothing of the failed one is left
    VE.publish(spark, root, new | {"orders": _numbers(spark, 100)})
    assert [VE.read_published(spark, root, n).count() for n in names] == [100] * 5
    assert VE.read_published(spark, root, "orders", version=1).count() == 4


def test_a_reader_of_the_old_refresh_is_not_disturbed(spark):
    root = scratch_path(spark, "published")
    VE.publish(spark, root, {"t": _numbers(spark, 5), "kept": _numbers(spark, 2)})
    old = VE.read_published(spark, root, "t")
    VE.publish(spark, root, {"t": _numbers(spark, 7).withColumn("w", F.col("v"))}, {"t": ("w",)})
    assert old.count() == 5 and VE.read_published(spark, root, "t").count() == 7
    assert VE.read_published(spark, root, "kept").count() == 2           # not part of the second refresh
    assert VE.drop_old(spark, root) == 0                                 # "kept" still lies in the first folder
    VE.publish(spark, root, {"t": _numbers(spark, 7), "kept": _numbers(spark, 3)})
    assert VE.drop_old(spark, root) == 2 and VE.versions(spark, root) == [3]
    assert VE.read_published(spark, root, "kept").count() == 3


def test_two_refreshes_at_once(spark, monkeypatch):
    root = scratch_path(spark, "published")
    VE.publish(spark, root, {"t": _numbers(spark, 1)})
    monkeypatch.setattr(VE._Folder, "versions", lambda self: [])         # has not seen the first one
    with pytest.raises(Exception, match="(?i)exist"):
        VE.publish(spark, root, {"t": _numbers(spark, 2)})
    monkeypatch.undo()
    assert VE.read_published(spark, root, "t").count() == 1
    assert os.listdir(f"{local_path(root)}/manifests").count("000000000001.json") == 1


def test_what_a_dead_refresh_left_goes_after_a_while(spark):
    root = scratch_path(spark, "published")
    with pytest.raises(FileNotFoundError):
        VE.published(spark, root)
    VE.publish(spark, root, {"t": _numbers(spark, 1)})
    _numbers(spark, 3).write.parquet(f"{root}/data/dead/t")
    assert VE.drop_old(spark, root) == 0
    assert VE.drop_old(spark, root, unfinished_hours=-1) == 1
    assert VE.read_published(spark, root, "t").count() == 1
    with pytest.raises(ValueError):
        VE.drop_old(spark, root, keep=0)


def test_csv_rejects_keep_every_line(spark):
    path = scratch_path(spark, "csv_rejects")
    lines = ['1,"a, b",2.5', "x,y,1", "2,only two", '3,"q ""in"" it",1,extra', "4,,", "5,z,n/a", "nan,z,also", "", ',"", ', '6,"esc \\" ok",7']
    spark.createDataFrame([(t,) for t in lines], "value string").coalesce(1).write.text(path)
    schema = spark.createDataFrame([], "id int, name string, v double").schema
    rows, rejects = IO.scan_csv_checked(spark, path, schema, header=False)
    assert rows.columns == ["id", "name", "v"]
    assert [tuple(r) for r in rows.orderBy("id").collect() if r.id] == [(1, "a, b", 2.5), (4, None, None), (6, 'esc " ok', 7.0)]
    got = {r.line: r.reasons for r in rejects.collect()}
    assert got["x,y,1"] == ["id: value does not fit int"] and got["5,z,n/a"] == ["v: value does not fit double"]
    assert got["nan,z,also"] == ["id: value does not fit int", "v: value does not fit double"]
    assert got["2,only two"] == ["2 cells, 3 expected"] and got['3,"q ""in"" it",1,extra'] == ["4 cells, 3 expected"]
    assert rows.count() + len(got) == len([t for t in lines if t])
    assert all(r.file.endswith(".txt") for r in rejects.collect())
