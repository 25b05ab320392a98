"""Stream intake: incremental runs over one checkpoint, validation split,
keys kept once across batches and runs."""

import datetime as dt
import pathlib

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampNTZType)

from ledgerline.plans import registry
from ledgerline.plans import validation as V
from ledgerline.session import local_path, scratch_path
from ledgerline.streaming import accepted, first_rows, intake, rejected, stream_first_by_key, stream_records

ENERGY = StructType([StructField("timestep", TimestampNTZType())]
                    + [StructField(m, DoubleType()) for m in
                       ("consumption_eur", "consumption_sib", "price_eur", "price_sib")])
USERS = StructType([StructField("user_id", IntegerType()), StructField("user_phone", StringType()),
                    StructField("seq", LongType())])


def _energy(spark, rows):
    return spark.createDataFrame(rows, ENERGY)


def test_intake_incremental_and_split(spark):
    base = scratch_path(spark, "test_intake")
    t = dt.datetime(2024, 1, 1)
    _energy(spark, [(t, 1.0, 1.0, 1.0, 1.0), (t, -1.0, 1.0, 1.0, 1.0)]).coalesce(1) \
        .write.mode("append").parquet(f"{base}/in")
    args = (spark, f"{base}/in", ENERGY, V.energy_rules(), f"{base}/out", f"{base}/ck")
    stream_records(*args, max_files_per_trigger=1)
    assert accepted(spark, f"{base}/out").count() == 1
    assert rejected(spark, f"{base}/out").count() == 1
    # a second run without new files changes nothing
    stream_records(*args, max_files_per_trigger=1)
    assert accepted(spark, f"{base}/out").count() == 1
    # a new file is taken in, the old ones are not read again
    _energy(spark, [(t, 2.0, 2.0, 2.0, 2.0)]).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream_records(*args, max_files_per_trigger=1)
    out = accepted(spark, f"{base}/out")
    assert out.count() == 2 and sorted(r.consumption_eur for r in out.collect()) == [1.0, 2.0]
    rej = rejected(spark, f"{base}/out").first()
    assert rej.errors == ["consumption_eur: must not be negative"]


def test_keys_kept_once_across_batches(spark):
    base = scratch_path(spark, "test_keys")
    users = [[(1, "a", 1), (2, "b", 2), (1, "a2", 3)], [(2, "b2", 4), (3, "c", 5), (None, "n", 6)]]
    for rows in users:
        spark.createDataFrame(rows, USERS).coalesce(1).write.mode("append").parquet(f"{base}/in")
    args = (spark, f"{base}/in", USERS, ["user_id"], ["seq"], f"{base}/out", f"{base}/ck")
    stream_first_by_key(*args, max_files_per_trigger=1)
    out = {r.user_id: r.user_phone for r in spark.read.parquet(f"{base}/out").collect()}
    assert set(out) == {1, 2, 3}
    assert out[1] == "a"                    # first row inside the batch wins
    # a later file repeating a key adds nothing
    spark.createDataFrame([(3, "c2", 7), (4, "d", 8)], USERS).coalesce(1) \
        .write.mode("append").parquet(f"{base}/in")
    stream_first_by_key(*args, max_files_per_trigger=1)
    out2 = spark.read.parquet(f"{base}/out")
    assert out2.count() == 4 and {r.user_id: r.user_phone for r in out2.collect()}[3] == "c"


def _load(spark, base, rows, **options):
    """One file of rows per list, loaded a file a batch."""
    for part in rows:
        spark.createDataFrame(part, USERS).coalesce(1).write.mode("append").parquet(f"{base}/in")
    return stream_first_by_key(spark, f"{base}/in", USERS, ["user_id"], ["seq"], f"{base}/out", f"{base}/ck",
                               max_files_per_trigger=1, **options)


def _loaded(spark, base):
    return sorted((r.user_id, r.user_phone) for r in first_rows(spark, f"{base}/out").collect())


def test_later_batches_never_replace_a_loaded_row(spark):
    """A key of an earlier batch stays as loaded, also against a row of a
    lower order; ties go by the other columns, NULL first."""
    base = scratch_path(spark, "test_keys_order")
    _load(spark, base, [[(1, "first", 50), (2, "b", 9), (2, None, 9), (2, "a", 9)]])
    _load(spark, base, [[(1, "lower order", 1), (3, "c", 1)]])
    assert _loaded(spark, base) == [(1, "first"), (2, None), (3, "c")]
    assert first_rows(spark, f"{base}/out").columns == USERS.names


def test_a_batch_run_again_replaces_its_output(spark):
    """The offsets of the last batch are written, its commit is lost."""
    base = scratch_path(spark, "test_keys_again")
    _load(spark, base, [[(1, "a", 1)]])
    _load(spark, base, [[(1, "x", 0), (2, "b", 2)]])
    folder = pathlib.Path(local_path(base)) / "ck" / "commits"
    last = max(int(f.name) for f in folder.iterdir() if f.name.isdigit())
    for f in (folder / str(last), folder / f".{last}.crc"):
        f.unlink(missing_ok=True)
    _load(spark, base, [])
    assert _loaded(spark, base) == [(1, "a"), (2, "b")]
    _load(spark, base, [[(2, "y", 0), (4, "d", 4)]])
    assert _loaded(spark, base) == [(1, "a"), (2, "b"), (4, "d")]


def test_hot_key_is_combined_before_it_moves(spark):
    """A third of all rows is one key: the map tasks aggregate first."""
    base = scratch_path(spark, "test_keys_hot")
    rows = [(7 if i % 3 == 0 else i, f"p{i}", 10_000 - i) for i in range(9000)]
    q = _load(spark, base, [rows])
    loaded = dict(_loaded(spark, base))
    assert len(loaded) == len({r[0] for r in rows}) and loaded[7] == "p8997"
    plan = q._jsq.explainInternal(False)
    assert "partial_min" in plan and plan.index("partial_min") > plan.index("Exchange hashpartitioning") and "Python" not in plan


def test_clock_set_back_writes_nothing(spark, monkeypatch):
    base = scratch_path(spark, "test_keys_clock")
    _load(spark, base, [[(1, "a", 1)]])
    monkeypatch.setattr(intake, "_batch_time", lambda spark, checkpoint, batch: 1000 - batch)
    with pytest.raises(StreamingQueryException):
        _load(spark, base, [[(2, "b", 2)]])
    assert _loaded(spark, base) == [(1, "a")]
    monkeypatch.undo()
    _load(spark, base, [])
    assert _loaded(spark, base) == [(1, "a"), (2, "b")]


def test_a_long_backlog_takes_a_bounded_number_of_batches(spark, tmp_path):
    """300,000 records: 120 files of 2,500 rows would be 30 batches of 4 files."""
    n = 300_000
    spark.range(0, n, 1, 8).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id) AS ts", "id % 97 AS user_id",
        "'view' AS event_type", "cast(id % 20 AS double) AS value", "'' AS props").write.parquet(str(tmp_path / "events.parquet"))
    out = registry._taken_in(spark, str(tmp_path))
    batches = [f for f in pathlib.Path(local_path(out)).iterdir() if f.name.startswith("batch_id=")]
    assert 2 <= len(batches) <= registry.STREAM_BATCHES
    assert accepted(spark, out).count() + rejected(spark, out).count() == n
    # the same for few files of a fixed size: more of them a batch
    for i in range(7):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"part-{i}.parquet").touch()
    (tmp_path / "in" / "_SUCCESS").touch()
    assert [intake.files_per_batch(spark, str(tmp_path / "in"), k, b) for k, b in ((1, 3), (4, 3), (1, 100))] == [3, 4, 1]
