"""File-stream intake with validation and key de-duplication.

The intake writes batch ``n`` to ``<out>/batch_id=n`` in overwrite mode, so a
batch that is run again after a failure (the checkpoint has its offsets but not
its commit) replaces its own output instead of adding duplicates; so does the
key load, which keeps its keys in the stream's state store.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.operators.quality import Rule, annotate


def _batch_path(base: str, batch_id: int) -> str:
    return f"{base.rstrip('/')}/batch_id={int(batch_id)}"


def files_per_batch(spark: SparkSession, src_dir: str, at_least: int, batches: int) -> int:
    """Files of a micro-batch so that what lies in ``src_dir`` is drained in ``batches``
    of them, or in fewer with ``at_least`` files each. A micro-batch has a price of its
    own (log, state, commit) whatever it holds, so a backlog is cut into a
    number of batches and not into batches of a size."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(src_dir)
    listed = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    n = sum(not f.getPath().getName().startswith(("_", ".")) for f in listed)
    return max(at_least, -(-n // batches))


def stream_records(spark: SparkSession, src_dir: str, schema: StructType, rules: Sequence[Rule],
                   out_dir: str, checkpoint: str,
                   max_files_per_trigger: int | None = None, wait: bool = True):
    """New record files are validated. Each batch is read once and written
    once, with its error list and parted by ``valid``; :func:`accepted` and
    :func:`rejected` read the two sides. Runs with ``availableNow`` and stops
    by itself when the folder is drained."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(src_dir)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        (annotate(batch, rules, "errors", valid="valid").write.mode("overwrite")
         .partitionBy("valid").parquet(_batch_path(out_dir, batch_id)))

    q = (stream.writeStream.foreachBatch(each_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q


def accepted(spark: SparkSession, out_dir: str) -> DataFrame:
    """The valid rows that :func:`stream_records` has taken in."""
    return (spark.read.parquet(out_dir).filter(F.col("valid").cast("boolean"))
            .drop("batch_id", "valid", "errors"))


def rejected(spark: SparkSession, out_dir: str) -> DataFrame:
    """The rows it has rejected, with their error lists."""
    return spark.read.parquet(out_dir).filter(~F.col("valid").cast("boolean")).drop("batch_id", "valid")


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_STORE = "spark.sql.streaming.stateStore.providerClass"
_CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"     # a commit writes changes only


def _batch_time(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """Milliseconds that the stream's log gives batch ``batch_id``; the same when
    the batch is run again."""
    log = spark.read.text(f"{checkpoint.rstrip('/')}/offsets/{int(batch_id)}")
    found = log.select(F.regexp_extract("value", '"batchTimestampMs":(\\d+)', 1).alias("ms")).filter("ms <> ''")
    return int(found.first().ms)


def stream_first_by_key(spark: SparkSession, src_dir: str, schema: StructType, keys: Sequence[str],
                        order_by: Sequence[str], out_dir: str, checkpoint: str,
                        max_files_per_trigger: int | None = None, wait: bool = True,
                        state_store: str = ROCKSDB):
    """Incremental load where each key is kept once across all files:
    within a batch the first row per key wins (``order_by``, then the other
    columns; NULL first), and keys of earlier batches are skipped. Rows with a NULL
    key are skipped. :func:`first_rows` reads what was loaded.

    The stream is one aggregate by key: the least (batch time, order, row), and the
    latest batch time. A key is new in a batch when both times are that
    batch's. The aggregate is combined in the map tasks, so a hot key
    sends one row a task, and its result by key is the stream's state: a batch
    costs what it holds, not what was loaded before. The state grows with the
    number of keys (no event time bounds it) and is kept on disk by RocksDB.

    Batch times come from the stream's log and must rise; should a clock be set back
    between two batches, the batch fails before it writes and can be run
    again later. A batch that is run again replaces its own folder."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(src_dir)
    for key in keys:
        stream = stream.filter(F.col(key).isNotNull())
    rest = [f.name for f in schema.fields if f.name not in (*keys, *order_by)]
    columns = [F.col(f"`{c}`") for c in (*order_by, *rest) if c not in keys]
    firsts = (stream.withColumn("__at", F.current_timestamp())          # in a stream: the batch's time
              .groupBy(*keys).agg(F.min(F.struct("__at", *columns)).alias("__row"), F.max("__at").alias("__last")))
    new = firsts.filter(F.col("__row.__at") == F.col("__last")).select(
        *[F.col(f"`{f.name}`") if f.name in keys else F.col(f"__row.`{f.name}`") for f in schema.fields])

    times: dict[int, int] = {}

    def time_of(batch_id: int) -> int:
        if batch_id not in times:
            times[batch_id] = _batch_time(spark, checkpoint, batch_id)
        return times[batch_id]

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        if batch_id > 0 and time_of(batch_id) <= time_of(batch_id - 1):
            raise RuntimeError(f"batch {batch_id} is not later than the one before: the clock was set back")
        batch.write.mode("overwrite").parquet(_batch_path(out_dir, batch_id))

    settings = {_STORE: state_store, _CHANGELOG: "true"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        q = (new.writeStream.outputMode("update").foreachBatch(each_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    if wait:
        q.awaitTermination()
    return q


def first_rows(spark: SparkSession, out_dir: str) -> DataFrame:
    """The rows that :func:`stream_first_by_key` has loaded."""
    return spark.read.parquet(out_dir).drop("batch_id")
