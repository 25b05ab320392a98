"""Scans and sinks (survey A1-A8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def scan_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A1: Parquet scan; schema from the footer unless one is given.
    Filters and projections applied later are pushed into the scan."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def scan_parquet_dir(spark: SparkSession, folder: str, schema: StructType,
                     glob: str = "*.parquet") -> DataFrame:
    """A2: all files of a folder matching ``glob``, rows concatenated.

    The declared schema makes an optional column (absent from some files)
    read as NULL. ``_file_name`` and ``_row_index`` give the first-wins order
    (file name, row position in the file). The folder must hold at least one
    matching file: with a declared schema Spark itself would read none as no
    rows, and a full refresh would then empty its output (X5).
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{glob}")
    if not pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern):
        raise FileNotFoundError(f"no files match {folder}/{glob}")
    df = (spark.read.schema(schema)
          .option("pathGlobFilter", glob)
          .option("recursiveFileLookup", "false")
          .parquet(folder))
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("_file_name"),
        F.col("_metadata.row_index").alias("_row_index"),
    )


def scan_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             header: bool = True, infer: bool = False) -> DataFrame:
    """A3/A4: CSV with a header. An explicit schema is the production path;
    without one every column reads as text (as the reference's Spark read
    did). ``infer=True`` asks Spark to infer the types (as pandas does), which
    costs a full extra pass over the data."""
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def scan_csv_checked(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """A3: ``(rows, rejects)`` of a CSV scan: lines that fit ``schema``, and those that
    do not, as (file, line, reasons). Nothing is dropped or turned to NULL: a line with
    a cell that is not of its type, or with too few or too many cells, is a reject
    with its whole text. An empty cell is NULL; a blank line is no line. Cells are
    parted by commas, quoted by ``"`` (doubled or after a backslash inside)."""
    corrupt = "__line"
    read = (spark.read.schema(StructType([*schema.fields, StructField(corrupt, StringType())]))
            .option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt)
            .option("columnPruning", False).csv(path))
    # Spark refuses a scan that reads the line column alone, as a count would: the
    # test reads every column and is always true
    every = F.size(F.array(*[F.col(f"`{f.name}`").isNull() for f in schema.fields])) > 0
    line = F.col("line")
    plain = F.regexp_replace(line, r'"([^"\\]|\\.|"")*"', "")
    cells = 1 + F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit("")))
    texts = ", ".join(f"c{i} string" for i in range(len(schema.fields)))
    bad = (read.filter(F.col(corrupt).isNotNull())
           .select(*[F.col(f"`{f.name}`").alias(f"read_{i}") for i, f in enumerate(schema.fields)],
                   F.col("_metadata.file_path").alias("file"), F.col(corrupt).alias("line"))
           .withColumns({"cells": cells, "text": F.from_csv(line, texts)}))
    # the reader leaves a cell that does not fit NULL and keeps the others
    misfits = [F.when(F.col("text").getField(f"c{i}").isNotNull() & F.col(f"read_{i}").isNull(),
                      F.array(F.lit(f"{f.name}: value does not fit {f.dataType.simpleString()}")))
               .otherwise(F.array().cast("array<string>")) for i, f in enumerate(schema.fields)]
    found = F.concat(*misfits)
    wrong_size = F.array(F.concat(F.col("cells").cast("string"), F.lit(f" cells, {len(schema.fields)} expected")))
    reasons = (F.when(F.col("cells") != len(schema.fields), wrong_size)
               .when(F.size(found) > 0, found).otherwise(F.array(F.lit("the line cannot be read"))))
    return read.filter(F.col(corrupt).isNull() & every).drop(corrupt), bad.select("file", "line", reasons.alias("reasons"))


def write_table(df: DataFrame, path: str | None, mode: str = "overwrite",
                partition_by: tuple[str, ...] = (), fmt: str = "parquet",
                options: dict[str, str] | None = None) -> str | None:
    """A5: full-refresh sink (overwrite) or append. Any Spark writer format
    works, e.g. ``fmt="jdbc"`` with ``options={"url": ..., "dbtable": ...}``
    and ``path=None`` for a database table. Returns the path."""
    w = df.write.mode(mode).format(fmt).options(**(options or {}))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if path is None:
        w.save()
    else:
        w.save(path)
    return path


def write_csv(df: DataFrame, path: str, drop: tuple[str, ...] = ("id",),
              mode: str = "overwrite") -> str:
    """CSV sink with a header, without the derived id column. Times are
    written to the microsecond (Spark's default cuts them to milliseconds)."""
    times = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
    (df.drop(*drop).write.mode(mode).option("header", True)
     .option("timestampFormat", times).option("timestampNTZFormat", times).csv(path))
    return path


def register(df: DataFrame, name: str) -> DataFrame:
    """Name a DataFrame for SQL."""
    df.createOrReplaceTempView(name)
    return df


def preview(df: DataFrame, n: int = 5, order_by: list[str | Column] | None = None) -> DataFrame:
    """N rows; give an order for a repeatable preview."""
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)
