"""Written intermediate tables in the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import scratch_path, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a fresh folder under ``spark.checkpoint.dir`` and
    read it back: the lineage is cut, a lost executor loses nothing, and every
    later read sees the same rows."""
    spark = df.sparkSession
    ship_package(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
