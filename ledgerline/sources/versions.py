"""A5: several tables refreshed as one.

A refresh writes each table to a fresh folder and then puts one small manifest
beside the earlier ones. The manifest names the folder of every table, and the latest
manifest is what readers see. It is written under another name and renamed into
place, which fails where the number is taken: so a refresh that stops half-way
changes nothing, no reader meets old and new tables side by side, and of two refreshes
at the same time one is refused. Tables that a refresh does not write stay as they were.

    <root>/data/<id>/<table>/          the rows
    <root>/manifests/000000000007.json {"tables": {"orders": "data/<id>/orders", ...}}

The rename is atomic on HDFS and local disks; an object store needs a
file system with an atomic rename in front.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from ledgerline.sources.files import write_table

_NUMBER = re.compile(r"^(\d{12})\.json$")


class _Folder:
    """The refreshes under one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf, self.gateway = spark._jvm, spark._jsc.hadoopConfiguration(), spark.sparkContext._gateway
        self.root = root.rstrip("/")
        self.fs = self.path().getFileSystem(self.conf)

    def path(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def names(self, *parts: str) -> dict[str, int]:
        """Name and time of change (ms) of what a folder holds."""
        folder = self.path(*parts)
        if not self.fs.exists(folder):
            return {}
        return {s.getPath().getName(): s.getModificationTime() for s in self.fs.listStatus(folder)}

    def versions(self) -> list[int]:
        return sorted(int(m[1]) for m in map(_NUMBER.match, self.names("manifests")) if m)

    def tables(self, version: int) -> dict[str, str]:
        stream = self.fs.open(self.path("manifests", f"{version:012d}.json"))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["tables"]
        finally:
            stream.close()

    def put(self, version: int, tables: Mapping[str, str]) -> None:
        draft = self.path("manifests", f".{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(draft, False)
        try:
            stream.write(bytearray(json.dumps({"tables": dict(tables)}, sort_keys=True), "utf-8"))
        finally:
            stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path().toUri(), self.conf)
        rename = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            context.rename(draft, self.path("manifests", f"{version:012d}.json"), self.gateway.new_array(rename, 0))
        except Exception:
            self.fs.delete(draft, False)
            raise


def versions(spark: SparkSession, root: str) -> list[int]:
    """The refreshes under ``root`` that can be read, oldest first."""
    return _Folder(spark, root).versions()


def published(spark: SparkSession, root: str, version: int | None = None) -> dict[str, str]:
    """Table name -> path, as of the latest refresh or of ``version``."""
    folder = _Folder(spark, root)
    found = folder.versions()
    if not found or (version is not None and version not in found):
        raise FileNotFoundError(f"no refresh {'' if version is None else version} under {root}")
    tables = folder.tables(found[-1] if version is None else version)
    return {name: f"{folder.root}/{path}" for name, path in tables.items()}


def read_published(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    """One table as of the latest refresh or of ``version``."""
    return spark.read.parquet(published(spark, root, version)[table])


def publish(spark: SparkSession, root: str, tables: Mapping[str, DataFrame],
            partition_by: Mapping[str, tuple[str, ...]] | None = None) -> dict[str, str]:
    """Refresh ``tables`` as one; returns the paths of all tables under ``root``.
    Where a table fails, its error is raised and readers keep the earlier refresh."""
    folder = _Folder(spark, root)
    found = folder.versions()
    base, before = (found[-1], folder.tables(found[-1])) if found else (0, {})
    new = f"data/{uuid.uuid4().hex}"
    try:
        for name, df in tables.items():
            write_table(df, f"{folder.root}/{new}/{name}", mode="error", partition_by=(partition_by or {}).get(name, ()))
        folder.put(base + 1, before | {name: f"{new}/{name}" for name in tables})
    except Exception:
        folder.fs.delete(folder.path(new), True)
        raise
    return published(spark, root, base + 1)


def drop_old(spark: SparkSession, root: str, keep: int = 1, unfinished_hours: float = 24) -> int:
    """Remove all but the last ``keep`` refreshes, and what a refresh left
    that died more than ``unfinished_hours`` ago. Returns the number of data folders
    removed."""
    if keep < 1:
        raise ValueError("at least one refresh stays")
    folder = _Folder(spark, root)
    found = folder.versions()
    tables = {v: folder.tables(v) for v in found}
    used = {path.split("/")[1] for v in found[-keep:] for path in tables[v].values()}
    known = {path.split("/")[1] for v in found for path in tables[v].values()}
    for version in found[:-keep]:                          # first, so that no manifest names what is gone
        folder.fs.delete(folder.path("manifests", f"{version:012d}.json"), False)
    oldest = (time.time() - unfinished_hours * 3600) * 1000
    gone = [name for name, changed in folder.names("data").items()
            if name not in used and (name in known or changed < oldest)]
    for name in gone:
        folder.fs.delete(folder.path("data", name), True)
    return len(gone)
