"""Where the built tables go: full replacement of Parquet folders or catalog tables.

Every write is a version of its own, and one small switch makes it the table: the replacement of a
file that names the current version, or of a view over it. Until then, and if a write or a switch
fails, the old version is what readers get. The version before the current one stays for queries that
still read it; older ones, and what failed writes left, go with the next write.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from claimstar.functions.columns import only

CURRENT = "_CURRENT"  # the file that names the current version
_VERSION = re.compile(r"\d{20}_[0-9a-f]{8}")


def _new_version() -> str:
    """A name of its own that sorts by time."""
    now = datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")
    return f"{now}_{uuid.uuid4().hex[:8]}"


def _outdated(versions: Sequence[str], current: str) -> list[str]:
    """All versions but the current one and the one before it."""
    earlier = sorted(v for v in versions if v < current)
    return earlier[:-1] + [v for v in versions if v > current]


def _laid_out(frame: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    # Rebalancing by the partition columns gives few files per partition value; unlike
    # repartition it lets adaptive execution split a value that holds most of the rows.
    return frame.hint("rebalance", *partition_by) if partition_by else frame


class _Files:
    """Small files and folders of the shared storage, whichever file system holds it."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._system = self._path(root).getFileSystem(self._conf)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def folders(self, path: str) -> list[str]:
        if not self._system.exists(self._path(path)):
            return []
        held = self._system.listStatus(self._path(path))
        return [f.getPath().getName() for f in held if f.isDirectory()]

    def text(self, path: str) -> str | None:
        """The content of a small file, None where there is none."""
        if not self._system.exists(self._path(path)):
            return None
        stream = self._system.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def replace(self, path: str, text: str) -> None:
        """Give a small file new content at once: readers see all of the old or all of the new."""
        fresh = f"{path}.{uuid.uuid4().hex}"
        stream = self._system.create(self._path(fresh), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        hadoop, lang = self._jvm.org.apache.hadoop.fs, self._jvm.java.lang
        kind = lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        overwrite = lang.reflect.Array.newInstance(kind, 1)
        lang.reflect.Array.set(overwrite, 0, lang.Enum.valueOf(kind, "OVERWRITE"))
        context = hadoop.FileContext.getFileContext(self._system.getUri(), self._conf)
        context.rename(self._path(fresh), self._path(path), overwrite)

    def delete(self, path: str) -> None:
        self._system.delete(self._path(path), True)


@dataclass(frozen=True)
class ParquetSink:
    """Tables as Parquet folders ``root/<prefix><name>/<version>`` on shared storage.

    ``location`` is the folder of the current version, for readers other than ``read``.
    """

    root: str
    prefix: str = ""
    partition_by: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def path(self, name: str) -> str:
        """The folder that holds all versions of a table."""
        return f"{self.root}/{self.prefix}{name}"

    def location(self, spark: SparkSession, name: str) -> str:
        current = _Files(spark, self.root).text(f"{self.path(name)}/{CURRENT}")
        if current is None:
            raise FileNotFoundError(f"{self.path(name)} has no version yet")
        return f"{self.path(name)}/{current}"

    def write(self, name: str, frame: DataFrame) -> None:
        columns = tuple(self.partition_by.get(name, ()))
        writer = _laid_out(frame, columns).write
        if columns:
            writer = writer.partitionBy(*columns)
        files, version = _Files(frame.sparkSession, self.root), _new_version()
        try:
            writer.parquet(f"{self.path(name)}/{version}")
            self._switch(files, name, version)
        except BaseException:
            files.delete(f"{self.path(name)}/{version}")
            raise
        held = [v for v in files.folders(self.path(name)) if _VERSION.fullmatch(v)]
        for old in _outdated(held, version):
            files.delete(f"{self.path(name)}/{old}")

    def _switch(self, files: _Files, name: str, version: str) -> None:
        files.replace(f"{self.path(name)}/{CURRENT}", version)

    def read(self, spark: SparkSession, name: str, like: DataFrame) -> DataFrame:
        stored = spark.read.schema(like.schema).parquet(self.location(spark, name))
        return only(stored, like.columns)


@dataclass(frozen=True)
class TableSink:
    """Views ``<database>.<prefix><name>`` over tables of the catalog that are named by version.

    The tables are optionally partitioned or bucketed; queries on the view make use of either.
    """

    database: str
    prefix: str = ""
    partition_by: Mapping[str, Sequence[str]] = field(default_factory=dict)
    bucket_by: Mapping[str, tuple[int, Sequence[str]]] = field(default_factory=dict)

    def table(self, name: str) -> str:
        return f"{self.database}.{self.prefix}{name}"

    def write(self, name: str, frame: DataFrame) -> None:
        columns = tuple(self.partition_by.get(name, ()))
        buckets = self.bucket_by.get(name)
        writer = _laid_out(frame, columns).write.format("parquet")
        if columns:
            writer = writer.partitionBy(*columns)
        if buckets:
            writer = writer.bucketBy(buckets[0], *buckets[1]).sortBy(*buckets[1])
        spark, version = frame.sparkSession, _new_version()
        fresh = f"{self.table(name)}__{version}"
        try:
            writer.saveAsTable(fresh)
            self._switch(spark, name, fresh)
        except BaseException:
            spark.sql(f"DROP TABLE IF EXISTS {fresh}")
            raise
        for old in _outdated(self._versions(spark, name), version):
            spark.sql(f"DROP TABLE IF EXISTS {self.table(name)}__{old}")

    def _versions(self, spark: SparkSession, name: str) -> list[str]:
        start = f"{self.prefix}{name}__"
        held = spark.sql(f"SHOW TABLES IN {self.database} LIKE '{start}*'").collect()
        names = [row["tableName"].removeprefix(start) for row in held]
        return [n for n in names if _VERSION.fullmatch(n)]

    def _switch(self, spark: SparkSession, name: str, fresh: str) -> None:
        spark.sql(f"CREATE OR REPLACE VIEW {self.table(name)} AS SELECT * FROM {fresh}")

    def read(self, spark: SparkSession, name: str, like: DataFrame) -> DataFrame:
        return only(spark.table(self.table(name)), like.columns)
