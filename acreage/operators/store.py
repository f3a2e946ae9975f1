"""Versioned Parquet tables on any file system Spark reaches: a new version is written whole, then a pointer is moved to it."""

from __future__ import annotations

import contextlib
import fcntl
import json
import os
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Locked(RuntimeError):
    pass


@contextlib.contextmanager
def exclusive(lock_file: str) -> Iterator[None]:
    """One writer at a time on this driver's machine; raises at once if another holds the lock."""
    os.makedirs(os.path.dirname(lock_file) or ".", exist_ok=True)
    with open(lock_file, "a") as f:
        try:
            fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except OSError:
            raise Locked(f"another run holds {lock_file}") from None
        yield


class Files:
    """Small files next to the tables, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self._path(self.root).getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def read(self, name: str) -> str | None:
        path = self._path(f"{self.root}/{name}")
        if not self.fs.exists(path):
            return None
        stream = self.fs.open(path)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """All or nothing: a reader sees the old text or the new one."""
        held = self._path(f"{self.root}/{name}.{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(held, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        options = self.jvm.java.lang.reflect.Array.newInstance(
            self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1
        )
        options[0] = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
        context.rename(held, self._path(f"{self.root}/{name}"), options)


class Store:
    """Tables of one warehouse. The pointer names the version of every table, so several tables change together."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.files = spark, Files(spark, root)
        self.root = self.files.root

    def versions(self) -> dict:
        return json.loads(self.files.read("current.json") or "{}")

    def exists(self, name: str) -> bool:
        return name in self.versions()

    def read(self, name: str) -> DataFrame:
        return self.staged(name, self.versions()[name])

    def stage(self, name: str, df: DataFrame) -> str:
        """Write a version that nobody sees yet."""
        version = uuid.uuid4().hex
        df.write.option("compression", "zstd").parquet(f"{self.root}/{name}/{version}")
        return version

    def stage_parts(self, name: str, df: DataFrame, by: str) -> dict[str, str]:
        """Write rows into a folder for each value of a date column; the version of each such part, which nobody sees yet.

        Values are few (the months of a calendar). Merged into the parts of the table that is current, the result names
        a whole table of which only these parts are new.
        """
        version = uuid.uuid4().hex
        at = f"{self.root}/{name}/version={version}"
        df.hint("rebalance", by).write.partitionBy(by).option("compression", "zstd").parquet(at)
        return {str(r[0]): version for r in df.sparkSession.read.schema(df.schema).parquet(at).select(by).distinct().collect()}

    def staged(self, name: str, version: str | dict[str, str], by: str = "month") -> DataFrame:
        """A version's rows; a filter on the column of a table in parts reads only the parts it names."""
        if isinstance(version, str):
            return self.spark.read.parquet(f"{self.root}/{name}/{version}")
        base = f"{self.root}/{name}"
        paths = [f"{base}/version={v}/{by}={part}" for part, v in sorted(version.items())]
        return self.spark.read.option("basePath", base).parquet(*paths).drop("version")

    def publish(self, versions: dict) -> None:
        """All tables change at once. Writers must hold the lock, as this reads what is current first."""
        self.files.write("current.json", json.dumps(self.versions() | versions, sort_keys=True))


def checked_write(store: Store, name: str, df: DataFrame, schema: T.StructType) -> str:
    """Write with the declared columns and types, read back, and compare rows and nulls before anyone may publish it."""
    version = store.stage(name, df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]))
    back = store.staged(name, version)
    kinds = [(f.name, f.dataType) for f in back.schema.fields]
    if kinds != [(f.name, f.dataType) for f in schema.fields]:
        raise ValueError(f"{name}: columns differ from the contract: {kinds}")
    nulls = back.agg(
        *[F.count_if(F.col(f.name).isNull()).alias(f.name) for f in schema.fields if not f.nullable] or [F.lit(0).alias("none")]
    ).first().asDict()
    if any(nulls.values()):
        raise ValueError(f"{name}: nulls in {[k for k, v in nulls.items() if v]}")
    return version
