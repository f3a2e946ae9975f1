"""Cutting lineage: intermediate tables in the folder that all machines of the cluster share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """This application's folder under the one that spark.checkpoint.dir names; its tables are removed at exit.

    Where that is unset, a session on one machine gets a temporary folder; a cluster has none that all machines share, so
    there it raises an error.
    """
    app = spark.sparkContext.applicationId
    if app not in _own:
        at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if at:
            _own[app] = f"{at.rstrip('/')}/acreage/{app}"
            atexit.register(remove, spark, _own[app])
        elif spark.sparkContext.master.split("[")[0] == "local":
            _own[app] = tempfile.mkdtemp(prefix="acreage-shared-")
            atexit.register(shutil.rmtree, _own[app], True)
        else:
            raise ValueError("spark.checkpoint.dir must name a folder that all machines of the cluster share")
    return _own[app]


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of the shared file system, if the session is still there to do it."""
    if spark.sparkContext._jsc is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet under the shared folder and read it again, so that a lost executor costs no recomputation.

    The shuffle files of this one write are removed as soon as it is done: nobody reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
