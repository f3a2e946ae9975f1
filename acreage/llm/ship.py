"""Sends this subpackage to the Python workers of a cluster."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Arrow batches hold at most so many rows and bytes, so that workers' memory follows neither the partition nor long texts.
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20


def shipped(spark: SparkSession) -> SparkSession:
    """The session, whose workers can import this subpackage and get batches of bounded size."""
    context = spark.sparkContext
    if not getattr(context, "_acreage_shipped", False):
        folder = Path(tempfile.mkdtemp(prefix="acreage-"))
        here = Path(__file__).resolve().parent
        with zipfile.ZipFile(folder / "acreage_llm.zip", "w") as z:
            z.write(here.parent / "__init__.py", "acreage/__init__.py")
            for f in sorted(here.glob("*.py")):
                z.write(f, f"acreage/llm/{f.name}")
        context.addPyFile(str(folder / "acreage_llm.zip"))
        context._acreage_shipped = True
        atexit.register(shutil.rmtree, folder, True)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark
