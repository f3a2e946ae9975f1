"""Clean batches as a stream: each micro-batch goes through the same merge as a daily run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from acreage import contract as C
from acreage.operators.warehouse import Warehouse


def deliver(warehouse: Warehouse, folder: str, checkpoint: str) -> StreamingQuery:
    """Take every Parquet file of clean records that arrives in folder, then stop; late corrections are ordinary updates.

    The micro-batch's number names the batch, so one that is delivered twice after a failure is replayed from the ledger.
    """

    def load(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            warehouse.run(batch, f"stream-{number}")

    stream = warehouse.spark.readStream.schema(C.CLEAN).parquet(folder)
    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
