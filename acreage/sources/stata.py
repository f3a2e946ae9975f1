"""Stata files by ranges of rows: only the asked columns, values as they are stored."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

PLAIN = {"convert_categoricals": False, "convert_dates": False, "preserve_dtypes": True}
KINDS = {"int8": "int", "int16": "int", "int32": "int", "float32": "double", "float64": "double"}

ARROW = {"int": pa.int32(), "double": pa.float64(), "string": pa.string()}


def stata_columns(path: str) -> dict[str, str]:
    """Column types by name; reads no more than one row."""
    with pd.read_stata(path, chunksize=1, **PLAIN) as reader:
        first = reader.read(1)
    return {c: KINDS.get(str(t), "string") for c, t in first.dtypes.items()}


class Rows(InputPartition):
    def __init__(self, start: int, stop: int):
        self.start, self.stop = start, stop


class Stata(DataSource):
    """spark.read.format("stata").option("columns", "a,b").option("rows", "100000").load(path), with _row_pos from 1."""

    @classmethod
    def name(cls) -> str:
        return "stata"

    def _columns(self) -> list[str]:
        return [c for c in self.options.get("columns", "").split(",") if c]

    def schema(self) -> str:
        kinds = stata_columns(self.options["path"])
        wanted = self._columns() or list(kinds)
        if missing := [c for c in wanted if c not in kinds]:
            raise ValueError(f"columns are missing: {missing}")
        return ", ".join(["_row_pos long", *[f"`{c}` {kinds[c]}" for c in wanted]])

    def reader(self, schema: StructType) -> DataSourceReader:
        return StataReader(self.options["path"], [f.name for f in schema.fields[1:]], int(self.options.get("rows", 100_000)))


class StataReader(DataSourceReader):
    def __init__(self, path: str, columns: Sequence[str], rows: int):
        self.path, self.columns, self.rows = path, list(columns), rows

    def partitions(self) -> list[InputPartition]:
        with pd.io.stata.StataReader(self.path) as reader:
            reader.variable_labels()
            n = reader._nobs
        return [Rows(k, min(k + self.rows, n)) for k in range(0, n, self.rows)] or [Rows(0, 0)]

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        if partition.start >= partition.stop:
            return
        with pd.read_stata(self.path, iterator=True, columns=self.columns, **PLAIN) as reader:
            reader._ensure_open()
            reader._lines_read = partition.start
            chunk = reader.read(partition.stop - partition.start)[self.columns]
        places = pa.array(range(partition.start + 1, partition.start + 1 + len(chunk)), pa.int64())
        columns = [pa.Array.from_pandas(chunk[c], type=ARROW[KINDS.get(str(chunk[c].dtype), "string")]) for c in self.columns]
        yield pa.RecordBatch.from_arrays([places, *columns], ["_row_pos", *self.columns])


def read_stata(spark: SparkSession, path: str, columns: Sequence[str] = (), rows: int = 100_000) -> DataFrame:
    # The reader travels with its code, so workers needn't have this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(Stata)
    return spark.read.format("stata").option("columns", ",".join(columns)).option("rows", rows).load(path)
