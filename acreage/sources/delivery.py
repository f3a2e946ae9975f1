"""Looking at a clean Parquet delivery before it is loaded, and at the workbook of official ids."""

from __future__ import annotations

import hashlib
import zipfile
from collections.abc import Sequence
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def inspect(spark: SparkSession, path: str, schema: T.StructType, rows: int | None = None) -> dict:
    """(rows, cleaning_run_id, sha256): the columns must be the contract's, the rows of a single run and as many as expected.

    Only the run's column is read. sha256 is over the digests of the files in order of their names, read by the executors.
    """
    df = spark.read.parquet(path)
    kinds = [(f.name, f.dataType) for f in df.schema.fields]
    if kinds != [(f.name, f.dataType) for f in schema.fields]:
        raise ValueError(
            f"columns differ from the contract: {sorted(set(kinds) ^ {(f.name, f.dataType) for f in schema.fields}, key=str)}"
        )
    got = df.agg(
        F.count("*").alias("rows"), F.min("cleaning_run_id").alias("run"), F.max("cleaning_run_id").alias("last")
    ).first()
    if got.run is None or got.run != got.last:
        raise ValueError(f"not of a single run: {got.run}, {got.last}")
    if rows is not None and got.rows != rows:
        raise ValueError(f"{got.rows} rows, {rows} expected")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    digests = files.select(
        F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("d")
    ).orderBy("name").collect()
    return {
        "rows": got.rows, "cleaning_run_id": got.run,
        "sha256": hashlib.sha256("".join(r.d for r in digests).encode()).hexdigest()
    }


def read_workbook(spark: SparkSession, path: str, columns: Sequence[str], sheet: int = 1) -> DataFrame:
    """The asked columns of a small worksheet as strings, by the names in its first row; the file is read on the driver."""
    with zipfile.ZipFile(path) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = [
                "".join(
                    t.text or "" for t in s.iter(f"{SHEET}t")
                ) for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{SHEET}si")
            ]
        grid = ElementTree.fromstring(z.read(f"xl/worksheets/sheet{sheet}.xml"))
    rows = [{place(c.get("r")): text_of(c, shared) for c in row.iter(f"{SHEET}c")} for row in grid.iter(f"{SHEET}row")]
    names = {name: k for k, name in (rows[0] if rows else {}).items()}
    if missing := [c for c in columns if c not in names]:
        raise ValueError(f"{path} lacks {missing}")
    return spark.createDataFrame(
        [tuple(r.get(names[c]) for c in columns) for r in rows[1:]], ", ".join(f"{c} string" for c in columns)
    )


def place(reference: str) -> int:
    """The number of a cell's column from 1: A is 1, AA is 27."""
    out = 0
    for letter in reference.rstrip("0123456789"):
        out = out * 26 + ord(letter) - 64
    return out


def text_of(cell: ElementTree.Element, shared: list[str]) -> str | None:
    kind, value = cell.get("t"), cell.find(f"{SHEET}v")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{SHEET}t"))
    if value is None:
        return None
    return shared[int(value.text)] if kind == "s" else value.text
