"""Reference tables of places: CSV scans, and building the lookup from its two sources."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage.functions.text import normalize_text

LOOKUP = ("legacy_county_code", "legacy_town_code", "county_id", "town_id", "city", "district")
ALIASES = ("legacy_county_code", "raw_town", "normalized_town")


def read_reference(spark: SparkSession, path: str, columns: Sequence[str], rows: int | None = None) -> DataFrame:
    """A small CSV table of normalised strings; rows is how many there must be."""
    df = spark.read.option("header", True).option("mode", "FAILFAST").schema(
        ", ".join(f"{c} string" for c in columns)
    ).csv(path)
    df = df.select(*[normalize_text(c).alias(c) for c in columns])
    if rows is not None and (n := df.count()) != rows:
        raise ValueError(f"{path}: {n} rows, {rows} expected")
    return df


def build_lookup(towns: DataFrame, official: DataFrame) -> DataFrame:
    """Join towns (hsn_cd, town_cd, hsn_nm, town_nm) with official ids (hsn_nm, town_nm, county_id, town_id), one to one."""
    a = towns.select(*[normalize_text(c).alias(c) for c in ("hsn_cd", "town_cd", "hsn_nm", "town_nm")])
    b = official.select(*[normalize_text(c).alias(c) for c in ("hsn_nm", "town_nm", "county_id", "town_id")]).distinct()
    for df, key in (
        (a, ["hsn_cd", "town_cd"]), (a, ["hsn_cd", "town_nm"]), (b, ["county_id", "town_id"]), (b, ["hsn_nm", "town_nm"])
    ):
        if not df.groupBy(*key).count().where("count > 1").isEmpty():
            raise ValueError(f"not unique on {key}")
    if not b.where(~F.col("county_id").rlike("^[0-9]{5}$") | ~F.col("town_id").rlike("^[0-9]{8}$")).isEmpty():
        raise ValueError("ids must have 5 and 8 digits")
    lost = a.join(b, ["hsn_nm", "town_nm"], "left_anti")
    if not lost.isEmpty():
        raise ValueError(f"towns without an official id: {[tuple(r) for r in lost.limit(5).collect()]}")
    both = a.join(b, ["hsn_nm", "town_nm"])
    return both.select(
        F.col("hsn_cd").alias("legacy_county_code"), F.col("town_cd").alias("legacy_town_code"), "county_id", "town_id",
        F.col("hsn_nm").alias("city"), F.col("town_nm").alias("district")
    ).orderBy("county_id", "town_id")


def file_sha256(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()
