"""Duplicates by identifier: exact or conflicting, first in input order wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def duplicate_kinds(df: DataFrame, key: Sequence[str], compare: Sequence[str], position: str | None = None) -> DataFrame:
    """(key..., n, kind) of each repeated key: exact if all compare columns agree, nulls being equal, else conflict.

    Two digests stand for the compared columns, so an aggregation with map-side combining is enough whatever the group's
    size. With position, first is the least of it. Keys with a null are no keys.
    """
    row = F.struct(*[F.col(c) for c in compare])
    digest = F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256)
    first = [F.min(position).alias("first")] if position else []
    got = df.dropna(subset=list(key)).groupBy(*key).agg(
        F.count("*").alias("n"), F.min(digest).alias("_lo"), F.max(digest).alias("_hi"), *first
    )
    kind = F.when(F.col("_lo") == F.col("_hi"), "exact").otherwise("conflict")
    return got.where("n > 1").select(*key, "n", kind.alias("kind"), *(["first"] if position else []))


def duplicate_reason(df: DataFrame, key: Sequence[str], compare: Sequence[str], position: str) -> DataFrame:
    """df with duplicate_reason: null, duplicate_exact (all but the first of equal rows) or duplicate_conflict (all rows).

    Rows without a key match nothing; they are dealt out by their position, so that they don't meet in one task.
    """
    kinds = duplicate_kinds(df, key, compare, position).select(
        *key, F.lit(0).cast("long").alias("_deal"), F.col("kind").alias("_kind"), F.col("first").alias("_first")
    )
    some_null = F.greatest(*[F.col(k).isNull() for k in key], F.lit(False))
    marked = df.withColumn(
        "_deal", F.when(some_null, F.xxhash64(position)).otherwise(F.lit(0).cast("long"))
    ).join(kinds, [*key, "_deal"], "left")
    reason = F.when(F.col("_kind") == "conflict", "duplicate_conflict").when(
        (F.col("_kind") == "exact") & (F.col(position) > F.col("_first")), "duplicate_exact"
    )
    return marked.withColumn("duplicate_reason", reason).drop("_kind", "_first", "_deal")


def first_wins(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key; Spark keeps only the first rows of each task before the exchange.

    The order has to tell all rows of a key apart, or the row that stays depends on which task was read first.
    """
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_k", rank).where("_k = 1").drop("_k")
