"""Exclusion: one reason for each row by precedence, every condition counted on its own, and the split."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def primary_reason(conditions: Mapping[str, Column]) -> Column:
    """The first condition that holds; null if none does."""
    items = list(conditions.items())
    out = F.when(F.coalesce(items[0][1], F.lit(False)), items[0][0])
    for name, held in items[1:]:
        out = out.when(F.coalesce(held, F.lit(False)), name)
    return out


def independent_checks(df: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """(check, rows): how often each condition holds, primary or not, in one pass."""
    counts = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check"), F.col(n).alias("rows")) for n in conditions])))


def split(df: DataFrame, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(reason).isNull()).drop(reason), df.where(F.col(reason).isNotNull())


def violations(df: DataFrame, contract: Mapping[str, Column]) -> dict[str, int]:
    """Rows that break each named predicate, in one aggregation. A predicate that is null isn't broken."""
    row = df.agg(*[F.count_if(~F.coalesce(p, F.lit(True))).alias(n) for n, p in contract.items()]).first()
    return row.asDict()


def require(df: DataFrame, contract: Mapping[str, Column], what: str) -> DataFrame:
    broken = {k: v for k, v in violations(df, contract).items() if v}
    if broken:
        raise ValueError(f"{what}: {broken}")
    return df
