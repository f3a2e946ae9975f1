"""Merging a batch into a table: change classes, the log of months touched, the merged rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def differs(columns: Sequence[str], a: str = "n", b: str = "o") -> Column:
    """Whether any column differs, nulls being equal."""
    row = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in columns])
    return ~row(a).eqNullSafe(row(b))


def classify(
    batch: DataFrame, target: DataFrame, key: str, compare: Sequence[str], core: Sequence[str], month: str = "month"
) -> DataFrame:
    """(key, change, old_month, new_month, has_core_impact) of each row of the batch: inserted, updated or unchanged."""
    new, old = batch.select(key, F.struct(*batch.columns).alias("n")), target.select(key, F.struct(*target.columns).alias("o"))
    both = new.join(old, key, "left")
    change = F.when(F.col("o").isNull(), "inserted").when(differs(compare), "updated").otherwise("unchanged")
    return both.select(
        key, change.alias("change"), F.col(f"o.{month}").alias("old_month"), F.col(f"n.{month}").alias("new_month"),
        (F.col("o").isNull() | differs(core)).alias("has_core_impact"),
    )


def month_impact(changes: DataFrame) -> DataFrame:
    """(month, entered, changed, exited, has_core_impact): a moved row leaves its old month and enters its new one."""
    row = lambda m, kind: F.struct(F.col(m).alias("month"), F.lit(kind).alias("kind"))
    moved = (F.col("change") == "updated") & ~F.col("old_month").eqNullSafe(F.col("new_month"))
    events = (
        F.when(F.col("change") == "inserted", F.array(row("new_month", "entered"))).when(
            moved, F.array(row("old_month", "exited"), row("new_month", "entered"))
        )
        .when(F.col("change") == "updated", F.array(row("new_month", "changed")))
    )
    flat = changes.select("has_core_impact", F.explode(events).alias("e"))
    count = lambda kind: F.count_if(F.col("e.kind") == kind).alias(kind)
    return flat.groupBy(F.col("e.month").alias("month")).agg(
        count("entered"), count("changed"), count("exited"), F.bool_or("has_core_impact").alias("has_core_impact")
    )


def upsert(batch: DataFrame, target: DataFrame, key: str, compare: Sequence[str]) -> DataFrame:
    """The table after the merge: rows that don't differ keep their stored version, nothing is deleted."""
    columns = target.columns
    new, old = batch.select(key, F.struct(*columns).alias("n")), target.select(key, F.struct(*columns).alias("o"))
    both = new.join(old, key, "full")
    keep = F.when(F.col("n").isNull(), F.col("o")).when(
        F.col("o").isNull() | differs(compare), F.col("n")
    ).otherwise(F.col("o"))
    return both.select(keep.alias("r")).select("r.*")


def change_detail(batch: DataFrame, target: DataFrame, key: str, compare: Sequence[str], limit: int = 50) -> DataFrame:
    """(key, detail) of the first updated rows by key: a JSON object of what differs, each with its new and old value as text."""
    new, old = (
        df.select(key, F.struct(*[F.col(c).cast("string").alias(c) for c in compare]).alias(side)) for df,
        side in ((batch, "n"), (target, "o"))
    )
    value = lambda c: F.struct(
        F.lit(c).alias("key"), F.struct(F.col(f"n.{c}").alias("new"), F.col(f"o.{c}").alias("old")).alias("value")
    )
    changed = F.array(*[F.when(~F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")), value(c)) for c in sorted(compare)])
    detail = F.to_json(F.map_from_entries(F.filter(changed, lambda x: x.isNotNull())), {"ignoreNullFields": "false"})
    return new.join(old, key).where(differs(compare)).select(key, detail.alias("detail")).orderBy(key).limit(limit)


def change_totals(changes: DataFrame) -> DataFrame:
    """One row of counts, with the arithmetic that must hold between them."""
    n = lambda p: F.count_if(p)
    moved = (F.col("change") == "updated") & ~F.col("old_month").eqNullSafe(F.col("new_month"))
    out = changes.agg(
        F.count("*").alias("input"), n(F.col("change") == "inserted").alias("inserted"),
        n(F.col("change") == "updated").alias("updated"), n(F.col("change") == "unchanged").alias("unchanged"),
        n(moved).alias("moved")
    )
    return out.withColumns(
        {
            "applied": F.col("inserted") + F.col("updated"), "entered": F.col("inserted") + F.col("moved"),
            "changed": F.col("updated") - F.col("moved"), "exited": F.col("moved"),
            "balanced": F.col("input") == F.col("inserted") + F.col("updated") + F.col("unchanged")
        }
    )


def affected_months(impact: DataFrame, rolling: int = 1) -> tuple[DataFrame, DataFrame]:
    """(months to recompute, months whose yearly change follows): M .. M + rolling - 1, and those a year later."""
    own = impact.where("has_core_impact and month is not null").select(
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(rolling - 1)), lambda k: F.add_months("month", k))).alias("month")
    ).distinct()
    return own, own.union(own.select(F.add_months("month", 12).alias("month"))).distinct()


def recompute_diff(expected: DataFrame, actual: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows that one side lacks or whose values differ, nulls being equal."""
    a = expected.select(*keys, F.struct(*values).alias("e"))
    both = a.join(actual.select(*keys, F.struct(*values).alias("a")), list(keys), "full")
    kind = F.when(F.col("a").isNull(), "missing").when(F.col("e").isNull(), "extra").when(
        ~F.col("e").eqNullSafe(F.col("a")), "different"
    )
    return both.withColumn("kind", kind).where("kind is not null").select(*keys, "kind")
