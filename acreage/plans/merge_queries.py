"""Change classification, the month log and the merged table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage.operators import merge
from acreage.plans.ledger import BATCH_SQL, batch, target

CORE = ["month", "kind", "total_price"]
ALL = [*CORE, "town"]


def changes(spark: SparkSession, d: str) -> DataFrame:
    return merge.classify(batch(spark, d), target(spark, d), "txn_id", ALL, CORE)


def month_impact(spark: SparkSession, d: str) -> DataFrame:
    return merge.month_impact(changes(spark, d))


def null_safe_diff(spark: SparkSession, d: str) -> DataFrame:
    """Rows that differ between delivery and table when amounts may be null on either side."""
    holed = lambda df, k: df.select("txn_id", F.when(F.col("txn_id") % k != 0, F.col("total_price")).alias("total_price"))
    return merge.recompute_diff(holed(target(spark, d), 9), holed(target(spark, d), 6), ["txn_id"], ["total_price"])


QUERIES = {
    "change_classification": changes,
    "month_impact": month_impact,
    "change_totals": lambda spark, d: merge.change_totals(changes(spark, d)),
    "upsert_result": lambda spark, d: merge.upsert(batch(spark, d), target(spark, d), "txn_id", ALL),
    "batch_semi_join": lambda spark, d: batch(spark, d).join(
        changes(spark, d).where("change = 'updated'"), "txn_id", "left_semi"
    ),
    "null_safe_diff": null_safe_diff,
}

ORACLES = {
    "change_classification": f"with {BATCH_SQL} select * from changes",
    "month_impact": f"with {BATCH_SQL} select * from impact",
    "change_totals": f"""with {BATCH_SQL},
        t as (select count(*) as input, count_if(change = 'inserted') as inserted, count_if(change = 'updated') as updated, count_if(change = 'unchanged') as unchanged,
                     count_if(change = 'updated' and old_month is distinct from new_month) as moved from changes)
        select *, inserted + updated as applied, inserted + moved as entered, updated - moved as changed, moved as exited, input = inserted + updated + unchanged as balanced from t""",
    "upsert_result": f"with {BATCH_SQL} select * from batch union all select * from target where txn_id not in (select txn_id from batch)",
    "batch_semi_join": f"with {BATCH_SQL} select * from batch where txn_id in (select txn_id from changes where change = 'updated')",
    "null_safe_diff": f"with {BATCH_SQL} select txn_id, 'different' as kind from target where (txn_id % 9 = 0) <> (txn_id % 6 = 0)",
}
