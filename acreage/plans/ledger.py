"""The star schema's tables read as a transaction ledger: a fact is an order, its place the customer's nation and region."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage.functions.dates import month_start

SQL = """
    ledger as (
        select o_orderkey as txn_id, cast(date_trunc('month', o_orderdate) as date) as month, cast(o_orderdate as date) as day,
               n_name as town, r_name as county, o_orderstatus as kind, o_orderpriority as building,
               cast(round(o_totalprice) as bigint) as total_price, o_totalprice / (20 + o_orderkey % 80) as unit_price, o_totalprice as price
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
"""


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations and regions have a fixed number of rows, so they are broadcast; customers are left to the planner."""
    places = read(spark, sf_dir, "nation").join(
        F.broadcast(read(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = read(spark, sf_dir, "customer").join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
    orders = read(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return orders.select(
        F.col("o_orderkey").alias("txn_id"), month_start(F.col("o_orderdate")).alias("month"), F.col("o_orderdate").cast("date").alias("day"),
        F.col("n_name").alias("town"), F.col("r_name").alias("county"), F.col("o_orderstatus").alias("kind"), F.col("o_orderpriority").alias("building"),
        F.round("o_totalprice").cast("bigint").alias("total_price"), (
            F.col("o_totalprice") / (20 + F.col("o_orderkey") % 80)
        ).alias("unit_price"), F.col("o_totalprice").alias("price"),
    )


def in_scope() -> Column:
    return F.col("kind").isin("F", "O")


def kpi_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger(spark, sf_dir).where(in_scope() & F.col("total_price").isNotNull() & F.col("unit_price").isNotNull())


def batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second delivery derived from the first: some rows dearer, some moved a month, some with another place name only, some new."""
    k = F.col("txn_id")
    sent = ledger(spark, sf_dir).where("txn_id % 3 <> 1")
    edited = sent.select(
        F.when(k % 11 == 0, -k).otherwise(k).alias("txn_id"), F.when(
            k % 7 == 0, F.add_months("month", 1)
        ).otherwise(F.col("month")).alias("month"),
        "kind", F.when(
            k % 5 == 0, F.col("total_price") + 1
        ).otherwise(F.col("total_price")).alias("total_price"), F.when(
            k % 4 == 0, F.lower("town")
        ).otherwise(F.col("town")).alias("town"),
    )
    return edited


def target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger(spark, sf_dir).select("txn_id", "month", "kind", "total_price", "town")


BATCH_SQL = SQL + """,
    target as (select txn_id, month, kind, total_price, town from ledger),
    batch as (
        select case when txn_id % 11 = 0 then -txn_id else txn_id end as txn_id,
               case when txn_id % 7 = 0 then cast(month + interval 1 month as date) else month end as month, kind,
               case when txn_id % 5 = 0 then total_price + 1 else total_price end as total_price,
               case when txn_id % 4 = 0 then lower(town) else town end as town
        from ledger where txn_id % 3 <> 1),
    changes as (
        select b.txn_id,
               case when t.txn_id is null then 'inserted'
                    when (b.month, b.kind, b.total_price, b.town) is distinct from (t.month, t.kind, t.total_price, t.town) then 'updated'
                    else 'unchanged' end as change,
               t.month as old_month, b.month as new_month,
               t.txn_id is null or (b.month, b.kind, b.total_price) is distinct from (t.month, t.kind, t.total_price) as has_core_impact
        from batch b left join target t on b.txn_id = t.txn_id),
    events as (
        select new_month as month, 'entered' as kind, has_core_impact from changes where change = 'inserted' or (change = 'updated' and old_month is distinct from new_month)
        union all select old_month, 'exited', has_core_impact from changes where change = 'updated' and old_month is distinct from new_month
        union all select new_month, 'changed', has_core_impact from changes where change = 'updated' and old_month is not distinct from new_month),
    impact as (
        select month, count_if(kind = 'entered') as entered, count_if(kind = 'changed') as changed, count_if(kind = 'exited') as exited, bool_or(has_core_impact) as has_core_impact
        from events group by month)
"""
