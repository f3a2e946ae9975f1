"""Increments, the warehouse's cutoff and its second computation, over the ledger after a late delivery."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage import contract as C
from acreage.operators import kpi, merge, recheck
from acreage.plans.kpi_queries import BASELINE, REGION_SQL, ROLLING_SQL, kpi_sql, regions, towns
from acreage.plans.ledger import SQL, in_scope, ledger, read

VALUES = ["month", "kind", "total_price", "unit_price"]

MERGED = """
    ledger as (select * exclude (month, total_price), case when late and txn_id % 3 = 0 then cast(month + interval 1 month as date) else month end as month, total_price + case when late then 1000 else 0 end as total_price
               from (select *, txn_id % 5 = 0 and month between date '1997-02-01' and date '1997-04-01' as late from ledger0))
"""
MERGED_SQL = SQL.replace("ledger as", "ledger0 as") + "," + MERGED


def after(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The ledger, the late delivery (dearer sales of three months, some of them a month later) and the ledger after it."""
    old = ledger(spark, d)
    late = old.where("txn_id % 5 = 0 and month between date'1997-02-01' and date'1997-04-01'")
    edited = late.withColumns(
        {
            "month": F.when(F.col("txn_id") % 3 == 0, F.add_months("month", 1)).otherwise(F.col("month")),
            "total_price": F.col("total_price") + 1000
        }
    )
    return old, edited, merge.upsert(edited, old, "txn_id", VALUES)


def population(facts: DataFrame) -> DataFrame:
    return facts.where(in_scope() & F.col("total_price").isNotNull() & F.col("unit_price").isNotNull())


def increment(key: str | None, members, width: int):
    def run(spark: SparkSession, d: str) -> DataFrame:
        old, edited, new = after(spark, d)
        keys, all_members = ([key], members(spark, d)) if key else ([], None)
        impact = merge.month_impact(merge.classify(edited, old, "txn_id", VALUES, VALUES))
        own, _ = merge.affected_months(impact, width)
        stored = kpi.monthly(population(old), keys, all_members, width=width)
        return kpi.increment(stored, population(new), sorted(r.month for r in own.collect()), keys, all_members, width)

    return run


def cutoff_warehouse(spark: SparkSession, d: str) -> DataFrame:
    """Sales of the last months have no price: they count for the last month of all, not for the baseline."""
    return kpi.cutoff(unpriced(ledger(spark, d)), in_scope() & F.col("total_price").isNotNull())


def unpriced(facts: DataFrame) -> DataFrame:
    return facts.withColumn(
        "total_price", F.when((F.col("month") < "2000-09-01") & (F.col("txn_id") % 9 != 0), F.col("total_price"))
    )


def stale_months(spark: SparkSession, d: str) -> DataFrame:
    """A stored month that is wrong and untouched by the delivery stays wrong; the comparison with a full rebuild tells which."""
    old, edited, new = after(spark, d)
    own, _ = merge.affected_months(merge.month_impact(merge.classify(edited, old, "txn_id", VALUES, VALUES)))
    stored = kpi.monthly(population(old)).withColumn("n", F.col("n") + F.when(F.month("month") == 7, 1).otherwise(0))
    built = kpi.increment(stored, population(new), sorted(r.month for r in own.collect()))
    return merge.recompute_diff(kpi.monthly(population(new)), built, ["month"], [*kpi.PRICES, "n"])


def facts_and_places(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The ledger in the warehouse's own tables."""
    nations = read(spark, d, "nation").join(read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    places = nations.select(
        F.col("n_nationkey").alias("location_id"), F.col("r_name").alias("county"), F.col("n_name").alias("town")
    )
    kind = F.when(in_scope(), C.HOUSE).otherwise(C.LAND)
    facts = ledger(spark, d).join(places.select("location_id", "town"), "town").select(
        "txn_id", "month", "location_id", kind.alias("transaction_type"), "total_price", "unit_price"
    )
    return facts, places


def second_computation(keys: list[str], width: int):
    def run(spark: SparkSession, d: str) -> DataFrame:
        facts, places = facts_and_places(spark, d)
        ends = facts.where(F.col("transaction_type") == C.HOUSE).agg(F.min("month"), F.max("month")).first()
        return recheck.expected(facts, places, keys, width, *ends)

    return run


def planted(df: DataFrame, where: Column) -> DataFrame:
    return df.withColumn("n", F.col("n") + F.when(where, 2).otherwise(0))


def grain_breach(spark: SparkSession, d: str) -> DataFrame:
    """Counts of regions that don't add up to the nation's in the months in which one was tampered with."""
    from acreage.plans.kpi_queries import by_region, national

    return kpi.cross_grain(
        planted(by_region(spark, d), (F.col("county") == "ASIA") & (F.month("month") == 5)), national(spark, d)
    )


def rolling_breach(spark: SparkSession, d: str) -> DataFrame:
    """The same over three months and for each region."""
    facts, places = facts_and_places(spark, d)
    named = facts.where(F.col("transaction_type") == C.HOUSE).join(places, "location_id")
    fine = kpi.monthly(named, ["county", "town"], places.select("county", "town"), width=3)
    coarse = kpi.monthly(named, ["county"], places.select("county").distinct(), width=3)
    return kpi.cross_grain(planted(fine, (F.month("month") == 5) & (F.col("town") == "NATION_12")), coarse, ["county"])


def first_gaps(spark: SparkSession, d: str) -> DataFrame:
    """The first month and town without a row in a table from which some were taken away."""
    facts, places = facts_and_places(spark, d)
    held = facts.join(places, "location_id").where(
        "not (month >= date'1997-03-01' and location_id % 7 = 3)"
    ).groupBy("month", "town").agg(F.count("*").alias("n"))
    ends = [date(1996, 1, 1), date(1998, 6, 1)]
    spine = places.select("town").crossJoin(
        kpi.month_spine(
            spark.range(1).select(*[F.lit(x).cast("date").alias(c) for c, x in zip(("first", "last"), ends, strict=True)])
        )
    )
    full = spine.join(held, ["town", "month"], "left").where("n is not null or month < date'1997-03-01'")
    return recheck.first_gap(full, places.select("town"), *ends)


def diff_detail(spark: SparkSession, d: str) -> DataFrame:
    """The first 50 months of towns whose stored values differ, with what differs."""
    from acreage.plans.kpi_queries import rolling3_nation

    want = rolling3_nation(spark, d)
    stored = want.where("month <> date'1996-02-01' or town <> 'NATION_12'").withColumn(
        "n", F.col("n") + F.when(F.month("month") == 2, 1).otherwise(0)
    )
    return recheck.first_differences(want, stored, ["month", "town"])


DELIVERY = f"with {MERGED_SQL}"

QUERIES = {
    "increment_national": increment(None, None, 1),
    "increment_city": increment("county", regions, 1),
    "increment_district": increment("town", towns, 3),
    "cutoff_warehouse": cutoff_warehouse,
    "stale_months": stale_months,
    "second_computation_national": second_computation([], 1),
    "second_computation_city": second_computation(["county"], 1),
    "second_computation_district": second_computation(["town"], 3),
    "grain_breach": grain_breach,
    "rolling_breach": rolling_breach,
    "first_gap": first_gaps,
    "diff_detail": diff_detail,
    "change_detail": lambda spark, d: merge.change_detail(
        *reversed(after(spark, d)[:2]), "txn_id", ["month", "total_price"], 50
    ),
}

ORACLES = {
    "increment_national": kpi_sql().replace(SQL, MERGED_SQL),
    "increment_city": REGION_SQL.replace(SQL, MERGED_SQL),
    "increment_district": ROLLING_SQL.replace(SQL, MERGED_SQL),
    "cutoff_warehouse": f"with {SQL}, {BASELINE} select * from cut".replace(
        "where kind in ('F', 'O') group by month",
        "where kind in ('F', 'O') and month < date '2000-09-01' and txn_id % 9 <> 0 group by month"
    ),
    "stale_months": kpi_sql().replace(SQL, MERGED_SQL).replace(
        "select * from kpi", "select month, 'different' as kind from kpi where month(month) = 7"
    ),
    "second_computation_national": kpi_sql(),
    "second_computation_city": REGION_SQL,
    "second_computation_district": ROLLING_SQL,
    "grain_breach": kpi_sql(out="select month, n + 2 as fine, n as coarse from kpi where month(month) = 5"),
    "rolling_breach": REGION_SQL.replace("select * from kpi", """, months as (select distinct month from kpi)
        select 'ASIA' as county, m.month, sum(k.n) + 2 as fine, sum(k.n) as coarse from months m join kpi k on k.county = 'ASIA' and k.month between m.month - interval 2 month and m.month
        where month(m.month) = 5 and m.month >= (select min(month) + interval 2 month from kpi) group by m.month"""),
    "first_gap": f"""with {SQL},
        g as (select cast(m as date) as month, n_name as town, n_nationkey from nation, unnest(generate_series(timestamp '1997-03-01', timestamp '1998-06-01', interval 1 month)) as u(m))
        select month, town from g where n_nationkey % 7 = 3 or not exists (select 1 from ledger l where l.town = g.town and l.month = g.month) order by month, town limit 1""",
    "diff_detail": ROLLING_SQL.replace("select * from kpi", """select month, town, month = date '1996-02-01' and town = 'NATION_12' as missing, false as unexpected,
        case when month = date '1996-02-01' and town = 'NATION_12' then '' else 'n' end as differing from kpi where month(month) = 2 order by month, town limit 50"""),
    "change_detail": f"""{DELIVERY}
        select n.txn_id, '{{' || case when n.month <> o.month then '"month":{{"new":"' || n.month || '","old":"' || o.month || '"}},' else '' end || '"total_price":{{"new":"' || n.total_price || '","old":"' || o.total_price || '"}}}}' as detail
        from ledger n join ledger0 o on n.txn_id = o.txn_id where n.total_price <> o.total_price order by 1 limit 50""",
}
