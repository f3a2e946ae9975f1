"""Indicator queries over the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage.operators import kpi
from acreage.operators.merge import affected_months, recompute_diff
from acreage.plans.ledger import BATCH_SQL, SQL, batch, in_scope, kpi_facts, ledger, read, target


def national(spark: SparkSession, d: str) -> DataFrame:
    return kpi.monthly(kpi_facts(spark, d))


def regions(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "region").select(F.col("r_name").alias("county"))


def towns(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "nation").select(F.col("n_name").alias("town"))


def by_region(spark: SparkSession, d: str) -> DataFrame:
    return kpi.monthly(kpi_facts(spark, d), ["county"], regions(spark, d))


def rolling3_nation(spark: SparkSession, d: str) -> DataFrame:
    return kpi.rolling3(kpi_facts(spark, d), ["town"], towns(spark, d))


def rolling_baseline(spark: SparkSession, d: str) -> DataFrame:
    return kpi.rolling_baseline(kpi.monthly_counts(ledger(spark, d), in_scope()))


def cutoff_month(spark: SparkSession, d: str) -> DataFrame:
    return kpi.cutoff(ledger(spark, d), in_scope())


def published(spark: SparkSession, d: str) -> DataFrame:
    """Indicators up to the cutoff month only; the cutoff is one row, taken as a literal so that it prunes the facts."""
    last = kpi.cutoff(ledger(spark, d), in_scope()).first().candidate
    facts = kpi_facts(spark, d)
    return kpi.monthly(facts.where(F.col("month") <= F.lit(last)), last=F.lit(last).cast("date"))


def month_spine(spark: SparkSession, d: str) -> DataFrame:
    counts = kpi_facts(spark, d).groupBy("town", "month").agg(F.count("*").alias("n"))
    spine = kpi.month_spine(
        counts.agg(F.min("month").alias("first"), F.max("month").alias("last"))
    ).join(F.broadcast(towns(spark, d)))
    return spine.join(counts, ["town", "month"], "left").select("town", "month", F.coalesce("n", F.lit(0)).alias("n"))


def empty_spine(spark: SparkSession, d: str) -> DataFrame:
    """A spine whose start lies after its end has no months."""
    bounds = ledger(spark, d).agg(F.add_months(F.max("month"), 1).alias("first"), F.max("month").alias("last"))
    return kpi.month_spine(bounds)


def missing_months(spark: SparkSession, d: str) -> DataFrame:
    """Months of a town's spine without any transaction: an anti join."""
    seen = kpi_facts(spark, d).select("town", "month").distinct()
    return month_spine(spark, d).select("town", "month").join(seen, ["town", "month"], "left_anti")


def region_share(spark: SparkSession, d: str) -> DataFrame:
    return kpi.share_of_total(by_region(spark, d), national(spark, d)).select("county", "month", "n", "share", "price_ratio")


def trailing_months(months: int):
    return lambda spark, d: kpi.trailing(national(spark, d), months).select("month", "n", "median_total")


def cross_grain_check(spark: SparkSession, d: str) -> DataFrame:
    return kpi.cross_grain(by_region(spark, d), national(spark, d))


def cross_grain_rolling(spark: SparkSession, d: str) -> DataFrame:
    """Sums of the towns' rolling counts against three months of the regions'."""
    shifted = by_region(spark, d).groupBy("month").agg(F.sum("n").alias("n")).withColumn(
        "month", F.explode(F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda k: F.add_months("month", k)))
    )
    coarse = shifted.groupBy("month").agg(F.sum("n").alias("n"))
    return kpi.cross_grain(
        rolling3_nation(spark, d), coarse.join(rolling3_nation(spark, d).select("month").distinct(), "month", "left_semi")
    )


def observed_months(spark: SparkSession, d: str) -> DataFrame:
    return kpi_facts(spark, d).groupBy("county").agg(F.array_sort(F.collect_set("month")).alias("m")).select(
        "county", F.array_join(F.transform("m", lambda x: x.cast("string")), ",").alias("months")
    )


def incremental_equals_full(spark: SparkSession, d: str) -> DataFrame:
    """Recompute only the affected months after a batch and compare with a full rebuild: no rows are left."""
    from acreage.operators.merge import classify, month_impact, upsert

    old, new = target(spark, d), batch(spark, d)
    core = ["month", "kind", "total_price"]
    impact = month_impact(classify(new, old, "txn_id", [*core, "town"], core))
    merged = upsert(new, old, "txn_id", [*core, "town"])
    count = lambda facts: facts.where(in_scope()).groupBy("month").agg(
        F.count("*").alias("n"), F.sum("total_price").alias("total")
    )
    months, _ = affected_months(impact)
    kept = count(old).join(months, "month", "left_anti")
    fresh = count(merged.join(F.broadcast(months), "month", "left_semi"))
    return recompute_diff(count(merged), kept.unionByName(fresh), ["month"], ["n", "total"])


def affected(rolling: int):
    def run(spark: SparkSession, d: str) -> DataFrame:
        from acreage.operators.merge import classify, month_impact

        core = ["month", "kind", "total_price"]
        impact = month_impact(classify(batch(spark, d), target(spark, d), "txn_id", [*core, "town"], core))
        own, yearly = affected_months(impact.where("month >= date'2000-06-01'"), rolling)
        return yearly.join(own.withColumn("recompute", F.lit(True)), "month", "left").select(
            "month", F.coalesce("recompute", F.lit(False)).alias("recompute")
        )

    return run


def affected_sql(rolling: int) -> str:
    return f"""
        with {BATCH_SQL},
             own as (select distinct cast(month + to_months(cast(k as integer)) as date) as month from impact, range({rolling}) r(k) where has_core_impact and month >= date '2000-06-01'),
             yearly as (select month from own union select cast(month + interval 12 month as date) from own)
        select y.month, o.month is not null as recompute from yearly y left join own o on y.month = o.month
    """


MEASURES = """cast(quantile_cont(total_price, 0.5) / 10000.0 as decimal(18,6)) as median_total,
    cast(cast(sum(total_price) as double) / count(total_price) / 10000.0 as decimal(18,6)) as mean_total,
    cast(quantile_cont(unit_price, 0.5) * 3.305785 / 10000.0 as decimal(18,6)) as median_unit,
    cast(avg(unit_price) * 3.305785 / 10000.0 as decimal(18,6)) as mean_unit, count(*) as n"""


def kpi_sql(key: str = "", members: str = "", where: str = "", last: str = "max(month)", out: str = "") -> str:
    """SQL of a dense monthly table with yearly change; key is the member's column, members the table of all."""
    k = f"{key}, " if key else ""
    pair = lambda a, b: f"cast(cast({a} as double) / {b} - 1 as decimal(14,8))"
    yoy = ", ".join(f"{pair(f'c.{c}', f'p.{c}')} as {c}_yoy" for c in kpi.PRICES)
    return f"""
        with {SQL},
             facts as (select * from ledger where kind in ('F', 'O') {where}),
             got as (select {k}month, {MEASURES} from facts group by {k}month),
             spine as (select {k}cast(m as date) as month from (select unnest(generate_series((select min(month) from facts)::timestamp, (select {last} from facts)::timestamp, interval 1 month)) as m) {members}),
             dense as (select s.*, median_total, mean_total, median_unit, mean_unit, coalesce(n, 0) as n from spine s left join got g on s.month = g.month {f'and s.{key} = g.{key}' if key else ''}),
             kpi as (select {'c.' + k if key else ''}c.month, c.median_total, c.mean_total, c.median_unit, c.mean_unit, c.n, {yoy},
                            case when p.n <> 0 then {pair('c.n', 'p.n')} end as n_yoy
                     from dense c left join dense p on c.month = cast(p.month + interval 12 month as date) {f'and c.{key} = p.{key}' if key else ''})
        {out or 'select * from kpi'}
    """


REGION_SQL = kpi_sql("county", "cross join (select r_name as county from region)")
ROLLING_SQL = kpi_sql("town", "cross join (select n_name as town from nation)").replace(
    "got as (select town, month,", "anchored as (select f.* exclude (month), cast(f.month + to_months(cast(k as integer)) as date) as month from facts f, range(3) r(k)),\n             got as (select town, month,",
).replace("from facts group by town, month)", "from anchored group by town, month)").replace("(select min(month) from facts)::timestamp", "(select min(month) + interval 2 month from facts)::timestamp")
BASELINE = """counts as (select month, count(*) as n from ledger where kind in ('F', 'O') group by month),
             scored as (select month, n, (select quantile_cont(b.n, 0.5) from counts b where b.month >= c.month - interval 12 month and b.month < c.month) as baseline,
                               (select count(*) from counts b where b.month >= c.month - interval 12 month and b.month < c.month) as observed from counts c),
             cut as (select (select max(month) from ledger) as source_max,
                            (select max(month) from scored where observed > 0 and n >= baseline * 0.75 and month <= (select max(month) from ledger) - interval 3 month) as candidate)"""

QUERIES = {
    "monthly_kpi_national": national,
    "monthly_kpi_region": by_region,
    "rolling3_nation": rolling3_nation,
    "rolling_baseline": rolling_baseline,
    "cutoff_month": cutoff_month,
    "monthly_kpi_published": published,
    "month_spine": month_spine,
    "empty_spine": empty_spine,
    "missing_months": missing_months,
    "region_share": region_share,
    "yoy_region": lambda spark, d: by_region(spark, d).select("county", "month", *[f"{c}_yoy" for c in [*kpi.PRICES, "n"]]),
    "trailing_12": trailing_months(12),
    "trailing_24": trailing_months(24),
    "cross_grain_check": cross_grain_check,
    "cross_grain_rolling": cross_grain_rolling,
    "observed_months": observed_months,
    "incremental_equals_full": incremental_equals_full,
    "affected_months": affected(1),
    "affected_anchors": affected(3),
}

ORACLES = {
    "monthly_kpi_national": kpi_sql(),
    "monthly_kpi_region": REGION_SQL,
    "rolling3_nation": ROLLING_SQL,
    "rolling_baseline": f"with {SQL}, {BASELINE} select * from scored",
    "cutoff_month": f"with {SQL}, {BASELINE} select * from cut",
    "monthly_kpi_published": kpi_sql(
        where="and month <= (select candidate from cut)", last="any_value((select candidate from cut))"
    ).replace("facts as (select", f"{BASELINE},\n             facts as (select", 1),
    "month_spine": kpi_sql("town", "cross join (select n_name as town from nation)", out="select town, month, n from dense"),
    "empty_spine": "select cast(null as date) as month where false",
    "missing_months": kpi_sql(
        "town", "cross join (select n_name as town from nation)", out="select town, month from dense where n = 0"
    ),
    "region_share": REGION_SQL.replace("select * from kpi", "")
    + """, whole as (select month, count(*) as n, cast(quantile_cont(total_price, 0.5) / 10000.0 as decimal(18,6)) as m from facts group by month)
        select county, kpi.month, kpi.n, cast(cast(kpi.n as double) / whole.n as decimal(14,8)) as share, cast(cast(median_total as double) / m as decimal(14,8)) as price_ratio
        from kpi left join whole on kpi.month = whole.month""",
    "yoy_region": REGION_SQL.replace(
        "select * from kpi",
        "select county, month, median_total_yoy, mean_total_yoy, median_unit_yoy, mean_unit_yoy, n_yoy from kpi"
    ),
    "trailing_12": kpi_sql(
        out="select month, n, median_total from kpi where month > (select max(month) from kpi) - interval 12 month"
    ),
    "trailing_24": kpi_sql(
        out="select month, n, median_total from kpi where month > (select max(month) from kpi) - interval 24 month"
    ),
    "cross_grain_check": "select cast(null as date) as month, 0 as fine, 0 as coarse where false",
    "cross_grain_rolling": "select cast(null as date) as month, 0 as fine, 0 as coarse where false",
    "observed_months": f"with {SQL} select county, string_agg(distinct cast(month as varchar), ',' order by cast(month as varchar)) as months from ledger where kind in ('F', 'O') group by county",
    "incremental_equals_full": "select cast(null as date) as month, '' as kind where false",
    "affected_months": affected_sql(1),
    "affected_anchors": affected_sql(3),
}
