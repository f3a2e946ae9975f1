"""Profiling queries over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage.functions.dates import month_gap
from acreage.functions.numeric import bucket, sum_present
from acreage.functions.text import digit_length
from acreage.operators import profile
from acreage.operators.profile_run import formula_groups, parking_formulas, parking_group
from acreage.plans.ledger import SQL, ledger, read

PATTERNS = {"the": "(?i)\\bthe\\b", "digits": "[0-9]{4}", "mail": "@", "url": "https?://", "bars": "\\|", "bangs": "!!"}


def lines(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "lineitem")


def with_gaps(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("l_quantity")
    return lines(spark, d).select(
        "l_orderkey", F.when(q == 7, None).when(q == 8, 0.0).when(q == 9, -q).when(q == 10, q + 0.5).otherwise(q).alias("q"),
        F.when(q % 5 != 0, F.col("l_extendedprice")).alias("p"), "l_returnflag", "l_linestatus"
    )


def formulas() -> dict:
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    return {
        "unit": (q > 0, p / q, F.round(p / q, 0)), "net": (F.col("l_discount") > 0, p * (1 - F.col("l_discount")), p * 0.95)
    }


def gap_buckets(spark: SparkSession, d: str) -> DataFrame:
    ship = lines(spark, d).join(read(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    gap = month_gap(F.col("l_shipdate"), F.lit("1996-01-01").cast("date"))
    return ship.select(
        bucket(gap, [3, 6, 12, 24, 60]).alias("bucket")
    ).where("bucket is not null").groupBy("bucket").agg(F.count("*").alias("rows"))


def row_sums(spark: SparkSession, d: str) -> DataFrame:
    return with_gaps(spark, d).select(
        "l_orderkey", F.round(sum_present([F.col("q"), F.col("p")]), 4).alias("total")
    ).groupBy("l_orderkey").agg(F.count("total").alias("n"), F.round(F.sum("total"), 2).alias("total"))


def parked(spark: SparkSession, d: str) -> DataFrame:
    """Lines as sales with a parking space, of which price, size, both or neither are told, or null."""
    k, size = F.col("l_orderkey") % 6, F.col("l_quantity") / 10
    return lines(spark, d).select(
        F.col("l_extendedprice").alias("total"), F.col("l_quantity").alias("area"), (
            F.col("l_extendedprice") / F.col("l_quantity") * (1 + F.col("l_discount") / 10)
        ).alias("unit"),
        F.when(k == 5, None).when(
            k.isin(0, 3), F.col("l_extendedprice") * F.col("l_tax")
        ).otherwise(0.0).alias("pp"), F.when(k.isin(0, 2), size).when(k == 4, -size).otherwise(0.0).alias("ps"),
    )


QUERIES = {
    "numeric_quality": lambda s, d: profile.numeric_quality(with_gaps(s, d), ["q", "p"]),
    "top_values": lambda s, d: profile.top_values(lines(s, d), ["l_returnflag", "l_linestatus", "l_linenumber"], 3),
    "nearest_rank": lambda s, d: profile.nearest_rank(lines(s, d), "l_linenumber", [0.5, 0.95, 0.99], ["l_returnflag"]),
    "percentiles": lambda s, d: profile.percentiles(with_gaps(s, d), ["q", "p"], [0.01, 0.5, 0.99]),
    "formula_match": lambda s, d: profile.formula_match(lines(s, d), formulas(), 0.5),
    "formula_matrix": lambda s, d: profile.formula_match(lines(s, d), formulas(), 0.5, ["l_returnflag", "l_linestatus"]),
    "regex_categories": lambda s, d: profile.flag_counts(
        read(s, d, "documents"), {n: F.col("text").rlike(p) for n, p in PATTERNS.items()}
    ),
    "month_gap_buckets": gap_buckets,
    "share_of_total": lambda s, d: profile.distribution(ledger(s, d), F.year("month"), "year"),
    "tuple_uniqueness": lambda s, d: profile.uniqueness(with_gaps(s, d), ["l_orderkey", "q"]),
    "group_examples": lambda s, d: profile.examples(read(s, d, "part"), ["p_brand"], "p_type", 3),
    "flag_cross_tab": lambda s, d: profile.cross_tab(lines(s, d), F.col("l_returnflag") == "R", F.col("l_quantity") > 25),
    "area_relations": lambda s, d: profile.relations(
        with_gaps(s, d), {"q_p": (F.col("q") * 1000, F.col("p")), "p_q": (F.col("p"), F.col("q") * 1000)}, 0.01
    ),
    "detail_total": lambda s, d: profile.detail_total(
        lines(s, d), F.col("l_discount") > 0, F.col("l_quantity"), F.lit(25.0), 0.5
    ),
    "transition_report": lambda s, d: profile.transition_report(
        ledger(s, d), ["county", "kind"], F.col("town").isNotNull(), ~F.col("town").endswith("2") | (F.col("kind") == "P")
    ),
    "parking_groups": lambda s, d: profile.distribution(parked(s, d), parking_group(F.col("pp"), F.col("ps")), "group"),
    "parking_formulas": lambda s, d: formula_groups(
        parked(s, d), parking_formulas(*[F.col(c) for c in ("total", "area", "unit", "pp", "ps")]), 50.0
    ),
    "unmatched_places": lambda s, d: profile.unmatched(
        ledger(s, d).select("county", F.when(~F.col("town").endswith("3"), F.col("town")).alias("town")), ["county", "town"],
        F.col("town").isNull() | F.col("town").endswith("7")
    ),
    "row_sums": row_sums,
    "digit_lengths": lambda s, d: ledger(s, d).groupBy(
        digit_length(F.col("total_price")).alias("digits")
    ).agg(F.count("*").alias("rows")),
}

GAPS = "g as (select l_orderkey, case l_quantity when 7 then null when 8 then 0.0 when 9 then -l_quantity when 10 then l_quantity + 0.5 else l_quantity end::double as q, case when l_quantity % 5 <> 0 then l_extendedprice end as p, l_returnflag, l_linestatus from lineitem)"
QUALITY = """select '{c}' as "column", count(*) as rows, count_if({c} is null) as missing, count_if({c} = 0) as zero, count_if({c} < 0) as negative, count_if({c} > 0) as valid,
    count_if({c} > 0 and abs({c} - round({c})) > 1e-9) as non_integer, min(case when {c} > 0 then {c} end) as lowest, max(case when {c} > 0 then {c} end) as highest, count_if({c} > 0)::double / count(*) as valid_rate from g"""
TOP = """select '{c}' as "column", {c}::varchar as value, count(*) as rows, row_number() over (order by count(*) desc, {c}::varchar) as k from lineitem group by {c} qualify k <= 3"""
MATCH = """select {k} 'unit' as formula, count(*) as comparable, count_if(abs(l_extendedprice / l_quantity - round(l_extendedprice / l_quantity)) <= 0.5) as matched, matched::double / comparable as rate from lineitem where l_quantity > 0 {g}
    union all select {k} 'net', count(*), count_if(abs(l_extendedprice * (1 - l_discount) - l_extendedprice * 0.95::double) <= 0.5), count_if(abs(l_extendedprice * (1 - l_discount) - l_extendedprice * 0.95::double) <= 0.5)::double / count(*) from lineitem where l_discount > 0 {g}"""
PARKED = """p as (select l_extendedprice as total, l_quantity as area, l_extendedprice / l_quantity * (1 + l_discount / 10) as unit, l_orderkey % 6 as k, l_extendedprice * l_tax as price, l_quantity / 10 as size from lineitem),
    q as (select total, area, unit, case when k = 5 then null when k in (0, 3) then price else 0 end as pp, case when k in (0, 2) then size when k = 4 then -size else 0 end as ps from p),
    parked as (select *, case when pp > 0 and ps > 0 then 'A_both_positive' when pp = 0 and ps = 0 then 'B_both_zero' when pp = 0 and ps > 0 then 'C_size_only' when pp > 0 and ps = 0 then 'D_price_only' else 'OTHER' end as g from q)"""
ORACLES = {
    "numeric_quality": f"with {GAPS} " + " union all ".join(QUALITY.format(c=c) for c in ("q", "p")),
    "top_values": " union all ".join(f"({TOP.format(c=c)})" for c in ("l_returnflag", "l_linestatus", "l_linenumber")),
    "nearest_rank": "select l_returnflag, count(*) as valid_rows, min(l_linenumber) as lowest, quantile_disc(l_linenumber, 0.5) as p50, quantile_disc(l_linenumber, 0.95) as p95, quantile_disc(l_linenumber, 0.99) as p99, max(l_linenumber) as highest from lineitem group by 1",
    "percentiles": f"with {GAPS} " + " union all ".join(
        f"select '{c}' as \"column\", {s}::double as share, quantile_cont({c}, {s}) as value from g where {c} > 0" for c in ("q", "p") for s in (0.01, 0.5, 0.99)
    ),
    "formula_match": MATCH.format(k="", g=""),
    "formula_matrix": MATCH.format(k="l_returnflag, l_linestatus,", g="group by l_returnflag, l_linestatus"),
    "regex_categories": " union all ".join(
        f"select '{n}' as flag, count_if(regexp_matches(text, '{p}')) as rows from documents" for n, p in PATTERNS.items()
    ),
    "month_gap_buckets": """with m as (select (year(l_shipdate) - 1996) * 12 + month(l_shipdate) - 1 as g from lineitem)
        select case when g <= 3 then '1-3' when g <= 6 then '4-6' when g <= 12 then '7-12' when g <= 24 then '13-24' when g <= 60 then '25-60' else '>60' end as bucket, count(*) as rows from m where g >= 1 group by 1""",
    "share_of_total": f"with {SQL} select year(month) as year, count(*) as rows, count(*)::double / sum(count(*)) over () as share from ledger group by 1",
    "tuple_uniqueness": f"with {GAPS} select count(*) as rows, (select count(*) from (select distinct l_orderkey, q from g)) as tuples from g",
    "group_examples": "with e as (select distinct p_brand, p_type from part where p_type is not null qualify dense_rank() over (partition by p_brand order by p_type) <= 3) select p_brand, string_agg(p_type, ',' order by p_type) as examples from e group by 1",
    "flag_cross_tab": "select l_returnflag = 'R' as a, l_quantity > 25 as b, count(*) as rows from lineitem group by 1, 2",
    "area_relations": f"with {GAPS} select 'q_p' as pair, count(*) as comparable, count_if(q * 1000 <= p + 0.01) as satisfied from g where q is not null and p is not null union all select 'p_q', count(*), count_if(p <= q * 1000 + 0.01) from g where q is not null and p is not null",
    "detail_total": "select l_discount > 0 as present, count(*) as rows, count_if(abs(l_quantity - 25) <= 0.5) as equal, count_if(l_quantity - 25 > 0.5) as greater, count_if(l_quantity - 25 < -0.5) as less from lineitem group by 1",
    "transition_report": f"with {SQL} select county, kind, count(*) as before, count_if(town not like '%2' or kind = 'P') as after, case when count_if(town like '%2' and kind <> 'P') = 0 then 'PASS' else 'FAIL' end as status from ledger group by 1, 2",
    "parking_groups": f"with {PARKED} select g as \"group\", count(*) as rows, count(*)::double / sum(count(*)) over () as share from parked group by 1",
    "parking_formulas": f"""with {PARKED}, f as (
        select g, 'unadjusted' as formula, unit, total / area as want from parked where g <> 'OTHER' and total > 0 and area > 0 and unit > 0
        union all select g, case g when 'A_both_positive' then 'adjust_price_and_area' when 'C_size_only' then 'adjust_area_only' else 'adjust_price_only' end, unit, (total - pp) / (area - ps)
        from parked where g in ('A_both_positive', 'C_size_only', 'D_price_only') and total > pp and area > ps and unit > 0)
        select g as "group", formula, count(*) as comparable, count_if(abs(unit - want) <= 50) as matched, count_if(abs(unit - want) <= 50)::double / count(*) as rate from f group by 1, 2""",
    "unmatched_places": f"with {SQL}, u as (select county, case when not ends_with(town, '3') then town end as town from ledger) select county, coalesce(town, '<BLANK>') as town, count(*) as rows from u where town is null or ends_with(town, '7') group by 1, 2",
    "row_sums": f"with {GAPS}, t as (select l_orderkey, case when coalesce(q, p) is not null then round(coalesce(q, 0) + coalesce(p, 0), 4) end as t from g) select l_orderkey, count(t) as n, round(sum(t), 2) as total from t group by 1",
    "digit_lengths": f"with {SQL} select length(total_price::varchar) as digits, count(*) as rows from ledger group by 1",
}
