"""Cleaning queries: duplicates, exclusion, parsing and normal forms over the driver's tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage.functions import dates, numeric, text
from acreage.operators.dedup import duplicate_kinds, duplicate_reason, first_wins
from acreage.operators.exclude import independent_checks, primary_reason, split, violations
from acreage.plans.ledger import SQL, ledger, read

COMPARED = ["l_linenumber", "l_quantity", "l_extendedprice"]
#: Where a row stands in its table: files by name, then rows.
PLACE = ["_metadata.file_path", "_metadata.row_index"]


def doubled(spark: SparkSession, d: str, place: Sequence[str] = ()) -> DataFrame:
    """lineitem with some rows delivered twice, in input order."""
    lines = read(spark, d, "lineitem").select("l_orderkey", *COMPARED, *place)
    first = lines.withColumn("pos", F.col("l_orderkey") * 100 + F.col("l_linenumber"))
    again = first.where("l_orderkey % 10 = 3").withColumn("pos", F.col("pos") + 10_000_000_000)
    return first.unionByName(again)


def dup_classification(spark: SparkSession, d: str) -> DataFrame:
    return duplicate_kinds(doubled(spark, d), ["l_orderkey"], COMPARED)


def first_wins_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Lines of an order may share their number and so their pos (null comes last); of these the first in the table wins."""
    rows = doubled(spark, d, PLACE)
    return first_wins(rows, ["l_orderkey"], [F.asc_nulls_last("pos"), "file_path", "row_index"]).drop("file_path", "row_index")


def duplicate_reasons(spark: SparkSession, d: str) -> DataFrame:
    return duplicate_reason(doubled(spark, d), ["l_orderkey"], COMPARED, "pos").select("pos", "l_orderkey", "duplicate_reason")


def conditions() -> dict[str, Column]:
    return {
        "missing_source_transaction_id": F.col("txn_id").isNull() | (F.col("txn_id") % 97 == 0),
        "invalid_transaction_period": ~F.col("month").between(
            F.lit("1995-06-01").cast("date"), F.lit("2001-01-01").cast("date")
        ),
        "unmapped_location": F.col("town").endswith("8"),
        "excluded_transaction_type": F.col("kind") == "P",
    }


CONDITIONS_SQL = {
    "missing_source_transaction_id": "txn_id % 97 = 0",
    "invalid_transaction_period": "not month between date '1995-06-01' and date '2001-01-01'",
    "unmapped_location": "ends_with(town, '8')",
    "excluded_transaction_type": "kind = 'P'",
}
REASON_SQL = "case " + " ".join(f"when {c} then '{n}'" for n, c in CONDITIONS_SQL.items()) + " end"


def reasons(spark: SparkSession, d: str) -> DataFrame:
    return ledger(spark, d).select("txn_id", "month", primary_reason(conditions()).alias("reason"))


def clean_split(spark: SparkSession, d: str) -> DataFrame:
    """Rows kept and excluded by month; together they are the input."""
    clean, excluded = split(reasons(spark, d))
    both = clean.groupBy("month").agg(F.count("*").alias("clean")).join(
        excluded.groupBy("month").agg(F.count("*").alias("excluded")), "month", "full"
    )
    return both.select(
        "month", F.coalesce("clean", F.lit(0)).alias("clean"), F.coalesce("excluded", F.lit(0)).alias("excluded")
    )


def contract_violations(spark: SparkSession, d: str) -> DataFrame:
    lines = read(spark, d, "lineitem")
    found = violations(
        lines,
        {
            "quantity_positive": F.col("l_quantity") > 10, "discount_small": F.col("l_discount") <= 0.05,
            "linenumber_set": F.col("l_linenumber").isNotNull()
        }
    )
    return spark.createDataFrame(sorted(found.items()), "predicate string, rows long")


def exclusion_ids(spark: SparkSession, d: str) -> DataFrame:
    out = reasons(spark, d).where("reason is not null")
    return out.select(
        "txn_id", F.format_string("%s-E%09d", F.lit("run1"), F.col("txn_id")).alias("exclusion_record_id"), "reason"
    )


def roc_dates(spark: SparkSession, d: str) -> DataFrame:
    """ROC dates written compactly and read back; some are spoilt on purpose."""
    k = F.col("txn_id")
    y, m, dd = F.year("day") - 1911, F.month("day"), F.dayofmonth("day")
    raw = F.when(k % 10 == 1, "").when(k % 10 == 2, "85061").when(
        k % 10 == 3, F.concat((y * 100 + 13).cast("string"), F.lit("01"))
    ).when(k % 10 == 4, "860231").otherwise((y * 10000 + m * 100 + dd).cast("string"))
    rows = ledger(spark, d).select("txn_id", raw.alias("raw"), (F.col("kind") == "P").alias("land"))
    date, status = dates.completion(F.col("raw"), F.col("land"))
    return rows.select("txn_id", date.alias("completion_date"), status.alias("status"))


def safe_dates(spark: SparkSession, d: str) -> DataFrame:
    """Dates built from parts; days that don't exist become null."""
    rows = ledger(spark, d).select(
        "txn_id", F.year("day").alias("y"), F.month("day").alias("m"), (F.col("txn_id") % 33).alias("d")
    )
    return rows.select("txn_id", dates.build_date(F.col("y"), F.col("m"), F.col("d")).alias("date"))


def positive_values(spark: SparkSession, d: str) -> DataFrame:
    """Amounts as text, some blank, negative, spelt NaN or broken: value, validity, wholeness."""
    k = F.col("txn_id")
    raw = F.when(k % 8 == 0, "").when(k % 8 == 1, "NaN").when(k % 8 == 2, "abc").when(k % 8 == 3, F.concat(F.lit("-"), F.col("total_price").cast("string"))).when(
        k % 8 == 4, F.concat(F.col("total_price").cast("string"), F.lit(".5"))
    ).otherwise(F.col("total_price").cast("string"))
    rows = ledger(spark, d).select("txn_id", raw.alias("raw"))
    value, valid, _, part = numeric.positive_integer(F.col("raw"))
    real, real_valid, _ = numeric.positive_float(F.col("raw"))
    layout, _, failed = numeric.nonnegative_integer(F.col("raw"))
    return rows.select(
        "txn_id", value.alias("value"), valid.alias("valid"), part.alias("part"), real.alias("real"),
        real_valid.alias("real_valid"), layout.cast("long").alias("layout"), failed.alias("failed")
    )


def normal_text(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents")
    return docs.select(
        "doc_id", text.normalize_text(F.concat(F.lit(" \t"), F.coalesce("text", F.lit("")), F.lit(" \n"))).alias("normal")
    )


def categories(spark: SparkSession, d: str) -> DataFrame:
    parts = read(spark, d, "part")
    return parts.select(
        "p_partkey", text.keyword_category(F.col("p_type"), ["STEEL", "COPPER", "BRASS", "PROMO"], "other").alias("category"),
        text.tri_state(F.substring("p_brand", -1, 1), "1", "2").alias("flag"),
        text.label_missing(F.nullif(F.col("p_type"), F.lit("PROMO"))).alias("label")
    )


def alias_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Places renamed by an alias table, then looked up; both tables are small and checked to have one row for each key."""
    places = read(spark, d, "nation").join(F.broadcast(read(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("county"), F.col("n_name").alias("town"), F.col("n_nationkey").alias("town_id")
    )
    aliases = places.where("town_id % 5 = 2").select("county", F.lower("town").alias("town"), F.col("town").alias("target"))
    raw = ledger(spark, d).select(
        "txn_id", "county", F.when(F.col("txn_id") % 2 == 0, F.lower("town")).otherwise(F.col("town")).alias("town")
    )
    renamed = raw.join(F.broadcast(aliases), ["county", "town"], "left").select(
        "txn_id", "county", F.coalesce("target", "town").alias("town")
    )
    return renamed.join(F.broadcast(places), ["county", "town"], "left").select("txn_id", "town", "town_id")


RAW_SQL = "case txn_id % 8 when 0 then '' when 1 then 'NaN' when 2 then 'abc' when 3 then '-' || total_price when 4 then total_price || '.5' else total_price::varchar end"

QUERIES = {
    "dup_classification": dup_classification,
    "first_wins_dedup": first_wins_dedup,
    "duplicate_reasons": duplicate_reasons,
    "exclusion_reasons": reasons,
    "independent_checks": lambda spark, d: independent_checks(ledger(spark, d), conditions()),
    "clean_split": clean_split,
    "contract_violations": contract_violations,
    "exclusion_ids": exclusion_ids,
    "completion_dates": roc_dates,
    "safe_dates": safe_dates,
    "positive_values": positive_values,
    "normal_text": normal_text,
    "categories": categories,
    "alias_lookup": alias_lookup,
}

DOUBLED = """lines as (select l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_orderkey * 100 + l_linenumber as pos from lineitem),
    d as (select * from lines union all select l_orderkey, l_linenumber, l_quantity, l_extendedprice, pos + 10000000000 from lines where l_orderkey % 10 = 3)"""
ORACLES = {
    "dup_classification": f"with {DOUBLED} select l_orderkey, count(*) as n, case when count(distinct (l_linenumber, l_quantity, l_extendedprice)) = 1 then 'exact' else 'conflict' end as kind from d group by 1 having count(*) > 1",
    "first_wins_dedup": f"with {DOUBLED} select l_orderkey, l_linenumber, l_quantity, l_extendedprice, pos from d qualify row_number() over (partition by l_orderkey order by pos) = 1",
    "duplicate_reasons": f"""with {DOUBLED}, k as (select l_orderkey, count(*) as n, count(distinct (l_linenumber, l_quantity, l_extendedprice)) as v, min(pos) as f from d group by 1)
        select pos, d.l_orderkey, case when v > 1 then 'duplicate_conflict' when n > 1 and pos > f then 'duplicate_exact' end as duplicate_reason from d join k on d.l_orderkey = k.l_orderkey""",
    "exclusion_reasons": f"with {SQL} select txn_id, month, {REASON_SQL} as reason from ledger",
    "independent_checks": f"with {SQL} " + " union all ".join(
        f"select '{n}' as \"check\", count_if({c}) as rows from ledger" for n, c in CONDITIONS_SQL.items()
    ),
    "clean_split": f"with {SQL} select month, count_if({REASON_SQL} is null) as clean, count_if({REASON_SQL} is not null) as excluded from ledger group by month",
    "contract_violations": """select 'quantity_positive' as predicate, count_if(not l_quantity > 10) as rows from lineitem union all select 'discount_small', count_if(not l_discount <= 0.05) from lineitem
        union all select 'linenumber_set', count_if(l_linenumber is null) from lineitem""",
    "exclusion_ids": f"with {SQL} select txn_id, 'run1-E' || lpad(txn_id::varchar, 9, '0') as exclusion_record_id, {REASON_SQL} as reason from ledger where {REASON_SQL} is not null",
    "completion_dates": f"""with {SQL}
        select txn_id, case when kind <> 'P' and txn_id % 10 not in (1, 2, 3, 4) then day end as completion_date,
               case when kind = 'P' then 'not_applicable' when txn_id % 10 = 1 then 'missing' when txn_id % 10 = 2 then 'ambiguous_5_digit' when txn_id % 10 in (3, 4) then 'invalid' else 'valid' end as status from ledger""",
    "safe_dates": f"with {SQL} select txn_id, try_cast(format('{{:04d}}-{{:02d}}-{{:02d}}', year(day), month(day), txn_id % 33) as date) as date from ledger",
    "positive_values": f"""with {SQL}, r as (select txn_id, {RAW_SQL} as raw, txn_id % 8 as k, total_price as t from ledger)
        select txn_id, case when k > 4 then t end as value, k > 4 as valid, k = 4 as part, case when k = 4 then t + 0.5::double when k > 4 then t::double end as "real", k >= 4 as real_valid,
               case when k > 4 then t end as layout, k in (1, 2, 3, 4) as failed from r""",
    "normal_text": r"select doc_id, nullif(nfc_normalize(regexp_replace(text, '^\s+|\s+$', '', 'g')), '') as normal from documents",
    "categories": """select p_partkey, case when p_type like '%PROMO%' then 'PROMO' when p_type like '%BRASS%' then 'BRASS' when p_type like '%COPPER%' then 'COPPER' when p_type like '%STEEL%' then 'STEEL' when p_type is not null then 'other' end as category,
        case right(p_brand, 1) when '1' then true when '2' then false end as flag, case when nullif(p_type, 'PROMO') is null then '<PANDAS_NA>' when trim(p_type) = '' then '<BLANK_STRING>' else p_type end as label from part""",
    "alias_lookup": f"""with {SQL}, p as (select n_name as town, n_nationkey as town_id from nation), x as (select txn_id, case when txn_id % 2 = 0 and (select town_id from p where p.town = ledger.town) % 5 <> 2 then lower(town) else town end as town from ledger)
        select txn_id, x.town, town_id from x left join p on x.town = p.town""",
}
