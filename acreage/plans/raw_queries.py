"""The whole cleaning run over raw records made from the ledger: clean rows, excluded rows and the counters of its audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage import contract as C
from acreage.operators.cleaning import Cleaned, clean_transactions
from acreage.operators.profile_run import summaries
from acreage.plans.ledger import SQL, ledger, read

KINDS = (C.HOUSE, C.HOUSE_PARKING, C.LAND, "車位")
USES = ("住", "商", "工", "農", "其他")
COMPLETED = ("1000101", "990230", "85123", "abc", "0")


def pick(values, k):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (k % len(values) + 1).cast("int"))


def raw(spark: SparkSession, d: str) -> DataFrame:
    """Records in the raw columns with every kind of fault, by their key."""
    k = F.col("txn_id")
    sometimes = lambda n, a, b: F.when(k % n == 0, a).otherwise(b)
    columns = {
        "no": sometimes(
            41, F.lit("  "), F.concat(F.lit(" T"), k.cast("string"))
        ), "trans_y": (k % 15 + 100).cast("int"), "trans_m": (k % 14).cast("int"), "trans_d": (k % 33).cast("int"),
        "county": F.col("county"), "countycd": F.substring("county", 1, 2), "town": F.when(k % 29 == 0, " ").when(
            k % 31 == 0, F.concat(F.lit("OLD "), F.col("town"))
        ).otherwise(F.concat(F.lit("　"), F.col("town"))),
        "type": pick(KINDS, k), "trans_landsize": F.when(k % 7 == 0, 0.0).when(k % 11 == 0, -1.0).otherwise(k % 50 + 0.5), "usage_type": sometimes(
            6, F.lit(None), pick(USES, k)
        ), "nonurban_type": F.lit(""),
        "building_type": pick(C.BUILDING_TYPES, k), "usage": sometimes(5, F.lit("見其它登記事項"), F.lit("住家用")), "date_complete": sometimes(
            6, F.lit(None), pick(COMPLETED, k)
        ), "trans_size": (k % 50).cast("double"),
        "room": (k % 6 - 1).cast("int"), "hall": F.lit(2), "bath": sometimes(3, F.lit(None), F.lit(1)), "manage": pick(("有", "無", ""), k), "housing_totprice": sometimes(
            13, F.lit(0.0), F.col("total_price").cast("double")
        ),
        "h_price_m2": sometimes(
            17, F.lit(None), F.col("unit_price")
        ), "parking_size": k % 2 * 10.0, "parking_price": k % 3 * 1000.0, "note": sometimes(4, F.lit("  "), F.lit("含車位")),
    }
    return ledger(spark, d).select(*[v.alias(c) for c, v in columns.items()], k.alias("_row_pos"))


def places(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    named = read(spark, d, "nation").join(read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    county, town = F.format_string("%05d", F.col("n_regionkey") + 63000), F.format_string(
        "%05d%03d", F.col("n_regionkey") + 63000, F.col("n_nationkey")
    )
    lookup = named.select(
        F.substring("r_name", 1, 2).alias("legacy_county_code"),
        F.format_string("%02d", F.col("n_nationkey")).alias("legacy_town_code"), county.alias("county_id"),
        town.alias("town_id"), F.col("r_name").alias("city"), F.col("n_name").alias("district")
    )
    return lookup, lookup.select(
        "legacy_county_code", F.concat(F.lit("OLD "), "district").alias("raw_town"), F.col("district").alias("normalized_town")
    )


def cleaned(spark: SparkSession, d: str) -> Cleaned:
    return clean_transactions(raw(spark, d), *places(spark, d), "run")


SHOWN = [f.name for f in C.CLEAN.fields if f.name not in ("unit_price_ntd_m2",)]

RAW_SQL = f"""{SQL},
    r as (
        select txn_id as k, l.county, town, n_nationkey, n_regionkey, total_price, unit_price, 100 + k % 15 as y, k % 14 as m, k % 33 as dd,
               ['{KINDS[0]}', '{KINDS[1]}', '{KINDS[2]}', '{KINDS[3]}'][k % 4 + 1] as kind,
               case when k % 6 <> 0 then ['1000101', '990230', '85123', 'abc', '0'][k % 5 + 1] end as done
        from ledger l join nation on n_name = town),
    s as (
        select *, try_cast(printf('%04d-%02d-%02d', y + 1911, m, dd) as date) as day, kind = '{C.LAND}' as land,
               case when k % 41 = 0 then 'missing_source_transaction_id' when m not between 1 and 12 or y * 100 + m not between 10108 and 11312 then 'invalid_transaction_period'
                    when k % 29 = 0 then 'unmapped_location' when k % 4 = 3 then 'excluded_transaction_type' end as reason
        from r)"""

QUERIES = {
    "clean_rows": lambda spark, d: cleaned(spark, d).clean.select(*SHOWN),
    "excluded_rows": lambda spark, d: cleaned(spark, d).excluded,
    "date_complete_summary": lambda spark, d: summaries(raw(spark, d))["date_complete_summary"],
    "note_flags": lambda spark, d: summaries(raw(spark, d))["note_flag_consistency"],
}

ORACLES = {
    "clean_rows": f"""with {RAW_SQL}
        select 'run' as cleaning_run_id, 'T' || k as source_transaction_id, y + 1911 as transaction_year, m as transaction_month, day as transaction_date, day is not null as transaction_date_valid,
               case when not land and done = '1000101' then date '2011-01-01' end as completion_date,
               case when land then 'not_applicable' when done is null then 'missing' when done = '85123' then 'ambiguous_5_digit' when done = '1000101' then 'valid' else 'invalid' end as completion_date_status,
               case when not land and done = '1000101' then date '2011-01-01' > day end as completion_after_transaction,
               printf('%05d', n_regionkey + 63000) as county_id, printf('%05d%03d', n_regionkey + 63000, n_nationkey) as town_id, county as city, town as district, kind as transaction_type,
               case when k % 6 <> 0 then ['住', '商', '工', '農', '其他'][k % 5 + 1] end as urban_land_use_type, null as nonurban_land_use_zone,
               case when not land then [{', '.join(f"'{b}'" for b in C.BUILDING_TYPES)}][k % 12 + 1] end as building_type,
               case when land then null when k % 5 = 0 then '見其他登記事項' else '住家用' end as primary_use, case when not land then [true, false, null][k % 3 + 1] end as has_management,
               case when k % 7 <> 0 and k % 11 <> 0 then k % 50 + 0.5 end::double as land_transfer_area_m2, case when not land and k % 50 > 0 then k % 50 end::double as building_transfer_area_m2,
               case when not land and k % 6 > 0 then k % 6 - 1 end as room_count, case when not land then 2 end as hall_count, case when not land and k % 3 <> 0 then 1 end as bathroom_count,
               case when k % 13 <> 0 and total_price > 0 then total_price end as total_price_ntd, k % 13 <> 0 and total_price > 0 as total_price_valid, k % 17 <> 0 as unit_price_valid, k % 7 <> 0 and k % 11 <> 0 as land_transfer_area_valid,
               case when not land then k % 50 > 0 end as building_transfer_area_valid, case when kind = '{C.HOUSE_PARKING}' then k % 2 = 1 and k % 3 > 0 end as parking_data_complete, k % 4 <> 0 as has_note
        from s where reason is null""",
    "excluded_rows": f"""with {RAW_SQL}
        select printf('run-E%09d', k) as exclusion_record_id, 'run' as cleaning_run_id, case when k % 41 <> 0 then 'T' || k end as source_transaction_id, reason as primary_exclusion_reason from s where reason is not null""",
    "date_complete_summary": f"""with {RAW_SQL}, t as (select case when done is null then 'missing' when done = '85123' then 'ambiguous_5_digit' when done = '1000101' then 'valid' else 'invalid' end as status from s where not land)
        select status, count(*) as rows, count(*)::double / sum(count(*)) over () as share from t group by 1""",
    "note_flags": f"with {RAW_SQL} select true as a, k % 4 <> 0 as b, count(*) as rows from s group by 2",
}
