"""The star schema: places, building types and the fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acreage import contract as C
from acreage.functions.dates import month_start

NOT_APPLICABLE, MISSING, FIRST_OFFICIAL = 0, 1, 2


def dim_building_type(spark: SparkSession) -> DataFrame:
    rows = [
        (NOT_APPLICABLE, "不適用", "not_applicable"), (MISSING, "未提供", "missing"),
        *[(FIRST_OFFICIAL + k, n, "official") for k, n in enumerate(C.BUILDING_TYPES)]
    ]
    return spark.createDataFrame(rows, "building_type_id int, building_type_name string, member_type string")


def dim_location(lookup: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Places with keys that never change: known places keep theirs, new ones follow in order of (county, town).

    The window runs over the places of a country, a table of fixed size.
    """
    places = lookup.select("county_id", "town_id", "city", "district").distinct()
    bad = places.agg(
        F.count_if(~F.col("county_id").rlike("^[0-9]{5}$") | ~F.col("town_id").rlike("^[0-9]{8}$")).alias("ids"),
        F.count_if((F.trim("city") == "") | (F.trim("district") == "")).alias("names")
    ).first()
    if bad.ids or bad.names:
        raise ValueError(f"places with bad ids: {bad.ids}, with blank names: {bad.names}")
    if known is None:
        return places.select(F.row_number().over(Window.orderBy("county_id", "town_id")).cast("int").alias("location_id"), "*")
    top = known.agg(F.max("location_id")).first()[0] or 0
    new = places.join(known, ["county_id", "town_id"], "left_anti").select(
        (F.row_number().over(Window.orderBy("county_id", "town_id")) + top).cast("int").alias("location_id"), "county_id",
        "town_id", "city", "district"
    )
    return places.join(
        known.select("location_id", "county_id", "town_id"), ["county_id", "town_id"]
    ).select("location_id", "county_id", "town_id", "city", "district").unionByName(new)


def facts(clean: DataFrame, places: DataFrame, buildings: DataFrame) -> DataFrame:
    """One fact for each clean record. The choice of building member is a computed key, so both joins are equalities."""
    member = F.when(F.col("transaction_type") == C.LAND, F.lit("不適用")).otherwise(F.coalesce("building_type", F.lit("未提供")))
    rows = clean.withColumn("building_type_name", member)
    rows = rows.join(places.select("location_id", "county_id", "town_id"), ["county_id", "town_id"], "left").join(
        buildings.select("building_type_id", "building_type_name"), "building_type_name", "left"
    )
    return rows.select(
        "source_transaction_id", month_start(
            F.make_date("transaction_year", "transaction_month", F.lit(1))
        ).alias("month"), "location_id", "building_type_id", "transaction_type",
        F.col("total_price_ntd").alias("total_price"), F.col("unit_price_ntd_m2").alias("unit_price"),
    )


def fact_rules() -> dict:
    c = F.col
    return {
        "id": c("source_transaction_id").isNotNull(), "month": (F.dayofmonth("month") == 1) & (
            c("month") >= F.lit("2012-08-01").cast("date")
        ), "location": c("location_id").isNotNull(), "building": c("building_type_id").isNotNull(),
        "land": (c("transaction_type") == C.LAND) == (c("building_type_id") == NOT_APPLICABLE), "prices": F.coalesce(
            F.least("total_price", "unit_price"), F.lit(1.0)
        ) > 0,
    }


def in_population() -> Column:
    """Which facts the indicators count: houses with both prices."""
    return F.col("transaction_type").isin(
        C.HOUSE, C.HOUSE_PARKING
    ) & F.col("total_price").isNotNull() & F.col("unit_price").isNotNull()


def kpi_population(facts: DataFrame) -> DataFrame:
    return facts.where(in_population())
