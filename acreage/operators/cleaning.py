"""Raw transaction records to clean and excluded ones, as one plan over the raw frame."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage import contract as C
from acreage.functions import dates, numeric
from acreage.functions.text import normalize_text, tri_state
from acreage.operators import exclude, profile
from acreage.operators.dedup import duplicate_reason


@dataclass
class Cleaned:
    clean: DataFrame
    excluded: DataFrame
    staged: DataFrame

    def audit(self) -> dict:
        """Counters of the run; every part is one aggregation over the staged rows."""
        return audit(self.staged)


def checked_lookup(lookup: DataFrame, aliases: DataFrame, places: int | None = None, renamed: int | None = None) -> None:
    """The places of a country: one row by county code and district and by id, ids of 5 and 8 digits, nothing null.

    An alias leads to one place that the lookup knows. places and renamed are how many rows there must be. All is checked
    before any record is joined; the first fault is raised.
    """
    for df, name, rows in ((lookup, "lookup", places), (aliases, "aliases", renamed)):
        if rows is not None and (n := df.count()) != rows:
            raise ValueError(f"{name}: {n} rows, {rows} expected")
    formats = {"county_id": r"^[0-9]{5}$", "town_id": r"^[0-9]{8}$", "legacy_town_code": r"^[0-9]{2}$"}
    rules = {f"{c} is set": F.col(c).isNotNull() for c in lookup.columns} | {
        f"{c} has its digits": F.coalesce(F.col(c).rlike(p), F.lit(False)) for c, p in formats.items() if c in lookup.columns
    }
    exclude.require(lookup, rules, "lookup")
    for df, key in (
        (lookup, ["legacy_county_code", "district"]), (lookup, ["county_id", "town_id"]),
        (aliases, ["legacy_county_code", "raw_town"])
    ):
        if not df.groupBy(*key).count().where("count > 1").isEmpty():
            raise ValueError(f"not unique on {key}")
    known = lookup.select("legacy_county_code", F.col("district").alias("normalized_town"))
    if not aliases.join(known, ["legacy_county_code", "normalized_town"], "left_anti").isEmpty():
        raise ValueError("an alias leads to no place")


def staged_rows(raw: DataFrame, lookup: DataFrame, aliases: DataFrame, position: str, start: int, end: int) -> DataFrame:
    """Every raw row with its normalised keys, its place and its one reason of exclusion."""
    named = raw.withColumns(
        {
            "source_id": normalize_text("no"), "county_code": normalize_text("countycd"),
            "raw_county": normalize_text("county"), "raw_town": normalize_text("town"), "kind": normalize_text("type")
        }
    )
    compare = [c for c in C.RAW_COLUMNS if c != "no"]
    marked = duplicate_reason(named, ["source_id"], compare, position)
    alias = aliases.select(F.col("legacy_county_code").alias("county_code"), "raw_town", "normalized_town")
    renamed = marked.join(alias, ["county_code", "raw_town"], "left").withColumn(
        "district", F.coalesce("normalized_town", "raw_town")
    )
    places = lookup.select(F.col("legacy_county_code").alias("county_code"), "district", "county_id", "town_id", "city")
    placed = renamed.join(places, ["county_code", "district"], "left")
    return placed.withColumn("reason", exclude.primary_reason(conditions(start, end)))


def conditions(start: int = C.PERIOD_START, end: int = C.PERIOD_END) -> dict[str, Column]:
    """The reasons of exclusion in order of precedence."""
    return {
        "missing_source_transaction_id": F.col("source_id").isNull(),
        "duplicate_exact": F.col("duplicate_reason") == "duplicate_exact",
        "duplicate_conflict": F.col("duplicate_reason") == "duplicate_conflict",
        "invalid_transaction_period": ~dates.valid_period(F.col("trans_y"), F.col("trans_m"), start, end),
        "unmapped_location": F.col("town_id").isNull(),
        "excluded_transaction_type": ~F.coalesce(F.col("kind").isin(*C.KEPT_TYPES), F.lit(False)),
    }


def clean_columns(run_id: str) -> dict[str, Column]:
    c = F.col
    land, parking = c("kind") == C.LAND, c("kind") == C.HOUSE_PARKING
    building = lambda x: F.when(~land, x)
    date = dates.build_date(numeric.number(c("trans_y")) + dates.ROC, c("trans_m"), c("trans_d"))
    completed, status = dates.completion(c("date_complete"), land)
    land_area, land_valid, _ = numeric.positive_float(c("trans_landsize"))
    area, area_valid, _ = numeric.positive_float(c("trans_size"))
    total, total_valid, _, _ = numeric.positive_integer(c("housing_totprice"))
    unit, unit_valid, _ = numeric.positive_float(c("h_price_m2"))
    layout = lambda name: building(numeric.nonnegative_integer(c(name))[0])
    both = F.coalesce((numeric.number(c("parking_price")) > 0) & (numeric.number(c("parking_size")) > 0), F.lit(False))
    use = normalize_text("usage")
    return {
        "cleaning_run_id": F.lit(run_id), "source_transaction_id": c("source_id"),
        "transaction_year": (
            numeric.number(c("trans_y")) + dates.ROC
        ).cast("short"), "transaction_month": numeric.number(c("trans_m")).cast("short"),
        "transaction_date": date, "transaction_date_valid": date.isNotNull(), "completion_date": completed, "completion_date_status": status, "completion_after_transaction": completed > date,
        "county_id": c("county_id"), "town_id": c("town_id"), "city": c("city"), "district": c("district"), "transaction_type": c("kind"),
        "urban_land_use_type": normalize_text("usage_type"), "nonurban_land_use_zone": normalize_text("nonurban_type"), "building_type": building(
            normalize_text("building_type")
        ),
        "primary_use": building(
            F.when(use == "見其它登記事項", "見其他登記事項").otherwise(use)
        ), "has_management": building(tri_state(normalize_text("manage"), "有", "無")),
        "land_transfer_area_m2": land_area, "building_transfer_area_m2": building(area), "room_count": layout("room"), "hall_count": layout("hall"), "bathroom_count": layout("bath"),
        "total_price_ntd": total, "unit_price_ntd_m2": unit, "total_price_valid": total_valid, "unit_price_valid": unit_valid, "land_transfer_area_valid": land_valid,
        "building_transfer_area_valid": building(area_valid), "parking_data_complete": F.when(parking, both), "has_note": normalize_text("note").isNotNull(),
    }


def clean_transactions(
    raw: DataFrame, lookup: DataFrame, aliases: DataFrame, run_id: str, *, position: str = "_row_pos",
    start: int = C.PERIOD_START, end: int = C.PERIOD_END, places: int | None = None, renamed: int | None = None
) -> Cleaned:
    """Split raw records into clean ones (contract.CLEAN) and excluded ones (contract.EXCLUDED) with exactly one reason each.

    The lookup and alias tables hold one row for each place of a country and are checked to (see checked_lookup).
    position is the input order, by which the first of equal records is the one that stays.
    """
    missing = [c for c in C.RAW_COLUMNS if c not in raw.columns]
    if missing:
        raise ValueError(f"raw columns are missing: {missing}")
    checked_lookup(lookup, aliases, places, renamed)
    staged = staged_rows(raw.select(*C.RAW_COLUMNS, position), lookup, aliases, position, start, end)
    kept = staged.where("reason is null")
    clean = kept.select(*[x.cast(C.CLEAN[n].dataType).alias(n) for n, x in clean_columns(run_id).items()])
    out = staged.where("reason is not null").select(
        F.format_string(
            "%s-E%09d", F.lit(run_id), F.col(position)
        ).alias("exclusion_record_id"), F.lit(run_id).alias("cleaning_run_id"), F.col("source_id").alias("source_transaction_id"), F.col("reason").alias(
            "primary_exclusion_reason"
        ),
    )
    return Cleaned(clean, out, staged)


def audit(staged: DataFrame) -> dict:
    """All counters; the staged rows are kept on the executors meanwhile, as several aggregations read them."""
    staged = staged.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return counters(staged)
    finally:
        staged.unpersist()


def counters(staged: DataFrame) -> dict:
    n = staged.agg(
        F.count("*").alias("input_rows"), F.count_if(F.col("reason").isNull()).alias("clean_rows"),
        F.count_if(F.col("reason").isNotNull()).alias("excluded_rows")
    ).first().asDict()
    n["reconciled"] = n["input_rows"] == n["clean_rows"] + n["excluded_rows"]
    primary = dict.fromkeys(C.REASONS, 0) | {
        r.reason: r["count"] for r in staged.where("reason is not null").groupBy("reason").count().collect()
    }
    kept = staged.where("reason is null")
    c, land = F.col, F.col("kind") == C.LAND
    col = clean_columns("")
    building, urban, manage = normalize_text("building_type"), normalize_text("usage_type"), normalize_text("manage")
    checks = {
        "invalid_transaction_day_clean_rows": ~col["transaction_date_valid"], "completion_after_transaction": col[
            "completion_after_transaction"
        ],
        "unexpected_management_value": ~land & ~manage.isin("有", "無"), "unexpected_building_type": ~land & ~building.isin(*C.BUILDING_TYPES), "unexpected_urban_land_use_type": ~urban.isin(*C.URBAN_USES),
        "parking_applicable_rows": c("kind") == C.HOUSE_PARKING, "parking_data_complete": col[
            "parking_data_complete"
        ], "parking_data_incomplete": ~col["parking_data_complete"], "has_note": col["has_note"],
        "raw_county_name_differs_from_canonical": c("raw_county") != c("city"),
    } | {f"building_value_on_land:{f}": land & (F.coalesce(numeric.number(c(f)) != 0, normalize_text(f).isNotNull()) if f in ("trans_size", "room", "hall", "bath") else normalize_text(f).isNotNull()) for f in ("building_type", "usage", "date_complete", "trans_size", "room", "hall", "bath", "manage")}
    numbers = kept.select(
        numeric.number(c("trans_landsize")).alias("land_transfer_area_m2"),
        F.when(~land, numeric.number(c("trans_size"))).alias("building_transfer_area_m2"),
        numeric.number(c("housing_totprice")).alias("total_price_ntd"),
        numeric.number(c("h_price_m2")).alias("unit_price_ntd_m2")
    )
    total, area, unit, pp, ps = (
        numeric.number(c(x)) for x in ("housing_totprice", "trans_size", "h_price_m2", "parking_price", "parking_size")
    )
    formulas = {
        "house_unit_price": ((c("kind") == C.HOUSE) & (total > 0) & (area > 0) & (unit > 0), unit, F.try_divide(total, area)),
        "parking_adjusted_unit_price": (
            (c("kind") == C.HOUSE_PARKING) & (total > pp) & (area > ps) & (unit > 0), unit, F.try_divide(total - pp, area - ps)
        ),
    }
    layout = kept.where(~land).select(
        F.inline(
            F.array(
                *[F.struct(F.lit(n).alias("column"), col[n].alias("v")) for n in ("room_count", "hall_count", "bathroom_count")]
            )
        )
    )
    unmatched = profile.unmatched(staged, ["county_code", "raw_town"], c("reason") == "unmapped_location")
    rows = lambda df: [r.asDict() for r in df.collect()]
    counts = {
        r.check: r.rows for df,
        cond in ((staged, conditions()), (kept, checks)) for r in exclude.independent_checks(df, cond).collect()
    }
    return {
        "row_counts": n, "primary_exclusion_reasons": primary, "independent_checks": counts, "unmatched_location_combinations": rows(
            unmatched.orderBy(F.desc("rows"), "county_code", "raw_town")
        ),
        "completion_date_status": {
            r.s: r["count"] for r in kept.groupBy(col["completion_date_status"].alias("s")).count().collect()
        },
        "numeric_quality": rows(
            profile.numeric_quality(numbers, numbers.columns)
        ), "formula_validation": rows(profile.formula_match(kept, formulas, 1.0)),
        "layout": rows(profile.nearest_rank(layout, "v", [0.5, 0.95, 0.99], ["column"])), "categories": rows(
            profile.top_values(
                kept.select("kind", building.alias("building_type"), urban.alias("urban_land_use_type")),
                ["kind", "building_type", "urban_land_use_type"], 50
            )
        ),
    }
