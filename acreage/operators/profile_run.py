"""The profiling of raw records: every summary by its name, each one aggregation, small enough for one CSV file."""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage import contract as C
from acreage.functions import dates, numeric
from acreage.functions.text import digit_length, label_missing, normalize_text, pattern_flags
from acreage.operators import profile

#: Within so much of the unit price a formula matches it.
TOLERANCE = 1.0
SHARES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
#: The municipalities whose counties were renamed, in the order of the report.
MUNICIPALITIES = ("臺北市", "新北市", "桃園市", "臺中市", "臺南市", "高雄市")


def parking_group(price: Column, size: Column) -> Column:
    """Which of price and size of a parking space are told. Names of groups are fixed values of the report."""
    return (
        F.when((price > 0) & (size > 0), "A_both_positive").when((price == 0) & (size == 0), "B_both_zero")
        .when((price == 0) & (size > 0), "C_size_only").when((price > 0) & (size == 0), "D_price_only").otherwise("OTHER")
    )


def parking_formulas(
    total: Column, area: Column, unit: Column, price: Column, size: Column
) -> dict[tuple[str, str], tuple[Column, Column, Column]]:
    """(applies, actual, expected) of each (group, formula): with the parking space, and without what is told of it."""
    group, told = parking_group(price, size), (total > 0) & (area > 0) & (unit > 0)
    takes = {
        "unadjusted": (F.lit(0.0), F.lit(0.0)), "adjust_price_and_area": (price, size), "adjust_area_only": (F.lit(0.0), size),
        "adjust_price_only": (price, F.lit(0.0))
    }
    asked = {
        "A_both_positive": ("adjust_price_and_area", "unadjusted"), "B_both_zero": ("unadjusted",),
        "C_size_only": ("unadjusted", "adjust_area_only"), "D_price_only": ("unadjusted", "adjust_price_only")
    }
    out = {}
    for name, formulas in asked.items():
        for formula in formulas:
            off_price, off_size = takes[formula]
            out[name, formula] = (
                (group == name) & told & (total > off_price) & (area > off_size), unit,
                F.try_divide(total - off_price, area - off_size)
            )
    return out


def formula_groups(
    df: DataFrame, formulas: Mapping[tuple[str, str], tuple[Column, Column, Column]], tolerance: float = TOLERANCE
) -> DataFrame:
    """(group, formula, comparable, matched, rate) of all groups and formulas in one pass."""
    got = profile.formula_match(df, {f"{g}|{f}": x for (g, f), x in formulas.items()}, tolerance)
    parts = F.split("formula", r"\|")
    return got.select(parts[0].alias("group"), parts[1].alias("formula"), "comparable", "matched", "rate")


def transitions(df: DataFrame) -> DataFrame:
    """Renamed counties: rows before and after the places were mapped, in the order of the report; PASS if none is lost."""
    six = df.where(F.col("city").isin(*MUNICIPALITIES))
    got = profile.transition_report(
        six, ["city", "county_code", "raw_county"], F.col("raw_town").isNotNull(), F.col("town_id").isNotNull()
    )
    place = F.array_position(F.array(*[F.lit(m) for m in MUNICIPALITIES]), F.col("city"))
    return got.orderBy(place, "county_code", "raw_county")


def land_areas(df: DataFrame) -> DataFrame:
    """(type, rows, positive, median) of (type, v): types are few and may be null, so medians come in pieces as well."""
    named = F.coalesce("type", F.lit(""))  # no normal text is empty
    counts = df.groupBy("type").agg(F.count("*").alias("rows"), F.count_if(F.col("v") > 0).alias("positive"))
    medians = profile.positive_percentiles(df.select(named.alias("column"), "v"), [0.5])
    got = counts.join(medians, named == F.col("column"), "left")
    return got.select("type", "rows", "positive", F.col("value").alias("median"))


def summaries(raw: DataFrame, staged: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every summary of raw records (contract.RAW_COLUMNS); with staged rows of the cleaning also those of places."""
    c, n = F.col, lambda name: numeric.number(F.col(name))
    house = raw.where(normalize_text("type") != C.LAND)
    parking = raw.where(normalize_text("type") == C.HOUSE_PARKING)
    total, area, unit, price, size = n("housing_totprice"), n("trans_size"), n("h_price_m2"), n("parking_price"), n("parking_size")
    numbers = ["housing_totprice", "h_price_m2", "trans_size", "trans_landsize", "parking_size", "parking_price"]
    amounts = raw.select(*[n(x).alias(x) for x in numbers])
    chosen = ["type", "usage_type", "nonurban_type", "building_type", "usage", "manage"]
    named = raw.select(*[label_missing(c(x).cast("string")).alias(x) for x in chosen])
    layout = house.select(*[n(x).alias(x) for x in ("room", "hall", "bath")])
    done, status = dates.completion(c("date_complete"), F.lit(False))
    sold = dates.build_date(n("trans_y") + dates.ROC, c("trans_m"), F.lit(1))
    built = house.select("*", done.alias("done"), status.alias("status"), sold.alias("sold"))
    digits = built.where("status = 'ambiguous_5_digit'")
    early = built.where("date_trunc('month', done) > sold").withColumn("gap", dates.month_gap(c("done"), c("sold")))
    note = normalize_text("note")
    count = lambda df, key, name: profile.distribution(df, key, name)
    out = {
        "year_distribution": count(raw, n("trans_y").cast("int"), "year"),
        "key_fields_validation": profile.uniqueness(raw, ["no"]),
        "no_global_uniqueness": profile.uniqueness(raw, ["countycd", "no"]),
        "selected_fields_summary": profile.flag_counts(raw, {x: normalize_text(x).isNull() for x in chosen}),
        "selected_fields_top_values": profile.top_values(named, chosen, 20),
        "price_area_summary": profile.numeric_quality(amounts, numbers),
        "price_area_percentiles": profile.percentiles(amounts, numbers, SHARES),
        "price_formula_validation": profile.formula_match(raw, {
            "house_unit_price": (
                (normalize_text("type") == C.HOUSE) & (total > 0) & (area > 0) & (unit > 0), unit, F.try_divide(total, area)
            ),
            "parking_adjusted": (
                (normalize_text("type") == C.HOUSE_PARKING) & (total > price) & (area > size) & (unit > 0), unit,
                F.try_divide(total - price, area - size)
            ),
        }, TOLERANCE),
        "parking_completeness": profile.cross_tab(
            parking, F.coalesce(price > 0, F.lit(False)), F.coalesce(size > 0, F.lit(False))
        ),
        "parking_groups": count(parking, parking_group(price, size), "group"),
        "parking_formula_validation_detailed": formula_groups(parking, parking_formulas(total, area, unit, price, size)),
        "remaining_house_numeric_summary": profile.numeric_quality(layout, layout.columns),
        "remaining_house_category_summary": profile.flag_counts(
            house, {x: normalize_text(x).isNotNull() for x in ("building_type", "usage", "manage")}
        ),
        "remaining_house_top_values": profile.top_values(
            house.select("building_type", "usage", "manage"), ["building_type", "usage", "manage"], 30
        ),
        "date_complete_summary": count(built, c("status"), "status"),
        "date_complete_digit_lengths": count(house, digit_length(n("date_complete")), "digits"),
        "date_complete_validation": profile.cross_tab(built, c("status") == "valid", c("done").isNotNull()),
        "date_complete_examples": profile.examples(built, ["status"], "date_complete"),
        "note_summary": profile.flag_counts(raw, {"blank": note.isNull(), "nonblank": note.isNotNull()}),
        "note_pattern_summary": profile.flag_counts(raw, pattern_flags(note)),
        "note_flag_consistency": profile.cross_tab(raw, c("note").isNotNull(), note.isNotNull()),
        "land_area_by_transaction_type": land_areas(raw.select(
            normalize_text("type").alias("type"), n("trans_landsize").alias("v")
        )),
        "land_mismatch_by_land": profile.detail_total(
            raw, normalize_text("type") == C.LAND, F.coalesce(area, F.lit(0.0)), F.lit(0.0), 1e-9
        ),
        "building_area_relationships": profile.relations(
            parking, {"parking_within_building": (size, area), "parking_price_within_total": (price, total)}, TOLERANCE
        ),
        "completion_5digit_year_distribution": count(digits, F.floor(n("date_complete") / 100).cast("int"), "roc_year"),
        "completion_5digit_building_type": count(digits, normalize_text("building_type"), "building_type"),
        "completion_5digit_transaction_year": count(digits, n("trans_y").cast("int"), "year"),
        "completion_5digit_examples": profile.examples(digits, ["status"], "date_complete"),
        "completion_after_transaction_gap": early.groupBy(
            numeric.bucket(c("gap"), [3, 6, 12, 24, 60]).alias("months")
        ).agg(F.count("*").alias("rows")),
        "completion_after_transaction_building_type": count(early, normalize_text("building_type"), "building_type"),
        "completion_after_transaction_year": count(early, n("trans_y").cast("int"), "year"),
        "completion_after_transaction_type": count(early, normalize_text("type"), "type"),
        "completion_after_transaction_note": profile.flag_counts(early, pattern_flags(note)),
    }
    if staged is not None:
        out["six_municipality_transition_validation"] = transitions(staged)
    return out


def write_csv(tables: Mapping[str, DataFrame], folder: str | Path) -> list[str]:
    """One file for each summary, in UTF-8 with a byte order mark, columns in their order; all rows of a summary are few."""
    Path(folder).mkdir(parents=True, exist_ok=True)
    for name, df in tables.items():
        df.toPandas().to_csv(Path(folder) / f"{name}.csv", index=False, encoding="utf-8-sig")
    return sorted(tables)
