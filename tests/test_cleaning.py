from __future__ import annotations

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from acreage import contract as C
from acreage.functions import dates, numeric, text
from acreage.operators.cleaning import checked_lookup, clean_transactions
from acreage.operators.dedup import duplicate_kinds
from acreage.operators.exclude import violations
from acreage.plans import cleaning_queries
from fixtures import aliases, lookup, raw


@pytest.fixture(scope="module")
def cleaned(spark):
    return clean_transactions(raw(spark), lookup(spark), aliases(spark), "run1", end=11412)


def test_thirteen_rows_split(cleaned):
    clean, excluded = cleaned.clean.collect(), cleaned.excluded.collect()
    assert {r.source_transaction_id for r in clean} == {
        "VALID", "BAD_DAY", "LAND", "ALIAS", "PARKING", "EXACT"
    } and len(clean) == 6
    reasons = sorted(r.primary_exclusion_reason for r in excluded)
    assert reasons == sorted(
        ["duplicate_conflict"] * 2 + [
            "missing_source_transaction_id", "duplicate_exact", "invalid_transaction_period", "unmapped_location",
            "excluded_transaction_type"
        ]
    )
    assert {r.exclusion_record_id for r in excluded if r.primary_exclusion_reason == "duplicate_exact"} == {"run1-E000000007"}


def test_values(cleaned):
    by = {r.source_transaction_id: r for r in cleaned.clean.collect()}
    assert by["BAD_DAY"].transaction_date is None and not by["BAD_DAY"].transaction_date_valid and by["BAD_DAY"].total_price_ntd is None and not by["BAD_DAY"].total_price_valid
    assert by["ALIAS"].district == "頭份市" and by["ALIAS"].city == "苗栗縣"
    assert by["LAND"].building_type is None and by["LAND"].building_transfer_area_valid is None and by["LAND"].completion_date_status == "not_applicable" and by["LAND"].has_note
    assert by["PARKING"].parking_data_complete is True and by["VALID"].parking_data_complete is None
    assert by["VALID"].unit_price_ntd_m2 == 100_000.25 and by["VALID"].transaction_year == 2023 and str(
        by["VALID"].completion_date
    ) == "2011-01-01"


def test_contract(cleaned):
    assert [(f.name, f.dataType) for f in cleaned.clean.schema.fields] == [(f.name, f.dataType) for f in C.CLEAN.fields]
    assert not any(violations(cleaned.clean, C.clean_rules()).values())


def test_audit(cleaned):
    audit = cleaned.audit()
    assert audit["row_counts"] == {"input_rows": 13, "clean_rows": 6, "excluded_rows": 7, "reconciled": True}
    assert audit["primary_exclusion_reasons"]["duplicate_conflict"] == 2
    assert audit["independent_checks"]["invalid_transaction_period"] == 2 and audit["independent_checks"][
        "building_value_on_land:usage"
    ] == 2
    assert audit["completion_date_status"] == {"valid": 4, "not_applicable": 2}
    assert {r["formula"]: (r["comparable"], r["matched"]) for r in audit["formula_validation"]}["house_unit_price"] == (2, 2)


def test_missing_column_and_bad_reference(spark):
    with pytest.raises(ValueError, match="missing"):
        clean_transactions(raw(spark).drop("note"), lookup(spark), aliases(spark), "r")
    with pytest.raises(ValueError, match="unique"):
        checked_lookup(lookup(spark).union(lookup(spark)), aliases(spark))
    with pytest.raises(ValueError, match="no place"):
        checked_lookup(lookup(spark).where("legacy_county_code = 'Z'"), aliases(spark))


def test_text(spark):
    df = spark.createDataFrame([("　ＡＢＣ　",), ("  x ",), (" ",), (None,), ("ｶﾞ",)], "s string")
    assert [r[0] for r in df.select(text.normalize_text("s")).collect()] == ["ABC", "x", None, None, "ガ"]
    df = spark.createDataFrame([("住宅用",), ("住商",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(text.keyword_category(F.col("s"), ["住", "商"], "其他")).collect()] == ["住", "商", "其他", None]


def test_numbers(spark):
    df = spark.createDataFrame([("1.5",), ("-2",), ("NaN",), ("Infinity",), ("3",), ("",), (None,), ("0",)], "s string")
    c = F.col("s")
    got = df.select(
        numeric.positive_float(c)[0], numeric.positive_integer(c)[0], numeric.nonnegative_integer(c)[0],
        numeric.nonnegative_integer(c)[2]
    ).collect()
    assert [tuple(r) for r in got] == [
        (1.5, None, None, True), (None, None, None, True), (None, None, None, True), (None, None, None, True),
        (3.0, 3, 3, False), (None, None, None, False), (None, None, None, False), (None, None, 0, False)
    ]
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    assert [r[0] for r in df.select(numeric.sum_present([F.col("a"), F.col("b")])).collect()] == [1, None]
    df = spark.createDataFrame([(0,), (3,), (4,), (61,)], "g int")
    assert [r[0] for r in df.select(numeric.bucket(F.col("g"), [3, 6, 60])).collect()] == [None, "1-3", "4-6", ">60"]


def test_dates(spark):
    df = spark.createDataFrame(
        [("1000101",), ("850229",), ("86022",), ("",), (None,), ("1120113.0",), ("abc",), ("-1000101",)], "s string"
    )
    got = df.select(*dates.completion(F.col("s"), F.lit(False))).collect()
    assert [(str(r[0]) if r[0] else None, r[1]) for r in got] == [
        ("2011-01-01", "valid"), ("1996-02-29", "valid"), (None, "ambiguous_5_digit"), (None, "missing"), (None, "missing"),
        ("2023-01-13", "valid"), (None, "invalid"), (None, "invalid")
    ]
    df = spark.createDataFrame([(2020, 2, 30), (2020, 2, 29), (None, 1, 1)], "y int, m int, d int")
    assert [
        str(r[0]) for r in df.select(dates.build_date(F.col("y"), F.col("m"), F.col("d"))).collect()
    ] == ["None", "2020-02-29", "None"]
    empty = spark.sql("select date'2020-03-01' as a, date'2020-01-01' as b").select(dates.month_range(F.col("a"), F.col("b")))
    assert empty.first()[0] == []


def test_duplicates_compare_nulls(spark):
    df = spark.createDataFrame(
        [("a", None), ("a", None), ("b", None), ("b", 1), ("c", 1), (None, 1), (None, 1)], "k string, v int"
    )
    assert {r.k: r.kind for r in duplicate_kinds(df, ["k"], ["v"]).collect()} == {"a": "exact", "b": "conflict"}


def test_first_wins_ties_go_to_input_order(spark, tmp_path):
    """Files that Spark reads in another order (the larger first), lines of one number, and a line without one."""
    folder = tmp_path / "lineitem.parquet"
    folder.mkdir()
    schema = pa.schema({"l_orderkey": "int64", "l_linenumber": "int32", "l_quantity": "float64", "l_extendedprice": "float64"})
    few = [(k, None if k == 7 else 1, 1.0, float(k)) for k in (3, 5, 7)]
    many = [(k, 1, 2.0, float(i)) for i in range(500) for k in (3, 5, 7, 13)]
    for name, rows in (("a", few), ("b", many)):
        table = pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)
        pq.write_table(table, folder / f"{name}.parquet")
    db = duckdb.connect(config={"threads": 1})
    db.execute(f"create view lineitem as select * from '{folder}/*.parquet'")
    want = sorted(db.execute(cleaning_queries.ORACLES["first_wins_dedup"]).fetchall())
    assert sorted(tuple(r) for r in cleaning_queries.first_wins_dedup(spark, str(tmp_path)).collect()) == want == [
        (3, 1, 1.0, 3.0, 301), (5, 1, 1.0, 5.0, 501), (7, 1, 2.0, 0.0, 701), (13, 1, 2.0, 0.0, 1301)
    ]
