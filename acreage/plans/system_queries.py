"""Sources, sinks, gates and the control plane, each run over small inputs made from the driver's tables or written out here."""

from __future__ import annotations

import io
import tempfile
import zipfile
from collections.abc import Callable
from datetime import date
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreage import contract as C
from acreage.functions.dates import build_date
from acreage.functions.text import normalize_text, pattern_flags
from acreage.operators import merge, profile, recheck, star
from acreage.operators.cleaning import checked_lookup
from acreage.operators.exclude import require
from acreage.operators.runs import Blocked, Ledger
from acreage.operators.store import Files, Store, checked_write
from acreage.plans.ledger import SQL, ledger, read
from acreage.sources import delivery
from acreage.sources.landzip import HEADERS, PARKING_HEADERS, read_land_zip
from acreage.sources.reference import ALIASES, LOOKUP, build_lookup, read_reference
from acreage.sources.releases import Registry
from acreage.sources.stata import read_stata


def folder(spark: SparkSession) -> str:
    """A new folder that all machines share: under spark.checkpoint.dir where it is set, else, on one machine, a temporary one."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared and shared.startswith("file:"):
        Path(shared.removeprefix("file:").replace("//", "/")).mkdir(parents=True, exist_ok=True)
        return tempfile.mkdtemp(prefix="acreage-", dir=shared.removeprefix("file:").replace("//", "/"))
    return tempfile.mkdtemp(prefix="acreage-")


def archive(path: str, nations: list[tuple[int, str]]) -> None:
    """A ZIP of two counties' files with a row for each nation, the way the publisher writes them, and a file to be left out."""
    row = {
        "type": C.HOUSE, "trans_landsize": "50", "usage_type": "住宅區", "nonurban_type": "", "building_type": C.BUILDING_TYPES[3],
        "usage": "住家用", "date_complete": "1000101", "trans_size": "100", "hall": "2", "bath": "1", "manage": "有",
        "h_price_m2": "100000", "parking_size": "0", "parking_price": "0", "note": ""
    }
    with zipfile.ZipFile(path, "w") as z:
        for letter, parking in (("z", PARKING_HEADERS[0]), ("A", PARKING_HEADERS[1])):
            out = io.StringIO()
            out.write(
                "﻿" + ",".join(
                    parking if k == "parking_size" else h for k, h in HEADERS.items()
                ) + "\n" + ",".join("english" for _ in HEADERS) + "\n"
            )
            for k, name in nations:
                own = row | {
                    "town": name, "date": f"112{k % 12 + 1:02d}05", "room": str(k % 5), "housing_totprice": str(1_000_000 + k),
                    "no": f"{letter}{k}"
                }
                out.write(",".join(own[c] for c in HEADERS) + "\n")
            z.writestr(f"{letter}_lvr_land_a.csv", out.getvalue())
        z.writestr("a_lvr_land_b.csv", "not a file of sales")


def nations(spark: SparkSession, d: str) -> list[tuple[int, str]]:
    return [
        tuple(r) for r in read(spark, d, "nation").select(
            F.col("n_nationkey").cast("int"), "n_name"
        ).orderBy("n_nationkey").collect()
    ]


def land_zip(spark: SparkSession, d: str) -> DataFrame:
    path = f"{folder(spark)}/land.zip"
    archive(path, nations(spark, d))
    return read_land_zip(spark, path).select(
        "no", "countycd", "county", "town", "usage_type", "trans_y", "trans_m", "trans_d", "room", "housing_totprice",
        F.col("_row_pos").alias("position")
    )


def stata(spark: SparkSession, d: str) -> DataFrame:
    path = f"{folder(spark)}/nation.dta"
    pd.DataFrame(
        nations(spark, d), columns=["k", "name"]
    ).assign(half=lambda t: t.k / 2, unused=1).to_stata(path, write_index=False)
    return read_stata(spark, path, ["name", "k", "half"], rows=7).select(
        F.col("_row_pos").alias("position"), "name", "k", "half"
    )


def lookup_of(spark: SparkSession, d: str) -> DataFrame:
    """Places built from two sources, a table of towns and a workbook of official ids, through CSV and XLSX files."""
    at = folder(spark)
    rows = read(spark, d, "nation").select("n_regionkey", "n_nationkey", "n_name").orderBy("n_nationkey").collect()
    pd.DataFrame(
        [(chr(65 + r.n_regionkey), f"{r.n_nationkey:02d}", f"R{r.n_regionkey}", f" {r.n_name} ") for r in rows],
        columns=["hsn_cd", "town_cd", "hsn_nm", "town_nm"]
    ).to_csv(f"{at}/towns.csv", index=False)
    workbook(
        f"{at}/ids.xlsx",
        [
            ("hsn_nm", "town_nm", "county_id", "town_id"),
            *[
                (
                    f"R{r.n_regionkey}", r.n_name, f"{10000 + r.n_regionkey}", f"{10000 + r.n_regionkey}{r.n_nationkey:03d}"
                ) for r in rows
            ]
        ]
    )
    towns = read_reference(spark, f"file://{at}/towns.csv", ["hsn_cd", "town_cd", "hsn_nm", "town_nm"], len(rows))
    return build_lookup(towns, delivery.read_workbook(spark, f"{at}/ids.xlsx", ["hsn_nm", "town_nm", "county_id", "town_id"]))


def workbook(path: str, rows: list[tuple[str, ...]]) -> None:
    cells = "".join(
        f'<row r="{i}">' + "".join(
            f'<c r="{chr(65 + j)}{i}" t="inlineStr"><is><t>{v}</t></is></c>' for j, v in enumerate(row)
        ) + "</row>" for i,
        row in enumerate(rows, 1)
    )
    with zipfile.ZipFile(path, "w") as z:
        z.writestr(
            "xl/worksheets/sheet1.xml",
            f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{cells}</sheetData></worksheet>'
        )


def store_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A checked table, written, published by the pointer and read; a second version that nobody published stays unseen."""
    store = Store(spark, f"file://{folder(spark)}/s")
    customers = read(spark, d, "customer")
    schema = T.StructType(
        [
            T.StructField("c_custkey", T.LongType(), False), T.StructField("c_name", T.StringType()),
            T.StructField("c_acctbal", T.DoubleType())
        ]
    )
    store.publish({"customers": checked_write(store, "customers", customers, schema)})
    checked_write(store, "customers", customers.limit(3), schema)
    return store.read("customers")


def store_parts(spark: SparkSession, d: str) -> DataFrame:
    """A table in months of which one month is written anew and one is taken away."""
    store = Store(spark, f"file://{folder(spark)}/s")
    facts = ledger(spark, d).select("txn_id", "total_price", "month").where("month < date'1996-01-01'")
    parts = store.stage_parts("facts", facts, "month")
    store.publish({"facts": parts})
    june = store.stage_parts(
        "facts", facts.where("month = date'1995-06-01'").withColumn("total_price", F.col("total_price") + 1), "month"
    )
    store.publish({"facts": {m: v for m, v in parts.items() if m != "1995-03-01"} | june})
    return store.read("facts").select("txn_id", "total_price", "month")


def outcome(work: Callable[[], object]) -> str:
    try:
        work()
    except (ValueError, Blocked) as error:
        return "raised" if isinstance(error, ValueError) else "blocked"
    return "ok"


def release_registry(spark: SparkSession, d: str) -> DataFrame:
    """Deliveries registered one after the other: new, the same again, another of that date, and what is refused."""
    at = folder(spark)
    archive(f"{at}/one.zip", nations(spark, d))
    archive(f"{at}/two.zip", nations(spark, d)[:3])
    registry, rows = Registry(f"{at}/r"), []

    def step(name: str, file: str, **given) -> None:
        try:
            got = registry.register(f"{at}/{file}.zip", **({"released": "2026-09-21", "period_end": 11509} | given))
            rows.append((name, got["release_id"], got["revision"], got["created"]))
        except ValueError:
            rows.append((name, "refused", None, None))

    step("1 new", "one")
    step("2 same again", "one")
    step("3 other file", "two")
    step("4 other again", "two")
    step("5 next date", "one", released="2026-10-01", period_end=11510)
    step("6 wrong period", "one", period_end=11508)
    step("7 wrong date", "one", released="2026-9-21")
    rows.append(("8 publish uncleaned", outcome(lambda: registry.published("2026-09-21", "test")), None, None))
    registry.cleaned("2026-09-21", status="success")
    rows.append(("9 publish cleaned", outcome(lambda: registry.published("2026-09-21", "test")), None, None))
    Path(f"{at}/r/2026-09-21/one.zip").write_text("changed")
    step("a changed copy", "one")
    return spark.createDataFrame(rows, "step string, release string, revision int, created boolean")


def run_ledger(spark: SparkSession, d: str) -> DataFrame:
    """Runs that succeed, are replayed, fail, are tried again and block what comes after."""
    ledger, rows, calls = Ledger(Files(spark, f"file://{folder(spark)}")), [], []

    def work(fail: bool = False) -> dict:
        calls.append(1)
        if fail:
            raise ValueError("no luck")
        return {"n": len(calls)}

    def step(name: str, layer: str, batch: str, fail: bool = False) -> None:
        done = outcome(lambda: ledger.run(layer, batch, lambda: work(fail)))
        entry = ledger.get(layer, batch)
        rows.append((name, done, entry["status"], entry.get("attempt", 0), len(calls)))

    step("1 first", "core", "a")
    step("2 replay", "core", "a")
    step("3 failure", "core", "b", True)
    rows.append(("4 to recover", str(ledger.to_recover("core")), "", 0, len(calls)))
    step("5 again", "core", "b")
    ledger.put("core", "c", status="running")
    step("6 running", "core", "c")
    rows.append(("7 running blocks", outcome(lambda: ledger.to_recover("core")), "", 0, len(calls)))
    ledger.put("core", "c", status="failed")
    ledger.put("core", "e", status="failed")
    rows.append(("8 two failures block", outcome(lambda: ledger.to_recover("core")), "", 0, len(calls)))
    ledger.put("analytics", "full", status="failed")
    rows.append(("9 failed rebuild blocks", outcome(lambda: ledger.to_recover("analytics")), "", 0, len(calls)))
    return spark.createDataFrame(rows, "step string, outcome string, status string, attempt int, calls int")


def gates(spark: SparkSession, d: str) -> DataFrame:
    """Every gate with an input that keeps it and inputs that break it."""
    places = lookup_of(spark, d)
    aliases = spark.createDataFrame(
        [("A", "OLD", places.where("legacy_county_code = 'A'").orderBy("town_id").first().district)],
        ", ".join(f"{c} string" for c in ALIASES)
    )
    day = date(2013, 1, 1)
    counts = lambda *rows: spark.createDataFrame([(day, *r) for r in rows], "month date, county_id string, n long")
    grains = {
        "national": counts(("", 3)).drop("county_id"), "city": counts(("a", 2), ("b", 1)),
        "district": counts(("a", 2), ("b", 1))
    }
    batch = spark.createDataFrame([("x", "r1"), ("y", "r1")], "id string, cleaning_run_id string")
    months = spark.createDataFrame([(date(2013, 1, 1),), (date(2013, 3, 1),)], "month date")
    fact = spark.createDataFrame([("x", 5, None), ("y", None, "t")], "id string, v int, w string")
    bad_id = places.withColumn(
        "town_id", F.when(F.col("district") == F.lit(aliases.first().normalized_town), "1").otherwise(F.col("town_id"))
    )
    kpi_row = "select date'2013-01-01' as month, {n} as n, {p} as median_total, 1.0 as mean_total, 1.0 as median_unit, 1.0 as mean_unit, {y} as median_total_yoy, 0.0 as mean_total_yoy, 0.0 as median_unit_yoy, 0.0 as mean_unit_yoy, 0.0 as n_yoy"
    kpi_case = lambda n, p, y: require(spark.sql(kpi_row.format(n=n, p=p, y=y)), C.kpi_rules(), "kpi")
    facts = spark.sql(
        f"select 'a' as source_transaction_id, date'2013-01-01' as month, 1 as location_id, {star.FIRST_OFFICIAL} as building_type_id, '{C.HOUSE}' as transaction_type, 5L as total_price, 1.0D as unit_price"
    )
    cases = {
        ("places", "right"): lambda: checked_lookup(places, aliases, 25, 1), ("places", "too few"): lambda: checked_lookup(places, aliases, 26, 1), (
            "places", "too many aliases"
        ): lambda: checked_lookup(places, aliases, 25, 0),
        ("places", "repeated"): lambda: checked_lookup(places.union(places), aliases), ("places", "bad id"): lambda: checked_lookup(bad_id, aliases), ("places", "null"): lambda: checked_lookup(
            places.withColumn("city", F.lit(None).cast("string")), aliases
        ),
        ("places", "alias to nowhere"): lambda: checked_lookup(places, aliases.withColumn("normalized_town", F.lit("NOWHERE"))),
        ("snapshot", "right"): lambda: recheck.snapshot(batch, "id", 2), ("snapshot", "rows"): lambda: recheck.snapshot(batch, "id", 3), ("snapshot", "two runs"): lambda: recheck.snapshot(
            batch.withColumn("cleaning_run_id", F.col("id")), "id"
        ), ("snapshot", "repeated"): lambda: recheck.snapshot(batch.withColumn("id", F.lit("x")), "id"),
        ("final values", "right"): lambda: recheck.final_values(fact, fact, "id", ["v", "w"]), ("final values", "lost"): lambda: recheck.final_values(fact, fact.limit(1), "id", ["v", "w"]), ("final values", "null"): lambda: recheck.final_values(
            fact, fact.withColumn("v", F.coalesce("v", F.lit(0))), "id", ["v"]
        ),
        ("spine", "right"): lambda: recheck.spine(months, None, day, day, "national"), ("spine", "gap"): lambda: recheck.spine(
            months, None, day, date(2013, 3, 1), "national"
        ),
        ("grains", "right"): lambda: recheck.grains(grains), ("grains", "cities"): lambda: recheck.grains(grains | {"city": counts(("a", 2), ("b", 2))}), ("grains", "districts"): lambda: recheck.grains(
            grains | {"district": counts(("a", 1), ("b", 2))}
        ), ("grains", "county lost"): lambda: recheck.grains(grains | {"district": counts(("a", 2))}),
        ("facts", "right"): lambda: require(facts, star.fact_rules(), "facts"), ("facts", "no place"): lambda: require(
            facts.withColumn("location_id", F.lit(None).cast("int")), star.fact_rules(), "facts"
        ), ("facts", "land in a house"): lambda: require(
            facts.withColumn("transaction_type", F.lit(C.LAND)), star.fact_rules(), "facts"
        ),
        ("indicators", "right"): lambda: kpi_case(2, "1.0", "0.5"), (
            "indicators", "empty with price"
        ): lambda: kpi_case(0, "1.0", "0.5"), ("indicators", "full without"): lambda: kpi_case(
            2, "cast(null as double)", "0.5"
        ), ("indicators", "change"): lambda: kpi_case(2, "1.0", "-1.5"),
        ("baseline", "other source"): lambda: C.baseline("x", {})["status"] == "not_applicable" or 1 / 0,
    }
    return spark.createDataFrame(
        [(gate, case, outcome(work)) for (gate, case), work in cases.items()], "gate string, case string, outcome string"
    )


def inspected(spark: SparkSession, d: str) -> DataFrame:
    """A Parquet delivery looked at before it is loaded: right, of two runs, of other columns, with too few rows."""
    at = folder(spark)
    one = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.lit("r1").alias("cleaning_run_id"))
    one.write.parquet(f"file://{at}/one")
    one.withColumn("cleaning_run_id", F.when(F.col("id") % 2 == 0, "r2").otherwise("r1")).write.parquet(f"file://{at}/two")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("cleaning_run_id", T.StringType())])
    got = delivery.inspect(spark, f"file://{at}/one", schema)
    rows = [("right", str(got["rows"]), got["cleaning_run_id"])]
    for name, path, columns, n in (
        ("two runs", "two", schema, None), ("columns", "one", T.StructType(schema.fields[:1]), None), ("rows", "one", schema, 1)
    ):
        rows.append((name, outcome(lambda p=path, c=columns, n=n: delivery.inspect(spark, f"file://{at}/{p}", c, n)), ""))
    return spark.createDataFrame(rows, "case string, rows string, run string")


#: Full-width forms, ligatures, half-width kana, compatibility signs, blanks of all kinds, and what they are after NFKC.
COMPATIBLE = {
    "Ａ１（ｘ）": "A1(x)", "ﬁn": "fin", "ｶﾞ": "ガ", "①②": "12", "㎡": "m2", "　 台北  ": "台北", "é": "é", "   ": None, "Ⅳ": "IV",
    "plain": "plain"
}
NOTES = ["親友間交易", "含裝潢及家具", "頂樓加蓋,未登記", "租約未滿,急買", "都更案", "共有人買賣;陽台外推;夾層", "", "其他"]


def compatible(spark: SparkSession, d: str) -> DataFrame:
    held = spark.createDataFrame(list(enumerate(COMPATIBLE)), "k int, raw string")
    return held.select("k", normalize_text("raw").alias("text"))


def notes(spark: SparkSession, d: str) -> DataFrame:
    """Orders with a note each by their key; how many notes fit each pattern."""
    held = read(spark, d, "orders").select(
        F.element_at(F.array(*[F.lit(n) for n in NOTES]), (F.col("o_orderkey") % len(NOTES) + 1).cast("int")).alias("note")
    )
    return profile.flag_counts(held, pattern_flags(F.col("note")))


def values(columns: str, rows: list[tuple]) -> str:
    """SQL of a written-out table."""
    spelt = lambda v: "null" if v is None else str(v).lower() if isinstance(v, bool) else f"'{v}'" if isinstance(v, str) else str(v)
    return f"select * from (values {', '.join('(' + ', '.join(map(spelt, r)) + ')' for r in rows)}) t({columns})"


QUERIES = {
    "source_land_zip": land_zip,
    "source_stata": stata,
    "source_reference": lookup_of,
    "source_inspect": inspected,
    "store_round_trip": store_round_trip,
    "store_parts": store_parts,
    "release_registry": release_registry,
    "run_ledger": run_ledger,
    "gates": gates,
    "compatible_text": compatible,
    "note_patterns": notes,
    "month_moves": lambda spark, d: merge.month_impact(
        merge.classify(moved(spark, d), ledger(spark, d), "txn_id", ["month", "kind"], ["month"])
    ),
    "built_dates": lambda spark, d: read(spark, d, "orders").select(
        "o_orderkey",
        build_date(F.col("o_orderkey") % 3 + 1999, F.col("o_orderkey") % 14, F.col("o_orderkey") % 33).alias("day")
    ),
}


def moved(spark: SparkSession, d: str) -> DataFrame:
    """A delivery in which every fourth sale moves back two months and every ninth becomes of another kind."""
    k = F.col("txn_id")
    return ledger(spark, d).withColumns(
        {
            "month": F.when(k % 4 == 0, F.add_months("month", -2)).otherwise(F.col("month")),
            "kind": F.when(k % 9 == 0, "X").otherwise(F.col("kind"))
        }
    )


LETTERED = "select *, row_number() over (order by n_nationkey) as r from nation"
ORACLES = {
    "source_land_zip": f"""with n as ({LETTERED}), c as (select * from (values ('A', 'A', '臺北市', 0), ('z', 'Z', '連江縣', 1)) t(letter, code, county, place))
        select letter || n_nationkey as no, code as countycd, county, n_name as town, '住' as usage_type, 112 as trans_y, cast(n_nationkey % 12 + 1 as int) as trans_m, 5 as trans_d,
               cast(n_nationkey % 5 as varchar) as room, cast(1000000 + n_nationkey as varchar) as housing_totprice, place * (select count(*) from nation) + r as position from n, c""",
    "source_stata": f"select r as position, n_name as name, n_nationkey as k, n_nationkey / 2 as half from ({LETTERED})",
    "source_reference": """select chr(cast(65 + n_regionkey as int)) as legacy_county_code, lpad(n_nationkey::varchar, 2, '0') as legacy_town_code, (10000 + n_regionkey)::varchar as county_id,
        (10000 + n_regionkey)::varchar || lpad(n_nationkey::varchar, 3, '0') as town_id, 'R' || n_regionkey as city, n_name as district from nation""",
    "source_inspect": "select 'right' as \"case\", count(*)::varchar as rows, 'r1' as run from orders union all select unnest(['two runs', 'columns', 'rows']), 'raised', ''",
    "store_round_trip": "select c_custkey, c_name, c_acctbal from customer",
    "store_parts": f"with {SQL} select txn_id, total_price + case when month = date '1995-06-01' then 1 else 0 end as total_price, month from ledger where month < date '1996-01-01' and month <> date '1995-03-01'",
    "release_registry": values("step, release, revision, created", [
        ("1 new", "2026-09-21", 1, True), ("2 same again", "2026-09-21", 1, False), ("3 other file", "2026-09-21-r2", 2, True), (
            "4 other again", "2026-09-21-r2", 2, False
        ), ("5 next date", "2026-10-01", 1, True),
        ("6 wrong period", "refused", None, None), ("7 wrong date", "refused", None, None), (
            "8 publish uncleaned", "raised", None, None
        ), ("9 publish cleaned", "ok", None, None), ("a changed copy", "refused", None, None),
    ]),
    "run_ledger": values("step, outcome, status, attempt, calls", [
        ("1 first", "ok", "success", 1, 1), ("2 replay", "ok", "success", 1, 1), (
            "3 failure", "raised", "failed", 1, 2
        ), ("4 to recover", "b", "", 0, 2), ("5 again", "ok", "success", 2, 3),
        ("6 running", "blocked", "running", 0, 3), ("7 running blocks", "blocked", "", 0, 3), ("8 two failures block", "blocked", "", 0, 3), (
            "9 failed rebuild blocks", "blocked", "", 0, 3
        ),
    ]),
    "gates": values('gate, "case", outcome', [
        ("places", "right", "ok"), ("places", "too few", "raised"), (
            "places", "too many aliases", "raised"
        ), ("places", "repeated", "raised"), ("places", "bad id", "raised"), ("places", "null", "raised"), (
            "places", "alias to nowhere", "raised"
        ),
        ("snapshot", "right", "ok"), ("snapshot", "rows", "raised"), (
            "snapshot", "two runs", "raised"
        ), (
            "snapshot", "repeated", "raised"
        ), ("final values", "right", "ok"), ("final values", "lost", "raised"), ("final values", "null", "raised"),
        ("spine", "right", "ok"), ("spine", "gap", "raised"), ("grains", "right", "ok"), ("grains", "cities", "raised"), ("grains", "districts", "raised"), (
            "grains", "county lost", "raised"
        ),
        ("facts", "right", "ok"), ("facts", "no place", "raised"), ("facts", "land in a house", "raised"), ("indicators", "right", "ok"), (
            "indicators", "empty with price", "raised"
        ), ("indicators", "full without", "raised"), ("indicators", "change", "raised"),
        ("baseline", "other source", "ok"),
    ]),
    "compatible_text": values("k, text", list(enumerate(COMPATIBLE.values()))),
    "note_patterns": f"with n as (select [{', '.join(repr(n) for n in NOTES)}][o_orderkey % {len(NOTES)} + 1] as note from orders) "
    + " union all ".join(f"select '{name}' as flag, count_if(regexp_matches(note, '{p}')) as rows from n" for name, p in {
        "related_party": "親友|員工|共有人|特殊關係", "renovation_or_furniture": "裝潢|裝修|家具|家電", "addition_or_unregistered": "增建|未登記|頂樓加蓋|陽台外推|夾層", "tenancy": "租約|租賃", "distressed_or_defect": "急買|急賣|瑕疵", "redevelopment": "都更|重建",
    }.items()),
    "month_moves": f"""with {SQL}, c as (select txn_id, month as o, case when txn_id % 4 = 0 then cast(month - interval 2 month as date) else month end as n, txn_id % 9 = 0 and kind <> 'X' as other from ledger),
        e as (select n as month, 'entered' as kind, true as core from c where n <> o union all select o, 'exited', true from c where n <> o union all select n, 'changed', false from c where n = o and other)
        select month, count_if(kind = 'entered') as entered, count_if(kind = 'changed') as changed, count_if(kind = 'exited') as exited, bool_or(core) as has_core_impact from e group by month""",
    "built_dates": "select o_orderkey, try_cast(printf('%04d-%02d-%02d', o_orderkey % 3 + 1999, o_orderkey % 14, o_orderkey % 33) as date) as day from orders",
}
