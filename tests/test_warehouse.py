from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from acreage import contract as C
from acreage.operators import kpi, merge, recheck
from acreage.operators.runs import Blocked, Ledger
from acreage.operators.store import Files, Locked, Store, checked_write, exclusive
from acreage.operators.warehouse import Warehouse
from fixtures import lookup


def record(
    i, month, price=8_000_000, unit=100_000.0, kind=C.HOUSE, run="r1", rooms=3, town=("63000", "63000010", "臺北市", "松山區")
):
    y, m = month
    day = dt.date(y, m, 3)
    land = kind == C.LAND
    return (
        run, i, y, m, day, True, None, "not_applicable" if land else "missing", None, *town, kind, None, None,
        None if land else C.BUILDING_TYPES[0], None, None, 10.0, None if land else 20.0, rooms, 1, 1, price, unit, True, True,
        True, None if land else True, None, False
    )


def clean(spark, rows):
    return spark.createDataFrame(rows, C.CLEAN)


def months(start, n):
    y, m = start
    return [((y * 12 + m - 1 + k) // 12, (y * 12 + m - 1 + k) % 12 + 1) for k in range(n)]


def history():
    """Sixteen months from 2012-08, four transactions each, two in a few."""
    few = {(2013, 1), (2013, 9), (2013, 10), (2013, 11)}
    return [
        record(f"T{k}-{j}", m, 8_000_000 + k * 10_000 + j * 100_000, 100_000.0 + k * 100 + j * 1_000) for k,
        m in enumerate(months((2012, 8), 16)) for j in range(2 if m in few else 4)
    ]


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("warehouse")
    w = Warehouse(spark, f"file://{root}/w", f"{root}/lock")
    with pytest.raises(Blocked):
        w.run(clean(spark, history()), "b0")
    w.initialize(lookup(spark), 4)
    return w, w.run(clean(spark, history()), "b1")


def test_first_load_publishes_up_to_the_cutoff(loaded):
    w, out = loaded
    assert out["staging"]["inserted"] == 56 and out["core"]["applied"] == 56
    assert out["analytics"] == {"last_month": "2013-08-01", "status": "OK", "national": 13, "city": 52, "district": 44}
    rows = {str(r.month): r for r in w.store.read("kpi_national").collect()}
    assert len(rows) == 13 and rows["2013-01-01"].n == 2 and rows["2013-08-01"].n_yoy == 0
    assert w.validate() == {"national": 0, "city": 0, "district": 0}
    with pytest.raises(ValueError):
        w.initialize(lookup(w.spark), 5)


def test_second_batch_changes_what_it_touches(loaded, spark):
    w, _ = loaded
    rows = [
        record("T0-0", (2012, 8), 8_000_000, 100_000.0, run="r2"), record("T0-1", (2012, 8), 9_900_000, 101_000.0, run="r2"),
        record("T1-0", (2012, 9), 8_010_000, 100_100.0, rooms=5, run="r2"),
        record("NEW", (2012, 9), 7_000_000, 99_000.0, run="r2")
    ]
    before = {str(r.month): r for r in w.store.read("kpi_national").collect()}
    out = w.run(clean(spark, rows), "b2")
    assert {
        k: out["staging"][k] for k in ("inserted", "updated", "unchanged", "moved")
    } == {"inserted": 1, "updated": 2, "unchanged": 1, "moved": 0}
    assert out["core"] == {"source": 3, "inserted": 1, "updated": 1, "unchanged": 1, "applied": 2}
    impact = {str(r.month): (r.entered, r.changed, r.exited, r.has_core_impact) for r in w._of_batch("impact", "b2").collect()}
    assert impact == {"2012-08-01": (0, 1, 0, True), "2012-09-01": (1, 1, 0, True)}
    after = {str(r.month): r for r in w.store.read("kpi_national").collect()}
    assert after["2012-08-01"].mean_total != before["2012-08-01"].mean_total and after["2013-08-01"].mean_total_yoy != before["2013-08-01"].mean_total_yoy
    assert after["2013-01-01"] == before["2013-01-01"] and w.validate() == {"national": 0, "city": 0, "district": 0}
    assert w.run(clean(spark, rows), "b2")["staging"] == out["staging"]


def test_failed_core_is_recovered(loaded, spark, monkeypatch):
    w, _ = loaded
    monkeypatch.setattr(w, "_sync", lambda batch: (_ for _ in ()).throw(RuntimeError("no disk")))
    rows = [record("LATE", (2012, 10), 7_500_000, 98_000.0)]
    with pytest.raises(RuntimeError, match="no disk"):
        w.run(clean(spark, rows), "b3")
    assert w.ledger.get("core", "b3")["status"] == "failed"
    monkeypatch.undo()
    out = w.run(clean(spark, rows), "b4")
    assert out["recovered"] == [("core", "b3")] and w.ledger.get("core", "b3")["attempt"] == 2 and out["staging"]["unchanged"] == 1
    assert w.validate() == {"national": 0, "city": 0, "district": 0}


def test_publication_never_shrinks(loaded, spark):
    w, _ = loaded
    moved = [record(f"T12-{j}", (2013, 8), 8_120_000 + j * 100_000, 101_200.0 + j * 1_000, kind=C.LAND) for j in range(4)]
    out = w.run(clean(spark, moved), "b5")
    assert out["analytics"]["last_month"] == "2013-08-01" and out["analytics"]["status"] == "REVIEW_CURRENT_AHEAD_OF_CANDIDATE"
    last = w.store.read("kpi_national").orderBy(F.desc("month")).first()
    assert last.n == 0 and last.median_total is None and w.validate() == {"national": 0, "city": 0, "district": 0}
    for grain, rows in (("national", 13), ("city", 52), ("district", 44)):
        table = w.store.read(f"kpi_{grain}")
        assert table.count() == rows and str(table.agg(F.max("month")).first()[0]) == "2013-08-01", grain


def test_untouched_parts_stay_and_only_touched_months_are_read(loaded, spark):
    w, _ = loaded
    before = w.store.versions()["facts"]
    w.run(clean(spark, [record("ONE", (2012, 12), 7_000_000, 90_000.0)]), "b6")
    after = w.store.versions()["facts"]
    assert {m for m in after if before.get(m) != after[m]} == {"2012-12-01"}
    built = kpi.increment(
        w.store.read("kpi_district"), w.population(), [dt.date(2013, 2, 1)], ["county_id", "town_id", "city", "district"],
        w.members("district"), 3
    )
    plan = built._jdf.queryExecution().explainString(
        w.spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    filters = [x for x in plan.split("\n") if x.startswith("PartitionFilters")]
    assert filters and all(m in filters[0] for m in ("month#", "2012-12-01", "2013-01-01", "2013-02-01")) and "2013-03-01" not in filters[0]
    assert w.validate() == {"national": 0, "city": 0, "district": 0}


def test_cutoff_counts_all_facts_for_the_last_month(spark, tmp_path):
    """Sales without a price reach further than those with one: the lag is counted from them."""
    w = Warehouse(spark, f"file://{tmp_path}/w", f"{tmp_path}/lock")
    w.initialize(lookup(spark))
    rows = [record(f"P{k}-{j}", m, 8_000_000, 100_000.0) for k, m in enumerate(months((2012, 8), 12)) for j in range(3)]
    rows += [
        record(f"N{k}", m, None, None)[:26] + (False, False) + record("", m, 1, 1.0)[28:] for k,
        m in enumerate(months((2013, 8), 3))
    ]
    out = w.run(clean(spark, rows), "b1")
    assert out["analytics"]["last_month"] == "2013-07-01"
    assert str(w.store.read("kpi_district").agg(F.min("month")).first()[0]) == "2012-10-01"


def test_gates(spark, tmp_path):
    w = Warehouse(spark, f"file://{tmp_path}/w", f"{tmp_path}/lock")
    w.initialize(lookup(spark))
    with pytest.raises(ValueError, match="one cleaning run"):
        recheck.snapshot(clean(spark, [record("A", (2013, 1)), record("B", (2013, 1), run="other")]), "source_transaction_id")
    with pytest.raises(ValueError, match="2 expected"):
        recheck.snapshot(clean(spark, [record("A", (2013, 1))]), "source_transaction_id", 2)
    with pytest.raises(ValueError, match="repeat"):
        w.run(clean(spark, [record("A", (2013, 1)), record("A", (2013, 2))]), "twice")
    w.ledger.put("staging", "twice", status="success", result={})
    facts = spark.createDataFrame([("A", 1), ("B", None)], "k string, v int")
    recheck.final_values(facts, facts, "k", ["v"])
    with pytest.raises(ValueError, match="after the write"):
        recheck.final_values(facts, facts.withColumn("v", F.coalesce("v", F.lit(0))), "k", ["v"])
    d = dt.date
    stored = spark.createDataFrame([(d(2013, 1, 1), "x"), (d(2013, 2, 1), "x"), (d(2013, 1, 1), "y")], "month date, c string")
    members = stored.select("c").distinct()
    recheck.spine(stored, members, d(2013, 1, 1), d(2013, 1, 1), "city")
    with pytest.raises(ValueError, match="rebuilt in full"):
        recheck.spine(stored, members, d(2013, 1, 1), d(2013, 2, 1), "city")
    assert recheck.first_gap(stored, members, d(2012, 12, 1), d(2013, 2, 1)).first() == (d(2012, 12, 1), "x")
    table = lambda *rows: spark.createDataFrame([(d(2013, 1, 1), *r) for r in rows], "month date, county_id string, n long")
    grains = {
        "national": table(("", 3)).drop("county_id"), "city": table(("a", 2), ("b", 1)), "district": table(("a", 2), ("b", 1))
    }
    recheck.grains(grains)
    with pytest.raises(ValueError, match="nation"):
        recheck.grains(grains | {"city": table(("a", 2), ("b", 2))})
    with pytest.raises(ValueError, match="districts"):
        recheck.grains(grains | {"district": table(("a", 2), ("b", 2))})
    with pytest.raises(ValueError, match="districts"):
        recheck.grains(grains | {"district": table(("a", 3))})


def test_full_rebuild_equals_increments(loaded):
    w, _ = loaded
    before = w.store.read("facts").orderBy("source_transaction_id").collect()
    assert w.full()["national"] >= 12
    assert w.store.read("facts").select(*before[0].__fields__).orderBy("source_transaction_id").collect() == before


def test_validator_finds_one_corrupted_cell(loaded):
    w, _ = loaded
    df = w.store.read("kpi_city")
    bad = df.withColumn(
        "n",
        F.when(
            (F.col("month") == F.lit("2012-09-01").cast("date")) & (F.col("city") == "臺北市"), F.col("n") + 1
        ).otherwise(F.col("n"))
    )
    w.store.publish({"kpi_city": w.store.stage("kpi_city", bad)})
    assert w.validate()["city"] == 1
    last = w.store.read("kpi_national").agg(F.max("month")).first()[0]
    want = recheck.expected(
        w.store.read("facts"), w.store.read("dim_location"), ["county_id", "city"], 1, dt.date(2012, 8, 1), last
    )
    report = recheck.first_differences(want, w.store.read("kpi_city"), ["month", "city"]).collect()
    assert [
        (str(r.month), r.city, r.missing, r.unexpected, r.differing) for r in report
    ] == [("2012-09-01", "臺北市", False, False, "n")]
    with pytest.raises(ValueError, match="nation"):
        recheck.grains({g: w.store.read(f"kpi_{g}") for g in ("national", "city", "district")})


def test_stream_delivers_the_same_merge(spark, tmp_path):
    from acreage.streaming.deliveries import deliver

    w = Warehouse(spark, f"file://{tmp_path}/w", f"{tmp_path}/lock")
    w.initialize(lookup(spark))
    clean(spark, history()).coalesce(1).write.parquet(f"{tmp_path}/in/a")
    q = deliver(w, f"file://{tmp_path}/in/*", f"file://{tmp_path}/cp")
    q.awaitTermination(120)
    assert w.store.read("facts").count() == 56


def test_moved_rows_leave_and_enter(spark):
    old = spark.createDataFrame([(1, dt.date(2024, 1, 1), 5), (2, dt.date(2024, 2, 1), 6)], "k int, month date, p int")
    new = spark.createDataFrame([(1, dt.date(2024, 3, 1), 5), (2, dt.date(2024, 2, 1), None)], "k int, month date, p int")
    changes = merge.classify(new, old, "k", ["month", "p"], ["month"])
    assert {
        (str(r.month), r.entered, r.changed, r.exited, r.has_core_impact) for r in merge.month_impact(changes).collect()
    } == {("2024-01-01", 0, 0, 1, True), ("2024-03-01", 1, 0, 0, True), ("2024-02-01", 0, 1, 0, False)}
    assert sorted(map(tuple, merge.upsert(new, old, "k", ["month", "p"]).collect())) == sorted(map(tuple, new.collect()))


def test_cutoff_without_candidate(spark):
    facts = spark.createDataFrame([(dt.date(2024, 1, 1), "H")], "month date, kind string")
    row = kpi.cutoff(facts, F.col("kind") == "H").first()
    assert row.candidate is None and str(row.source_max) == "2024-01-01"


def test_ledger_and_lock(spark, tmp_path):
    ledger = Ledger(Files(spark, f"file://{tmp_path}"))
    with pytest.raises(ZeroDivisionError):
        ledger.run("core", "a", lambda: 1 / 0)
    assert ledger.to_recover("core") == "a"
    ledger.put("core", "b", status="failed")
    with pytest.raises(Blocked):
        ledger.to_recover("core")
    ledger.put("core", "b", status="running")
    with pytest.raises(Blocked):
        ledger.to_recover("core")
    with exclusive(f"{tmp_path}/lock"), pytest.raises(Locked), exclusive(f"{tmp_path}/lock"):
        pass


def test_checked_write(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    version = checked_write(store, "clean", clean(spark, history()[:2]), C.CLEAN)
    assert store.staged("clean", version).count() == 2 and not store.exists("clean")
    with pytest.raises(ValueError, match="nulls"):
        checked_write(store, "clean", clean(spark, history()[:2]).withColumn("city", F.lit(None).cast("string")), C.CLEAN)
