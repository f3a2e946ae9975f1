"""The daily run: a clean batch into staging, core and indicators, each layer published whole and written to the ledger."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage import contract as C
from acreage.functions.dates import month_start
from acreage.operators import kpi, merge, recheck, star
from acreage.operators.exclude import require
from acreage.operators.runs import Blocked, Ledger
from acreage.operators.store import Store, exclusive

STAGING_KEY = "source_transaction_id"
STAGED = [f.name for f in C.CLEAN.fields]
COMPARED = [c for c in STAGED if c not in (STAGING_KEY, "cleaning_run_id")]
#: What a change of a record must touch to reach the fact table.
FACT = ["month", "location_id", "building_type_id", "transaction_type", "total_price", "unit_price"]
GRAINS = {
    "national": ([], 1), "city": (["county_id", "city"], 1), "district": (["county_id", "town_id", "city", "district"], 3)
}
START = date.fromisoformat(C.ANALYSIS_START)


@dataclass
class Warehouse:
    spark: SparkSession
    root: str
    lock_file: str

    def __post_init__(self) -> None:
        self.store = Store(self.spark, self.root)
        self.ledger = Ledger(self.store.files)

    def initialize(self, lookup: DataFrame, places: int | None = None) -> None:
        """Write the dimensions; places is how many there must be."""
        with exclusive(self.lock_file):
            known = self.store.read("dim_location") if self.store.exists("dim_location") else None
            dim, buildings = star.dim_location(lookup, known), star.dim_building_type(self.spark)
            if places is not None and dim.count() != places:
                raise ValueError(f"{dim.count()} places, {places} expected")
            if buildings.count() != C.BUILDING_MEMBERS:
                raise ValueError(f"there must be {C.BUILDING_MEMBERS} building members")
            self.store.publish(
                {
                    "dim_location": self.store.stage("dim_location", dim.coalesce(1)),
                    "dim_building_type": self.store.stage("dim_building_type", buildings.coalesce(1))
                }
            )

    def run(self, clean: DataFrame, batch: str) -> dict:
        """Recover what one earlier run left failed, then load the batch through all layers under one lock."""
        with exclusive(self.lock_file):
            if not self.store.exists("dim_location"):
                raise Blocked("the dimensions are not there yet")
            recovered = []
            for layer, step in (("analytics", self._refresh), ("core", self._sync)):
                if left := self.ledger.to_recover(layer):
                    self.ledger.run(layer, left, lambda s=step, b=left: s(b))
                    recovered.append((layer, left))
                    if layer == "core":
                        self.ledger.run("analytics", left, lambda b=left: self._refresh(b))
            out = {"staging": self.ledger.run("staging", batch, lambda: self._load(clean, batch))}
            out["core"] = self.ledger.run("core", batch, lambda: self._sync(batch))
            out["analytics"] = self.ledger.run("analytics", batch, lambda: self._refresh(batch))
            return out | {"recovered": recovered}

    def full(self) -> dict:
        """Rebuild facts and all indicators from staging."""
        with exclusive(self.lock_file):
            def work() -> dict:
                self.store.publish(
                    {"facts": self.store.stage_parts("facts", self._checked_facts(self.store.read("staging")), "month")}
                )
                return self._publish_kpi(None)

            return self.ledger.run("analytics", "full", work)

    def _facts(self, clean: DataFrame) -> DataFrame:
        return star.facts(clean, self.store.read("dim_location"), self.store.read("dim_building_type"))

    def _checked_facts(self, clean: DataFrame) -> DataFrame:
        return require(self._facts(clean), star.fact_rules(), "facts")

    def _merged(self, name: str, fresh: DataFrame, touched: list[date], key: str, compare: list[str]) -> dict[str, str]:
        """The parts of a table after a merge: rows of the touched months are written anew, all other parts stay as they are."""
        current = self.store.versions().get(name, {})
        days = {str(m) for m in touched}
        old = self.store.staged(
            name, {m: v for m, v in current.items() if m in days}
        ) if days & current.keys() else fresh.limit(0)
        parts = self.store.stage_parts(name, merge.upsert(fresh, old.select(*fresh.columns), key, compare), "month")
        return {m: v for m, v in current.items() if m not in days} | parts

    def _load(self, clean: DataFrame, batch: str) -> dict:
        clean = clean.select(*STAGED)
        recheck.snapshot(clean, STAGING_KEY)
        require(clean, C.clean_rules(), "clean batch")
        fresh = clean.withColumn("month", month_start(F.make_date("transaction_year", "transaction_month", F.lit(1))))
        old = self.store.read("staging").select(*fresh.columns) if self.store.exists("staging") else fresh.limit(0)
        new_facts, old_facts = self._facts(clean), self._facts(old.join(clean.select(STAGING_KEY), STAGING_KEY, "left_semi"))
        rows = merge.classify(fresh, old, STAGING_KEY, COMPARED, COMPARED).select(
            STAGING_KEY, "change", F.col("old_month").alias("staged_month")
        )
        core = merge.classify(new_facts, old_facts, STAGING_KEY, FACT, FACT).select(
            STAGING_KEY, "old_month", "new_month", "has_core_impact"
        )
        version = self.store.stage("changes", rows.join(core, STAGING_KEY))
        changes = self.store.staged("changes", version)
        totals = merge.change_totals(changes).first().asDict()
        if not totals["balanced"]:
            raise ValueError(f"the counts of changes don't add up: {totals}")
        # A changed record may have stood in another month; that part is written anew without it.
        applied = changes.where("change <> 'unchanged'")
        touched = months_of(applied, "staged_month", "new_month")
        written = self._merged(
            "staging", fresh.join(applied.select(STAGING_KEY), STAGING_KEY, "left_semi"), touched, STAGING_KEY, COMPARED
        ) if touched else None
        impact = self.store.stage("impact", merge.month_impact(changes).coalesce(1))
        self.store.publish({"staging": written} if written is not None else {})
        self.ledger.put("changes", batch, status="success", result={"changes": version, "impact": impact})
        return {k: int(v) for k, v in totals.items() if k != "balanced"}

    def _of_batch(self, name: str, batch: str) -> DataFrame:
        return self.store.staged(name, self.ledger.get("changes", batch)["result"][name])

    def _sync(self, batch: str) -> dict:
        """Bring the batch's changed records into the fact table; the change set is the batch's own, whatever came later."""
        touched = self._of_batch("changes", batch).where("change <> 'unchanged'").select(STAGING_KEY)
        n = touched.count()
        if not n:
            return {"source": 0, "inserted": 0, "updated": 0, "unchanged": 0, "applied": 0}
        fresh = self._checked_facts(self.store.read("staging").join(touched, STAGING_KEY, "left_semi"))
        if fresh.count() != n:
            raise ValueError("changed records are missing from staging")
        old = self.store.read("facts").join(
            touched, STAGING_KEY, "left_semi"
        ).select(*fresh.columns) if self.store.exists("facts") else fresh.limit(0)
        changes = self.store.staged("synced", self.store.stage("synced", merge.classify(fresh, old, STAGING_KEY, FACT, FACT)))
        totals = merge.change_totals(changes).first().asDict()
        months = months_of(changes.where("change <> 'unchanged'"), "old_month", "new_month")
        if months:
            parts = self._merged("facts", fresh, months_of(changes, "old_month", "new_month"), STAGING_KEY, FACT)
            recheck.final_values(
                fresh, self.store.staged("facts", parts).join(touched, STAGING_KEY, "left_semi"), STAGING_KEY, FACT
            )
            self.store.publish({"facts": parts})
        return {"source": n} | {k: int(totals[k]) for k in ("inserted", "updated", "unchanged", "applied")}

    def _refresh(self, batch: str) -> dict:
        impact = self._of_batch("impact", batch)
        if all(self.store.exists(f"kpi_{g}") for g in GRAINS):
            if impact.where("has_core_impact").isEmpty():
                return {"months": 0}
            return self._publish_kpi(impact)
        return self._publish_kpi(None)

    def members(self, grain: str) -> DataFrame | None:
        keys, _ = GRAINS[grain]
        return self.store.read("dim_location").select(*keys).distinct() if keys else None

    def population(self) -> DataFrame:
        """The facts that indicators count, with their place."""
        return star.kpi_population(self.store.read("facts")).join(self.store.read("dim_location"), "location_id")

    def _publish_kpi(self, impact: DataFrame | None) -> dict:
        """Build all grains up to the effective end, check them against each other, then publish them together.

        After a batch (impact) only the months that its facts count for, and those that publication newly reaches, are
        measured; others keep their stored prices, and the yearly change is taken from stored values. The end of
        publication never moves back, and every grain reaches it, with or without facts in its last months.
        """
        facts = self.store.read("facts")
        candidate = kpi.cutoff(facts, star.in_population() & (F.col("month") >= F.lit(START).cast("date"))).first().candidate
        current = self.store.read("kpi_national").agg(F.max("month")).first()[0] if impact is not None else None
        last = max((x for x in (candidate, current) if x is not None), default=None)
        if last is None:
            raise ValueError("no month qualifies for publication")
        population, versions, rows = self.population(), {}, {}
        for grain, (keys, width) in GRAINS.items():
            first, members = kpi.back(START, 1 - width), self.members(grain)
            if impact is None:
                built = kpi.monthly(population, keys, members, F.lit(first).cast("date"), F.lit(last).cast("date"), width)
            else:
                stored = self.store.read(f"kpi_{grain}")
                recheck.spine(stored, members, first, current, grain)
                own, _ = merge.affected_months(impact, width)
                months = {r.month for r in own.collect()} | set(kpi.months_from(kpi.back(current, -1), last))
                built = kpi.increment(stored, population, sorted(m for m in months if first <= m <= last), keys, members, width)
            versions[grain] = self.store.stage(f"kpi_{grain}", built)
            rows[grain] = require(self.store.staged(f"kpi_{grain}", versions[grain]), C.kpi_rules(), grain).count()
        recheck.grains({g: self.store.staged(f"kpi_{g}", v) for g, v in versions.items()})
        self.store.publish({f"kpi_{g}": v for g, v in versions.items()})
        status = "OK" if candidate == last else "REVIEW_CURRENT_AHEAD_OF_CANDIDATE"
        return {"last_month": str(last), "status": status, **rows}

    def validate(self) -> dict[str, int]:
        """Rows of each grain that a full computation in SQL of its own does not confirm, up to the published end."""
        last = self.store.read("kpi_national").agg(F.max("month")).first()[0]
        return {g: self.differences(g, last).count() for g in GRAINS}

    def differences(self, grain: str, last: date) -> DataFrame:
        """(keys, month, kind) of the rows that differ; see recheck.first_differences for a report of them."""
        keys, width = GRAINS[grain]
        want = recheck.expected(self.store.read("facts"), self.store.read("dim_location"), keys, width, START, last)
        return merge.recompute_diff(want, self.store.read(f"kpi_{grain}"), [*keys, "month"], recheck.VALUES)


def months_of(changes: DataFrame, *columns: str) -> list[date]:
    """The distinct months of some columns: no more than a calendar has."""
    found = changes.select(F.explode(F.array(*columns)).alias("month")).where("month is not null").distinct()
    return sorted(r.month for r in found.collect())
