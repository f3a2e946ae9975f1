"""Command line: python -m acreage.cli COMMAND ..."""

from __future__ import annotations

import argparse
import json
import uuid
from datetime import UTC, datetime
from pathlib import Path

from pyspark.sql import SparkSession

from acreage import contract as C
from acreage.operators.cleaning import clean_transactions, staged_rows
from acreage.operators.profile_run import summaries, write_csv
from acreage.operators.report import render
from acreage.operators.store import Store, checked_write
from acreage.operators.warehouse import Warehouse
from acreage.session import CONF
from acreage.sources.landzip import read_land_zip
from acreage.sources.reference import ALIASES, LOOKUP, file_sha256, read_reference
from acreage.sources.releases import Registry, replace_text
from acreage.sources.stata import read_stata


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="acreage")
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("clean", help="raw file to clean and excluded Parquet and an audit")
    for name in ("--raw", "--lookup", "--aliases", "--output-dir"):
        c.add_argument(name, required=True)
    c.add_argument("--period-start", type=int, default=C.PERIOD_START)
    c.add_argument("--period-end", type=int)
    c.add_argument("--places", type=int, default=C.PLACES)
    c.add_argument("--place-aliases", type=int, default=C.PLACE_ALIASES)
    c = sub.add_parser("register", help="archive a delivery and write it to the registry")
    for name in ("--source", "--release-date", "--release-root"):
        c.add_argument(name, required=True)
    c.add_argument("--period-end", type=int, required=True)
    c.add_argument("--source-url")
    c = sub.add_parser("profile", help="every summary of a raw file as CSV")
    for name in ("--raw", "--lookup", "--aliases", "--output-dir"):
        c.add_argument(name, required=True)
    c = sub.add_parser("release", help="register a delivery, clean it and write that to the registry")
    for name in ("--source", "--release-date", "--release-root", "--lookup", "--aliases", "--output-dir"):
        c.add_argument(name, required=True)
    c.add_argument("--period-start", type=int, default=C.PERIOD_START)
    c.add_argument("--period-end", type=int, required=True)
    c.add_argument("--places", type=int, default=C.PLACES)
    c.add_argument("--place-aliases", type=int, default=C.PLACE_ALIASES)
    c.add_argument("--source-url")
    c = sub.add_parser("published", help="write to the registry that a cleaned release was published")
    for name in ("--release-root", "--release-id", "--target", "--batch"):
        c.add_argument(name, required=True)
    c = sub.add_parser("initialize", help="write the dimensions")
    c.add_argument("--lookup", required=True)
    c.add_argument("--places", type=int)
    r = sub.add_parser("run", help="load one clean batch through all layers")
    r.add_argument("--parquet", required=True)
    r.add_argument("--batch", required=True)
    f = sub.add_parser("full", help="rebuild facts and indicators")
    for s in (c, r, f):
        s.add_argument("--warehouse", required=True)
        s.add_argument("--lock", required=True)
    a = sub.add_parser("report", help="audit JSON to Markdown")
    a.add_argument("audit")
    a.add_argument("--output")
    return p


def clean(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Clean and excluded rows are published together or not at all; a failed run leaves an audit that says why."""
    archive = a.raw.lower().endswith(".zip")
    if archive and a.period_end is None:
        raise SystemExit("--period-end is needed for a ZIP archive")
    run_id, started = uuid.uuid4().hex[:12], datetime.now(UTC).isoformat(timespec="seconds")
    out = Path(a.output_dir) / f"audit-{run_id}.json"
    try:
        raw = read_land_zip(spark, a.raw) if archive else read_stata(spark, a.raw, C.RAW_COLUMNS)
        done = clean_transactions(
            raw, read_reference(spark, a.lookup, LOOKUP), read_reference(spark, a.aliases, ALIASES), run_id,
            start=a.period_start, end=a.period_end or C.PERIOD_END, places=a.places, renamed=a.place_aliases
        )
        audit = done.audit()
        if archive and audit["primary_exclusion_reasons"]["duplicate_conflict"]:
            raise ValueError("the archive has conflicting duplicates")
        if not audit["row_counts"]["reconciled"] or not audit["row_counts"]["clean_rows"]:
            raise ValueError(f"rows don't add up: {audit['row_counts']}")
        digest = file_sha256(a.raw)
        known = C.baseline(digest, audit)
        if known["status"] == "differs":
            raise ValueError(f"the counts of a known source differ: {known['differences']}")
        store = Store(spark, f"file://{Path(a.output_dir).resolve()}")
        versions = {
            "clean": checked_write(store, "clean", done.clean, C.CLEAN),
            "excluded": checked_write(store, "excluded", done.excluded, C.EXCLUDED)
        }
        counts = {name: store.staged(name, v).count() for name, v in versions.items()}
        gates = {
            "rows add up": counts["clean"] + counts["excluded"] == audit["row_counts"]["input_rows"],
            "written as counted": counts["clean"] == audit["row_counts"]["clean_rows"]
        }
        if not all(gates.values()):
            raise ValueError(f"what was written does not add up: {gates}")
        store.publish(versions)
        times = {"started": started, "completed": datetime.now(UTC).isoformat(timespec="seconds")}
        audit = {
            "status": "success", "run_id": run_id, **times, "source_sha256": digest, "baseline": known, "gates": gates,
            "results": audit
        }
    except Exception as error:
        replace_text(out, json.dumps({"status": "failed", "run_id": run_id, "error": str(error)}, ensure_ascii=False, indent=1))
        raise
    replace_text(out, json.dumps(audit, ensure_ascii=False, indent=1, default=str))
    return audit


def release(spark: SparkSession, a: argparse.Namespace) -> dict:
    """One delivery from archive to clean rows; a release that was cleaned before is not cleaned again."""
    registry = Registry(a.release_root)
    entry = registry.register(a.source, released=a.release_date, period_end=a.period_end, url=a.source_url)
    if entry["cleaning"].get("status") == "success":
        return entry
    a.raw = str(registry.root / entry["archive_path"])
    try:
        audit = clean(spark, a)
    except Exception as error:
        registry.cleaned(entry["release_id"], status="failed", error=str(error)[:2000])
        raise
    registry.cleaned(entry["release_id"], status="success", run_id=audit["run_id"], row_counts=audit["results"]["row_counts"])
    return registry.find(entry["release_id"])


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.command == "register":
        print(
            json.dumps(
                Registry(a.release_root).register(a.source, released=a.release_date, period_end=a.period_end, url=a.source_url),
                ensure_ascii=False
            )
        )
        return 0
    if a.command == "report":
        text = render(json.loads(Path(a.audit).read_text(encoding="utf-8")))
        replace_text(Path(a.output), text) if a.output else print(text)
        return 0
    if a.command == "published":
        Registry(a.release_root).published(
            a.release_id, a.target, batch=a.batch, recorded=datetime.now(UTC).isoformat(timespec="seconds")
        )
        return 0
    spark = SparkSession.builder.config(map=CONF).getOrCreate()
    if a.command == "profile":
        raw = (
            read_land_zip(spark, a.raw) if a.raw.lower().endswith(".zip") else read_stata(spark, a.raw, C.RAW_COLUMNS)
        ).persist()
        staged = staged_rows(
            raw, read_reference(spark, a.lookup, LOOKUP), read_reference(spark, a.aliases, ALIASES), "_row_pos", C.PERIOD_START,
            C.PERIOD_END
        )
        print(json.dumps(write_csv(summaries(raw, staged), a.output_dir)))
        return 0
    if a.command == "release":
        print(json.dumps(release(spark, a), ensure_ascii=False, default=str))
        return 0
    if a.command == "clean":
        print(json.dumps(clean(spark, a), ensure_ascii=False, default=str))
        return 0
    w = Warehouse(spark, a.warehouse, a.lock)
    if a.command == "initialize":
        w.initialize(read_reference(spark, a.lookup, LOOKUP), a.places)
    else:
        print(json.dumps(w.full() if a.command == "full" else w.run(spark.read.parquet(a.parquet), a.batch), default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
