"""The audit of a cleaning run as Markdown."""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo


def share(part: int, whole: int) -> str:
    return f"{part / whole:.2%}" if whole else "-"


def table(heads: list[str], rows: list[list]) -> list[str]:
    return [
        "| " + " | ".join(heads) + " |", "|" + " --- |" * len(heads),
        *["| " + " | ".join(str(c) for c in r) + " |" for r in rows], ""
    ]


def local(time: str) -> str:
    """A time as the audit has it, in Taipei."""
    return datetime.fromisoformat(time).astimezone(ZoneInfo("Asia/Taipei")).strftime("%Y-%m-%d %H:%M:%S")


def render(audit: dict) -> str:
    """From the audit alone: neither raw nor clean rows are read again."""
    if audit.get("status") != "success":
        return f"# Cleaning run {audit.get('run_id', '')}\n\nFailed: {audit.get('error', '')}\n"
    r = audit["results"]
    n = r["row_counts"]
    lines = [f"# Cleaning run {audit['run_id']}", "", f"Source: `{audit['source_sha256']}`", ""]
    if "started" in audit:
        seconds = int((datetime.fromisoformat(audit["completed"]) - datetime.fromisoformat(audit["started"])).total_seconds())
        lines += [
            f"From {local(audit['started'])} to {local(audit['completed'])} (Taipei), {seconds // 60} min {seconds % 60} s", ""
        ]
    lines += table(
        ["Rows", "Count", "Share"],
        [[k, n[f"{k}_rows"], share(n[f"{k}_rows"], n["input_rows"])] for k in ("input", "clean", "excluded")]
    )
    if "gates" in audit:
        known = audit["baseline"]
        lines += ["## Gates", ""] + table(["Gate", "Result"], [[k, "PASS" if v else "FAIL"] for k, v in audit["gates"].items()] + [["known source", f"{known['status']}, {len(known['differences'])} differences"]])
    lines += ["## Reasons of exclusion", ""] + table(["Reason", "Rows", "Share"], [[k, v, share(v, n["input_rows"])] for k, v in r["primary_exclusion_reasons"].items()])
    lines += ["## Places without a match", ""] + table(["County", "Town", "Rows"], [[u["county_code"], u["raw_town"], u["rows"]] for u in r["unmatched_location_combinations"]])
    lines += ["## Completion dates", ""] + table(["Status", "Rows", "Share"], [[k, v, share(v, n["clean_rows"])] for k, v in sorted(r["completion_date_status"].items())])
    lines += ["## Checks", ""] + table(["Check", "Rows"], sorted(r["independent_checks"].items()))
    lines += ["## Numbers", ""] + table(["Column", "Rows", "Missing", "Valid", "Lowest", "Highest"], [[q["column"], q["rows"], q["missing"], q["valid"], q["lowest"], q["highest"]] for q in r["numeric_quality"]])
    lines += ["## Layout", ""] + table(["Column", "Rows", "Lowest", "Median", "95 %", "99 %", "Highest"], [[q["column"], q["valid_rows"], q["lowest"], q["p50"], q["p95"], q["p99"], q["highest"]] for q in r["layout"]])
    lines += ["## Formulas", ""] + table(["Formula", "Comparable", "Matched", "Share"], [[f["formula"], f["comparable"], f["matched"], share(f["matched"], f["comparable"])] for f in r["formula_validation"]])
    lines += ["## Categories", ""] + table(["Column", "Value", "Rows"], [[c["column"], c["value"], c["rows"]] for c in r["categories"]])
    return "\n".join(lines)
