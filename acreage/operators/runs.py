"""The ledger of runs: claims, replays, failures that are kept, and what a daily run may recover."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime

from acreage.operators.store import Files


class Blocked(RuntimeError):
    pass


class Ledger:
    """Runs by layer and batch in one small JSON file: {layer: {batch: {status, attempt, ...}}}."""

    def __init__(self, files: Files, name: str = "runs.json"):
        self.files, self.name = files, name

    def all(self) -> dict:
        return json.loads(self.files.read(self.name) or "{}")

    def get(self, layer: str, batch: str) -> dict | None:
        return self.all().get(layer, {}).get(batch)

    def put(self, layer: str, batch: str, **entry) -> None:
        runs = self.all()
        runs.setdefault(layer, {}).setdefault(batch, {}).update(entry)
        self.files.write(self.name, json.dumps(runs, indent=1, sort_keys=True))

    def run(self, layer: str, batch: str, work: Callable[[], dict]) -> dict:
        """Do the work once: a batch that succeeded is replayed from its entry, a failed one is tried again.

        A failure is written down with its message and raised; trouble while writing it down never hides the first error.
        """
        known = self.get(layer, batch)
        if known and known["status"] == "success":
            return known["result"]
        if known and known["status"] == "running":
            raise Blocked(f"{layer} {batch} is running")
        attempt = (known or {}).get("attempt", 0) + 1
        self.put(layer, batch, status="running", attempt=attempt, started=datetime.now(UTC).isoformat(timespec="seconds"))
        try:
            result = work()
        except BaseException as error:
            try:
                self.put(layer, batch, status="failed", error=str(error)[:2000])
            except Exception as second:  # noqa: BLE001
                error.add_note(f"the failure could not be written down: {second}")
            raise
        self.put(layer, batch, status="success", result=result, error=None)
        return result

    def to_recover(self, layer: str) -> str | None:
        """The one failed batch of a layer; a running one, several failed ones or a failed full rebuild block."""
        runs = self.all().get(layer, {})
        running = sorted(b for b, r in runs.items() if r["status"] == "running")
        failed = sorted(b for b, r in runs.items() if r["status"] == "failed")
        if running:
            raise Blocked(f"{layer} has running batches: {running}")
        if "full" in failed:
            raise Blocked(f"the last full rebuild of {layer} failed")
        if len(failed) > 1:
            raise Blocked(f"{layer} has several failed batches: {failed}")
        return failed[0] if failed else None
