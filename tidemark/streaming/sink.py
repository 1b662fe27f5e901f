"""The raw table's writer: every micro-batch once, with its facts."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.types import from_rows, struct_of
from ..operators.changelog import to_bronze
from ..operators.facts import FACTS, fold_metrics, measures
from ..sources import sidefiles
from ..sources.migrations import migrate, newest_properties
from ..sources.versioned import VersionedTable

_FIELDS = struct_of(FACTS)


def write_facts(spark: SparkSession, table: VersionedTable, rows: list[dict[str, Any]], txn: tuple[str, int] | None = None, metadata: str | None = None) -> int | None:
    """Append rows of facts; columns not given are null, unknown ones an error."""
    for r in rows:
        if unknown := set(r) - set(_FIELDS.names):
            raise ValueError(f"no such facts: {', '.join(sorted(unknown))}")
    if table.exists():
        migrate(table, "facts")
    table.create(FACTS, newest_properties("facts"))
    now = datetime.now(UTC).replace(tzinfo=None)
    made = from_rows(spark, [tuple((r | {"written_at": now}).get(n) for n in _FIELDS.names) for r in rows], _FIELDS)
    return table.append(made, txn=txn, metadata=metadata)


def take_events(folder: str | None) -> list[tuple[str, dict[str, Any]]]:
    """(file, event) of what the ranges of a batch left."""
    return [(name, e) for name in sidefiles.names(folder) for e in sidefiles.read(folder, name)]


#: What a batch is observed for, by the names of its facts.
OBSERVED = ("rows", "min_lsn", "max_lsn", "min_commit_ts", "max_commit_ts", "deletes", "inserts", "updates")

#: The same of a batch without rows.
NONE: dict[str, Any] = dict.fromkeys(OBSERVED) | {"rows": 0, "deletes": 0, "inserts": 0, "updates": 0}


class BronzeWriter:
    """A ``foreachBatch`` function.

    Rows are appended under the transaction (app_id, batch), facts under the same after them, so a
    batch that is replayed after a crash changes nothing. The source is read once: facts are observed
    while the rows are written, and a batch in which none was seen commits facts only. What the
    ranges measured is folded into the facts, and their events are rows of their own.

    A micro-batch that carries several capped batches (its rows say of which they are) is one
    transaction with facts for each. Their numbers go on from the last one's, which the facts' commit
    says where it is not the micro-batch's own.
    """

    def __init__(self, bronze: VersionedTable, app_id: str, facts: VersionedTable, *, events: str | None = None):
        self.bronze, self.app_id, self.facts, self.events = bronze, app_id, facts, events

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        began, started = time.time(), datetime.now(UTC).replace(tzinfo=None)
        if not self._due(batch_id):
            return
        first = self._first(batch_id)
        got = self._held(batch_id) or self._append(df, batch_id, first)
        found = take_events(self.events)
        number = lambda e: first + e.get("batch", 0)
        rows, last = [], max([first, *got, *[number(e) for _, e in found]])
        for n in range(first, last + 1):
            rows += self._facts(n, got.get(n, NONE), [e for _, e in found if number(e) == n], started, began)
        write_facts(df.sparkSession, self.facts, rows, (self.app_id, batch_id), json.dumps({"next": last + 1}) if last != batch_id else None)
        if found:
            sidefiles.remove(self.events, sorted({name for name, _ in found}))

    def _facts(self, number: int, got: dict[str, Any], found: list[dict[str, Any]], started: datetime, began: float) -> list[dict[str, Any]]:
        """A batch's row of facts, and those of its events."""
        facts = {"app_id": self.app_id, "batch_id": number, "target": self.bronze.path}
        batch = facts | got | measured([e for e in found if e["event"] == "metrics"], got.get("max_commit_ts"))
        batch |= {"started_at": started, "duration_ms": int(1000 * (time.time() - began)), "end_lsn": got.get("max_lsn") or batch.get("end_lsn"), "end_commit_ts": got.get("max_commit_ts")}
        if said := [w for e in found if e["event"] == "warnings" for w in e["detail"]]:
            batch["detail"] = json.dumps({"warnings": said})
        return [batch, *[facts | {"event": e["event"], "detail": e.get("detail")} for e in found if e["event"] not in ("metrics", "warnings")]]

    def _first(self, batch_id: int) -> int:
        """Number of a micro-batch's first batch."""
        last = self.facts.last_txn(self.app_id) if self.facts.exists() else None
        said = self.facts.metadata_of(self.app_id, last) if last is not None else None
        return said["next"] if said else batch_id

    def _due(self, batch_id: int) -> bool:
        last = self.facts.last_txn(self.app_id) if self.facts.exists() else None
        if last is not None and batch_id < last:
            raise ValueError(f"batch {batch_id} of {self.app_id!r} comes after batch {last}: the checkpoint was reset, so use another app_id")
        return last != batch_id

    def _held(self, batch_id: int) -> dict[int, dict[str, Any]]:
        """The facts, by number, of a micro-batch whose rows are there: written just now, or before a crash that came between rows and facts."""
        if not (self.bronze.exists() and self.bronze.has_txn(self.app_id, batch_id)):
            return {}
        found = self.bronze.read_txn(self.app_id, batch_id).where(F.col("_operation") != 0).groupBy("_batch_id").agg(*measures()).collect()
        return {r["_batch_id"]: {n: r[n] for n in OBSERVED} for r in found}

    def _append(self, df: DataFrame, batch_id: int, first: int) -> dict[int, dict[str, Any]]:
        seen, together = Observation(), "_batch_id" in df.columns  # several batches are measured by number once they are there
        columns = [c.cast("string").alias(n) if n.endswith("_ts") else c.alias(n) for c, n in zip(measures(), OBSERVED, strict=True) if n == "rows" or not together]
        rows = to_bronze(df, first).observe(seen, *columns)
        self.bronze.append(rows, txn=(self.app_id, batch_id), metadata=json.dumps({"app": self.app_id, "batch": batch_id}), wanted=lambda: bool(seen.get["rows"]))
        if together:
            return self._held(batch_id)
        got = dict(seen.get)
        return {first: {n: datetime.fromisoformat(v) if n.endswith("_ts") and isinstance(v, str) else v for n, v in got.items()}}


def bronze_writer(bronze: VersionedTable, app_id: str, facts: VersionedTable, *, events: str | None = None) -> Callable[[DataFrame, int], None]:
    return BronzeWriter(bronze, app_id, facts, events=events)


def measured(files: list[dict[str, Any]], position: datetime | None) -> dict[str, Any]:
    """Facts of what the ranges measured: their fold, and how far the batch is from both ends of the log."""
    if not files:
        return {}
    got = fold_metrics(files)
    time_of = lambda n: datetime.fromisoformat(got[n]) if got.get(n) else None
    low, top, now = time_of("retention_watermark_ts"), time_of("source_max_commit_ts"), datetime.now(UTC).replace(tzinfo=None)
    hours = lambda a, b: round((a - b).total_seconds() / 3600, 2) if a and b else None
    seconds = lambda a, b: round((a - b).total_seconds(), 3) if a and b else None
    return got | {"retention_watermark_ts": low, "source_max_commit_ts": top, "retention_headroom_hours": hours(position, low), "ingestion_lag_seconds": seconds(top, position), "capture_lag_seconds": seconds(now, top)}
