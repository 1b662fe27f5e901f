"""Snapshots of a stream: which are open, which may begin, and what their events say."""

from __future__ import annotations

import json
import re
from datetime import datetime, timedelta
from typing import Any

from ..operators.facts import COMPLETED


class SnapshotOpen(Exception):
    """Another snapshot of the table has to end first."""


def mode_of(detail: str | None) -> str:
    """full or chunked; events of before there were modes are chunked."""
    return (json.loads(detail).get("mode") if detail else None) or "chunked"


def unfinished(events: list[dict[str, Any]]) -> dict[str, Any] | None:
    """The newest snapshot that was opened and not completed."""
    done = {e["max_lsn"] for e in events if e["event"] in COMPLETED}
    opened = [e for e in events if e["event"] == "snapshot_open" and e["max_lsn"] not in done]
    return max(opened, key=lambda e: e["max_lsn"], default=None)


def lock(events: list[dict[str, Any]], mode: str, app_id: str, low: str | None = None) -> dict[str, Any] | None:
    """The open snapshot to go on with, None to begin one, or an error: full and chunked ones don't overlap, nor those of two applications.

    One whose position is below ``low`` can't be completed any more (its changes are purged), so it bars nothing.
    """
    found = unfinished(events)
    if found is None or (low is not None and found["max_lsn"] < low):
        return None
    if mode_of(found.get("detail")) != mode:
        raise SnapshotOpen(f"a {mode_of(found.get('detail'))} snapshot is open at {found['max_lsn']}; complete it before a {mode} one")
    if found.get("app_id") not in (None, app_id):
        raise SnapshotOpen(f"{found['app_id']!r} has a snapshot open at {found['max_lsn']}")
    return found


def too_soon(events: list[dict[str, Any]], now: datetime, days: float) -> bool:
    """Whether the last repair by a new snapshot is less than ``days`` ago: another would hide that something is wrong."""
    last = max((e["written_at"] for e in events if e["event"] == "resnapshot" and e.get("written_at")), default=None)
    return last is not None and now - last < timedelta(days=days)


def switch_of(detail: str) -> dict[str, Any]:
    """old, new, start_lsn and not_captured of a switch event: JSON, or the older text ``old -> new; start_lsn=..; not captured: a, b``."""
    if detail.lstrip().startswith("{"):
        got = json.loads(detail)
        return {k: got.get(k) for k in ("old", "new", "start_lsn")} | {"not_captured": list(got.get("not_captured") or [])}
    head, *rest = [p.strip() for p in detail.split(";")]
    old, _, new = (x.strip() for x in head.partition("->"))
    out: dict[str, Any] = {"old": old or None, "new": new or None, "start_lsn": None, "not_captured": []}
    for p in rest:
        if m := re.fullmatch(r"start_lsn\s*[=:]\s*(0x[0-9A-Fa-f]+)", p):
            out["start_lsn"] = m[1]
        elif p.lower().startswith("not captured"):
            out["not_captured"] = [c.strip() for c in p.partition(":")[2].split(",") if c.strip()]
    return out


def switches_to_snapshot(events: list[dict[str, Any]]) -> list[dict[str, Any]]:
    """Switches since which no snapshot was completed or opened, oldest first."""
    after = max((e["max_lsn"] for e in events if e["event"] in (*COMPLETED, "snapshot_open") and e["max_lsn"]), default="")
    found = [switch_of(e["detail"]) for e in events if e["event"] == "capture_instance_switched"]
    return sorted((s for s in found if s["start_lsn"] and s["start_lsn"] > after), key=lambda s: s["start_lsn"])
