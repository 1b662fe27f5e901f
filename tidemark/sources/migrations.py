"""Versions of the bookkeeping tables: what each release added, and who may still read or write them."""

from __future__ import annotations

from dataclasses import dataclass

from .versioned import VersionedTable

VERSION, LEAST = "tidemark.version", "tidemark.least_version"


class TooNew(Exception):
    """The table needs a newer release."""


@dataclass(frozen=True)
class Step:
    """Columns that a version added; ``breaking``: older releases may not write the table any more."""

    version: int
    columns: str
    breaking: bool = False


#: By kind of table, in order. A new table starts at the newest version.
STEPS: dict[str, tuple[Step, ...]] = {
    "bronze": (Step(1, "_snapshot string"), Step(2, "_chunk int")),
    "facts": (Step(1, "detail string, target string"), Step(2, "end_lsn string, end_commit_ts timestamp_ntz"), Step(3, "written_at timestamp_ntz")),
    "control": (Step(1, "applied_lsn string, snapshot_lsn string"), Step(2, "open_snapshot_lsn string, snapshot_wave int")),
    "silver": (),
}


def newest(kind: str) -> int:
    return max((s.version for s in STEPS[kind]), default=0)


def newest_properties(kind: str) -> dict[str, str]:
    """What a new table is marked with."""
    return {VERSION: str(newest(kind))}


def migrate(table: VersionedTable, kind: str) -> int:
    """Bring a table to this release's version; returns how many steps were applied. A table that a newer release closed to this one is an error."""
    have = table.properties()
    at, least = int(have.get(VERSION, 0)), int(have.get(LEAST, 0))
    if least > newest(kind):
        raise TooNew(f"{table.path} needs version {least} of {kind} tables; this release has {newest(kind)}")
    todo = [s for s in STEPS[kind] if s.version > at]
    for s in todo:
        table.add_columns(s.columns, {VERSION: str(s.version)} | ({LEAST: str(s.version)} if s.breaking else {}))
    return len(todo)
