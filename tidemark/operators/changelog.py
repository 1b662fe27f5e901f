"""Reading a change log: intervals, capture instances, commit times and order."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

META = ["_capture_instance", "_start_lsn", "_seqval", "_operation", "_command_id", "_commit_ts"]
RESERVED = {*META, "_batch_id", "_snapshot", "_chunk"}
DELETE, INSERT, BEFORE, AFTER, SNAPSHOT = 1, 2, 3, 4, 0


def check_names(columns: list[str]) -> None:
    if clash := sorted({c for c in columns if c.lower() in RESERVED}):
        raise ValueError(f"columns with reserved names: {', '.join(clash)}")


def interval(log: DataFrame, lo: str, hi: str) -> DataFrame:
    """Rows of the closed interval; both ends reach the scan as pushed filters."""
    return log.where(F.col("_start_lsn").between(lo, hi))


def with_commit_time(log: DataFrame, timeline: DataFrame) -> DataFrame:
    """Each row with its commit's time. The timeline has a row a commit, so both are shuffled alike unless Spark sees that it is small."""
    return log.join(timeline.select(F.col("start_lsn").alias("_start_lsn"), F.col("commit_ts").alias("_commit_ts")), "_start_lsn")


def commit_order(log: DataFrame) -> DataFrame:
    return log.orderBy("_start_lsn", "_command_id", "_seqval", "_operation")


def typed_nulls(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``df`` with exactly these columns, those that it lacks as nulls of their type."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[F.col(have[n.lower()]).cast(t).alias(n) if n.lower() in have else F.lit(None).cast(t).alias(n) for n, t in columns.items()])


def pieces(lo: str, hi: str, switch: str | None) -> list[tuple[str, str, str]]:
    """(instance, from, to) of an interval: the older instance below ``switch``, the newer from it on; no empty piece."""
    from ..functions import lsn

    if switch is None or hi < switch:
        return [("older", lo, hi)]
    if lo >= switch:
        return [("newer", lo, hi)]
    return [("older", lo, lsn.before(switch)), ("newer", switch, hi)]


def across_switch(older: DataFrame, newer: DataFrame, lo: str, hi: str, switch: str, columns: dict[str, str]) -> DataFrame:
    """One interval read from both instances, with the union of their columns."""
    source = {"older": older, "newer": newer}
    parts = [typed_nulls(interval(source[i], a, b), columns) for i, a, b in pieces(lo, hi, switch)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def of_instances(log: DataFrame, names: list[str]) -> DataFrame:
    return log.where(F.lower("_capture_instance").isin([n.lower() for n in names]))


def snapshot_rows(log: DataFrame, position: str | None = None, *, chunks: list[int] | None = None, chunked: bool = False) -> DataFrame:
    """Operation-0 rows, of one snapshot (rows older than the _snapshot column carry it as _start_lsn) and some chunks of it."""
    out = log.where(F.col("_operation") == SNAPSHOT)
    if position is not None:
        out = out.where(F.coalesce("_snapshot", "_start_lsn") == position)
    if chunks is not None:
        return out.where(F.col("_chunk").isin(chunks))
    return out.where(F.col("_chunk").isNotNull() if chunked else F.col("_chunk").isNull())


def changes_after(log: DataFrame, position: str) -> DataFrame:
    return log.where((F.col("_operation") != SNAPSHOT) & (F.col("_start_lsn") > position))


def stamped(df: DataFrame, instance: str, position: str, commit_ts: Column, *, command_id: bool = True) -> DataFrame:
    """Rows of a table as snapshot rows: operation 0, one position, no sequence or command."""
    meta = {
        "_capture_instance": F.lit(instance), "_start_lsn": F.lit(position), "_seqval": F.lit(None).cast("string"),
        "_operation": F.lit(SNAPSHOT), "_command_id": F.lit(None).cast("int"), "_commit_ts": commit_ts,
    }
    if not command_id:
        del meta["_command_id"]
    return df.select(*[c.alias(n) for n, c in meta.items()], *df.columns)


def to_bronze(df: DataFrame, batch_id: int | None, snapshot: str | None = None) -> DataFrame:
    """The raw table's columns: what was read, then batch, snapshot and chunk, typed and last. Rows that carry the number of a batch count on from ``batch_id``."""
    # A number would be part of the generated code, which would be compiled and warmed up again for every batch; a decimal is handed to it.
    batch = F.col("_batch_id") + F.lit(Decimal(batch_id)) if "_batch_id" in df.columns else F.lit(batch_id)
    chunk = F.col("_chunk").cast("int") if "_chunk" in df.columns else F.lit(None).cast("int")
    rest = [c for c in df.columns if c not in ("_batch_id", "_snapshot", "_chunk")]
    return df.select(*rest, batch.cast("int").alias("_batch_id"), F.lit(snapshot).cast("string").alias("_snapshot"), chunk.alias("_chunk"))


def seed(df: DataFrame, columns: dict[str, str], missing: str = "error") -> DataFrame:
    """A copy of the table as its captured columns, matched ignoring case; those missing are an error, or NULL."""
    have = {c.lower() for c in df.columns}
    lost = [c for c in columns if c.lower() not in have]
    if lost and missing == "error":
        raise ValueError(f"the copy lacks {', '.join(lost)}")
    return typed_nulls(df, columns)
