"""Micro-batches that carry several capped batches, and a feed that reads only the row groups of what is asked."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import lsn
from tidemark.sources import logfeed
from tidemark.sources.capture import CaptureStore
from tidemark.sources.logfeed import LogFeed
from tidemark.sources.versioned import VersionedTable
from tidemark.streaming import finality, jobs, sink

START = datetime(2026, 1, 1, 13, 50)
MEASURED = ["batch_id", "rows", "min_lsn", "max_lsn", "min_commit_ts", "max_commit_ts", "deletes", "inserts", "updates", "end_lsn"]


def tables_at(path):
    return jobs.Tables(*[f"{path}/{n}" for n in ("bronze", "facts", "control", "silver")])


def facts_of(spark, tables):
    return sorted(map(tuple, VersionedTable(spark, tables.facts).read().where("event is null").select(*MEASURED).collect()))


def captured(tmp_path):
    """Twenty commits, of which those from 6 to 9 are of another table."""
    store = CaptureStore(str(tmp_path / "db"))
    store.add_table("orders", [("order_id", "int"), ("status", "string")], ["order_id"], "dbo_orders")
    store.add_table("other", [("id", "int")], ["id"], "dbo_other")
    for i in range(20):
        table, row = ("other", {"id": i}) if 6 <= i < 9 else ("orders", {"order_id": i, "status": "new"})
        store.commit(START + timedelta(minutes=i), table, [("insert", row)])
    return store


@pytest.mark.parametrize("together", [2, 100])
def test_capped_batches_have_the_same_facts_together(spark, tmp_path, together):
    """Ids, counts, ends, an empty batch and a restart after a short one; commits of a micro-batch are fewer than batches."""
    store = captured(tmp_path)
    ends = [e["lsn"] for e in store.timeline()]
    got = []
    for n in (1, together):
        t = tables_at(tmp_path / f"t{n}")
        for until in (ends[10], ends[19]):
            jobs.run_stream(spark, store, "orders", t, str(tmp_path / f"c{n}"), "a", options={"maxCommits": 3, "batchesAtOnce": n, "until": until})
            jobs.apply_changes(spark, t, instances=["dbo_orders"], keys=["order_id"])
        bronze = VersionedTable(spark, t.bronze)
        control = finality.row_of(spark, t.control, t.silver)
        rows = sorted(map(tuple, bronze.read().select("_batch_id", "order_id").collect()))
        state = sorted(map(tuple, VersionedTable(spark, t.silver).read().select("order_id", "status", "_start_lsn").collect()))
        got.append((facts_of(spark, t), rows, state, control["finalized_until"], control["applied_lsn"]))
        appended = sum(bool(c["paths"]) for c in bronze.commits())
        assert appended == {1: 6, 2: 4, 100: 2}[n]
    assert got[0] == got[1]
    assert [f[:2] for f in got[1][0]] == [(0, 3), (1, 3), (2, 0), (3, 2), (4, 3), (5, 3), (6, 3)]


def test_a_crash_between_rows_and_facts_of_batches_together(spark, tmp_path, monkeypatch):
    store, options = captured(tmp_path), {"maxCommits": 4, "batchesAtOnce": 3}
    good, bad = tables_at(tmp_path / "good"), tables_at(tmp_path / "bad")
    jobs.run_stream(spark, store, "orders", good, str(tmp_path / "cg"), "a", options=options)
    with monkeypatch.context() as m:
        m.setattr(sink, "write_facts", lambda *a, **k: 1 / 0)
        with pytest.raises(Exception, match="ZeroDivisionError|division"):
            jobs.run_stream(spark, store, "orders", bad, str(tmp_path / "cb"), "a", options=options)
    assert VersionedTable(spark, bad.bronze).exists() and not VersionedTable(spark, bad.facts).exists()
    jobs.run_stream(spark, store, "orders", bad, str(tmp_path / "cb"), "a", options=options)
    assert facts_of(spark, bad) == facts_of(spark, good)
    assert VersionedTable(spark, bad.bronze).read().count() == 17


def test_positions_read_only_their_row_groups(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(logfeed, "_GROUP", 4096)
    feed = LogFeed.create(str(tmp_path / "feed"))
    n = 20_000
    at = F.concat(F.lit("0x"), F.lpad(F.hex(F.col("id") * 16 + 1000), 20, "0"))
    feed.put_timeline(spark.range(n).select(at.alias("lsn"), F.timestamp_micros(F.col("id") * 1_000_000).cast("timestamp_ntz").alias("ts")))
    assert len(feed._groups()) > 20
    pos = lambda i: lsn.from_int(1000 + 16 * i)
    read = []
    monkeypatch.setattr(LogFeed, "_data", lambda *a: read.append(a))  # a scan of all commits
    assert feed.newest() == pos(n - 1)
    for i in (0, 1, 777, n - 2, n - 1):
        assert feed.time_of(pos(i)) == feed.time_of(lsn.after(pos(i))) == (datetime(1970, 1, 1) + timedelta(seconds=i)).isoformat(sep=" ")
        assert feed.nth_after(pos(i), 5) == pos(min(n - 1, i + 5))
        assert feed.positions(pos(i), pos(i + 3)) == [pos(j) for j in range(i, min(n, i + 4))]
    assert feed.time_of(lsn.ZERO) is None and feed.nth_after(pos(n), 3) == pos(n) and feed.nth_after(lsn.ZERO, n + 9) == pos(n - 1)
    assert not read
