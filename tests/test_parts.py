"""Retries, backends, locks, bounds and names."""

import json
import sqlite3
from datetime import date, datetime, timedelta
from decimal import Decimal

import pyarrow as pa
import pytest

from tidemark import session
from tidemark.functions import bounds, keys
from tidemark.sources import backend, retry, sidefiles
from tidemark.sources.logfeed import resolve
from tidemark.streaming import lock


def test_transient_errors_are_tried_again(monkeypatch):
    waits, calls = [], []
    monkeypatch.setattr(retry, "pause", waits.append)

    class Source:
        def reconnect(self):
            calls.append("reconnect")

        @retry.retrying
        def read(self, fail):
            calls.append("read")
            if len(calls) < fail:
                raise RuntimeError("[08S01] communication link failure")
            return 7

    assert Source().read(6) == 7 and calls == ["read", "reconnect"] * 3 + ["read"]
    assert all(a <= w <= 2 * a for w, a in zip(waits, (1, 2, 4), strict=True))
    calls.clear()
    with pytest.raises(RuntimeError):
        Source().read(99)
    assert not retry.transient(ValueError("column 08 is wrong")) and retry.transient(RuntimeError("HYT00")) and retry.transient(TimeoutError())
    cause = ValueError("x")
    cause.__cause__ = ConnectionResetError("reset")
    assert retry.transient(cause)


def test_batches_of_a_database_grow_while_rows_are_small():
    held = sqlite3.connect(":memory:")
    held.execute("CREATE TABLE t (k INTEGER, s TEXT, at TEXT)")
    held.executemany("INSERT INTO t VALUES (?, ?, ?)", [(i, "x" * 10, f"2024-01-01 00:00:{i % 60:02d}.123456") for i in range(100)])
    b = backend.DbApiBackend(lambda: held, text_params=True)
    assert [len(x) for x in b.batches("SELECT * FROM t ORDER BY k", (), 30)] == [1, 2, 4, 8, 16, 30, 30, 9]
    assert backend.next_size(1024, 10_000, 1 << 20) == 64 and backend.next_size(8, 10_000, 1 << 40) == 1
    got = pa.Table.from_batches(b.arrow("SELECT k, at FROM t WHERE k < ? ORDER BY k", pa.schema([("k", pa.int64()), ("at", pa.timestamp("ns"))]), (5,)))
    assert got["k"].to_pylist() == [0, 1, 2, 3, 4] and got["at"].type == pa.timestamp("us") and got["at"][1].as_py() == datetime(2024, 1, 1, 0, 0, 1, 123456)
    assert b.scalar("SELECT count(*) FROM t") == 100 and b.ping(3) >= 0
    assert backend.network_wait(5, 9) == 4 and backend.network_wait(9, 5) is None and backend.network_wait(None, 5) is None


def test_locks_and_switches():
    opened = {"event": "snapshot_open", "max_lsn": "0x10", "detail": json.dumps({"mode": "chunked"}), "app_id": "a"}
    done = {"event": "bootstrap", "max_lsn": "0x10", "detail": None, "app_id": "a"}
    assert lock.lock([], "full", "a") is None and lock.lock([opened], "chunked", "a") == opened and lock.lock([opened, done], "full", "b") is None
    for mode, app in (("full", "a"), ("chunked", "b")):
        with pytest.raises(lock.SnapshotOpen):
            lock.lock([opened], mode, app)
    assert lock.lock([opened], "full", "b", low="0x11") is None
    now = datetime(2024, 1, 2)
    again = [{"event": "resnapshot", "written_at": now - timedelta(hours=3)}]
    assert lock.too_soon(again, now, 1) and not lock.too_soon(again, now, 0.1) and not lock.too_soon([], now, 1)
    old = lock.switch_of("dbo_a -> dbo_b; start_lsn=0x00AB; not captured: x, y")
    assert old == {"old": "dbo_a", "new": "dbo_b", "start_lsn": "0x00AB", "not_captured": ["x", "y"]}
    assert lock.switch_of(json.dumps({"old": "p", "new": "q", "start_lsn": "0x1"}))["not_captured"] == []
    switch = {"event": "capture_instance_switched", "max_lsn": None, "detail": json.dumps({"old": "p", "new": "q", "start_lsn": "0x20"})}
    assert [s["new"] for s in lock.switches_to_snapshot([done, switch])] == ["q"] and lock.switches_to_snapshot([switch, done | {"max_lsn": "0x21"}]) == []


def test_names_of_instances():
    found = [{"name": n, "table": t, "created": c} for n, t, c in (("dbo_A", "A", "1"), ("dbo_a", "B", "2"), ("x", "A", "3"))]
    assert [i["name"] for i in resolve(found, "dbo_A")] == ["dbo_A", "x"]
    assert [i["name"] for i in resolve([found[2]], "dbo_a")] == ["x"]  # its default name is gone
    with pytest.raises(ValueError, match="ambiguous"):
        resolve(found, "DBO_A")
    with pytest.raises(ValueError, match="no capture"):
        resolve(found, "other")


def test_bounds():
    assert bounds.coerce(1 << 63, "bigint", lower=False) is None and bounds.coerce("2024-01-02 03:04", "date", lower=True) == date(2024, 1, 2)
    assert bounds.coerce("2024-01-02 03:04:05.1234567", "timestamp_ntz", lower=True) == datetime(2024, 1, 2, 3, 4, 5, 123457)
    assert bounds.coerce("2024-01-02 03:04:05.1234567", "timestamp_ntz", lower=False) == datetime(2024, 1, 2, 3, 4, 5, 123456)
    assert bounds.coerce("2024-01-02T03:04:05.1234560", "timestamp_ntz", lower=True).microsecond == 123456
    assert bounds.coerce("0x0AFF", "binary", lower=True) == b"\x0a\xff" and bounds.coerce("1.50", "decimal(5,2)", lower=True) == Decimal("1.50")
    assert bounds.text_of(datetime(2024, 1, 1, 0, 0, 0, 123456), "datetime") == "2024-01-01 00:00:00.123" and bounds.text_of(Decimal("1E+2")) == "100"
    assert bounds.bound_types([("a", "int", None), ("b", "varchar(10)", "Latin1_General_BIN")]) == ["int", "varchar(10) COLLATE Latin1_General_BIN"]
    assert bounds.bound_types([("a", "datetime2", None), ("b", "int", None)]) is None and bounds.bound_types([("a", "int", None), ("b", "datetime2(7)", None)]) == ["int", "datetime2(7)"]
    assert bounds.bound_types([("a", "time", None)]) is None and bounds.bound_types([("a", "geography", None)]) is None


def test_names_and_side_files(spark, tmp_path):
    assert keys.identifier("a b") == "a b" and keys.zone_name("W. Europe Standard Time")
    for bad in ("", "a]b", "a\x00", "x" * 129):
        with pytest.raises(ValueError):
            keys.identifier(bad)
    with pytest.raises(ValueError):
        keys.zone_name("UTC'; DROP")
    folder = f"file://{tmp_path}/side"
    sidefiles.write(folder, "a.json", [1])
    assert sidefiles.names(folder) == ["a.json"] and sidefiles.read(str(tmp_path / "side"), "a.json") == [1] and sidefiles.names(f"{tmp_path}/none") == []
    sidefiles.remove(folder, ["a.json", "gone.json"])
    assert sidefiles.names(folder) == []
    assert session.get_spark() is spark and session.available_cores(spark) >= 1


def test_log_checkpoints(spark, tmp_path, monkeypatch):
    from tidemark.sources import versioned

    monkeypatch.setattr(versioned, "CHECKPOINT_EVERY", 3)
    t = versioned.VersionedTable(spark, str(tmp_path / "t")).create("k int")
    for i in range(5):
        t.append(spark.createDataFrame([(i,)], "k int"), txn=("a", i))
    again = versioned.VersionedTable(spark, t.path)
    read = []
    original = again.files.read
    again.files.read = lambda name: read.append(name) or original(name)
    assert again.read().count() == 5 and again.version() == 5 and sum(n.endswith(".json") for n in read) == 0
    again.commits()
    assert len(read) == 1  # one checkpoint, of all six commits


def test_a_merge_writes_only_the_buckets_it_touches(spark, tmp_path):
    from pyspark.sql import functions as F

    from tidemark.sources.versioned import BUCKETS, VersionedTable

    t = VersionedTable(spark, str(tmp_path / "s")).create("k int, v string, _start_lsn string, _commit_ts timestamp_ntz", {BUCKETS: "8"})
    images = spark.range(200).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v"), F.lit("0x1").alias("_start_lsn"), F.lit(None).cast("timestamp_ntz").alias("_commit_ts"), F.lit(2).alias("_operation"))
    t.merge_images(images, ["k"])
    before = t._paths(None)
    assert len(before) == 8 and t.read().count() == 200
    one = images.where("k = 5").withColumns({"v": F.lit("b"), "_start_lsn": F.lit("0x2")})
    gone = images.where("k = 6").withColumns({"_operation": F.lit(1), "_start_lsn": F.lit("0x2")})
    t.merge_images(one.unionByName(gone), ["k"])
    assert 6 <= len(set(before) & set(t._paths(None))) < 8
    got = {r["k"]: r["v"] for r in t.read().collect()}
    assert len(got) == 199 and got[5] == "b" and 6 not in got and t.read(1).count() == 200
    t.merge_images(images.limit(0), ["k"])
    t.merge_images(images.where("k = 1"), ["k"], rebuild=True)
    assert [r["k"] for r in t.read().collect()] == [1]
