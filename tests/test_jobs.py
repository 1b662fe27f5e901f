"""The feed, the raw table, the verdict, the current state and their repair, on a change database in files."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import lsn
from tidemark.sources.capture import CaptureStore
from tidemark.sources.versioned import Conflict, VersionedTable
from tidemark.streaming import finality, jobs

START = datetime(2026, 1, 1, 13, 50)


@pytest.fixture
def db(tmp_path):
    store = CaptureStore(str(tmp_path / "db"))
    store.add_table("orders", [("order_id", "int"), ("status", "string")], ["order_id"], "dbo_orders")
    tables = jobs.Tables(*[str(tmp_path / n) for n in ("bronze", "facts", "control", "silver")])
    return store, tables, str(tmp_path / "checkpoint")


def fill(store, n=4, rows=3, at=START):
    for i in range(n):
        store.commit(at + timedelta(seconds=i), "orders", [("insert", {"order_id": rows * i + j, "status": "new"}) for j in range(rows)])


def silver(spark, tables):
    return {r["order_id"]: r["status"] for r in VersionedTable(spark, tables.silver).read().collect()}


def source(store):
    return {r["order_id"]: r["status"] for r in store.rows("orders")}


def apply(spark, tables):
    return jobs.apply_changes(spark, tables, instances=["dbo_orders"], keys=["order_id"])


def test_stream_restart_verdict_and_state(spark, db):
    store, tables, checkpoint = db
    fill(store)
    assert jobs.run_stream(spark, store, "orders", tables, checkpoint, "a", options={"numPartitions": 3}) == datetime(2026, 1, 1, 13)
    assert VersionedTable(spark, tables.bronze).read().count() == 12
    store.commit(START + timedelta(minutes=1), "orders", [("update", {"order_id": 1, "status": "paid"}), ("delete", {"order_id": 2}), ("update", {"order_id": 50, "status": "moved", "_old": {"order_id": 3}})])
    assert apply(spark, tables).bronze_found
    jobs.run_stream(spark, store, "orders", tables, checkpoint, "a")
    result = apply(spark, tables)
    assert not result.rebuilt and silver(spark, tables) == source(store)
    assert finality.is_final(spark, tables.control, tables.silver, datetime(2026, 1, 1, 13))
    store.idle(START + timedelta(hours=2))
    assert jobs.run_stream(spark, store, "orders", tables, checkpoint, "a") == datetime(2026, 1, 1, 15)
    facts = VersionedTable(spark, tables.facts).read().orderBy("batch_id").collect()
    assert [f["rows"] for f in facts][0] == 12 and facts[1]["deletes"] == 1 and facts[1]["updates"] == 2 and facts[-1]["rows"] == 0
    assert apply(spark, tables).finalized_until == datetime(2026, 1, 1, 15)


def test_replayed_batches_and_reset_checkpoints(spark, db):
    from tidemark.streaming.sink import bronze_writer

    store, tables, checkpoint = db
    fill(store)
    jobs.run_stream(spark, store, "orders", tables, checkpoint, "a")
    bronze, facts = VersionedTable(spark, tables.bronze), VersionedTable(spark, tables.facts)
    rows = bronze.read()
    write = bronze_writer(bronze, "a", facts)
    write(rows.drop("_batch_id", "_snapshot", "_chunk"), 0)
    assert bronze.read().count() == 12 and facts.read().count() == 1
    write(rows.drop("_batch_id", "_snapshot", "_chunk"), 1)
    with pytest.raises(ValueError, match="checkpoint was reset"):
        write(rows, 0)


def test_loss_fails_or_takes_a_new_snapshot(spark, db):
    store, tables, checkpoint = db
    fill(store)
    jobs.run_stream(spark, store, "orders", tables, checkpoint, "a")
    apply(spark, tables)
    store.commit(START + timedelta(minutes=5), "orders", [("delete", {"order_id": 0})])
    at = store.commit(START + timedelta(minutes=6), "orders", [("insert", {"order_id": 99, "status": "late"})])
    store.cleanup("dbo_orders", lsn.after(at))
    with pytest.raises(Exception) as e:
        jobs.run_stream(spark, store, "orders", tables, checkpoint, "a")
    assert jobs.check_loss(e.value)
    jobs.run_stream(spark, store, "orders", tables, checkpoint, "a", on_loss="resnapshot")
    assert apply(spark, tables).rebuilt and silver(spark, tables) == source(store)
    assert jobs.generation(checkpoint)["generation"] == 1


def test_backfill_beside_changes(spark, db):
    store, tables, checkpoint = db
    fill(store, 5, 8)
    jobs.run_stream(spark, store, "orders", tables, checkpoint, "s", options={"startingPosition": "latest"})
    jobs.backfill(spark, store, "orders", tables, "b", key="order_id", chunk_rows=10, waves=1)
    apply(spark, tables)
    assert 0 < len(silver(spark, tables)) < 40
    store.commit(START + timedelta(minutes=2), "orders", [("delete", {"order_id": 1}), ("update", {"order_id": 30, "status": "paid"})])
    jobs.run_stream(spark, store, "orders", tables, checkpoint, "s")
    at = jobs.backfill(spark, store, "orders", tables, "b", key="order_id", chunk_rows=10)
    assert apply(spark, tables).rebuilt and silver(spark, tables) == source(store)
    from tidemark.operators import audit, facts

    f = facts.chunks_of(VersionedTable(spark, tables.facts).read(), at).collect()
    held = {r["_chunk"]: (r["n"], r["m"]) for r in VersionedTable(spark, tables.bronze).read().where("_chunk is not null").groupBy("_chunk").agg(F.count("*").alias("n"), F.min("_start_lsn").alias("m")).collect()}
    assert audit.check_chunks(at, [r.asDict() | {"stamp": r["max_lsn"]} for r in f], held) == []


def test_bootstrap_reconcile_and_schema_change(spark, db):
    store, tables, checkpoint = db
    fill(store)
    store.cleanup("dbo_orders", lsn.after(store.newest()))
    jobs.run_stream(spark, store, "orders", tables, checkpoint, "a", bootstrap=True)
    store.commit(START + timedelta(minutes=1), "orders", [("insert", {"order_id": 70, "status": "x"})])
    store.alter("orders", "ALTER TABLE orders ADD note varchar(10)")
    jobs.run_stream(spark, store, "orders", tables, checkpoint, "a", bootstrap=True)
    assert apply(spark, tables).rebuilt and silver(spark, tables) == source(store)
    assert [r["event"] for r in VersionedTable(spark, tables.facts).read().where("event is not null").collect()].count("schema_change") == 1
    truth = spark.createDataFrame([(k, "new" if k != 5 else "odd") for k in source(store) if k != 7] + [(1000, "new")], "order_id int, status string")
    got = jobs.reconcile(spark, truth, tables, keys=["order_id"], bucket_rows=4, sample=1.0, seed=1)
    assert got.counts == {"MISSING_SOURCE": 1, "MISSING_TARGET": 1, "RECORD_DIFF": 2}
    store.set_type("dbo_orders", "order_id", "string")
    store.commit(START + timedelta(minutes=3), "orders", [("insert", {"order_id": 71, "status": "x"})])
    q = spark.read.format("tidemark_snapshot").options(path=store.path, table="orders").load()
    assert q.schema["order_id"].dataType.simpleString() == "string"


def test_switch_to_a_newer_instance(spark, db):
    store, tables, checkpoint = db
    fill(store, 2)
    store.add_instance("orders", "dbo_orders_v2", [("order_id", "int"), ("status", "string"), ("note", "string")])
    store.commit(START + timedelta(minutes=1), "orders", [("insert", {"order_id": 80, "status": "n", "note": "hello"})])
    jobs.run_stream(spark, store, "orders", tables, checkpoint, "a")
    rows = VersionedTable(spark, tables.bronze).read().collect()
    assert sorted((r["_capture_instance"], r["note"]) for r in rows) == [("dbo_orders", None)] * 6 + [("dbo_orders_v2", "hello")]
    jobs.apply_changes(spark, tables, instances=["dbo_orders", "dbo_orders_v2"], keys=["order_id"])
    assert silver(spark, tables) == source(store)


def test_fan_out(spark, tmp_path):
    store = CaptureStore(str(tmp_path / "db"))
    for t in ("orders", "people"):
        store.add_table(t, [("id", "int"), ("name", "string")], ["id"], f"dbo_{t}")
        store.commit(START, t, [("insert", {"id": 1, "name": t})])
    with pytest.raises(ValueError, match="{ci}"):
        jobs.start_many(spark, store, ["orders"], jobs.Tables("x", "y", "z"), "c", "a")
    at = lambda n: str(tmp_path / n)
    qs = jobs.start_many(spark, store, ["orders", "people"], jobs.Tables(at("{ci}/bronze"), at("{ci}/facts"), at("{ci}/control")), at("{ci}/checkpoint"), "{ci}")
    assert jobs.await_all(qs) == {}
    assert [r["name"] for r in VersionedTable(spark, at("people/bronze")).read().collect()] == ["people"]
    jobs.stop_all(qs)


def test_versions_conflicts_and_columns(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"))
    t.append(spark.createDataFrame([(1, "a")], "k int, v string"), txn=("x", 1))
    assert t.append(spark.createDataFrame([(1, "a")], "k int, v string"), txn=("x", 1)) is None
    t.append(spark.createDataFrame([(2, "b", 1.5)], "k int, v string, w double"))
    assert t.read(0).count() == 1 and {tuple(r) for r in t.read().collect()} == {(1, "a", None), (2, "b", 1.5)}
    with pytest.raises(Conflict):
        t.replace(t.read(), base=0)
    with pytest.raises(Exception, match="does not hold"):
        t.append(spark.createDataFrame([("z",)], "k string"))
    assert t.history().count() == 2 and t.last_txn("x") == 1


def test_migrations(spark, tmp_path, monkeypatch):
    from tidemark.sources import migrations

    t = VersionedTable(spark, str(tmp_path / "control")).create("table_name string, finalized_until timestamp_ntz")
    assert migrations.migrate(t, "control") == 2 and "snapshot_wave" in t.schema().names and migrations.migrate(t, "control") == 0
    monkeypatch.setitem(migrations.STEPS, "control", (*migrations.STEPS["control"], migrations.Step(3, "x int", breaking=True)))
    assert migrations.migrate(t, "control") == 1
    monkeypatch.undo()
    with pytest.raises(migrations.TooNew):
        migrations.migrate(t, "control")


def test_tracker_and_freshness(spark, db):
    store, tables, checkpoint = db
    fill(store)
    q = jobs.stream(spark, store, "orders", tables, checkpoint, "a")
    tracker = finality.Tracker(spark, tables.control, "t", str(q.id))
    q.awaitTermination()
    from tidemark.streaming.jobs import checkpoint_of, committed_offset

    assert committed_offset(checkpoint_of(checkpoint, 0))["lsn"] == store.newest()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
    tracker.close()
    assert finality.finalized_until(spark, tables.control, "t") in (None, datetime(2026, 1, 1, 13))
    finality.advance(spark, tables.control, "t", {"lsn": store.newest(), "commit_ts": "2026-01-01 15:10:00"})
    assert finality.advance(spark, tables.control, "t", {"lsn": store.newest(), "commit_ts": "2026-01-01 12:10:00"}) == datetime(2026, 1, 1, 15)
    row = finality.freshness(spark, tables.control, datetime(2026, 1, 1, 16)).first()
    assert row["behind_seconds"] == 3600


def test_capped_batches_and_skipped_loss(spark, tmp_path):
    from tidemark.sources.feed import ChangeReader, Options, _schema, captured

    store = CaptureStore(str(tmp_path / "db"))
    store.add_table("orders", [("order_id", "int")], ["order_id"], "i")
    for i in range(10):
        store.commit(START + timedelta(seconds=i), "orders", [("insert", {"order_id": 3 * i + j}) for j in range(3)])
    options = Options({"path": store.path, "table": "orders", "maxCommits": "4"})
    columns = captured(store, options)
    reader = ChangeReader(options, columns, _schema(columns, True))
    at, sizes = reader.initialOffset(), []
    while (end := reader.latestOffset()) != at:
        sizes.append(sum(b.num_rows for p in reader.partitions(at, end) for b in reader.read(p)))
        at = end
    assert sizes == [12, 12, 6]
    store.cleanup("i", lsn.after(store.newest()))
    reader = ChangeReader(Options(options | {"failOnDataLoss": "false"}), columns, _schema(columns, True))
    parts = reader.partitions({"lsn": lsn.ZERO}, {"lsn": store.newest()})
    assert [e["event"] for e in parts[-1].events] == ["data_skipped"] and sum(b.num_rows for p in parts for b in reader.read(p)) == 0


def test_file_log_batches_end_on_commits(spark, tmp_path):
    from tidemark.sources import filelog

    rows = [(lsn.from_int(16 * i), j, lsn.from_int(16 * i + j), 2, 10 * i + j) for i in range(10) for j in range(3)]
    log = spark.createDataFrame(rows, "_start_lsn string, _command_id int, _seqval string, _operation int, k int")
    filelog.write_groups(log, str(tmp_path / "log"), 4)
    seen = []
    stream = filelog.read_groups(spark, str(tmp_path / "log"), log.schema)
    q = stream.writeStream.foreachBatch(lambda df, i: seen.append(sorted({r["_start_lsn"] for r in df.collect()}))).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(len, seen)) == [2, 4, 4] and sorted(x for s in seen for x in s) == sorted({r[0] for r in rows})


def test_errors_by_kind():
    from tidemark import api

    assert api.is_data_loss(api.DataLoss("x")) and not api.is_schema_changed(api.DataLoss("x"))
    assert api.is_schema_changed(RuntimeError("Spark says tidemark.functions.types.SchemaChanged: y"))
