"""Queries that run the jobs: streams, snapshots, tables and checks over a feed made of the test tables, each with the SQL of what must be there at the end."""

from __future__ import annotations

import json
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import testlog as T
from .folders import work_folder
from .functions import bounds, clock, keys, lsn, types
from .operators import audit, current, facts
from .plans import tiles
from .queries import _DIFF, _IMAGE, S, query
from .sources import feed as sources
from .sources.logfeed import LogFeed, resolve
from .sources.versioned import VersionedTable
from .streaming import finality, jobs, lock

_MASKED = f"CASE WHEN _start_lsn < '{S}' THEN NULL ELSE event_type END AS event_type"


def _changes(log: DataFrame) -> DataFrame:
    return log.select(F.col("_start_lsn").alias("lsn"), F.col("_seqval").alias("seq"), F.col("_operation").alias("op"), F.col("_command_id").alias("command"), "user_id", "event_type", "value")


def _feed(spark: SparkSession, d: str) -> LogFeed:
    """The change log as a feed: an older instance without event_type up to commit 500, a newer one from there on, and the table as it is at the end."""
    f = LogFeed.create(work_folder(spark, "feed"))
    commits = T.timeline(spark, d, ordered=True).select(F.col("start_lsn").alias("lsn"), F.col("commit_ts").alias("ts"))
    older, newer = (_changes(log) for log in T.changes_in_order(spark, d, 500))
    with ThreadPoolExecutor(1) as beside:
        timeline = beside.submit(f.put_timeline, commits, ordered=True)
        f.put_instance("events", "dbo_events", T.pos(0), older.drop("event_type"), keys=["user_id"], ordered=True)
        f.put_instance("events", "dbo_events_2", S, newer, keys=["user_id"], ordered=True)
        timeline.result()
    return f


def _with_table(spark: SparkSession, d: str, f: LogFeed) -> LogFeed:
    f.put_table("events", current.state(T.log(spark, d), ["user_id"], ["user_id", "event_type", "value"]).drop("_start_lsn", "_commit_ts"), ["user_id"])
    return f


def _orders(spark: SparkSession, d: str, f: LogFeed) -> LogFeed:
    """Orders as a table of its own whose rows were inserted by the first hundred commits."""
    o = T.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    at = T.position(F.col("o_orderkey") % 100)
    f.put_instance("orders", "dbo_orders", T.pos(0), o.select(at.alias("lsn"), at.alias("seq"), F.lit(2).alias("op"), (F.col("o_orderkey") % 1000 + 1).cast("int").alias("command"), "*"), keys=["o_orderkey"])
    f.put_table("orders", o, ["o_orderkey"])
    return f


def _tables(spark: SparkSession) -> tuple[jobs.Tables, str]:
    root = work_folder(spark, "tables")
    return jobs.Tables(f"{root}/bronze", f"{root}/facts", f"{root}/control", f"{root}/silver"), f"{root}/checkpoint"


_COLUMNS = ["_capture_instance", "_start_lsn", "_seqval", "_operation", "_command_id", "_commit_ts", "user_id", "event_type", "value"]
_BOTH = ["dbo_events", "dbo_events_2"]


@query(f"SELECT _capture_instance, _start_lsn, _seqval, _operation, _command_id, _commit_ts, user_id, {_MASKED}, value FROM log")
def s_stream_bronze(spark, d):
    """One run of the stream, its batch read by four ranges across the switch of instances."""
    f, (t, checkpoint) = _feed(spark, d), _tables(spark)
    jobs.run_stream(spark, f, "events", t, checkpoint, "s", options={"numPartitions": 4, "leastRows": 500})
    return VersionedTable(spark, t.bronze).read().select(*_COLUMNS)


def _restarted(spark: SparkSession, d: str, after=lambda *a: None) -> jobs.Tables:
    """Batches of 400 commits, up to 128 of them in a micro-batch, stopped after the second and started again."""
    f, (t, checkpoint) = _feed(spark, d), _tables(spark)
    for until in (T.pos(799), f.newest()):
        jobs.run_stream(spark, f, "events", t, checkpoint, "s", options={"maxCommits": 400, "batchesAtOnce": 128, "until": min(until, f.newest())})
        after(spark, t)
    return t


_BATCHES = "SELECT t.c // 400 AS batch_id, count(*) AS rows, min(_start_lsn) AS min_lsn, max(_start_lsn) AS max_lsn, max(_commit_ts) AS max_commit_ts, count(*) FILTER (_operation = 1) AS deletes, count(*) FILTER (_operation = 2) AS inserts, count(*) FILTER (_operation = 4) AS updates FROM log l JOIN timeline t ON t.start_lsn = l._start_lsn GROUP BY 1"


@query(f"SELECT *, max_lsn AS end_lsn FROM ({_BATCHES})")
def s_restart(spark, d):
    """Facts of capped batches over a restart."""
    t = _restarted(spark, d)
    return VersionedTable(spark, t.facts).read().where("event is null").select("batch_id", "rows", "min_lsn", "max_lsn", "max_commit_ts", "deletes", "inserts", "updates", "end_lsn")


@query(f"SELECT user_id, {_MASKED}, value, _start_lsn, _commit_ts FROM ({_IMAGE.format('')}) WHERE _operation NOT IN (1, 3)")
def s_stream_silver(spark, d):
    """The current state, folded after each of two runs."""
    t = _restarted(spark, d, lambda s, t: jobs.apply_changes(s, t, instances=_BOTH, keys=["user_id"]))
    return VersionedTable(spark, t.silver).read().select("user_id", "event_type", "value", "_start_lsn", "_commit_ts")


@query("SELECT date_trunc('hour', max(_commit_ts))::TIMESTAMP AS finalized_until, max(_start_lsn) AS applied_lsn FROM log")
def s_verdict(spark, d):
    """How far bronze is complete by the control table, and how far silver has followed."""
    t = _restarted(spark, d, lambda s, t: jobs.apply_changes(s, t, instances=_BOTH, keys=["user_id"]))
    until = finality.finalized_until(spark, t.control, t.silver)
    return types.from_rows(spark, [(until, finality.row_of(spark, t.control, t.silver)["applied_lsn"])], types.struct_of("finalized_until timestamp_ntz, applied_lsn string"))


@query(f"SELECT 'dbo_events' AS old, 'dbo_events_2' AS new, '{S}' AS start_lsn FROM (SELECT 1 FROM timeline WHERE start_lsn >= '{S}' LIMIT 1)")
def s_switch_event(spark, d):
    """What the stream says of the switch of instances."""
    f, (t, checkpoint) = _feed(spark, d), _tables(spark)
    jobs.run_stream(spark, f, "events", t, checkpoint, "s")
    found = [lock.switch_of(e["detail"]) for e in jobs.events_of(spark, t) if e["event"] == "capture_instance_switched"]
    return spark.createDataFrame([(s["old"], s["new"], s["start_lsn"]) for s in found], "old string, new string, start_lsn string")


@query(f"SELECT _start_lsn, count(*) AS rows, 1 AS skipped FROM log WHERE _start_lsn >= '{T.pos(40)}' GROUP BY 1")
def i5_retention_guard(spark, d):
    """A stream that may skip what was purged: the rows that are left, and how often it said so."""
    f, (t, checkpoint) = _feed(spark, d), _tables(spark)
    f.cleanup("dbo_events", T.pos(40))
    jobs.run_stream(spark, f, "events", t, checkpoint, "s", options={"startingPosition": lsn.ZERO, "failOnDataLoss": "false"})
    skipped = sum(e["event"] == "data_skipped" for e in jobs.events_of(spark, t))
    return VersionedTable(spark, t.bronze).read().groupBy("_start_lsn").agg(F.count("*").alias("rows")).withColumn("skipped", F.lit(skipped))


@query(f"SELECT user_id, event_type, value FROM ({_IMAGE.format('')}) WHERE _operation NOT IN (1, 3)")
def s_recover(spark, d):
    """Changes are purged before they are read; a new snapshot in a new generation repairs the state."""
    f, (t, checkpoint) = _with_table(spark, d, _feed(spark, d)), _tables(spark)
    jobs.run_stream(spark, f, "events", t, checkpoint, "s", options={"until": T.pos(20)})
    jobs.apply_changes(spark, t, instances=_BOTH, keys=["user_id"])
    for i in _BOTH:
        f.cleanup(i, max(lsn.after(f.newest()), S))
    jobs.run_stream(spark, f, "events", t, checkpoint, "s", on_loss="resnapshot")
    jobs.apply_changes(spark, t, instances=_BOTH, keys=["user_id"])
    return VersionedTable(spark, t.silver).read().select("user_id", "event_type", "value")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def s_backfill(spark, d):
    """A table read in chunks, stopped after a wave and gone on with, as the state that its snapshot leaves."""
    t = _backfilled(spark, d)
    jobs.apply_changes(spark, t, instances=["dbo_orders"], keys=["o_orderkey"])
    return VersionedTable(spark, t.silver).read().select("o_orderkey", "o_orderstatus", "o_totalprice")


def _backfilled(spark: SparkSession, d: str) -> jobs.Tables:
    f, (t, _) = _orders(spark, d, _feed(spark, d)), _tables(spark)
    jobs.backfill(spark, f, "orders", t, "b", key="o_orderkey", chunk_rows=5000, chunks_per_wave=4, waves=1)
    jobs.backfill(spark, f, "orders", t, "b", key="o_orderkey", chunk_rows=5000, chunks_per_wave=4)
    return t


@query("SELECT 0 AS failures, count(*) AS rows FROM orders")
def j5_chunks_of_backfill(spark, d):
    """Chunk checks of a finished backfill, and the rows that its completion counts."""
    t = _backfilled(spark, d)
    wrong = len(jobs.chunk_failures(spark, t))
    done = next(e for e in jobs.events_of(spark, t) if e["event"] in facts.COMPLETED)
    return spark.createDataFrame([(wrong, done["rows"])], "failures int, rows bigint")


@query("SELECT chunk::INT AS chunk, count(*) AS rows, max(conv_id * 100000 + turn)::BIGINT AS newest FROM (SELECT *, (row_number() OVER (ORDER BY conv_id, turn) - 1) // 200 AS chunk FROM conversations) GROUP BY 1")
def s_backfill_keyset(spark, d):
    """Chunks over a composite key, as bronze holds them."""
    f, (t, _) = _feed(spark, d), _tables(spark)
    c = T.table(spark, d, "conversations").select("conv_id", "turn", "role")
    none = c.limit(0).select(F.lit("").alias("lsn"), F.lit("").alias("seq"), F.lit(2).alias("op"), F.lit(1).alias("command"), "*")
    f.put_instance("conversations", "dbo_conversations", T.pos(0), none, keys=["conv_id", "turn"])
    f.put_table("conversations", c, ["conv_id", "turn"])
    jobs.backfill(spark, f, "conversations", t, "b", key=["conv_id", "turn"], chunk_rows=200, chunks_per_wave=64)
    b = VersionedTable(spark, t.bronze).read()
    return b.groupBy(F.col("_chunk").alias("chunk")).agg(F.count("*").alias("rows"), F.max(F.col("conv_id") * 100000 + F.col("turn")).alias("newest"))


@query("SELECT 'events' AS name, count(*) AS rows FROM log UNION ALL SELECT 'orders', count(*) FROM orders")
def s_fan_out(spark, d):
    """Two streams at once, each with tables of its own."""
    f, root = _orders(spark, d, _feed(spark, d)), work_folder(spark, "many")
    at = lambda n: f"{root}/{{ci}}/{n}"
    running = jobs.start_many(spark, f, ["events", "orders"], jobs.Tables(at("bronze"), at("facts"), at("control")), at("checkpoint"), "{ci}")
    failed = jobs.await_all(running)
    if failed:
        raise RuntimeError(str(failed))
    rows = [VersionedTable(spark, f"{root}/{n}/bronze").read().agg(F.count("*").alias("rows")).select(F.lit(n).alias("name"), "rows") for n in ("events", "orders")]
    return rows[0].unionByName(rows[1])


@query("SELECT o_orderkey, o_orderstatus, 'dbo_orders' AS _capture_instance, 0 AS _operation FROM orders")
def a8_snapshot_partitions(spark, d):
    """A snapshot read by eight tasks, each of its own row groups."""
    f = _orders(spark, d, _feed(spark, d))
    sources.register(spark)
    return jobs.rows_of(spark, f, "orders", numPartitions=8).select("o_orderkey", "o_orderstatus", "_capture_instance", "_operation")


@query("SELECT count(*) AS n FROM orders")
def a18_row_estimate(spark, d):
    """Rows by the files' footers: nothing is scanned."""
    f = _orders(spark, d, _feed(spark, d))
    return spark.createDataFrame([(f.estimate("orders"),)], "n bigint")


@query("SELECT name, instance, created FROM (VALUES ('dbo_events', 'dbo_events', 0), ('dbo_events', 'dbo_events_2', 500), ('DBO_EVENTS_2', 'dbo_events', 0), ('DBO_EVENTS_2', 'dbo_events_2', 500), ('dbo_orders', 'dbo_orders', 0)) t(name, instance, created)")
def a14_listed_instances(spark, d):
    """All instances of the table that a name means: by exact name, else ignoring case."""
    found = _orders(spark, d, _feed(spark, d)).all_instances()
    commit = lambda at: (lsn.to_int(at) - 1000) // 16
    rows = [(n, i["name"], commit(i["created"])) for n in ("dbo_events", "DBO_EVENTS_2", "dbo_orders") for i in resolve(found, n)]
    return spark.createDataFrame(rows, "name string, instance string, created int")


@query("SELECT * FROM (SELECT 0 AS version, 0 AS rows, 2 AS columns UNION ALL SELECT 1, count(*) FILTER (o_orderstatus = 'F'), 2 FROM orders UNION ALL SELECT 2, count(*), 3 FROM orders UNION ALL SELECT 3, count(*) FILTER (o_orderstatus <> 'O'), 3 FROM orders)")
def a27_versions(spark, d):
    """Every version of a table after a create, an append, the same again, one with a new column, and a replace."""
    o = T.table(spark, d, "orders")
    t = VersionedTable(spark, work_folder(spark, "versions")).create("o_orderkey bigint, o_orderstatus string")
    for _ in range(2):
        t.append(o.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus"), txn=("app", 1))
    t.append(o.where("o_orderstatus <> 'F'").select("o_orderkey", "o_orderstatus", "o_totalprice"), txn=("app", 2))
    t.upsert(lambda now: now.where("o_orderstatus <> 'O'"))
    out = None
    for v in range(t.version() + 1):
        now = t.read(v)
        row = now.agg(F.count("*").alias("rows")).select(F.lit(v).alias("version"), "rows", F.lit(len(now.columns)).alias("columns"))
        out = row if out is None else out.unionByName(row)
    return out


@query(None)
def j2_reconcile(spark, d):
    """A whole reconcile of a faulty state, through its report table: every bucket's rows compared."""
    t, _ = _tables(spark)
    VersionedTable(spark, t.silver).append(T.faulty_orders(spark, d))
    got = jobs.reconcile(spark, T.source_orders(spark, d), t, keys=["o_orderkey"], bucket_rows=1000, sample=1.0, seed=1, report=f"{t.silver}-report")
    return got.failures


@query(None)
def j2_report_buckets(spark, d):
    """The merged buckets of the report, by status, and the rows that they hold."""
    t, _ = _tables(spark)
    VersionedTable(spark, t.silver).append(T.faulty_orders(spark, d))
    got = jobs.reconcile(spark, T.source_orders(spark, d), t, keys=["o_orderkey"], bucket_rows=1000, sample=0.0)
    return got.buckets.agg(F.sum("source_rows").alias("source_rows"), F.sum("target_rows").alias("target_rows"))


def _collected(df: DataFrame, *cols: str) -> list[tuple]:
    """Rows of a small aggregate, in order."""
    return [tuple(r) for r in df.orderBy(*cols).collect()]


@query(None)
def d6_bucket_merge(spark, d):
    s, t = (audit.buckets(x, "o_orderkey", "int", 256) for x in (T.source_orders(spark, d), T.faulty_orders(spark, d)))
    fine = [tuple(r)[:5] for r in _collected(audit.compare_buckets(s, t), "bucket")]
    rows = [(m[0], m[1], m[2], m[4]) for m in audit.merge_buckets(fine, 1000)]
    return spark.createDataFrame(rows, "first bigint, last bigint, source_rows bigint, target_rows bigint")


@query(None)
def d8_tile_merge(spark, d):
    log = T.log(spark, d).withColumn("i", F.floor((lsn.as_number(F.col("_start_lsn")) - 1000) / 256))
    found = log.groupBy("i").agg(F.max("_start_lsn").alias("hi"), F.count("*").alias("n"))
    return spark.createDataFrame(tiles.merge_tiles([(hi, n) for _, hi, n in _collected(found, "i")], 1000), "hi string, rows bigint")


@query("SELECT max(hi) AS end_lsn, round(median(n), 1)::DOUBLE AS source_rtt_ms, sum(n)::BIGINT AS read_seconds, NULL::BIGINT AS network_wait_ms FROM (SELECT max(_start_lsn) AS hi, count(*) AS n FROM log l JOIN timeline t ON t.start_lsn = l._start_lsn GROUP BY t.c // 64)")
def d18_metrics_fold(spark, d):
    """What the ranges of a batch measured, as one: here each measured its rows, and one did not know its waits."""
    log = T.log(spark, d).withColumn("i", F.floor((lsn.as_number(F.col("_start_lsn")) - 1000) / 1024))
    ranges = _collected(log.groupBy("i").agg(F.max("_start_lsn").alias("hi"), F.count("*").alias("n")), "i")
    got = facts.fold_metrics([{"to_lsn": hi, "rtt_ms": n, "read_seconds": n, "read_mb": 0, "network_wait_ms": n if i else None} for i, hi, n in ranges])
    row = (got["end_lsn"], None if got["source_rtt_ms"] is None else float(got["source_rtt_ms"]), got["read_seconds"], got["network_wait_ms"])
    return spark.createDataFrame([row], "end_lsn string, source_rtt_ms double, read_seconds bigint, network_wait_ms bigint")


@query(None)
def j5_chunk_checks(spark, d):
    """Chunks of 5,000 keys as orders announces them, against what a faulty copy holds."""
    count = lambda df: {r[0]: r[1] for r in _collected(df.where("o_orderkey < 100000000").groupBy(F.expr("cast(o_orderkey div 5000 as int)").alias("c")).agg(F.count("*")), "c")}
    said, held = count(T.source_orders(spark, d)), count(T.faulty_orders(spark, d))
    last = max(said, default=0)
    chunks = [{"chunk": c, "lo": json.dumps(5000 * c) if c else None, "hi": json.dumps(5000 * (c + 1)), "last": c == last, "rows": n} for c, n in said.items()]
    wrong = audit.check_chunks(T.pos(1), chunks, {c: (n, T.pos(1)) for c, n in held.items()})
    return spark.createDataFrame(wrong, "failure_type string, chunk int, detail string")


@query("SELECT ceil(0.25 * count(*))::BIGINT AS chosen FROM (SELECT DISTINCT o_orderkey // 256 AS b FROM orders)")
def f7_bucket_sample(spark, d):
    """How many of the matching buckets a quarter of them is."""
    found = _collected(audit.buckets(T.source_orders(spark, d), "o_orderkey", "int", 256).select("bucket"), "bucket")
    return spark.createDataFrame([(len(set(audit.pick([(b, "MATCH") for (b,) in found], 0.25, 7))),)], "chosen bigint")


@query("SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN lower(n_name) || '!' ELSE lower(n_name) END AS n_name, n_regionkey, 1 AS schema_changes FROM nation WHERE n_regionkey <> 2")
def s_simulator(spark, d):
    """The file simulator: its first commits are purged, so the stream begins with a snapshot; then updates, deletes and a schema change."""
    from datetime import datetime, timedelta

    from .sources.capture import CaptureStore

    nations = [(r["n_nationkey"], r["n_name"].lower(), r["n_regionkey"]) for r in T.table(spark, d, "nation").orderBy("n_nationkey").collect()]  # a fixed 25 rows
    store = CaptureStore(work_folder(spark, "db").removeprefix("file://").removeprefix("file:"))
    store.add_table("nation", [("n_nationkey", "int"), ("n_name", "string"), ("n_regionkey", "int")], ["n_nationkey"], "dbo_nation")
    t, checkpoint = _tables(spark)
    row = lambda k, n, r: {"n_nationkey": k, "n_name": n, "n_regionkey": r}
    at = datetime(2026, 1, 1)
    for i in range(5):
        store.commit(at + timedelta(minutes=i), "nation", [("insert", row(*x)) for x in nations if x[2] == i])
    store.cleanup("dbo_nation", lsn.after(store.newest()))
    jobs.run_stream(spark, store, "nation", t, checkpoint, "s", bootstrap=True)
    store.commit(at + timedelta(hours=1), "nation", [("update", row(k, n + "!", r)) for k, n, r in nations if r == 1])
    store.commit(at + timedelta(hours=2), "nation", [("delete", row(*x)) for x in nations if x[2] == 2])
    store.alter("nation", "ALTER TABLE nation ADD n_comment varchar(100)")
    store.idle(at + timedelta(hours=3))
    jobs.run_stream(spark, store, "nation", t, checkpoint, "s", bootstrap=True)
    jobs.apply_changes(spark, t, instances=["dbo_nation"], keys=["n_nationkey"])
    said = sum(e["event"] == "schema_change" for e in jobs.events_of(spark, t))
    return VersionedTable(spark, t.silver).read().select("n_nationkey", "n_name", "n_regionkey").withColumn("schema_changes", F.lit(said))


@query("SELECT max(start_lsn) AS lsn, date_trunc('day', max(commit_ts))::TIMESTAMP AS candidate FROM timeline")
def a33_progress_offset(spark, d):
    """The end of a stream's last batch by its progress report, and the verdict that this would give."""
    f, (t, checkpoint) = _feed(spark, d), _tables(spark)
    q = jobs.stream(spark, f, "events", t, checkpoint, "s")
    q.awaitTermination()
    end = finality.end_offset(json.loads(q.lastProgress.json))
    return spark.createDataFrame([(end["lsn"], finality.candidate(end, "day"))], "lsn string, candidate timestamp_ntz")


@query(f"""SELECT round((epoch_us(max(_commit_ts)) - (SELECT epoch_us(max(commit_ts)) FROM timeline WHERE start_lsn = CASE WHEN (SELECT max(start_lsn) FROM timeline) >= '{S}' THEN '{S}' ELSE '{T.pos(0)}' END)) / 3600000000, 2)::DOUBLE AS headroom,
  0.0::DOUBLE AS lag, count(*) AS rows, true AS measured, max(_start_lsn) AS end_lsn FROM log""")
def h19_measured_batch(spark, d):
    """What a batch was measured for: headroom over the purged end, lag behind the newest commit, and that reads were timed."""
    f, (t, checkpoint) = _feed(spark, d), _tables(spark)
    jobs.run_stream(spark, f, "events", t, checkpoint, "s")
    known = F.col("read_seconds").isNotNull() & (F.col("read_mb") > 0) & F.col("source_rtt_ms").isNotNull() & (F.col("capture_lag_seconds") > 0)
    return VersionedTable(spark, t.facts).read().where("event is null").select(F.col("retention_headroom_hours").alias("headroom"), F.col("ingestion_lag_seconds").alias("lag"), "rows", known.alias("measured"), "end_lsn")


@query(f"SELECT user_id, value, _start_lsn, (SELECT count(*) FROM timeline WHERE start_lsn = '{T.pos(0)}') AS warnings FROM log")
def i28_declared_columns(spark, d):
    """Declared columns leave out what an instance captures besides, and the batch's facts say so."""
    f, (t, checkpoint) = _feed(spark, d), _tables(spark)
    jobs.run_stream(spark, f, "events", t, checkpoint, "s", options={"columns": "user_id bigint, value double"})
    said = sum(len(json.loads(r["detail"])["warnings"]) for r in VersionedTable(spark, t.facts).read().where("event is null and detail is not null").collect())
    return VersionedTable(spark, t.bronze).read().select("user_id", "value", "_start_lsn").withColumn("warnings", F.lit(said).cast("bigint"))


@query(f"SELECT user_id, event_type, value FROM ({_IMAGE.format('')}) WHERE _operation NOT IN (1, 3) AND EXISTS (SELECT 1 FROM timeline WHERE start_lsn >= '{S}')")
def i25_snapshot_on_switch(spark, d):
    """After a batch that passed to the newer instance, a snapshot of the whole table."""
    f, (t, checkpoint) = _with_table(spark, d, _feed(spark, d)), _tables(spark)
    jobs.run_stream(spark, f, "events", t, checkpoint, "s", snapshot_on_switch="full")
    return VersionedTable(spark, t.bronze).read().where("_operation = 0").select("user_id", "event_type", "value")


@query("SELECT * FROM (VALUES ('b', 'chunked', true), ('b', 'full', false), ('c', 'chunked', false)) t(app_id, mode, allowed)")
def i17_mode_lock(spark, d):
    """Who may take which snapshot while a chunked one is open."""
    f, (t, _) = _orders(spark, d, _feed(spark, d)), _tables(spark)
    jobs.open_backfill(spark, f, "orders", t, "b", ["o_orderkey"], 5000)
    events = jobs.events_of(spark, t)

    def may(app: str, mode: str) -> bool:
        try:
            return lock.lock(events, mode, app) is not None
        except lock.SnapshotOpen:
            return False

    return spark.createDataFrame([(a, m, may(a, m)) for a, m in (("b", "chunked"), ("b", "full"), ("c", "chunked"))], "app_id string, mode string, allowed boolean")


@query("SELECT o_custkey, n, greatest(1, 60 // n)::INT AS rounds, n > 15 AS pause FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)")
def i24_wave_sizes(spark, d):
    """Rounds of a wave of a minute at a pace of so many seconds a round, and whether so little headroom pauses it."""
    from .plans.chunks import pause, wave_rounds

    found = _collected(T.table(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")), "o_custkey")
    return spark.createDataFrame([(k, n, wave_rounds(60, n), pause(40.0 - n, 0.0, 25.0)) for k, n in found], "o_custkey bigint, n bigint, rounds int, pause boolean")


# Functions


@query("SELECT event_id, ts + INTERVAL 1 MICROSECOND AS lower, ts AS upper, strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS text FROM events")
def h9_bound_coercion(spark, d):
    """Bounds of times with a seventh digit: the lower moves up, the upper is cut; and as text in milliseconds."""
    fine = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("7"))
    e = T.table(spark, d, "events")
    return e.select("event_id", bounds.coerced(fine, lower=True).alias("lower"), bounds.coerced(fine, lower=False).alias("upper"), bounds.text(F.col("ts"), "datetime").alias("text"))


@query("SELECT o_orderkey, strftime(DATE '1970-01-01' + (30 * (n + 1))::INT, '%Y-%m-%d') AS hi, o_orderkey AS lo FROM (SELECT o_orderkey, CAST(floor(date_diff('day', DATE '1970-01-01', o_orderdate::DATE) / 30) AS BIGINT) AS n FROM orders)")
def h8_ordinal_bounds(spark, d):
    """The end of each order's bucket of 30 days as a bound, and its key read back from one (H8, H13)."""
    o = T.table(spark, d, "orders").select("o_orderkey", keys.bucket(keys.ordinal(F.to_date("o_orderdate"), "date"), 30).alias("n"))
    return o.select("o_orderkey", keys.bound_of((F.col("n") + 1) * 30, "date").alias("hi"), F.from_json(F.to_json(F.struct("o_orderkey")), "o_orderkey bigint")["o_orderkey"].alias("lo"))


@query("""WITH p AS (SELECT unnest([3, 9, 10, 18, 20, 38]) AS p), t AS (SELECT p, unnest(range(0, p + 1)) AS s FROM p)
  SELECT 'decimal(' || a.p || ',' || a.s || ')' AS value, 'decimal(' || b.p || ',' || b.s || ')' AS into_, a.s <= b.s AND a.p - a.s <= b.p - b.s AS fits FROM t a, t b
  UNION ALL SELECT i.n, 'decimal(' || b.p || ',' || b.s || ')', b.p - b.s >= i.k FROM (VALUES ('tinyint', 3), ('smallint', 5), ('int', 10), ('bigint', 20)) i(n, k), t b""")
def h21_type_fits(spark, d):
    """Which decimals hold which decimals and whole numbers."""
    some = [f"decimal({p},{s})" for p in (3, 9, 10, 18, 20, 38) for s in range(p + 1)]
    rows = [(a, b, types.fits(a, b)) for a in (*some, "tinyint", "smallint", "int", "bigint") for b in some]
    return spark.createDataFrame(rows, "value string, into_ string, fits boolean")


@query("""SELECT * FROM (VALUES ('bit', 'boolean'), ('tinyint', 'smallint'), ('smallint', 'smallint'), ('int', 'int'), ('bigint', 'bigint'), ('real', 'float'), ('float', 'double'), ('money', 'decimal(19,4)'), ('smallmoney', 'decimal(10,4)'),
  ('decimal', 'decimal(9,3)'), ('numeric', 'decimal(9,3)'), ('date', 'date'), ('datetime', 'timestamp_ntz'), ('datetime2', 'timestamp_ntz'), ('smalldatetime', 'timestamp_ntz'), ('datetimeoffset', 'timestamp'), ('time', 'string'), ('nvarchar', 'string'),
  ('uniqueidentifier', 'string'), ('varbinary', 'binary'), ('rowversion', 'binary'), ('geography', NULL)) t(source, spark)""")
def h22_type_map(spark, d):
    """Source types as Spark types; an unmapped one is an error unless its column is declared."""

    def of(name: str) -> str | None:
        try:
            return types.spark_type(name, 9, 3)
        except types.UnmappedType:
            return None

    names = "bit tinyint smallint int bigint real float money smallmoney decimal numeric date datetime datetime2 smalldatetime datetimeoffset time nvarchar uniqueidentifier varbinary rowversion geography"
    return spark.createDataFrame([(n, of(n)) for n in names.split()], "source string, spark string")


@query("SELECT n_name, '`' || replace(n_name || '`', '`', '``') || '`' AS quoted FROM nation")
def h23_quoted_names(spark, d):
    names = [n for (n,) in _collected(T.table(spark, d, "nation").select("n_name"), "n_name")]
    return spark.createDataFrame([(n, keys.quoted(keys.identifier(n) + "`")) for n in names], "n_name string, quoted string")


@query("SELECT event_id, ts - INTERVAL 1 HOUR * CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 1 ELSE 2 END AS utc FROM events")
def i31_clock(spark, d):
    """A source's clock that was read anew: one fixed offset before, another after."""
    e = T.table(spark, d, "events")
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    return e.select("event_id", F.when(F.col("ts") < cut, clock.Clock(None, 60).utc(F.col("ts"))).otherwise(clock.Clock(None, 120).utc(F.col("ts"))).alias("utc"))


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def b16_computed_columns(spark, d):
    """Columns that the source computes are left out of what is compared and read."""
    c = T.table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", F.upper("c_name").alias("C_UPPER"))
    return without_computed(c, ["c_upper"])


def without_computed(df: DataFrame, computed: Iterable[str]) -> DataFrame:
    gone = {c.lower() for c in computed}
    return df.select(*[c for c in df.columns if c.lower() not in gone])


@query("SELECT _chunk, rows FROM (SELECT (o_orderkey // 5000)::INT AS _chunk, count(*) AS rows FROM orders GROUP BY 1)")
def d15_observed_chunk_rows(spark, d):
    """Rows of each chunk, counted while they pass."""
    from pyspark.sql import Observation

    o = T.table(spark, d, "orders").withColumn("_chunk", F.expr("cast(o_orderkey div 5000 as int)"))
    top = o.agg(F.max("_chunk")).first()[0]
    if top is None:
        return spark.createDataFrame([], "_chunk int, rows bigint")
    seen = Observation()
    o.observe(seen, *[F.count(F.when(F.col("_chunk") == i, 1)).alias(str(i)) for i in range(top + 1)]).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(int(i), n) for i, n in seen.get.items() if n], "_chunk int, rows bigint")


def _oracles() -> dict[str, Any]:
    from .queries import ORACLES

    diff = f"WITH {T.FAULTY} SELECT key, failure_type, detail FROM ({_DIFF})"
    ORACLES["j2_reconcile"] = diff
    ORACLES["j2_report_buckets"] = f"WITH {T.FAULTY} SELECT (SELECT count(*) FROM orders) AS source_rows, (SELECT count(*) FROM faulty) AS target_rows"
    ORACLES["j5_chunk_checks"] = f"WITH {T.FAULTY}, a AS (SELECT (o_orderkey // 5000)::INT AS chunk, count(*) AS n FROM orders GROUP BY 1), h AS (SELECT (o_orderkey // 5000)::INT AS chunk, count(*) AS n FROM faulty WHERE o_orderkey < 100000000 GROUP BY 1) SELECT 'CHUNK_ROWS' AS failure_type, a.chunk, 'announced ' || a.n || ', held ' || coalesce(h.n, 0) AS detail FROM a LEFT JOIN h ON h.chunk = a.chunk WHERE a.n <> coalesce(h.n, 0)"
    ORACLES["d6_bucket_merge"] = f"""WITH RECURSIVE {T.FAULTY}, b AS (SELECT o_orderkey // 256 AS b, 1 AS s, 0 AS t FROM orders UNION ALL SELECT o_orderkey // 256, 0, 1 FROM faulty),
  n AS (SELECT row_number() OVER (ORDER BY b) AS i, b, sum(s) AS s, sum(t) AS t FROM b GROUP BY b),
  g AS (SELECT i, b, 0 AS m, s, t FROM n WHERE i = 1 UNION ALL
    SELECT n.i, n.b, CASE WHEN greatest(g.s, g.t) < 1000 THEN g.m ELSE g.m + 1 END, CASE WHEN greatest(g.s, g.t) < 1000 THEN g.s + n.s ELSE n.s END, CASE WHEN greatest(g.s, g.t) < 1000 THEN g.t + n.t ELSE n.t END FROM g JOIN n ON n.i = g.i + 1)
  SELECT min(b) AS first, max(b) AS last, max(s)::BIGINT AS source_rows, max(t)::BIGINT AS target_rows FROM g GROUP BY m"""
    ORACLES["d8_tile_merge"] = f"""WITH RECURSIVE {T.LOG}, t AS (SELECT c // 16 AS i, max(start_lsn) AS hi, sum(n) AS n FROM (SELECT t.c, t.start_lsn, count(*) AS n FROM log l JOIN timeline t ON t.start_lsn = l._start_lsn GROUP BY ALL) GROUP BY 1),
  s AS (SELECT row_number() OVER (ORDER BY i) AS i, hi, n FROM t),
  g AS (SELECT i, hi, 0 AS tile, n AS run FROM s WHERE i = 1 UNION ALL SELECT s.i, s.hi, CASE WHEN g.run >= 1000 THEN g.tile + 1 ELSE g.tile END, CASE WHEN g.run >= 1000 THEN s.n ELSE g.run + s.n END FROM g JOIN s ON s.i = g.i + 1),
  m AS (SELECT tile, max(hi) AS hi, max(run) AS rows FROM g GROUP BY tile), z AS (SELECT max(tile) AS z FROM m)
  SELECT max(hi) AS hi, sum(rows)::BIGINT AS rows FROM m, z GROUP BY CASE WHEN tile = z AND z > 0 AND rows < 1000 THEN z - 1 ELSE tile END"""
    return ORACLES


_oracles()
