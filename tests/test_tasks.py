"""Tasks that read several capped batches, change rows handed out row group by row group, and small tables in one file."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import lsn
from tidemark.sources import logfeed, sidefiles
from tidemark.sources.capture import CaptureStore
from tidemark.sources.feed import ChangeReader, Options, _schema, captured
from tidemark.sources.logfeed import LogFeed
from tidemark.sources.versioned import VersionedTable
from tidemark.streaming import sink

START = datetime(2026, 1, 1)
N, SWITCH = 2_000, 901


def pos(i):
    return lsn.from_int(1000 + 16 * i)


@pytest.fixture
def log_feed(spark, tmp_path, monkeypatch):
    """2,000 commits of three rows each, apart from the commits 100 to 139, which are another table's; a newer instance from commit 901 on."""
    monkeypatch.setattr(logfeed, "_GROUP", 8192)
    feed = LogFeed.create(str(tmp_path / "feed"))
    at = F.concat(F.lit("0x"), F.lpad(F.hex(F.col("id") * 16 + 1000), 20, "0"))
    feed.put_timeline(spark.range(N).select(at.alias("lsn"), F.timestamp_micros(F.col("id") * 1_000_000).cast("timestamp_ntz").alias("ts")))
    rows = spark.range(N).where("id < 100 OR id >= 140").withColumn("command", F.explode(F.array([F.lit(i) for i in (2, 1, 3)])))
    rows = rows.select(at.alias("lsn"), at.alias("seq"), F.lit(2).alias("op"), "command", F.col("id").alias("k"), "id")
    feed.put_instance("t", "dbo_t", pos(0), rows.where(F.col("id") < SWITCH).drop("id"), keys=["k"])
    feed.put_instance("t", "dbo_t_2", pos(SWITCH), rows.where(F.col("id") >= SWITCH).drop("id"), keys=["k"])
    return feed


def whole(store, folder, tasks, lo, hi, **more):
    """(tasks, rows of each, rows by batch, measured end and events by batch) of one micro-batch of many capped ones."""
    given = {"path": store.path, "table": "t", "maxCommits": "40", "batchesAtOnce": "100", "events": folder} | more
    options = Options(given | ({"tasks": str(tasks)} if tasks else {}))
    columns = captured(store, options)
    reader = ChangeReader(options, columns, _schema(columns, True, batch=True))
    parts = reader.partitions({"lsn": lsn.before(lo)}, {"lsn": hi})
    per_task = [[r for b in reader.read(p) for r in b.to_pylist()] for p in parts]
    said = [e for n in sidefiles.names(folder) for e in sidefiles.read(folder, n)]
    ends = sorted((e["batch"], e["to_lsn"], e["max_commit_ts"]) for e in said if e["event"] == "metrics")
    events = sorted((e["batch"], e["event"], e["detail"]) for e in said if e["event"] != "metrics")
    return len(parts), per_task, ends, events


def test_tasks_of_several_batches_read_the_same(log_feed, tmp_path):
    n0, alone, ends0, events0 = whole(log_feed, str(tmp_path / "a"), None, pos(0), pos(N - 1))
    n1, together, ends1, events1 = whole(log_feed, str(tmp_path / "b"), 4, pos(0), pos(N - 1))
    assert n0 == 51 and n1 <= 6  # fifty batches, one in two pieces at the switch
    rows = [r for t in together for r in t]
    assert rows == [r for t in alone for r in t] and len(rows) == 3 * (N - 40)
    assert [(r["_start_lsn"], r["_command_id"]) for r in rows] == sorted((pos(i), c) for i in range(N) for c in (1, 2, 3) if not 100 <= i < 140)
    assert all(r["_batch_id"] == (lsn.to_int(r["_start_lsn"]) - 1000) // 16 // 40 for r in rows)
    assert ends0 == ends1 and events0 == events1 and len(ends1) == 51
    assert [e[1] for e in events1] == ["capture_instance_switched"] and events1[0][0] == 49


def test_what_was_purged_is_not_read_within_a_task(log_feed, tmp_path):
    """The files still hold the purged rows, between ranges that a task must not unite over them."""
    log_feed.cleanup("dbo_t", pos(50))
    log_feed.cleanup("dbo_t_2", pos(1_000))
    got = [whole(log_feed, str(tmp_path / str(n)), n, pos(0), pos(N - 1), failOnDataLoss="false") for n in (None, 2)]
    assert [r for t in got[0][1] for r in t] == [r for t in got[1][1] for r in t] and got[0][2:] == got[1][2:]
    read = {(lsn.to_int(r["_start_lsn"]) - 1000) // 16 for t in got[1][1] for r in t}
    assert read == set(range(50, 100)) | set(range(140, SWITCH)) | set(range(1_000, N)) and got[1][0] < got[0][0]


def test_tasks_of_several_batches_of_json_files(tmp_path):
    store = CaptureStore(str(tmp_path / "db"))
    store.add_table("t", [("k", "int")], ["k"], "dbo_t")
    for i in range(90):
        store.commit(START + timedelta(minutes=i), "t", [("insert", {"k": i})])
    lo, hi = store.timeline()[0]["lsn"], store.newest()
    got = [whole(store, str(tmp_path / str(n)), n, lo, hi, maxCommits="7") for n in (None, 3)]
    assert (got[0][0], got[1][0]) == (13, 3) and got[0][2:] == got[1][2:]
    assert [(r["k"], r["_batch_id"]) for t in got[1][1] for r in t] == [(i, i // 7) for i in range(90)]


def test_a_long_interval_is_handed_out_row_group_by_row_group(log_feed, monkeypatch):
    groups = len(log_feed._groups("changes/dbo_t_2"))
    assert groups > 5
    read, inside = [], LogFeed._inside

    class Seen:
        def __init__(self, group):
            self.group = group

        def to_table(self, **more):
            read.append(self.group)
            return self.group.to_table(**more)

    monkeypatch.setattr(LogFeed, "_inside", lambda f, name, lo, hi: [(low, Seen(g) if name != "timeline" else g) for low, g in inside(f, name, lo, hi)])
    batches = log_feed.change_batches("dbo_t_2", pos(SWITCH), pos(N - 1))
    first = next(b for b in batches if b.num_rows)
    assert first["lsn"][0].as_py() == pos(SWITCH) and len(read) <= 2
    assert first.num_rows + sum(b.num_rows for b in batches) == 3 * (N - SWITCH) and len(read) == groups
    assert log_feed.commit_rows("dbo_t_2", pos(N - 2), pos(N + 5)) == [(pos(N - 2), 3), (pos(N - 1), 3)]


def test_facts_of_a_batch_are_one_file(spark, tmp_path):
    facts = VersionedTable(spark, str(tmp_path / "facts"))
    when = datetime(2026, 1, 1, 12, 0, 0, 5)
    for number in range(2):
        sink.write_facts(spark, facts, [{"app_id": "a", "batch_id": i, "rows": 3, "max_commit_ts": when, "read_mb": 1, "detail": None} for i in range(9)], ("a", number))
    for commit in facts.commits():
        assert all(len(list((tmp_path / "facts/data" / p).glob("*.parquet"))) == 1 for p in commit["paths"])
    assert {tuple(r) for r in facts.read().select("rows", "max_commit_ts", "read_mb", "detail").collect()} == {(3, when, 1.0, None)} and facts.read().count() == 18


def test_few_images_are_merged_by_few_tasks(spark, tmp_path):
    """Images come from a shuffle's many partitions; the merge's own shuffle must not make a file for nearly every row."""
    from tidemark.session import available_cores
    from tidemark.sources.versioned import BUCKETS

    t = VersionedTable(spark, str(tmp_path / "silver")).create("k bigint, v bigint, _start_lsn string", {BUCKETS: "4"})
    tasks = []
    images = spark.range(1000).repartition(97).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"), F.lit(pos(1)).alias("_start_lsn"), F.lit(4).alias("_operation"))
    coalesce = type(images).coalesce
    type(images).coalesce = lambda df, n: tasks.append(n) or coalesce(df, n)
    try:
        t.merge_images(images, ["k"])
    finally:
        type(images).coalesce = coalesce
    assert available_cores(spark) in tasks
    assert {(r["k"], r["v"]) for r in t.read().collect()} == {(i, 2 * i) for i in range(1000)}
