"""The feed of the test tables, written in order without sorting rows by text, and plans that stay the same from batch to batch."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark import job_queries, testlog
from tidemark.operators.changelog import to_bronze
from tidemark.queries import S
from tidemark.sources import logfeed
from tidemark.sources.versioned import VersionedTable

IDS = [0, 1, 7, 8, 3_999, 4_000, 4_001, 8_005, 9_000, 26, -3, -500, -600, -4_000, None]


@pytest.fixture
def odd(spark, tmp_path):
    """Events about the switch, in no order, with updates that move keys, negative ids and none."""
    kinds = ["click", "error", "signup"]
    rows = [(i, n % 5, kinds[n % 3], float(n)) for n, i in enumerate(IDS * 2)]
    events = spark.createDataFrame(rows, "event_id bigint, user_id bigint, event_type string, value double")
    events.withColumn("ts", F.timestamp_seconds(F.col("value") + 1.7e9).cast("timestamp_ntz")).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    return str(tmp_path)


def test_feed_holds_the_whole_log(spark, odd, monkeypatch):
    """Every change row is there, in the instance that its position says, and no row is sorted by text."""
    monkeypatch.setattr(logfeed, "_sorted", lambda *a: pytest.fail("sorted by text"))
    feed = job_queries._feed(spark, odd)
    log = testlog.changes(spark, odd)
    rows = lambda df: sorted(map(repr, df.collect()))
    columns = ["lsn", "seq", "op", "command", "user_id", "event_type", "value"]
    for name, some in (("dbo_events", log.where(F.col("_start_lsn") < S)), ("dbo_events_2", log.where(F.col("_start_lsn") >= S))):
        want = some.select(F.col("_start_lsn").alias("lsn"), F.col("_seqval").alias("seq"), F.col("_operation").alias("op"), F.col("_command_id").alias("command"), "user_id", "event_type", "value")
        have = [c for c in columns if (name, c) != ("dbo_events", "event_type")]
        assert want.count() > 5 and rows(spark.read.parquet(f"{feed.path}/changes/{name}").select(*have)) == rows(want.select(*have))
    assert rows(spark.read.parquet(f"{feed.path}/timeline").select("lsn", "ts")) == rows(testlog.timeline(spark, odd).select(F.col("start_lsn").alias("lsn"), F.col("commit_ts").alias("ts")))


def test_feed_files_are_in_commit_order(spark):
    feed = job_queries._feed(spark, "/root/testdata/sf0.01")
    for name in ("timeline", "changes/dbo_events", "changes/dbo_events_2"):
        by = "lsn" if name == "timeline" else "lsn, command, op"
        order = f"SELECT filename, file_row_number, row_number() OVER (PARTITION BY filename ORDER BY {by}) - 1 AS n FROM read_parquet('{feed.path}/{name}/*.parquet', filename=true, file_row_number=true)"
        assert duckdb.sql(f"SELECT count(*) > 0, count(*) FILTER (n <> file_row_number) FROM ({order})").fetchall() == [(True, 0)]
        spans = duckdb.sql(f"SELECT min(lsn) AS a, max(lsn) AS b FROM read_parquet('{feed.path}/{name}/*.parquet', filename=true) GROUP BY filename ORDER BY 1").fetchall()
        assert all(b <= c for (_, b), (c, _) in zip(spans, spans[1:], strict=False))


def test_generated_code_is_the_same_for_every_batch(spark):
    rows = spark.range(5).select("id", F.col("id").cast("int").alias("_batch_id"))
    made = [to_bronze(rows, n) for n in (7, 1_000_000)]
    assert [[r["_batch_id"] for r in df.collect()] for df in made] == [[n + i for i in range(5)] for n in (7, 1_000_000)]
    assert made[0].schema["_batch_id"].dataType.simpleString() == "int"
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    code = [debug.codegenString(df._jdf.queryExecution().executedPlan()).partition("Generated code:")[2] for df in made]
    assert code[0] and code[0] == code[1]


def test_an_empty_table_needs_no_python_worker(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t")).create("k bigint, ts timestamp_ntz, v string")
    assert t.read().collect() == [] and t.read().schema == t.schema()
    assert "PythonRDD" not in t.read()._jdf.rdd().toDebugString()
