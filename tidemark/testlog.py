"""A change log, its timeline and its tables, derived from the test tables in Spark and in SQL alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import lsn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def position(commit) -> F.Column:
    return F.concat(F.lit("0x"), F.lpad(F.hex((commit * 16 + 1000).cast("bigint")), 20, "0"))


def pos(commit: int) -> str:
    return lsn.from_int(1000 + 16 * commit)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")


def _commits(events: DataFrame) -> DataFrame:
    return events.withColumn("c", F.expr("event_id div 8"))


def _dealt(df: DataFrame, by: str) -> DataFrame:
    return df.repartitionByRange(by).sortWithinPartitions(by)


def timeline(spark: SparkSession, sf_dir: str, *, ordered: bool = False) -> DataFrame:
    """A row a commit: start_lsn, commit_ts. ``ordered``: sorted by number before positions are made of them."""
    commits = _commits(_events(spark, sf_dir)).groupBy("c").agg(F.max("ts").alias("commit_ts"))
    return (_dealt(commits, "c") if ordered else commits).select(position(F.col("c")).alias("start_lsn"), "commit_ts")


def changes_in_order(spark: SparkSession, sf_dir: str, switch: int) -> tuple[DataFrame, DataFrame]:
    """The change table's positions below that of commit ``switch``, and the others, each sorted by number: cheaper than their rows, twice as many, by text."""
    e, at = _events(spark, sf_dir), F.expr("event_id div 8") * 16 + 1000
    below = (at >= 0) & (at < 16 * switch + 1000)
    older = e.where(F.col("event_id") < 8 * switch).where(below)  # the first of these reaches the scan
    return _changes(_dealt(older, "event_id")), _changes(_dealt(e.where(~below), "event_id"))


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change table, without commit times: an update is its rows 3 (before; for some, another key) and 4."""
    return _changes(_events(spark, sf_dir))


def _changes(events: DataFrame) -> DataFrame:
    e = _commits(events)
    op = F.when(F.col("event_type") == "error", 1).when(F.col("event_type") == "signup", 2).otherwise(4)
    ops = F.when(op == 4, F.array(F.lit(3), F.lit(4))).otherwise(F.array(op))
    rows = e.withColumn("_operation", F.explode(ops))
    moved = (F.col("_operation") == 3) & (F.col("event_id") % 13 == 0)
    seq = F.concat(F.lit("0x"), F.lpad(F.hex((F.col("c") * 16 + 1001 + F.col("event_id") % 8).cast("bigint")), 20, "0"))
    return rows.select(
        F.when(F.col("c") < 500, "dbo_events").otherwise("dbo_events_2").alias("_capture_instance"), position(F.col("c")).alias("_start_lsn"), seq.alias("_seqval"), "_operation",
        (F.col("event_id") % 8 + 1).cast("int").alias("_command_id"), (F.col("user_id") + F.when(moved, 1).otherwise(0)).alias("user_id"), "event_type", "value",
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .operators.changelog import with_commit_time

    return with_commit_time(changes(spark, sf_dir), timeline(spark, sf_dir))


LOG = """
base AS (SELECT event_id, ts, user_id, event_type, value, event_id // 8 AS c FROM events),
timeline AS (SELECT '0x' || lpad(upper(to_hex(1000 + 16 * c)), 20, '0') AS start_lsn, max(ts) AS commit_ts, c FROM base GROUP BY c),
ops AS (SELECT *, unnest(CASE event_type WHEN 'error' THEN [1] WHEN 'signup' THEN [2] ELSE [3, 4] END)::INT AS _operation FROM base),
log AS (SELECT CASE WHEN o.c < 500 THEN 'dbo_events' ELSE 'dbo_events_2' END AS _capture_instance, t.start_lsn AS _start_lsn,
  '0x' || lpad(upper(to_hex(1001 + 16 * o.c + event_id % 8)), 20, '0') AS _seqval, _operation, (event_id % 8 + 1)::INT AS _command_id,
  t.commit_ts AS _commit_ts, user_id + CASE WHEN _operation = 3 AND event_id % 13 = 0 THEN 1 ELSE 0 END AS user_id, event_type, value
  FROM ops o JOIN timeline t ON o.c = t.c)
"""

#: Silver as a copy of orders with faults: some keys dropped, some rows changed, some added.
FAULTY = """
faulty AS (SELECT o_orderkey, CASE WHEN o_orderkey % 101 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_custkey, o_orderpriority FROM orders WHERE o_orderkey % 97 <> 0
  UNION ALL SELECT o_orderkey + 100000000, o_orderstatus, o_custkey, o_orderpriority FROM orders WHERE o_orderkey % 500 = 1)
"""


def source_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey", "o_orderpriority")


def faulty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = source_orders(spark, sf_dir)
    kept = o.where("o_orderkey % 97 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 101 == 0, "X").otherwise(F.col("o_orderstatus")))
    return kept.unionByName(o.where("o_orderkey % 500 = 1").withColumn("o_orderkey", F.col("o_orderkey") + 100_000_000))
