"""Named queries over the test tables, each with the SQL that must give the same rows.

"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import testlog as T
from .functions import clock, keys, lsn
from .operators import asof, audit, changelog, current, facts
from .plans import chunks, tiles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None):
    """Register a function under its name, with its SQL; LOG's tables may be used in it."""

    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = (f"WITH {T.LOG} " if "log" in sql.lower() or "timeline" in sql else "") + sql
        return f

    return register


A, B_, S = T.pos(100), T.pos(900), T.pos(500)

# A. Sources


@query(f"SELECT _start_lsn, _command_id, _seqval, _operation, _commit_ts, user_id, value FROM log WHERE _start_lsn BETWEEN '{A}' AND '{B_}'")
def a5_change_scan(spark, d):
    got = changelog.with_commit_time(changelog.interval(T.changes(spark, d), A, B_), T.timeline(spark, d))
    return got.select("_start_lsn", "_command_id", "_seqval", "_operation", "_commit_ts", "user_id", "value")


@query("SELECT conv_id, turn, role FROM conversations WHERE (conv_id > 20 OR (conv_id = 20 AND turn >= 2)) AND (conv_id < 90 OR (conv_id = 90 AND turn < 1))")
def a6_key_range_scan(spark, d):
    return T.table(spark, d, "conversations").where(keys.in_range(["conv_id", "turn"], (20, 2), (90, 1))).select("conv_id", "turn", "role")


@query("SELECT _capture_instance, min(_start_lsn) AS start_lsn, max(_start_lsn) AS last_lsn, count(*) AS n FROM log GROUP BY 1")
def a14_capture_instances(spark, d):
    return T.changes(spark, d).groupBy("_capture_instance").agg(F.min("_start_lsn").alias("start_lsn"), F.max("_start_lsn").alias("last_lsn"), F.count("*").alias("n"))


@query(f"""SELECT l.start_lsn AS lsn, t.commit_ts, 'ALTER TABLE events /* ' || l.c || ' */' AS command FROM timeline l JOIN timeline t ON t.c = l.c
  WHERE l.c % 50 = 7 AND l.start_lsn > '{A}' AND l.start_lsn <= '{B_}'""")
def a16_ddl_history(spark, d):
    t = T.timeline(spark, d)
    c = ((lsn.as_number(F.col("start_lsn")) - 1000) / 16).cast("bigint")
    ddl = t.where(c % 50 == 7).select(F.col("start_lsn").alias("lsn"), F.concat(F.lit("ALTER TABLE events /* "), c.cast("string"), F.lit(" */")).alias("command"))
    some = ddl.where((F.col("lsn") > A) & (F.col("lsn") <= B_))
    return asof.asof_join(some, t, "lsn", "start_lsn", ["commit_ts"]).select("lsn", "commit_ts", "command")


@query(f"SELECT 'dbo_orders' AS _capture_instance, '{S}' AS _start_lsn, NULL::VARCHAR AS _seqval, 0 AS _operation, TIMESTAMP '2024-02-01' AS _commit_ts, o_orderkey, o_orderstatus FROM orders")
def a4_snapshot_rows(spark, d):
    rows = T.table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return changelog.stamped(rows, "dbo_orders", S, F.to_timestamp_ntz(F.lit("2024-02-01 00:00:00")), command_id=False)


@query("SELECT 'dbo_customer' AS _capture_instance, c_custkey, c_name, NULL::DECIMAL(20,4) AS credit FROM customer")
def a31_seed(spark, d):
    rows = changelog.seed(T.table(spark, d, "customer"), {"C_CUSTKEY": "bigint", "c_name": "string", "credit": "decimal(20,4)"}, missing="null")
    return rows.select(F.lit("dbo_customer").alias("_capture_instance"), F.col("C_CUSTKEY").alias("c_custkey"), "c_name", "credit")


# B. Projections and filters


@query("SELECT _start_lsn, _seqval, _operation, user_id, 7 AS _batch_id, NULL::VARCHAR AS _snapshot, NULL::INT AS _chunk FROM log")
def b1_bronze_projection(spark, d):
    return changelog.to_bronze(T.changes(spark, d).select("_start_lsn", "_seqval", "_operation", "user_id"), 7)


@query("SELECT p_partkey::INT AS p_partkey, p_retailprice::DECIMAL(18,2) AS p_retailprice, p_size::BIGINT AS p_size FROM part")
def b2_cast_to_schema(spark, d):
    return changelog.typed_nulls(T.table(spark, d, "part"), {"p_partkey": "int", "p_retailprice": "decimal(18,2)", "p_size": "bigint"})


@query("SELECT s_suppkey, s_name, NULL::VARCHAR AS note, NULL::DECIMAL(20,4) AS amount FROM supplier")
def b3_missing_columns(spark, d):
    return changelog.typed_nulls(T.table(spark, d, "supplier"), {"s_suppkey": "bigint", "s_name": "string", "note": "string", "amount": "decimal(20,4)"})


@query(f"SELECT _start_lsn, _operation, user_id FROM log WHERE _start_lsn > '{A}' AND _start_lsn <= '{S}'")
def b5_closed_interval(spark, d):
    return changelog.interval(T.changes(spark, d), lsn.after(A), S).select("_start_lsn", "_operation", "user_id")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey >= 1000 AND l_orderkey < 3000")
def b7_integer_range(spark, d):
    return T.table(spark, d, "lineitem").where(keys.in_range(["l_orderkey"], (1000,), (3000,))).select("l_orderkey", "l_linenumber", "l_quantity")


@query(f"SELECT _start_lsn, _seqval, _operation, user_id, CASE WHEN _start_lsn < '{S}' THEN NULL ELSE event_type END AS event_type FROM log WHERE _start_lsn BETWEEN '{A}' AND '{B_}'")
def b8_across_switch(spark, d):
    new = T.changes(spark, d)
    columns = {"_start_lsn": "string", "_seqval": "string", "_operation": "int", "user_id": "bigint", "event_type": "string"}
    return changelog.across_switch(new.drop("event_type"), new, A, B_, S, columns)


@query("SELECT count(*) AS n, min(_start_lsn) AS lo FROM log WHERE lower(_capture_instance) IN ('dbo_events_2')")
def b9_instance_filter(spark, d):
    return changelog.of_instances(T.changes(spark, d), ["DBO_Events_2"]).agg(F.count("*").alias("n"), F.min("_start_lsn").alias("lo"))


def _bronze(spark, d):
    """Changes, a whole snapshot at commit 300 and chunks of one opened at commit 600, stamped by wave."""
    log = T.log(spark, d)
    rows = T.table(spark, d, "orders").select(F.col("o_orderkey").alias("user_id"), F.col("o_orderstatus").alias("event_type"), F.col("o_totalprice").alias("value"))
    ts = F.to_timestamp_ntz(F.lit("2024-02-01 00:00:00"))
    whole = changelog.to_bronze(changelog.stamped(rows, "dbo_events", T.pos(300), ts), None, None)
    chunk = F.expr("cast(user_id div 500 as int)")
    stamp = F.when(chunk < 2, T.pos(610)).otherwise(T.pos(620))
    chunked = changelog.stamped(rows, "dbo_events", T.pos(600), ts).withColumn("_start_lsn", stamp).withColumn("_chunk", chunk)
    return changelog.to_bronze(log, 1).unionByName(whole).unionByName(changelog.to_bronze(chunked, None, T.pos(600)))


_BRONZE = f"""SELECT _capture_instance, _start_lsn, _seqval, _operation, _command_id, _commit_ts, user_id, event_type, value, NULL AS _snapshot, NULL::INT AS _chunk FROM log
  UNION ALL SELECT 'dbo_events', '{T.pos(300)}', NULL, 0, NULL, TIMESTAMP '2024-02-01', o_orderkey, o_orderstatus, o_totalprice, NULL, NULL FROM orders
  UNION ALL SELECT 'dbo_events', CASE WHEN o_orderkey // 500 < 2 THEN '{T.pos(610)}' ELSE '{T.pos(620)}' END, NULL, 0, NULL, TIMESTAMP '2024-02-01', o_orderkey, o_orderstatus, o_totalprice, '{T.pos(600)}', (o_orderkey // 500)::INT FROM orders"""


@query(f"SELECT user_id, event_type FROM ({_BRONZE}) WHERE _operation = 0 AND coalesce(_snapshot, _start_lsn) = '{T.pos(300)}' AND _chunk IS NULL")
def b10_snapshot_filter(spark, d):
    return changelog.snapshot_rows(_bronze(spark, d), T.pos(300)).select("user_id", "event_type")


@query(f"SELECT _start_lsn, _operation, user_id FROM ({_BRONZE}) WHERE (_operation = 0 AND _chunk IS NULL AND coalesce(_snapshot, _start_lsn) = '{T.pos(300)}') OR (_operation <> 0 AND _start_lsn > '{T.pos(300)}')")
def b11_rebuild_base(spark, d):
    b = _bronze(spark, d)
    return changelog.snapshot_rows(b, T.pos(300)).unionByName(changelog.changes_after(b, T.pos(300))).select("_start_lsn", "_operation", "user_id")


@query(f"SELECT _start_lsn, _chunk, user_id FROM ({_BRONZE}) WHERE _operation = 0 AND coalesce(_snapshot, _start_lsn) = '{T.pos(600)}' AND _chunk IN (2, 3) AND _start_lsn >= '{T.pos(620)}'")
def b12_chunk_wave(spark, d):
    return changelog.snapshot_rows(_bronze(spark, d), T.pos(600), chunks=[2, 3]).where(F.col("_start_lsn") >= T.pos(620)).select("_start_lsn", "_chunk", "user_id")


@query(f"SELECT l._start_lsn, l._operation, l.user_id FROM log l WHERE l._start_lsn > '{T.pos(600)}' AND EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.user_id)")
def b13_later_changes(spark, d):
    later = changelog.changes_after(T.log(spark, d), T.pos(600))
    held = T.table(spark, d, "orders").select(F.col("o_orderkey").alias("user_id"))
    return current.semi(later, held, ["user_id"]).select("_start_lsn", "_operation", "user_id")


def _facts(spark, d):
    """Batches of 200 commits, and events as JSON details."""
    log = T.log(spark, d).withColumn("batch_id", F.floor((lsn.as_number(F.col("_start_lsn")) - 1000) / 3200).cast("bigint"))
    rows = facts.batch_facts(log, "batch_id").select("batch_id", "rows", "min_lsn", "max_lsn", "max_commit_ts", F.lit(None).cast("string").alias("event"), F.lit(None).cast("string").alias("detail"))
    kind = F.element_at(F.array(*map(F.lit, ("snapshot_open", "snapshot_chunk", "bootstrap", "schema_change"))), (F.col("batch_id") % 4 + 1).cast("int"))
    detail = F.when(kind == "snapshot_open", F.when(F.col("batch_id") % 8 == 0, '{"mode":"full"}').otherwise('{"mode":"chunked"}')).when(
        kind == "snapshot_chunk", F.concat(F.lit('{"snapshot":"S","wave":1,"chunk":'), F.col("batch_id").cast("string"), F.lit(',"last":false}'))
    )
    events = rows.select("batch_id", "rows", "min_lsn", "max_lsn", "max_commit_ts", kind.alias("event"), detail.alias("detail"))
    return rows.unionByName(events).withColumn("target", F.lit("bronze.events")).withColumn("app_id", F.when(F.col("batch_id") % 2 == 0, "even").otherwise("odd"))


_FACTS = """SELECT *, 'bronze.events' AS target, CASE WHEN batch_id % 2 = 0 THEN 'even' ELSE 'odd' END AS app_id FROM (
  WITH b AS (SELECT l.*, t.c // 200 AS batch_id FROM log l JOIN timeline t ON t.start_lsn = l._start_lsn),
  r AS (SELECT batch_id, count(*) AS rows, min(_start_lsn) AS min_lsn, max(_start_lsn) AS max_lsn, max(_commit_ts) AS max_commit_ts FROM b GROUP BY batch_id)
  SELECT *, NULL AS event, NULL AS detail FROM r
  UNION ALL SELECT *, ['snapshot_open', 'snapshot_chunk', 'bootstrap', 'schema_change'][batch_id % 4 + 1],
    CASE batch_id % 4 WHEN 0 THEN CASE WHEN batch_id % 8 = 0 THEN '{"mode":"full"}' ELSE '{"mode":"chunked"}' END
    WHEN 1 THEN '{"snapshot":"S","wave":1,"chunk":' || batch_id || ',"last":false}' END FROM r)"""


@query(f"SELECT max_lsn, detail FROM ({_FACTS}) WHERE event = 'snapshot_open' AND json_extract_string(detail, '$.mode') IS DISTINCT FROM 'full'")
def b14_open_snapshots(spark, d):
    return facts.open_snapshots(_facts(spark, d), "bronze.events").select("max_lsn", "detail")


@query(f"SELECT (detail->>'$.wave')::INT AS wave, (detail->>'$.chunk')::INT AS chunk, rows FROM ({_FACTS}) WHERE event = 'snapshot_chunk' AND detail->>'$.snapshot' = 'S'")
def b14_chunk_rows(spark, d):
    return facts.chunks_of(_facts(spark, d), "S").select("wave", "chunk", "rows")


@query(f"SELECT _start_lsn, _operation FROM log WHERE _start_lsn > '{B_}'")
def b15_changes_after(spark, d):
    return changelog.changes_after(T.changes(spark, d), B_).select("_start_lsn", "_operation")


# C. Joins


@query("SELECT _start_lsn, max(_commit_ts) AS commit_ts, count(*) AS n FROM log GROUP BY 1")
def c1_commit_join(spark, d):
    return T.log(spark, d).groupBy("_start_lsn").agg(F.max("_commit_ts").alias("commit_ts"), F.count("*").alias("n"))


def _null_keys(df, key, every):
    return df.withColumn(key, F.when(F.col(key) % every != 0, F.col(key)))


@query("SELECT o_orderkey, k FROM (SELECT o_orderkey, CASE WHEN o_custkey % 11 <> 0 THEN o_custkey END AS k FROM orders) o WHERE EXISTS (SELECT 1 FROM (SELECT CASE WHEN c_custkey % 7 <> 0 THEN c_custkey END AS k FROM customer) c WHERE c.k IS NOT DISTINCT FROM o.k)")
def c2_null_safe_semi(spark, d):
    o = _null_keys(T.table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("k")), "k", 11)
    c = _null_keys(T.table(spark, d, "customer").select(F.col("c_custkey").alias("k")), "k", 7)
    return current.semi(o, c, ["k"])


@query("SELECT o_orderkey, k FROM (SELECT o_orderkey, CASE WHEN o_custkey % 11 <> 0 THEN o_custkey END AS k FROM orders) o WHERE NOT EXISTS (SELECT 1 FROM (SELECT CASE WHEN c_custkey % 7 <> 0 THEN c_custkey END AS k FROM customer) c WHERE c.k IS NOT DISTINCT FROM o.k)")
def c3_null_safe_anti(spark, d):
    o = _null_keys(T.table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("k")), "k", 11)
    c = _null_keys(T.table(spark, d, "customer").select(F.col("c_custkey").alias("k")), "k", 7)
    return current.anti(o, c, ["k"])


_RANGES = "(VALUES (NULL, 1000, '{0}'), (1000, 3000, '{1}'), (5000, 9000, '{0}')) r(lo, hi, stamp)".format(T.pos(400), T.pos(800))


def _range_deletes(spark, d):
    cur = T.table(spark, d, "orders").select("o_orderkey", T.position(F.col("o_orderkey") % 1000).alias("_start_lsn"))
    held = T.table(spark, d, "orders").where("o_orderkey % 3 = 0").select("o_orderkey")
    ranges = spark.createDataFrame([(None, 1000, T.pos(400)), (1000, 3000, T.pos(800)), (5000, 9000, T.pos(400))], "lo bigint, hi bigint, stamp string")
    return current.range_deletes(cur, held, ranges, "o_orderkey")


@query(f"""SELECT o_orderkey, r.stamp AS _start_lsn, 1 AS _operation FROM orders JOIN {_RANGES} ON (lo IS NULL OR o_orderkey >= lo) AND o_orderkey < hi
  WHERE o_orderkey % 3 <> 0 AND '0x' || lpad(upper(to_hex(1000 + 16 * (o_orderkey % 1000))), 20, '0') < r.stamp""")
def c4_range_deletes(spark, d):
    return _range_deletes(spark, d)


ORACLES["c4_range_deletes_by_order"] = ORACLES["c4_range_deletes"]


def c4_range_deletes_by_order(spark, d):
    """The same without a broadcast, as for more chunks than one allows."""
    most, current.MOST_RANGES = current.MOST_RANGES, 1
    try:
        return _range_deletes(spark, d)
    finally:
        current.MOST_RANGES = most


QUERIES["c4_range_deletes_by_order"] = c4_range_deletes_by_order

_DIFF = f"""SELECT '{{"o_orderkey":' || coalesce(s.o_orderkey, t.o_orderkey) || '}}' AS key,
  CASE WHEN t.o_orderkey IS NULL THEN 'MISSING_TARGET' WHEN s.o_orderkey IS NULL THEN 'MISSING_SOURCE' ELSE 'RECORD_DIFF' END AS failure_type,
  CASE WHEN s.o_orderkey IS NOT NULL AND t.o_orderkey IS NOT NULL THEN 'o_orderstatus' END AS detail, coalesce(s.o_orderkey, t.o_orderkey) AS k
  FROM orders s FULL OUTER JOIN faulty t ON s.o_orderkey = t.o_orderkey
  WHERE s.o_orderkey IS NULL OR t.o_orderkey IS NULL OR s.o_orderstatus IS DISTINCT FROM t.o_orderstatus"""
_COLS = ["o_orderkey", "o_orderstatus", "o_custkey", "o_orderpriority"]


@query(None)
def c5_row_differences(spark, d):
    return audit.row_differences(T.source_orders(spark, d), T.faulty_orders(spark, d), ["o_orderkey"], _COLS)


ORACLES["c5_row_differences"] = f"WITH {T.FAULTY} SELECT key, failure_type, detail FROM ({_DIFF})"


@query(None)
def c7_in_flight(spark, d):
    moved = T.source_orders(spark, d).where("o_orderkey % 2 = 0").select("o_orderkey")
    return audit.row_differences(T.source_orders(spark, d), T.faulty_orders(spark, d), ["o_orderkey"], _COLS, moved)


ORACLES["c7_in_flight"] = f"WITH {T.FAULTY} SELECT key, CASE WHEN k % 2 = 0 AND k < 100000000 THEN 'IN_FLIGHT' ELSE failure_type END AS failure_type, detail FROM ({_DIFF})"


@query(None)
def c8_bucket_rows(spark, d):
    """Rows of the buckets that differ, by an equi-join on the bucket."""
    s, t = (audit.buckets(x, "o_orderkey", "int", 512) for x in (T.source_orders(spark, d), T.faulty_orders(spark, d)))
    bad = audit.compare_buckets(s, t).where("status = 'MISMATCH'").select("bucket")
    return T.source_orders(spark, d).withColumn("bucket", keys.bucket(F.col("o_orderkey"), 512)).join(bad, "bucket").groupBy("bucket").agg(F.count("*").alias("n"))


_BUCKETS = "b(t, bucket, n, s) AS (SELECT 's', o_orderkey // 512, count(*), sum(o_orderkey) FROM orders GROUP BY 2 UNION ALL SELECT 't', o_orderkey // 512, count(*), sum(o_orderkey) FROM faulty GROUP BY 2), c AS (SELECT bucket, coalesce(max(n) FILTER (t = 's'), 0) AS source_rows, coalesce(max(s) FILTER (t = 's'), 0) AS source_sum, coalesce(max(n) FILTER (t = 't'), 0) AS target_rows, coalesce(max(s) FILTER (t = 't'), 0) AS target_sum FROM b GROUP BY bucket)"
ORACLES["c8_bucket_rows"] = f"WITH {T.FAULTY}, {_BUCKETS} SELECT o_orderkey // 512 AS bucket, count(*) AS n FROM orders WHERE o_orderkey // 512 IN (SELECT bucket FROM c WHERE (source_rows, source_sum) <> (target_rows, target_sum)) GROUP BY 1"


def _merge_inputs(spark, d):
    log = T.log(spark, d)
    target = current.state(changelog.interval(log, lsn.ZERO, S), ["user_id"])
    images = current.latest_image(changelog.changes_after(log, A), ["user_id"]).select("user_id", "event_type", "value", "_start_lsn", "_commit_ts", "_operation")
    return target, images


_IMAGE = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY _start_lsn DESC, _command_id DESC NULLS LAST, _seqval DESC NULLS LAST, _operation DESC) AS rn FROM log {0}) WHERE rn = 1"


@query(f"SELECT user_id, event_type, value, _start_lsn, _commit_ts FROM ({_IMAGE.format('')}) WHERE _operation NOT IN (1, 3)")
def c10_merge(spark, d):
    target, images = _merge_inputs(spark, d)
    return current.merge(target, images, ["user_id"])


@query(f"SELECT user_id, event_type, value, _start_lsn, _commit_ts FROM ({_IMAGE.format(f'''WHERE _start_lsn > '{A}' ''')}) WHERE _operation NOT IN (1, 3)")
def c10_merge_rebuild(spark, d):
    target, images = _merge_inputs(spark, d)
    return current.merge(target, images, ["user_id"], rebuild=True)


@query("SELECT x.c AS c, t.commit_ts FROM (SELECT unnest([0, 13, 77, 512, 1000000])::BIGINT AS c) x ASOF LEFT JOIN timeline t ON x.c * 3 + 1 >= t.c")
def c13_lsn_to_time(spark, d):
    asked = spark.createDataFrame([(c,) for c in (0, 13, 77, 512, 1_000_000)], "c bigint").withColumn("lsn", T.position(F.col("c") * 3 + 1))
    return asof.asof_join(asked, T.timeline(spark, d), "lsn", "start_lsn", ["commit_ts"]).select("c", "commit_ts")


@query("SELECT o.o_orderkey, t.start_lsn FROM (SELECT o_orderkey, TIMESTAMP '2024-01-01' + INTERVAL 1 MINUTE * (o_orderkey % 40000) AS at FROM orders) o ASOF LEFT JOIN timeline t ON o.at >= t.commit_ts")
def c14_time_to_lsn(spark, d):
    at = F.timestamp_add("MINUTE", (F.col("o_orderkey") % 40000).cast("int"), F.to_timestamp_ntz(F.lit("2024-01-01 00:00:00")))
    asked = T.table(spark, d, "orders").select("o_orderkey", at.alias("at"))
    return asof.asof_join(asked, T.timeline(spark, d), "at", "commit_ts", ["start_lsn"]).select("o_orderkey", "start_lsn")


@query("SELECT start_lsn, ts AS commit_ts FROM (SELECT *, lag(ts) OVER (ORDER BY start_lsn) AS p FROM (SELECT start_lsn, CASE WHEN c % 97 = 5 THEN commit_ts - INTERVAL 1 HOUR ELSE commit_ts END AS ts FROM timeline)) WHERE epoch_us(p) - epoch_us(ts) > 60000000")
def c15_clock_went_back(spark, d):
    t = T.timeline(spark, d).withColumn("c", ((lsn.as_number(F.col("start_lsn")) - 1000) / 16).cast("bigint"))
    t = t.withColumn("day_ts", F.when(F.col("c") % 97 == 5, F.timestamp_add("HOUR", F.lit(-1), F.col("commit_ts"))).otherwise(F.col("commit_ts")))
    return clock.went_back(t.select("start_lsn", F.col("day_ts").alias("commit_ts"))).select("start_lsn", "commit_ts")


@query(f"SELECT a.app_id, a.batch_id, a.rows, v.verdict FROM (SELECT app_id, max(batch_id) AS batch_id, arg_max(rows, batch_id) AS rows FROM ({_FACTS}) WHERE event IS NULL GROUP BY app_id) a LEFT JOIN (SELECT app_id, date_trunc('day', max(max_commit_ts))::TIMESTAMP AS verdict FROM ({_FACTS}) WHERE event IS NULL AND app_id = 'even' GROUP BY app_id) v ON v.app_id = a.app_id")
def c16_verdict_and_batch(spark, d):
    """Each stream's newest batch beside the verdict of its control row, which one stream does not have yet."""
    f = _facts(spark, d)
    verdict = f.where("event is null and app_id = 'even'").groupBy("app_id").agg(F.date_trunc("day", F.max("max_commit_ts")).cast("timestamp_ntz").alias("verdict"))
    return facts.last_batch(f).join(verdict, "app_id", "left")


@query(f"SELECT s.batch_id, s.max_lsn, max(b.max_lsn) AS passed FROM ({_FACTS}) s LEFT JOIN ({_FACTS}) b ON b.target = s.target AND b.event IS NULL WHERE s.event = 'schema_change' GROUP BY 1, 2")
def c17_switch_readiness(spark, d):
    f = _facts(spark, d)
    passed = f.where("event is null").groupBy("target").agg(F.max("max_lsn").alias("passed"))
    return f.where("event = 'schema_change'").join(passed, "target", "left").select("batch_id", "max_lsn", "passed")


# D. Aggregations

_MEASURES = "count(*) AS rows, min(_start_lsn) AS min_lsn, max(_start_lsn) AS max_lsn, min(_commit_ts) AS min_commit_ts, max(_commit_ts) AS max_commit_ts, count(*) FILTER (_operation = 1) AS deletes, count(*) FILTER (_operation = 2) AS inserts, count(*) FILTER (_operation = 4) AS updates"


@query(f"SELECT t.c // 200 AS batch_id, {_MEASURES} FROM log l JOIN timeline t ON t.start_lsn = l._start_lsn GROUP BY 1")
def d1_batch_facts(spark, d):
    log = T.log(spark, d).withColumn("batch_id", F.floor((lsn.as_number(F.col("_start_lsn")) - 1000) / 3200).cast("bigint"))
    return facts.batch_facts(log, "batch_id")


@query(f"SELECT app_id, max(batch_id) AS batch_id, arg_max(rows, batch_id) AS rows FROM ({_FACTS}) WHERE event IS NULL GROUP BY app_id")
def d3_last_batch(spark, d):
    return facts.last_batch(_facts(spark, d))


@query("SELECT o_orderkey // 512 AS bucket, count(*) AS rows, sum(o_orderkey)::DECIMAL(38,0) AS key_sum FROM orders GROUP BY 1")
def d4_integer_buckets(spark, d):
    return audit.buckets(T.table(spark, d, "orders"), "o_orderkey", "int", 512)


@query("SELECT CAST(floor(date_diff('day', DATE '1970-01-01', o_orderdate::DATE) / 30) AS BIGINT) AS bucket, count(*) AS rows, sum(date_diff('day', DATE '1970-01-01', o_orderdate::DATE))::DECIMAL(38,0) AS key_sum FROM orders GROUP BY 1")
def d5_date_buckets(spark, d):
    return audit.buckets(T.table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")), "day", "date", 30)


@query(None)
def j2_bucket_status(spark, d):
    moved = T.source_orders(spark, d).where("o_orderkey % 4000 = 0").select(keys.bucket(F.col("o_orderkey"), 512).alias("bucket"))
    return audit.compare_buckets(*[audit.buckets(x, "o_orderkey", "int", 512) for x in (T.source_orders(spark, d), T.faulty_orders(spark, d))], moved)


ORACLES["j2_bucket_status"] = f"WITH {T.FAULTY}, {_BUCKETS} SELECT bucket, source_rows, source_sum::DECIMAL(38,0) AS source_sum, target_rows, target_sum::DECIMAL(38,0) AS target_sum, CASE WHEN source_rows = target_rows AND source_sum = target_sum THEN 'MATCH' WHEN bucket IN (SELECT o_orderkey // 512 FROM orders WHERE o_orderkey % 4000 = 0) THEN 'IN_FLIGHT' ELSE 'MISMATCH' END AS status FROM c"


@query("SELECT max(max_lsn) FILTER (event IN ('bootstrap', 'resnapshot')) AS snapshot, count(*) AS rows FROM (" + _FACTS + ")")
def d9_newest_snapshot(spark, d):
    return facts.newest_snapshot(_facts(spark, d), "bronze.events")


@query(f"SELECT max(coalesce(_snapshot, _start_lsn)) AS s FROM ({_BRONZE}) WHERE _operation = 0 AND _chunk IS NULL")
def d10_newest_whole_snapshot(spark, d):
    return changelog.snapshot_rows(_bronze(spark, d)).agg(F.max(F.coalesce("_snapshot", "_start_lsn")).alias("s"))


@query("SELECT max(CASE WHEN lower(_capture_instance) <> 'dbo_events' THEN _capture_instance END) AS other, max(CASE WHEN _operation <> 0 THEN _start_lsn END) AS newest FROM log")
def d11_foreign_and_newest(spark, d):
    return T.changes(spark, d).agg(F.max(F.when(F.lower("_capture_instance") != "dbo_events", F.col("_capture_instance"))).alias("other"), F.max(F.when(F.col("_operation") != 0, F.col("_start_lsn"))).alias("newest"))


@query("SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi, count(*) AS rows FROM orders")
def d12_key_extent(spark, d):
    return T.table(spark, d, "orders").agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi"), F.count("*").alias("rows"))


@query(f"SELECT max(start_lsn) AS lsn, count(*) AS n FROM (SELECT start_lsn FROM timeline WHERE start_lsn > '{A}' ORDER BY start_lsn LIMIT 100)")
def d13_nth_commit(spark, d):
    return T.timeline(spark, d).where(F.col("start_lsn") > A).orderBy("start_lsn").limit(100).agg(F.max("start_lsn").alias("lsn"), F.count("*").alias("n"))


@query(f"SELECT _chunk, count(*) AS rows, min(_start_lsn) AS least FROM ({_BRONZE}) WHERE _operation = 0 AND _chunk IS NOT NULL GROUP BY 1")
def d16_chunk_rows(spark, d):
    return changelog.snapshot_rows(_bronze(spark, d), chunked=True).groupBy("_chunk").agg(F.count("*").alias("rows"), F.min("_start_lsn").alias("least"))


@query(None)
def d17_failures_by_type(spark, d):
    return c5_row_differences(spark, d).groupBy("failure_type").agg(F.count("*").alias("n"))


ORACLES["d17_failures_by_type"] = f"WITH {T.FAULTY} SELECT failure_type, count(*) AS n FROM ({_DIFF}) GROUP BY 1"


@query("SELECT DISTINCT user_id // 4 AS bucket FROM log WHERE _start_lsn > '" + B_ + "'")
def d19_moved_buckets(spark, d):
    return changelog.changes_after(T.changes(spark, d), B_).select(keys.bucket(F.col("user_id"), 4).alias("bucket")).distinct()


@query(f"SELECT max(CASE WHEN _operation <> 0 THEN _start_lsn WHEN _chunk IS NOT NULL THEN _snapshot END) AS known FROM ({_BRONZE})")
def d20_last_known_position(spark, d):
    return _bronze(spark, d).agg(F.max(F.when(F.col("_operation") != 0, F.col("_start_lsn")).when(F.col("_chunk").isNotNull(), F.col("_snapshot"))).alias("known"))


@query(f"SELECT target, arg_max(rows, max_commit_ts) AS rows, max(max_commit_ts) AS newest, CASE WHEN max(max_commit_ts) < TIMESTAMP '2024-01-20' THEN 'STALE' ELSE 'OK' END AS health FROM ({_FACTS}) WHERE event IS NULL GROUP BY target")
def d22_stream_health(spark, d):
    late = F.to_timestamp_ntz(F.lit("2024-01-20 00:00:00"))
    f = _facts(spark, d).where("event is null").groupBy("target").agg(F.max_by("rows", "max_commit_ts").alias("rows"), F.max("max_commit_ts").alias("newest"))
    return f.withColumn("health", F.when(F.col("newest") < late, "STALE").otherwise("OK"))


# E. Windows


@query(f"SELECT user_id, _start_lsn, _seqval, _operation, event_type, value FROM ({_IMAGE.format('')})")
def e1_latest_image(spark, d):
    return current.latest_image(T.changes(spark, d), ["user_id"]).select("user_id", "_start_lsn", "_seqval", "_operation", "event_type", "value")


@query(f"SELECT user_id, _start_lsn, _seqval, _operation, event_type, value FROM ({_IMAGE.format('')})")
def e1_latest_image_agg(spark, d):
    return current.latest_image_agg(T.changes(spark, d), ["user_id"]).select("user_id", "_start_lsn", "_seqval", "_operation", "event_type", "value")


@query("SELECT tile, max(_start_lsn) AS hi, count(*) AS rows FROM (SELECT _start_lsn, ntile(4) OVER (ORDER BY _start_lsn) AS tile FROM log) GROUP BY 1")
def e2_lsn_tiles(spark, d):
    return tiles.lsn_tiles(T.changes(spark, d), 4)


@query("SELECT tile, max(_start_lsn) AS hi, sum(n)::BIGINT AS rows FROM (SELECT _start_lsn, n, (((sum(n) OVER (ORDER BY _start_lsn) - 1) * 8) // (sum(n) OVER ()) + 1)::INT AS tile FROM (SELECT _start_lsn, count(*) AS n FROM log GROUP BY 1)) GROUP BY 1")
def e2_lsn_tiles_by_commit(spark, d):
    return tiles.lsn_tiles_by_commit(T.changes(spark, d), 8)


@query("SELECT tile::INT AS tile, conv_id, turn FROM (SELECT *, lag(tile) OVER (ORDER BY conv_id, turn) AS p FROM (SELECT conv_id, turn, ntile(8) OVER (ORDER BY conv_id, turn) AS tile FROM conversations)) WHERE tile > 1 AND tile <> p")
def e3_key_tiles(spark, d):
    return tiles.key_tiles(T.table(spark, d, "conversations"), 8, ["conv_id", "turn"])


# F. Sorts and limits


@query("SELECT _start_lsn, _command_id, _operation FROM log ORDER BY _start_lsn, _command_id, _seqval, _operation")
def f1_commit_order(spark, d):
    return changelog.commit_order(T.changes(spark, d)).select("_start_lsn", "_command_id", "_operation")


@query(f"SELECT start_lsn, commit_ts FROM timeline WHERE start_lsn > '{A}' ORDER BY start_lsn LIMIT 25")
def f2_next_commits(spark, d):
    return T.timeline(spark, d).where(F.col("start_lsn") > A).orderBy("start_lsn").limit(25)


@query("SELECT conv_id, turn FROM conversations ORDER BY conv_id DESC, turn DESC LIMIT 1")
def f3_key_maximum(spark, d):
    return T.table(spark, d, "conversations").select("conv_id", "turn").orderBy(F.col("conv_id").desc(), F.col("turn").desc()).limit(1)


@query("SELECT conv_id, turn FROM conversations WHERE conv_id >= 10 AND conv_id < 100 ORDER BY conv_id, turn LIMIT 1 OFFSET 50")
def f4_keyset_bound(spark, d):
    some = T.table(spark, d, "conversations").where(keys.in_range(["conv_id"], (10,), (100,)))
    return some.orderBy("conv_id", "turn").offset(50).limit(1).select("conv_id", "turn")


@query(f"SELECT max_lsn FROM ({_FACTS}) WHERE event = 'snapshot_open' AND json_extract_string(detail, '$.mode') IS DISTINCT FROM 'full' ORDER BY max_lsn DESC LIMIT 1")
def f5_newest_open_snapshot(spark, d):
    return facts.open_snapshots(_facts(spark, d), "bronze.events").select("max_lsn").limit(1)


# G. Sets


@query(f"SELECT user_id, event_type, _operation FROM ({_BRONZE})")
def g1_union_by_name(spark, d):
    return _bronze(spark, d).select("user_id", "event_type", "_operation")


@query(f"SELECT o_orderkey, o_orderstatus, 0 AS _operation FROM orders UNION ALL SELECT o_orderkey, NULL, 1 FROM orders WHERE o_orderstatus = 'F'")
def g2_union_missing_columns(spark, d):
    o = T.table(spark, d, "orders")
    upserts = o.select("o_orderkey", "o_orderstatus", F.lit(0).alias("_operation"))
    return upserts.unionByName(o.where("o_orderstatus = 'F'").select("o_orderkey", F.lit(1).alias("_operation")), allowMissingColumns=True)


@query("SELECT DISTINCT user_id FROM log")
def g6_distinct_keys(spark, d):
    return T.changes(spark, d).select("user_id").distinct()


# H. Functions


@query("SELECT event_id, '0x' || lpad(upper(hex), 20, '0') AS canonical, '0x' || lpad(upper(to_hex(n)), 20, '0') AS round_trip, '0x' || lpad(upper(to_hex(n + 1)), 20, '0') AS next, '0x' || lpad(upper(to_hex(greatest(n - 1, 0))), 20, '0') AS previous FROM (SELECT event_id, n, to_hex(n) AS hex FROM (SELECT event_id, event_id::HUGEINT * 1099511627783 AS n FROM events))")
def h1_position_arithmetic(spark, d):
    n = F.col("event_id").cast("decimal(20,0)") * F.lit(1099511627776 + 7).cast("decimal(18,0)")  # over 64 bits from some 8 million on
    digits = F.regexp_replace(F.lower(lsn.from_number(n)), "^0x0*(?=.)", "")
    e = T.table(spark, d, "events").select("event_id", lsn.normalized(digits).alias("canonical"))
    c = F.col("canonical")
    return e.select("event_id", "canonical", lsn.from_number(lsn.as_number(c)).alias("round_trip"), lsn.shifted(c, 1).alias("next"), lsn.shifted(c, -1).alias("previous"))


@query("SELECT date_trunc('hour', ts)::TIMESTAMP AS hour, date_trunc('day', ts)::TIMESTAMP AS day, date_trunc('minute', ts)::TIMESTAMP AS minute FROM events")
def h4_truncate(spark, d):
    return T.table(spark, d, "events").select(*[clock.truncated(F.col("ts"), g).alias(g) for g in ("hour", "day", "minute")])


@query("SELECT o_orderkey, CAST(floor((o_orderkey - 7000) / 300.0) AS BIGINT) AS bucket, date_diff('day', DATE '1970-01-01', o_orderdate::DATE) AS ordinal FROM orders")
def h6_ordinals(spark, d):
    return T.table(spark, d, "orders").select("o_orderkey", keys.bucket(F.col("o_orderkey") - 7000, 300).alias("bucket"), keys.ordinal(F.to_date("o_orderdate"), "date").alias("ordinal"))


@query("""SELECT c_custkey, sha256('{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"' || CASE WHEN c_nationkey % 5 <> 0 THEN ',"n":' || c_nationkey ELSE '' END || '}') AS h FROM customer""")
def h10_row_hash(spark, d):
    c = T.table(spark, d, "customer").withColumn("n", F.when(F.col("c_nationkey") % 5 != 0, F.col("c_nationkey")))
    return c.select("c_custkey", keys.row_hash(["c_custkey", "c_name", "n"]).alias("h"))


@query("""SELECT '{"conv_id":' || conv_id || ',"turn":' || CASE WHEN turn % 3 = 0 THEN 'null' ELSE turn::VARCHAR END || '}' AS key FROM conversations""")
def h12_key_json(spark, d):
    return T.table(spark, d, "conversations").select("conv_id", F.when(F.col("turn") % 3 != 0, F.col("turn")).alias("turn")).select(keys.as_json(["conv_id", "turn"]).alias("key"))


@query("SELECT event_id, floor((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') + 18000000) / 36000000) / 100 AS headroom, floor((epoch_us(TIMESTAMP '2024-02-01') - epoch_us(ts) + 500) / 1000) / 1000 AS lag FROM events")
def h17_lags(spark, d):
    at = lambda s: F.to_timestamp_ntz(F.lit(s))
    return T.table(spark, d, "events").select("event_id", clock.headroom_hours(F.col("ts"), at("2024-01-01 00:00:00")).alias("headroom"), clock.lag_seconds(F.col("ts"), at("2024-02-01 00:00:00")).alias("lag"))


@query("SELECT event_id, ts + INTERVAL 3 HOUR AS utc FROM events")
def h20_parse_offset(spark, d):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("7 -03:00"))
    return T.table(spark, d, "events").select("event_id", clock.parse_offset(text).alias("utc"))


# I, J. Composites


@query(f"SELECT batch_id, rows, date_trunc('hour', max_commit_ts)::TIMESTAMP AS candidate, max(date_trunc('hour', max_commit_ts)) OVER (ORDER BY batch_id)::TIMESTAMP AS verdict FROM ({_FACTS}) WHERE event IS NULL")
def i12_verdict_by_batch(spark, d):
    f = _facts(spark, d).where("event is null").select("batch_id", "rows", clock.truncated(F.col("max_commit_ts"), "hour").alias("candidate"))
    return f.withColumn("verdict", F.max("candidate").over(Window.orderBy("batch_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)))  # a row a batch


@query("""WITH RECURSIVE e AS (SELECT min(o_custkey) AS lo, max(o_custkey) AS hi, count(*) AS n FROM orders),
  w AS (SELECT lo, greatest(1, ceil((hi - lo + 1) / least(100000, greatest(1, ceil(16.0 * n / 2000)))))::BIGINT AS w FROM e),
  s AS (SELECT row_number() OVER (ORDER BY sl) AS i, a, c FROM (SELECT (o_custkey - lo) // w AS sl, min(o_custkey) AS a, count(*) AS c FROM orders, w GROUP BY 1)),
  g AS (SELECT i, a, c, 0 AS chunk, c AS run FROM s WHERE i = 1 UNION ALL
    SELECT s.i, s.a, s.c, CASE WHEN g.run + s.c <= 2000 THEN g.chunk ELSE g.chunk + 1 END, CASE WHEN g.run + s.c <= 2000 THEN g.run + s.c ELSE s.c END FROM g JOIN s ON s.i = g.i + 1),
  c AS (SELECT chunk, min(a) AS a, sum(c) AS n FROM g GROUP BY chunk)
  SELECT chunk, CASE WHEN chunk > 0 THEN a END AS lo, coalesce(lead(a) OVER (ORDER BY chunk), (SELECT hi + 1 FROM e)) AS hi, n::BIGINT AS rows FROM c""")
def i20_integer_chunks(spark, d):
    o = T.table(spark, d, "orders")
    lo, hi, n = o.agg(F.min("o_custkey"), F.max("o_custkey"), F.count("*")).first()
    got = chunks.integer_chunks((lo, hi, n), 2000, chunks.count_slices(o, "o_custkey"))
    return spark.createDataFrame([(i, *c) for i, c in enumerate(got)], "chunk int, lo bigint, hi bigint, rows bigint")


@query("SELECT chunk::BIGINT AS chunk, o_custkey FROM (SELECT *, lag(chunk) OVER (ORDER BY o_custkey) AS p FROM (SELECT o_custkey, (sum(n) OVER (ORDER BY o_custkey) - n) // 500 AS chunk FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1))) WHERE chunk <> p")
def i33_keyset_bounds(spark, d):
    return chunks.keyset_bounds(T.table(spark, d, "orders"), ["o_custkey"], 500)


@query(f"SELECT user_id, event_type, value, _start_lsn, _commit_ts FROM ({_IMAGE.format('')}) WHERE _operation NOT IN (1, 3)")
def j1_current_state(spark, d):
    return current.state(T.log(spark, d), ["user_id"])


@query(f"SELECT DISTINCT user_id FROM log WHERE _start_lsn > '{B_}'")
def j3_moved_keys(spark, d):
    return changelog.changes_after(T.changes(spark, d), B_).select("user_id").distinct()


# More of A to H


@query("SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def a19_present_columns(spark, d):
    """Of the columns that change rows carry (here those of orders and of customer), those that the table has and does not compute."""
    o = T.table(spark, d, "orders")
    wanted = [*o.columns, *T.table(spark, d, "customer").columns]
    return o.select(*present(wanted, o.columns, computed=[c for c in o.columns if c.endswith(("date", "custkey"))]))


def present(wanted: list[str], have: list[str], *, computed: list[str] = ()) -> list[str]:
    """Names of ``have`` that are wanted, ignoring case, in the order they are wanted; computed ones are left out."""
    gone, by = {c.lower() for c in computed}, {c.lower(): c for c in have}
    return [by[c.lower()] for c in wanted if c.lower() in by and c.lower() not in gone]


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey BETWEEN 500 AND 900 AND o_orderkey % 2 = 0")
def b20_literal_span(spark, d):
    """A semi join behind the span of its keys as literals, which the scan can prune by."""
    some = T.table(spark, d, "orders").where("o_orderkey between 500 and 900 and o_orderkey % 2 = 0").select("o_orderkey")
    lo, hi = some.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    o = T.table(spark, d, "orders").where(F.col("o_orderkey").between(F.lit(lo), F.lit(hi)))
    return current.semi(o, some, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("SELECT s.c_name, t.c_acctbal AS other FROM customer s LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) t ON s.c_name = t.c_name")
def c6_source_side(spark, d):
    """Rows of the source side with what the other has, for keys without an order."""
    s = T.table(spark, d, "customer").select("c_name")
    t = T.table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_name").alias("k"), F.col("c_acctbal").alias("other"))
    return s.join(t, F.col("c_name").eqNullSafe(F.col("k")), "left").select("c_name", "other")


@query("SELECT b.bucket, b.rows, l.n_name AS label FROM (SELECT o_custkey // 64 AS bucket, count(*) AS rows FROM orders GROUP BY 1) b LEFT JOIN nation l ON b.bucket = l.n_nationkey")
def c9_bucket_labels(spark, d):
    """Buckets with a label from a table of names, which not every bucket has."""
    labels = T.table(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("bucket"), F.col("n_name").alias("label"))
    return audit.buckets(T.table(spark, d, "orders"), "o_custkey", "int", 64).select("bucket", "rows").join(labels, "bucket", "left")


@query(f"SELECT {_MEASURES} FROM log")
def d2_observed_facts(spark, d):
    """The facts of a batch, measured while its rows pass."""
    from pyspark.sql import Observation

    seen = Observation()
    names = ("rows", "min_lsn", "max_lsn", "min_commit_ts", "max_commit_ts", "deletes", "inserts", "updates")
    measured = [c.cast("string").alias(n) if n.endswith("_ts") else c for c, n in zip(facts.measures(), names, strict=True)]
    T.log(spark, d).observe(seen, *measured).write.format("noop").mode("overwrite").save()
    got = seen.get
    rows = spark.createDataFrame([tuple(got[n] for n in names)], "rows bigint, min_lsn string, max_lsn string, a string, b string, deletes bigint, inserts bigint, updates bigint")
    return rows.select("rows", "min_lsn", "max_lsn", F.to_timestamp_ntz("a").alias("min_commit_ts"), F.to_timestamp_ntz("b").alias("max_commit_ts"), "deletes", "inserts", "updates")


@query(f"SELECT _chunk, count(*) AS rows FROM ({_BRONZE}) WHERE _chunk IS NOT NULL GROUP BY 1")
def d14_rows_per_chunk(spark, d):
    return changelog.snapshot_rows(_bronze(spark, d), chunked=True).groupBy("_chunk").agg(F.count("*").alias("rows"))


@query("SELECT count(*) AS rows, count(o_custkey) AS keyed FROM orders")
def d21_whole_count(spark, d):
    return T.table(spark, d, "orders").agg(F.count("*").alias("rows"), F.count("o_custkey").alias("keyed"))


@query(f"SELECT batch_id, rows FROM ({_FACTS}) WHERE event IS NULL AND app_id = 'odd' ORDER BY batch_id DESC LIMIT 1")
def f6_newest_facts(spark, d):
    return _facts(spark, d).where("event is null and app_id = 'odd'").select("batch_id", "rows").orderBy(F.col("batch_id").desc()).limit(1)


@query("SELECT o_orderkey FROM orders WHERE o_orderkey < 100 OR (o_orderkey >= 200 AND o_orderkey < 300)")
def g3_seek_pieces(spark, d):
    o = T.table(spark, d, "orders").select("o_orderkey")
    return o.where(keys.in_range(["o_orderkey"], None, (100,))).unionByName(o.where(keys.in_range(["o_orderkey"], (200,), (300,))))


@query(None)
def g4_report_union(spark, d):
    """A reconcile report: bucket rows, then key rows."""
    s, t = T.source_orders(spark, d), T.faulty_orders(spark, d)
    found = audit.compare_buckets(*[audit.buckets(x, "o_orderkey", "int", 512) for x in (s, t)])
    rows = audit.row_differences(s, t, ["o_orderkey"], _COLS)
    return found.select("bucket", "status").unionByName(rows.select("key", "failure_type"), allowMissingColumns=True)


ORACLES["g4_report_union"] = f"WITH {T.FAULTY}, {_BUCKETS} SELECT bucket, CASE WHEN source_rows = target_rows AND source_sum = target_sum THEN 'MATCH' ELSE 'MISMATCH' END AS status, NULL AS key, NULL AS failure_type FROM c UNION ALL SELECT NULL, NULL, key, failure_type FROM ({_DIFF})"


@query("SELECT DISTINCT user_id FROM (SELECT user_id FROM log WHERE _start_lsn > '" + B_ + "' UNION ALL SELECT o_orderkey FROM orders)")
def g5_held_and_unread_keys(spark, d):
    held = changelog.changes_after(T.changes(spark, d), B_).select("user_id")
    unread = T.table(spark, d, "orders").select(F.col("o_orderkey").alias("user_id"))
    return held.unionByName(unread).distinct()


@query("SELECT event_id, ts - INTERVAL 2 HOUR AS utc FROM events")
def h15_to_utc(spark, d):
    return T.table(spark, d, "events").select("event_id", clock.to_utc(F.col("ts"), "+02:00").alias("utc"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus IS DISTINCT FROM x THEN 'o_orderstatus' ELSE '' END AS detail FROM (SELECT *, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS x FROM orders)")
def h11_differing_columns(spark, d):
    o = T.table(spark, d, "orders")
    a, b = F.struct("o_orderkey", "o_orderstatus"), F.struct("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")).alias("o_orderstatus"))
    return o.select("o_orderkey", a.alias("a"), b.alias("b")).select("o_orderkey", keys.differing(["o_orderkey", "o_orderstatus"], "a", "b").alias("detail"))


@query("SELECT user_id, strftime(max(_commit_ts), '%Y-%m-%d %H:%M:%S') AS newest FROM log GROUP BY 1")
def h25_iso_times(spark, d):
    return T.log(spark, d).groupBy("user_id").agg(F.date_format(F.max("_commit_ts"), "yyyy-MM-dd HH:mm:ss").alias("newest"))
