"""Jobs over a change feed: stream, snapshot, apply, reconcile, backfill, recover, and many streams at once."""

from __future__ import annotations

import json
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import keys as K
from ..functions import lsn
from ..functions.types import DataLoss
from ..operators import audit, changelog, current
from ..operators.facts import COMPLETED, chunks_of
from ..plans.chunks import count_slices, integer_chunks, keyset_bounds, pause, wave_rounds
from ..session import available_cores
from ..sources import sidefiles
from ..sources.feed import Store, register, stamp
from ..sources.migrations import migrate
from ..sources.versioned import BUCKETS, VersionedTable
from . import finality, lock
from .sink import bronze_writer, write_facts


@dataclass
class Tables:
    """Where a table's data and bookkeeping are."""

    bronze: str
    facts: str
    control: str
    silver: str | None = None


def _options(store: Store, table: str, more: dict[str, Any] | None = None) -> dict[str, str]:
    return {"path": store.path, "table": table} | {k: str(v) for k, v in (more or {}).items()}


# Streams


def opened(spark: SparkSession, path: str, kind: str) -> VersionedTable:
    """A bookkeeping table, brought to this release's version if it is there."""
    table = VersionedTable(spark, path)
    if table.exists():
        migrate(table, kind)
    return table


def events_of(spark: SparkSession, tables: Tables) -> list[dict[str, Any]]:
    """The target's events: a row a chunk, snapshot, switch or schema change."""
    f = opened(spark, tables.facts, "facts")
    if not f.exists():
        return []
    some = f.read().where((F.col("target") == tables.bronze) & F.col("event").isNotNull())
    return [r.asDict() for r in some.select("app_id", "event", "max_lsn", "detail", "rows", "batch_id", "written_at").collect()]


def generation(checkpoint: str) -> dict[str, Any]:
    """State of a stream's restarts: {generation, snapshot_lsn}; generation 0 is the checkpoint itself."""
    if "generation.json" not in sidefiles.names(checkpoint):
        return {"generation": 0, "snapshot_lsn": None}
    return sidefiles.read(checkpoint, "generation.json")


def checkpoint_of(checkpoint: str, number: int) -> str:
    return f"{checkpoint}/stream" if not number else f"{checkpoint}/stream.g{number}"


def committed_offset(folder: str) -> dict[str, Any] | None:
    """Offset of a checkpoint's last committed batch: the third line of its offset file."""
    done = [int(n) for n in sidefiles.listing(f"{folder}/commits") if n.isdigit()]
    return json.loads(sidefiles.text(f"{folder}/offsets", str(max(done))).splitlines()[2]) if done else None


def lost(store: Store, table: str, position: str) -> bool:
    """Whether changes after a position were purged from the instance that holds them."""
    found = store.instances(table)
    holder = [i for i in found if i["created"] <= lsn.after(position)] or found[:1]
    return lsn.after(position) < holder[-1]["low"]


def stream(spark: SparkSession, store: Store, table: str, tables: Tables, checkpoint: str, app_id: str, *, options: dict[str, Any] | None = None, on_loss: str = "fail", bootstrap: bool = False, resnapshot_days: float = 0.0, **trigger: Any) -> StreamingQuery:
    """Start the stream into bronze. ``on_loss``: fail, or resnapshot into a new generation, but not within ``resnapshot_days`` of the last. ``bootstrap``: begin with a snapshot.

    A restart tells the source where its checkpoint stands, so ``maxCommits`` holds for its first batch too.
    """
    if on_loss not in ("fail", "resnapshot"):
        raise ValueError("on_loss is fail or resnapshot")
    register(spark)
    bronze, facts = opened(spark, tables.bronze, "bronze"), opened(spark, tables.facts, "facts")
    state = generation(checkpoint)
    at = committed_offset(checkpoint_of(checkpoint, state["generation"]))
    more = dict(options or {})
    if at and lost(store, table, at["lsn"]) and on_loss == "resnapshot":
        if too_soon := lock.too_soon(events_of(spark, tables), now(), resnapshot_days):
            raise DataLoss(f"changes after {at['lsn']} were purged, and the last new snapshot is less than {resnapshot_days} days old: {too_soon}")
        number = state["generation"] + 1
        position = snapshot(spark, store, table, tables, f"{app_id}.g{number}", event="resnapshot", lost=(at["commit_ts"] or None, None))
        state, at = {"generation": number, "snapshot_lsn": position}, None
        sidefiles.write(checkpoint, "generation.json", state)
    elif at is None and bootstrap and state["snapshot_lsn"] is None:
        state["snapshot_lsn"] = found_snapshot(spark, tables) or snapshot(spark, store, table, tables, app_id, event="bootstrap")
        sidefiles.write(checkpoint, "generation.json", state)
    if state["snapshot_lsn"]:
        more["startingPosition"] = state["snapshot_lsn"]
    more["resume"] = at["lsn"] if at is not None else "start"
    more.setdefault("tasks", 2 * available_cores(spark))
    folder, app = checkpoint_of(checkpoint, state["generation"]), app_id if not state["generation"] else f"{app_id}.g{state['generation']}"
    events = f"{checkpoint}/events-{app}"
    rows = spark.readStream.format("tidemark_changes").options(**_options(store, table, more | {"events": events})).load()
    writer = rows.writeStream.foreachBatch(bronze_writer(bronze, app, facts, events=events)).option("checkpointLocation", folder)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def run_stream(spark: SparkSession, store: Store, table: str, tables: Tables, checkpoint: str, app_id: str, *, granularity: str = "hour", snapshot_on_switch: str | None = None, **more: Any) -> datetime | None:
    """Run until what is there now is read, then advance the verdict. The end is frozen first, so a busy source can't keep the run going.

    With ``maxCommits`` the batches are capped one after the other. ``snapshot_on_switch`` (full, or chunked: then ``backfill`` goes on with it)
    takes a snapshot after a batch that passed to a newer instance.
    """
    options = dict(more.pop("options", None) or {})
    options.setdefault("until", store.newest())
    if "maxCommits" in options:
        q = stream(spark, store, table, tables, checkpoint, app_id, options=options, processingTime="0 seconds", **more)
        try:
            q.processAllAvailable()
        finally:
            q.stop()
    else:
        q = stream(spark, store, table, tables, checkpoint, app_id, options=options, **more)
        q.awaitTermination()
    if snapshot_on_switch:
        after_switch(spark, store, table, tables, app_id, snapshot_on_switch)
    at = committed_offset(checkpoint_of(checkpoint, generation(checkpoint)["generation"]))
    return finality.advance(spark, tables.control, tables.bronze, at, granularity)


def after_switch(spark: SparkSession, store: Store, table: str, tables: Tables, app_id: str, mode: str) -> str | None:
    """A full snapshot, or the opening of a chunked one, if a switch has had none; its position."""
    events = events_of(spark, tables)
    if not lock.switches_to_snapshot(events) or lock.lock(events, mode, f"{app_id}#switch", min(i["low"] for i in store.instances(table))):
        return None
    if mode == "full":
        return snapshot(spark, store, table, tables, f"{app_id}#switch", event="resnapshot")
    return open_backfill(spark, store, table, tables, f"{app_id}#switch", store.keys(table), 1_000_000)[0]


# Snapshots


def found_snapshot(spark: SparkSession, tables: Tables) -> str | None:
    """Position of the newest whole snapshot in bronze."""
    b = VersionedTable(spark, tables.bronze)
    return changelog.snapshot_rows(b.read()).agg(F.max(F.coalesce("_snapshot", "_start_lsn"))).first()[0] if b.exists() else None


def snapshot(spark: SparkSession, store: Store, table: str, tables: Tables, app_id: str, *, event: str = "bootstrap", lost: tuple[Any, Any] = (None, None), copy: DataFrame | None = None) -> str:
    """Append the table's rows (or a copy of them) as one snapshot, and the event that completes it; returns its position."""
    register(spark)
    at = stamp(store, table)
    if copy is None:
        rows = spark.read.format("tidemark_snapshot").options(**_options(store, table, {"snapshotPosition": at})).load()
    else:
        inst = store.instances(table)[-1]
        ts = F.lit(store.time_of(at)).cast("timestamp_ntz")
        rows = changelog.stamped(changelog.seed(copy, dict(inst["columns"])), inst["name"], at, ts)
    b = VersionedTable(spark, tables.bronze)
    number = lsn.to_int(at) % (1 << 62)
    b.append(changelog.to_bronze(rows, None, at), txn=(f"{app_id}#snapshot", number))
    n = changelog.snapshot_rows(b.read(), at).count()
    fact = {"app_id": app_id, "event": event, "rows": n, "max_lsn": at, "min_lsn": at, "target": tables.bronze}
    since = datetime.fromisoformat(lost[0]) if lost[0] else None
    write_facts(spark, VersionedTable(spark, tables.facts), [fact | {"lost_from_ts": since, "lost_to_ts": lost[1]}], (f"{app_id}#snapshot", number))
    return at


# Current state


@dataclass
class Applied:
    bronze_found: bool
    rebuilt: bool = False
    applied_lsn: str | None = None
    waves: list[int] = field(default_factory=list)
    finalized_until: datetime | None = None


def apply_changes(spark: SparkSession, tables: Tables, *, instances: list[str], keys: list[str], buckets: int = 16) -> Applied:
    """Fold what bronze gained since the last call into silver, which is created with so many ``buckets`` of keys.

    The verdict and the position are read before bronze is pinned, so silver never claims more than
    it holds; the position is recorded after the merge, so a crash repeats work that changes nothing.
    A newer complete snapshot rebuilds silver; of an open chunked one, each new wave is applied.
    """
    verdict = finality.row_of(spark, tables.control, tables.bronze)
    mine = finality.row_of(spark, tables.control, tables.silver) or {}
    b = VersionedTable(spark, tables.bronze)
    if not b.exists():
        return Applied(False)
    f = VersionedTable(spark, tables.facts)
    events = events_of(spark, tables)
    log = b.read(b.version())
    whole = [e["max_lsn"] for e in events if e["event"] in COMPLETED] + ([s] if (s := found_snapshot(spark, tables)) else [])
    newest = max(whole, default=None)
    opened = max((e["max_lsn"] for e in events if e["event"] == "snapshot_open" and (newest is None or e["max_lsn"] > newest)), default=None)
    captured_ = [c for c in log.columns if not c.startswith("_")]
    applied = mine.get("applied_lsn")
    log = changelog.of_instances(log, instances)
    rebuild = newest is not None and newest > (mine.get("snapshot_lsn") or "") or (applied is None and not opened)
    silver = VersionedTable(spark, tables.silver)
    names = ", ".join(f"{K.quoted(c)} {log.schema[c].dataType.simpleString()}" for c in captured_)
    silver.create(f"{names}, _start_lsn string, _commit_ts timestamp_ntz", {BUCKETS: str(buckets)}).add_columns(names)
    later = changelog.changes_after(log, newest or lsn.ZERO) if rebuild else changelog.changes_after(log, applied or lsn.ZERO)
    if rebuild and newest:
        snap = log.where((F.col("_operation") == 0) & (F.coalesce("_snapshot", "_start_lsn") == newest))
        later = snap.unionByName(later)
    top = log.where("_operation <> 0").agg(F.max("_start_lsn")).first()[0]
    waves: list[int] = []
    images = later
    if opened and not rebuild:
        seen = (mine.get("snapshot_wave") or 0) if mine.get("open_snapshot_lsn") == opened else -1
        new = [c for c in chunks_of(f.read().where(F.col("target") == tables.bronze), opened).collect() if c["wave"] > seen]
        if new:
            waves = sorted({c["wave"] for c in new})
            held = changelog.snapshot_rows(log, opened, chunks=[c["chunk"] for c in new])
            # With each chunk row come all changes of its key since the snapshot opened: it may have been deleted meanwhile.
            again = current.semi(changelog.changes_after(log, opened), held.select(*keys).distinct(), keys)
            images = images.unionByName(held).unionByName(again).distinct()
            if len(keys) == 1:
                spans = spark.createDataFrame([(json.loads(c["lo"]) if c["lo"] else None, json.loads(c["hi"]) if c["hi"] else None, c["max_lsn"]) for c in new], "lo bigint, hi bigint, stamp string")
                if log.schema[keys[0]].dataType.simpleString() in ("bigint", "int", "smallint"):
                    gone = current.range_deletes(silver.read(), held, spans, keys[0])
                    images = images.unionByName(gone, allowMissingColumns=True)
    image = current.latest_image(images, keys).select(*captured_, "_start_lsn", "_commit_ts", "_operation")
    silver.merge_images(image, keys, rebuild=bool(rebuild and newest))
    state = {"applied_lsn": max(filter(None, (top, applied)), default=None), "open_snapshot_lsn": opened, "snapshot_wave": max([*waves, (mine.get("snapshot_wave") or 0) if opened else 0])}
    finality.put(spark, tables.control, tables.silver, **(state | ({"snapshot_lsn": newest} if rebuild and newest else {})))
    until = mine.get("finalized_until")
    if not opened and verdict and verdict["finalized_until"] and (until is None or verdict["finalized_until"] > until):
        until = verdict["finalized_until"]
        finality.put(spark, tables.control, tables.silver, finalized_until=until, end_lsn=verdict["end_lsn"], end_commit_ts=verdict["end_commit_ts"])
    return Applied(True, bool(rebuild), state["applied_lsn"], waves, until)


# Backfill


def rows_of(spark: SparkSession, store: Store, table: str, **options: Any) -> DataFrame:
    return spark.read.format("tidemark_snapshot").options(**_options(store, table, options)).load()


def plan_of(now_: DataFrame, keys: list[str], chunk_rows: int) -> tuple[str, list[tuple[Any, Any]]]:
    """(kind, bounds of the chunks): counted slices of one integer key, else the first keys of every ``chunk_rows`` rows (lists, NULL first). The last chunk is open above."""
    whole = now_.schema[keys[0]].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint")
    if len(keys) == 1 and whole:
        lo, hi, n = now_.agg(F.min(keys[0]), F.max(keys[0]), F.count(F.col(keys[0]))).first()
        chunks = integer_chunks((lo, hi, n), chunk_rows, count_slices(now_, keys[0])) if n else []
        cuts: list[Any] = [a for a, _, _ in chunks[1:]]
        kind = "int"
    else:
        found = keyset_bounds(now_, keys, chunk_rows)
        cuts = [[json.loads(K.bound_to_json((r[k],))) for k in keys] for r in found.orderBy("chunk").collect()]  # a row a chunk
        kind = "keyset"
    ends = [None, *cuts, None]
    return kind, list(zip(ends[:-1], ends[1:], strict=True))


def open_backfill(spark: SparkSession, store: Store, table: str, tables: Tables, app_id: str, keys: list[str], chunk_rows: int) -> tuple[str, dict[str, Any]]:
    """The open chunked snapshot to go on with, or a new one: its position, recorded before the extent of its keys, and its plan as stored."""
    register(spark)
    f = opened(spark, tables.facts, "facts")
    found = lock.lock(events_of(spark, tables), "chunked", app_id, min(i["low"] for i in store.instances(table)))
    if found is None:
        at = stamp(store, table)
        kind, plan = plan_of(rows_of(spark, store, table, snapshotPosition=at), keys, chunk_rows)
        detail = json.dumps({"mode": "chunked", "kind": kind, "keys": keys, "plan": plan, "chunk_rows": chunk_rows})
        write_facts(spark, f, [{"app_id": app_id, "target": tables.bronze, "event": "snapshot_open", "max_lsn": at, "detail": detail}], (f"{app_id}#open", lsn.to_int(at) % (1 << 62)))
        found = lock.lock(events_of(spark, tables), "chunked", app_id)  # what was stored counts, should another have been faster
        if found is None:  # it is complete already, and nothing was committed since
            return at, {"keys": keys, "plan": []}
    return found["max_lsn"], json.loads(found["detail"])


def headroom(spark: SparkSession, tables: Tables, app_id: str) -> tuple[float | None, float]:
    """The stream's newest measured headroom in hours, and how old that is."""
    f = opened(spark, tables.facts, "facts")
    row = f.read().where((F.col("app_id") == app_id) & F.col("event").isNull()).select("retention_headroom_hours", "written_at").orderBy(F.col("batch_id").desc()).limit(1).collect() if f.exists() else []
    if not row or row[0][0] is None:
        return None, 0.0
    return row[0][0], (now() - row[0][1]).total_seconds() / 3600


def backfill(
    spark: SparkSession, store: Store, table: str, tables: Tables, app_id: str, *, key: str | list[str], chunk_rows: int, chunks_per_wave: int = 2, waves: int | None = None,
    target_seconds: float | None = None, most_seconds: float | None = None, stream_id: str | None = None, least_headroom_hours: float = 0.0,
) -> str:
    """Read a big table in chunks beside its stream; a call goes on where the last one ended (``waves``: at most so many now).

    The snapshot is opened at a position recorded before its extent. Each wave is stamped before it
    is read and is one commit. While a wave's facts are written, a second thread already reads the next
    and writes its rows to files that no commit names yet. With ``target_seconds`` waves take as many
    rounds of ``chunks_per_wave`` as the pace so far fits in. With ``stream_id`` the call ends early
    when that stream's headroom is short. The last wave writes the event that completes the snapshot.
    """
    keys = [key] if isinstance(key, str) else list(key)
    at, opening = open_backfill(spark, store, table, tables, app_id, keys, chunk_rows)
    keys, plan = opening["keys"], [tuple(p) for p in opening["plan"]]
    if not plan:
        return at
    f, b = opened(spark, tables.facts, "facts"), opened(spark, tables.bronze, "bronze")
    base = {"app_id": app_id, "target": tables.bronze}
    said = [json.loads(e["detail"]) for e in events_of(spark, tables) if e["event"] == "snapshot_chunk"]
    ready = {d["chunk"] for d in said if d["snapshot"] == at}
    todo = [i for i in range(len(plan)) if i not in ready]
    number = max((d["wave"] for d in said if d["snapshot"] == at), default=-1) + 1
    app = f"{app_id}#snap.{at}"

    def read(wave: int, numbers: list[int]) -> tuple[str, Any, dict[int, int]]:
        """Stamp, then write the rows of some chunks aside, counted as they pass."""
        position, out = max(at, stamp(store, table)), None
        for i in numbers:
            span = {k: json.dumps(v) for k, v in zip(("lo", "hi"), plan[i], strict=True) if v is not None}
            part = rows_of(spark, store, table, snapshotPosition=position, chunk=i, **span)
            out = part if out is None else out.unionByName(part)
        seen = Observation()
        counted = changelog.to_bronze(out, None, at).observe(seen, *[F.count(F.when(F.col("_chunk") == i, 1)).alias(str(i)) for i in numbers])
        staged = b.stage(counted)
        return position, staged, {i: seen.get[str(i)] for i in numbers}

    def next_wave(pace: float | None) -> list[int]:
        rounds = wave_rounds(target_seconds, pace, most_seconds) if target_seconds else 1
        return [todo.pop(0) for _ in range(min(len(todo), rounds * chunks_per_wave))]

    pace, done, coming = None, 0, None
    with ThreadPoolExecutor(1) as ahead:
        while todo or coming:
            if waves is not None and done >= waves and not coming:
                break
            if stream_id and pause(*headroom(spark, tables, stream_id), least_headroom_hours) and not coming:
                break
            if not coming:
                numbers = next_wave(pace)
                coming = (numbers, ahead.submit(read, number, numbers))
            numbers, task = coming
            began = time.time()
            held = b.metadata_of(app, number)  # a wave that was committed before a crash: its facts are still to be written
            position, staged, counts = task.result()
            if held is None:
                b.append_staged(staged, txn=(app, number), metadata=json.dumps({"wave": number, "lsn": position, "chunks": {str(i): n for i, n in counts.items()}}))
            else:
                position, counts = held["lsn"], {int(i): n for i, n in held["chunks"].items()}
                todo = sorted({*todo, *numbers} - set(counts))
                numbers = sorted(counts)
            pace = max(time.time() - began, 1e-3) / max(1, -(-len(numbers) // chunks_per_wave))
            done += 1
            coming = None
            if todo and (waves is None or done < waves) and not (stream_id and pause(*headroom(spark, tables, stream_id), least_headroom_hours)):
                following = next_wave(pace)
                coming = (following, ahead.submit(read, number + 1, following))
            facts = []
            for i in numbers:
                lo_, hi_ = (None if v is None else json.dumps(v) for v in plan[i])
                facts.append(base | {"event": "snapshot_chunk", "rows": counts[i], "max_lsn": position, "detail": json.dumps({"snapshot": at, "wave": number, "chunk": i, "last": i == len(plan) - 1, "lo": lo_, "hi": hi_})})
            write_facts(spark, f, facts, (app, number))
            number += 1
    if not todo:
        total = sum(e["rows"] or 0 for e in events_of(spark, tables) if e["event"] == "snapshot_chunk" and json.loads(e["detail"])["snapshot"] == at)
        write_facts(spark, f, [base | {"event": "bootstrap", "rows": total, "max_lsn": at, "detail": json.dumps({"snapshot": at, "chunks": len(plan), "rows": total})}], (f"{app_id}#done", lsn.to_int(at) % (1 << 62)))
    return at


# Reconciling


@dataclass
class Reconciled:
    buckets: DataFrame
    failures: DataFrame
    counts: dict[str, int]


#: The report table, a row a merged bucket or failure.
REPORT = "run_id string, kind string, lo string, hi string, source_rows bigint, target_rows bigint, status string, key string, failure_type string, detail string"


def chunk_failures(spark: SparkSession, tables: Tables) -> list[tuple[str, int | None, str]]:
    """What is wrong with the newest chunked snapshot: its chunks as announced against the rows that bronze holds."""
    events = events_of(spark, tables)
    chunked = [e for e in events if e["event"] == "snapshot_open" and lock.mode_of(e["detail"]) != "full"]
    if not chunked:
        return []
    at = max(e["max_lsn"] for e in chunked)
    complete = any(e["event"] in COMPLETED and e["max_lsn"] == at for e in events)
    said = [(json.loads(e["detail"]), e) for e in events if e["event"] == "snapshot_chunk"]
    chunks = [{k: d.get(k) for k in ("chunk", "lo", "hi", "last")} | {"rows": e["rows"], "stamp": e["max_lsn"]} for d, e in said if d["snapshot"] == at]
    b = VersionedTable(spark, tables.bronze)
    rows = changelog.snapshot_rows(b.read(), at, chunked=True).groupBy("_chunk").agg(F.count(F.lit(1)).alias("n"), F.min("_start_lsn").alias("m")).collect() if b.exists() else []  # a row a chunk
    return audit.check_chunks(at, chunks, {r["_chunk"]: (r["n"], r["m"]) for r in rows}, complete=complete)


def reconcile(spark: SparkSession, source: DataFrame, tables: Tables, *, keys: list[str], kind: str = "int", bucket_rows: int = 1_000_000, sample: float = 0.01, seed: int | None = None, report: str | None = None, run_id: str = "run", computed: tuple[str, ...] = ()) -> Reconciled:
    """Compare silver with the source (read after silver's position was): buckets of the key first, then the rows of those that differ and of a sample; and the chunks of the newest snapshot.

    Fine buckets are united until the larger side has ``bucket_rows``; their sums, at most audit.FINE
    rows, are what the driver sees. ``computed`` columns are not compared. ``report`` is a table to append to.
    """
    row = finality.row_of(spark, tables.control, tables.silver) or {}
    silver = VersionedTable(spark, tables.silver).read()
    columns = [c for c in source.columns if not c.startswith("_") and c in silver.columns and c.lower() not in {x.lower() for x in computed}]
    b = VersionedTable(spark, tables.bronze)
    moved = changelog.changes_after(b.read(), row["applied_lsn"]).select(*keys) if b.exists() and row.get("applied_lsn") else None
    key = keys[0]
    if kind in ("int", "date") and len(keys) == 1:
        o = K.ordinal(F.col(key), kind)
        lo, hi = source.select(key).unionByName(silver.select(key)).agg(F.min(o), F.max(o)).first()
        width = audit.fine_width(lo or 0, hi or 0)
        found = audit.compare_buckets(*[audit.buckets(x, key, kind, width) for x in (source, silver)], moved.select(K.bucket(o, width).alias("bucket")) if moved is not None else None)
        fine = found.orderBy("bucket").collect()  # at most audit.FINE rows
        merged = audit.merge_statuses([tuple(r) for r in fine], bucket_rows)
        bounds = lambda m: (K.bound(m["first"] * width, kind), K.bound((m["last"] + 1) * width, kind))
        buckets = spark.createDataFrame([(i, *map(str, bounds(m)), m["source_rows"], m["target_rows"], m["status"]) for i, m in enumerate(merged)], "bucket bigint, lo string, hi string, source_rows bigint, target_rows bigint, status string")
        chosen = audit.pick([(i, m["status"]) for i, m in enumerate(merged)], sample, seed)
        spans = spark.createDataFrame([(b_,) for i in chosen for b_ in range(merged[i]["first"], merged[i]["last"] + 1)], "_b bigint")  # at most audit.FINE rows
        in_ = lambda df: df.withColumn("_b", K.bucket(o, width)).join(F.broadcast(spans), "_b", "left_semi").drop("_b")
        # Rows without a key are in no bucket, so they are always compared.
        some = lambda df: in_(df).unionByName(df.where(F.col(key).isNull()))
        failures = audit.row_differences(some(source), some(silver), keys, columns, moved)
    else:
        buckets = spark.createDataFrame([], "bucket bigint, lo string, hi string, source_rows bigint, target_rows bigint, status string")
        failures = audit.row_differences(source, silver, keys, columns, moved)
    wrong = spark.createDataFrame([(None if c is None else json.dumps({"chunk": c}), t, d) for t, c, d in chunk_failures(spark, tables)], "key string, failure_type string, detail string")
    failures = failures.unionByName(wrong)
    if report:
        out = VersionedTable(spark, report).create(REPORT)
        part = buckets.drop("bucket").withColumn("kind", F.lit("bucket")).unionByName(failures.withColumn("kind", F.lit("failure")), allowMissingColumns=True)
        out.append(part.withColumn("run_id", F.lit(run_id)).select(*[f.name for f in out.schema()]), txn=(f"report.{run_id}", 0))
        failures = out.read().where((F.col("run_id") == run_id) & (F.col("kind") == "failure")).select("key", "failure_type", "detail")
    return Reconciled(buckets, failures, {r["failure_type"]: r["n"] for r in failures.groupBy("failure_type").agg(F.count("*").alias("n")).collect()})


# Many streams


def start_many(spark: SparkSession, store: Store, names: list[str], tables: Tables, checkpoint: str, app_id: str, **more: Any) -> dict[str, StreamingQuery]:
    """One stream a table. Every path and the app_id must contain {ci}, which becomes the table's name."""
    for what, text in (("bronze", tables.bronze), ("checkpoint", checkpoint), ("app_id", app_id)):
        if "{ci}" not in text:
            raise ValueError(f"{what} needs {{ci}}, or streams would share it")
    out = {}
    for name in names:
        f = lambda s, n=name: s.replace("{ci}", n) if s else s
        out[name] = stream(spark, store, name, Tables(f(tables.bronze), f(tables.facts), f(tables.control), f(tables.silver)), f(checkpoint), f(app_id), **more)
    return out


def await_all(queries: dict[str, StreamingQuery], timeout: float | None = None) -> dict[str, str]:
    """Wait for all; what failed, by table."""
    out = {}
    for name, q in queries.items():
        try:
            q.awaitTermination(timeout) if timeout else q.awaitTermination()
        except Exception as e:  # the others go on
            out[name] = str(e)
    return out


def stop_all(queries: dict[str, StreamingQuery]) -> None:
    for q in queries.values():
        q.stop()


def check_loss(error: BaseException) -> bool:
    from ..functions.types import is_kind

    return is_kind(error, DataLoss)


def now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)
