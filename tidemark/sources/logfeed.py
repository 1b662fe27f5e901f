"""A change feed over Parquet: commits, change rows by instance, and tables, each sorted, so that a range of positions or keys is read by file statistics.

It offers what ``capture.CaptureStore`` does for reading, and hands rows out as Arrow. ``meta.json``
names the tables, their keys and instances, and the schema changes.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import lsn

_ROWS = 10_000
#: Bytes of a row group of commits and change rows, so that a range reads little more than its own rows.
_GROUP = 1 << 20
#: Row groups of commits and change rows by folder, as long as the folder's files are these: (files, [(least, greatest, group)] by least).
_GROUPS: dict[str, tuple[tuple, list[tuple[str, str, ds.Fragment]]]] = {}


def _system(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))


def is_feed(path: str) -> bool:
    store, root = _system(path)
    return store.get_file_info(f"{root}/meta.json").type == fs.FileType.File


class LogFeed:
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    # Files

    def _data(self, name: str) -> ds.Dataset:
        store, root = _system(self.path)
        return ds.dataset(f"{root}/{name}", filesystem=store, format="parquet")

    def _meta(self) -> dict[str, Any]:
        store, root = _system(self.path)
        with store.open_input_stream(f"{root}/meta.json") as f:
            return json.loads(f.read())

    def _put(self, meta: dict[str, Any]) -> None:
        store, root = _system(self.path)
        with store.open_output_stream(f"{root}/meta.json.new") as f:
            f.write(json.dumps(meta).encode())
        store.move(f"{root}/meta.json.new", f"{root}/meta.json")

    # Commits

    def _groups(self, name: str = "timeline") -> list[tuple[str, str, ds.Fragment]]:
        """Row groups of the commits, or of an instance's change rows, by least position; footers are read once as long as the files stay. Without statistics a group may hold any."""
        folder = f"{self.path}/{name}"
        store, root = _system(folder)
        files = tuple(sorted((i.path, i.size, i.mtime_ns) for i in store.get_file_info(fs.FileSelector(root)) if i.is_file))
        if _GROUPS.get(folder, ((), []))[0] != files:
            pieces = [g for f in self._data(name).get_fragments() for g in f.split_by_row_group()]
            ends = [(g.row_groups[0].statistics or {}).get("lsn") or {"min": "", "max": "~"} for g in pieces]
            _GROUPS[folder] = files, sorted(((e["min"], e["max"], g) for e, g in zip(ends, pieces, strict=True)), key=lambda x: x[:2])
        return _GROUPS[folder][1]

    def _inside(self, name: str, lo: str, hi: str) -> list[tuple[str, ds.Fragment]]:
        """(least position, row group) of those that may hold rows of a closed interval, by least position."""
        return [(low, g) for low, high, g in self._groups(name) if low <= hi and high >= lo]

    def _end(self, some: ds.Expression | None, last: bool = True) -> dict[str, Any] | None:
        """The last (or first) commit that passes; only two columns and the row groups that may hold it are read."""
        best = None
        for b in self._data("timeline").to_batches(columns=["lsn", "ts"], filter=some):
            if b.num_rows:
                i = pc.index(b["lsn"], (pc.max if last else pc.min)(b["lsn"])).as_py()
                row = {"lsn": b["lsn"][i].as_py(), "ts": b["ts"][i].as_py().isoformat(sep=" ")}
                if best is None or (row["lsn"] > best["lsn"]) == last:
                    best = row
        return best

    def newest(self) -> str:
        """By the statistics of the files alone where they have them."""
        best = max((high for _, high, _ in self._groups()), default=lsn.ZERO)
        return best if best != "~" else (self._end(None) or {"lsn": lsn.ZERO})["lsn"]

    def time_of(self, position: str) -> str | None:
        """Time of the last commit up to a position; only the row groups that may hold it are read."""
        best: tuple[str, datetime] | None = None
        for low, high, g in sorted(self._groups(), key=lambda x: x[1], reverse=True):
            if best is not None and high <= best[0]:
                break
            if low <= position:
                b = g.to_table(columns=["lsn", "ts"], filter=pc.field("lsn") <= position)
                if b.num_rows:
                    i = pc.index(b["lsn"], pc.max(b["lsn"])).as_py()
                    found = b["lsn"][i].as_py(), b["ts"][i].as_py()
                    best = found if best is None else max(best, found)
        return best[1].isoformat(sep=" ") if best else None

    def position_at(self, ts: datetime) -> str | None:
        found = self._end(pc.field("ts") <= pa.scalar(ts, pa.timestamp("us")))
        return found["lsn"] if found else None

    def nth_after(self, position: str, n: int) -> str:
        """The n-th commit after a position, or the last there is: row groups are read in order until n commits lie below the next, and the n least are held, no more."""
        held = pa.array([], pa.string())
        for low, high, g in self._groups():
            if len(held) >= n and held[n - 1].as_py() < low:
                break
            if high > position:
                more = g.to_table(columns=["lsn"], filter=pc.field("lsn") > position)["lsn"].cast(pa.string()).combine_chunks()
                held = pa.concat_arrays([held, more])
                held = held.take(pc.sort_indices(held)[:n])
        return held[len(held) - 1].as_py() if len(held) else position

    def positions(self, lo: str, hi: str) -> list[str]:
        """Commits of a closed interval, in order."""
        held = [g.to_table(columns=["lsn"], filter=_between(lo, hi))["lsn"].to_pylist() for _, g in self._inside("timeline", lo, hi)]
        return sorted(p for some in held for p in some)

    def commit_rows(self, instance: str, lo: str, hi: str) -> list[tuple[str, int]]:
        """(position, rows) of the commits of a closed interval, in order; a row a commit, from one column."""
        out: dict[str, int] = {}
        for _, g in self._inside(f"changes/{instance}", lo, hi):
            t = g.to_table(columns=["lsn"], filter=_between(lo, hi)).group_by("lsn").aggregate([([], "count_all")])
            for at, n in zip(t["lsn"].to_pylist(), t["count_all"].to_pylist(), strict=True):
                out[at] = out.get(at, 0) + n
        return sorted(out.items())

    # Instances and tables

    def instances(self, table: str) -> list[dict[str, Any]]:
        return sorted((i for i in self._meta()["instances"] if i["table"] == table), key=lambda i: i["created"])

    def all_instances(self) -> list[dict[str, Any]]:
        return sorted(self._meta()["instances"], key=lambda i: i["created"])

    def low(self, instance: str) -> str:
        return next(i["low"] for i in self._meta()["instances"] if i["name"] == instance)

    def keys(self, table: str) -> list[str]:
        return self._meta()["keys"].get(table, [])

    def ddl(self, table: str, lo: str, hi: str) -> list[dict[str, str]]:
        return [d for d in self._meta()["ddl"] if d["table"] == table and lo < d["lsn"] <= hi]

    def estimate(self, table: str) -> int:
        """Rows of a table by its files' footers; no row is read."""
        return self._data(f"tables/{table}").count_rows()

    # Rows

    def change_batches(self, instance: str, lo: str, hi: str) -> Iterator[pa.RecordBatch]:
        """lsn, seq, op, command, ts and the captured columns, in commit order. Row groups are read one after the other, and rows below the next one's least position are sorted and handed out, so of an interval, however long, no more is held than groups that overlap."""
        spans = self._inside(f"changes/{instance}", lo, hi)
        commits = [g.to_table(columns=["lsn", "ts"], filter=_between(lo, hi)) for _, g in self._inside("timeline", lo, hi)]
        if not (spans and commits):
            return
        times = pa.concat_tables(commits).combine_chunks()
        held: pa.Table | None = None
        for (_, g), upto in zip(spans, [*[low for low, _ in spans[1:]], None], strict=True):
            some = g.to_table(filter=_between(lo, hi))
            held = some if held is None else pa.concat_tables([held, some])
            ready, held = (held, None) if upto is None else (held.filter(pc.field("lsn") < upto), held.filter(pc.field("lsn") >= upto))
            at = pc.index_in(ready["lsn"], value_set=times["lsn"])
            met = ready.append_column("ts", times["ts"].take(at)).filter(pc.is_valid(at)).combine_chunks()
            yield from met.sort_by([(c, "ascending") for c in ("lsn", "command", "seq", "op")]).to_batches(max_chunksize=_ROWS)

    def row_batches(self, table: str, key: str | None, lo: Any, hi: Any, part: int, parts: int, *, closed: bool = False) -> Iterator[pa.RecordBatch]:
        """Rows of lo <= key < hi (``closed``: <= hi, as the first key of a composite bound may be), every ``parts``-th fragment of row groups of them: no task reads all rows to leave some out."""
        some = None
        if key is not None and lo is not None:
            some = pc.field(key) >= lo
        if key is not None and hi is not None:
            under = pc.field(key) <= hi if closed else pc.field(key) < hi
            below = under | pc.field(key).is_null() if lo is None else under
            some = below if some is None else some & below
        pieces = [g for f in self._data(f"tables/{table}").get_fragments(filter=some) for g in f.split_by_row_group(filter=some)]
        for f in pieces[part::parts]:
            yield from f.to_batches(filter=some, batch_size=_ROWS)

    # Writing

    @classmethod
    def create(cls, path: str) -> LogFeed:
        out = cls(path)
        store, root = _system(path)
        store.create_dir(root, recursive=True)
        out._put({"keys": {}, "instances": [], "ddl": []})
        return out

    def put_timeline(self, commits: DataFrame, *, ordered: bool = False) -> None:
        """``commits``: lsn, ts. ``ordered``, here and below: they are dealt by ranges of positions and sorted already, and are written as they come."""
        some = commits.select("lsn", F.col("ts").cast("timestamp_ntz").alias("ts"))
        (some if ordered else _sorted(some, ["lsn"])).write.mode("overwrite").option("parquet.block.size", _GROUP).parquet(f"{self.path}/timeline")

    def put_instance(self, table: str, name: str, created: str, rows: DataFrame, *, keys: list[str], low: str | None = None, ordered: bool = False) -> None:
        """``rows``: lsn, seq, op, command, then the captured columns."""
        (rows if ordered else _sorted(rows, ["lsn", "command", "seq", "op"])).write.mode("overwrite").option("parquet.block.size", _GROUP).parquet(f"{self.path}/changes/{name}")
        meta = self._meta()
        columns = [[f.name, f.dataType.simpleString()] for f in rows.schema if f.name not in ("lsn", "seq", "op", "command")]
        meta["instances"] = [i for i in meta["instances"] if i["name"] != name] + [{"name": name, "table": table, "created": created, "columns": columns, "low": low or created}]
        meta["keys"][table] = keys
        self._put(meta)

    def put_table(self, table: str, rows: DataFrame, keys: list[str]) -> None:
        _sorted(rows, keys).write.mode("overwrite").parquet(f"{self.path}/tables/{table}")

    def cleanup(self, instance: str, low: str) -> None:
        """Move the low mark: what is below counts as purged, whether its files are gone yet or not."""
        meta = self._meta()
        for i in meta["instances"]:
            if i["name"] == instance:
                i["low"] = low
        self._put(meta)

    def alter(self, table: str, position: str, command: str) -> None:
        meta = self._meta()
        meta["ddl"].append({"table": table, "lsn": position, "command": command})
        self._put(meta)


def _between(lo: str, hi: str) -> ds.Expression:
    return (pc.field("lsn") >= lo) & (pc.field("lsn") <= hi)


def _sorted(df: DataFrame, by: list[str]) -> DataFrame:
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


def open_store(path: str):
    from .capture import CaptureStore

    return LogFeed(path) if is_feed(path) else CaptureStore(path)


def resolve(instances: list[dict[str, Any]], name: str) -> list[dict[str, Any]]:
    """All instances of the table that ``name`` captures, oldest first: by exact name, else ignoring case, which must not be ambiguous; a name that was dropped, but names a table by the default rule (schema_table), follows the table."""
    exact = [i for i in instances if i["name"] == name]
    loose = exact or [i for i in instances if i["name"].lower() == name.lower()]
    if len({i["table"] for i in loose}) > 1:
        raise ValueError(f"{name!r} is ambiguous: {', '.join(sorted(i['name'] for i in loose))}")
    table = loose[0]["table"] if loose else next((i["table"] for i in instances if f"dbo_{i['table']}".lower() == name.lower()), None)
    if table is None:
        raise ValueError(f"no capture instance {name!r}")
    return sorted((i for i in instances if i["table"] == table), key=lambda i: i["created"])
