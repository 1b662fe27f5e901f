"""Suffix-array dedup: remove bytes covered by a long string that also starts elsewhere.

A string of LENGTH bytes is a window. Windows are dealt by their anchor, the leftmost least hash of
the short strings inside them, so equal windows meet wherever they stand; consecutive windows with
one anchor travel as one run.

1. Equal texts are one. If it is long enough for a window, all of it is covered.
2. Of each run only hashes are dealt, by a key of the bytes that all its windows share. A run whose
   key has no other place is done. Of equal contents two places stand for all.
3. The bytes of these are dealt by key, and the suffix sort decides: a task sorts the suffixes of a few
   million bytes at a time, blockwise with a difference cover (see ``diffcover``). Places beyond the
   two that stand for a content are covered if the sort covers those.
   A key of more than CROWD contents is split by more leading bytes: each of its windows becomes a run
   of its own whose key is the whole window, and goes through steps 2 and 3.
4. Covered spans meet their texts, which give up those bytes.

Hashes deal out work and tell which places have one content (two hashes of 64 bits) and which texts
are equal (one, with the length); two given ones that differ are taken for one with a chance of 2^-64.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .diffcover import repeated
from .shared import documents, durable, mix, prefix_hash, span_hash, text_chunks

LENGTH = 400
ANCHOR = 32
FILTER_BITS = 1 << 26
CROWD = 4096
#: Bytes of candidate runs sorted at a time, but for a key with more.
SORTED_AT_ONCE = 4 << 20
_PLACE_BITS = 22


def key_of(text: bytes) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def anchors(data: np.ndarray, offsets: np.ndarray, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: first start, number of windows, anchor. Windows lie within one text."""
    width = length - ANCHOR + 1
    n = len(data)
    empty = (np.zeros(0, np.int64),) * 3
    if n < length:
        return empty
    # Hash above, place below: the least value is the leftmost least hash.
    at = np.arange(n - ANCHOR + 1, dtype=np.uint64)
    bits = np.uint64(max(_PLACE_BITS, n.bit_length()))
    value = hashes >> bits << bits | at
    m = -(-len(value) // width) * width
    padded = np.full(m, ~np.uint64(0))
    padded[: len(value)] = value
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    starts = n - length + 1
    low = np.minimum(back[:starts], ahead[width - 1 : width - 1 + starts])
    anchor = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    # Windows that cross into the next text don't count.
    ok = np.zeros(n + 1, np.int64)
    sizes = np.diff(offsets)
    fit = sizes >= length
    np.add.at(ok, offsets[:-1][fit], 1)
    np.add.at(ok, offsets[1:][fit] - length + 1, -1)
    ok = np.cumsum(ok)[:starts] > 0
    new = np.ones(starts, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | ~ok[:-1]
    new[offsets[:-1][fit]] = True  # also where one text's windows follow another's
    first = np.flatnonzero(new & ok)
    end = np.flatnonzero(ok & np.append(new[1:] | ~ok[1:], True))
    return first, end - first + 1, anchor[first]


class Runs:
    """All runs of some texts, each cut where the bytes that its windows share would change: key, start, windows, content hash, owner."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
        self.data, self.offsets, self.length = data, offsets, length
        self.prefix = prefix_hash(data)
        n = len(data)
        at = np.arange(max(0, n - ANCHOR + 1))
        first, count, anchor = anchors(data, offsets, span_hash(self.prefix, at, at + ANCHOR) if len(at) else np.zeros(0, np.uint64), length)
        half = (length - ANCHOR) // 2
        # The distance from a window's start to its anchor falls along a run; the far half and the near half share different bytes.
        last = first + count - 1
        turn = anchor - half  # the first start of the near half
        parts = []
        for lo, hi, a, b in ((first, np.minimum(last, turn - 1), anchor - half - 1, anchor + ANCHOR), (np.maximum(first, turn), last, anchor, anchor + length - half)):
            some = hi >= lo
            parts.append((lo[some], hi[some] - lo[some] + 1, a[some], b[some]))
        lo, self.windows, a, b = (np.concatenate([p[i] for p in parts]) for i in range(4))
        self.start = lo
        self.key = span_hash(self.prefix, a, b).view(np.int64)
        self.content = self.hash_of(lo, lo + self.windows + length - 1)
        self.owner = np.searchsorted(offsets, lo, "right") - 1

    def hash_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix(span_hash(self.prefix, a, b) + np.uint64(0x51)).view(np.int64)


def _bits(df: DataFrame, column: str):
    """A broadcast bitmap of FILTER_BITS positions: 8 MB, however many values."""

    def run(batches):
        for batch in batches:
            at = np.unique(mix(batch.column(0).to_numpy().view(np.uint64)) % np.uint64(FILTER_BITS))
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32))], names=["at"])

    got = df.select(column).mapInArrow(run, "at int").distinct().toArrow()
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    at = got.column("at").to_numpy()
    np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return df.sparkSession.sparkContext.broadcast(bits)


def _has(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = (mix(values.view(np.uint64)) % np.uint64(FILTER_BITS)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7) & 1).astype(bool)


#: Places of runs: bucket, then arrays of key, content, text, start and windows.
_PLACES = "bucket long, key binary, content binary, text binary, start binary, windows binary"
_NAMES = ("key", "content", "text", "start", "windows")


def _deal(cols: dict[str, np.ndarray], buckets: int) -> pa.RecordBatch | None:
    if not len(cols["key"]):
        return None
    b = (mix(cols["key"].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(b, kind="stable")
    cuts = np.flatnonzero(np.diff(b[order], prepend=-1))
    ends = [*cuts[1:].tolist(), len(b)]
    out = [pa.array(b[order][cuts])]
    for name in _NAMES:
        x = cols[name][order].astype(np.int32 if name in ("start", "windows") else np.int64)
        out.append(pa.array([x[s:e].tobytes() for s, e in zip(cuts.tolist(), ends, strict=True)], pa.binary()))
    return pa.RecordBatch.from_arrays(out, names=["bucket", *_NAMES])


def _gather(batches) -> dict[str, np.ndarray]:
    held: dict[str, list] = {n: [] for n in _NAMES}
    for batch in batches:
        for name in _NAMES:
            held[name] += [np.frombuffer(x, np.int32 if name in ("start", "windows") else np.int64) for x in batch.column(name).to_pylist()]
    return {n: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for n, x in held.items()}


def _group(key: np.ndarray, content: np.ndarray) -> np.ndarray:
    """One value for a content of a key."""
    return mix(key.view(np.uint64) ^ mix(content.view(np.uint64) + np.uint64(0x2545F4914F6CDD1D))).view(np.int64)


def _settled(places: DataFrame, parts: int, length: int, crowd_at: int | None) -> DataFrame:
    """Rows kind, text, start, size, grp / kind 0: a place that follows the two of its content; 1: one of these (size is its mark); 2: a crowded key (size is the key)."""

    def run(batches):
        p = _gather(batches)
        if not len(p["key"]):
            return
        order = np.lexsort((p["start"], p["text"], p["content"], p["key"]))
        p = {n: x[order] for n, x in p.items()}
        same = lambda *names: np.logical_and.reduce([p[n][1:] == p[n][:-1] for n in names])
        place = np.concatenate(([True], ~same("key", "content", "text", "start")))  # equal rows are one place
        p = {n: x[place] for n, x in p.items()}
        new_content = np.concatenate(([True], ~same("key", "content")))
        new_key = np.concatenate(([True], p["key"][1:] != p["key"][:-1]))
        of_key = np.cumsum(new_key) - 1
        first = np.flatnonzero(new_content)
        rank = np.arange(len(new_content)) - first[np.cumsum(new_content) - 1]  # among the places of a content
        several = np.bincount(of_key)[of_key] > 1
        many = np.bincount(of_key[new_content])[of_key] > crowd_at if crowd_at else np.zeros(len(of_key), bool)
        grp = _group(p["key"], p["content"])
        rows = []
        for kind, some, size in ((0, several & ~many & (rank > 1), p["windows"] + length - 1), (1, several & ~many & (rank < 2), _mark(p["text"], p["start"])), (2, new_key & many, p["key"])):
            rows.append((np.full(int(some.sum()), kind), p["text"][some], p["start"][some], size[some], grp[some]))
        kind, text, start, size, grp = (np.concatenate([r[i] for r in rows]) for i in range(5))
        for s in range(0, len(kind), 1 << 16):
            e = s + (1 << 16)
            yield pa.RecordBatch.from_arrays([pa.array(kind[s:e].astype(np.int32)), *[pa.array(x[s:e]) for x in (text, start, size, grp)]], names=["kind", "text", "start", "size", "grp"])

    return places.repartition(parts, "bucket").mapInArrow(run, "kind int, text long, start long, size long, grp long")


def _mark(text: np.ndarray, start: np.ndarray) -> np.ndarray:
    return mix(text.view(np.uint64) ^ mix(start.astype(np.uint64))).view(np.int64)


def _chunks(batch: pa.RecordBatch):
    """First row, keys of the texts, bytes and offsets, a chunk at a time."""
    for at, data, offsets in text_chunks(batch.column("text")):
        raw = data.tobytes()
        keys = np.array([key_of(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)], np.int64)
        yield at, keys, data, offsets


def remove_repeats(df: DataFrame, *, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans (start, end of each removed run) for every row of ``df`` (doc_id, text).

    Every byte covered by a string of ``length`` bytes that also starts elsewhere (same text
    included) goes; repeated rows are elsewhere to each other. A null text is empty: nothing goes.
    Texts shorter than ``length`` lose nothing.
    """
    spark = df.sparkSession
    texts = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def identify(batches):
        for batch in batches:
            raw = [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([key_of(x) for x in raw], pa.int64()), pa.array([len(x) for x in raw], pa.int64())], names=["key", "n"])

    rows = texts.mapInArrow(identify, "key long, n long").where(F.col("n") >= length)
    sized = durable(rows.groupBy("key", "n").agg(F.count("*").alias("copies")))
    copied = durable(sized.where("copies > 1").select("key", "n"))
    parts = max(parts, sized.count() // 10_000)

    def runs(batch: pa.RecordBatch, crowds=None):
        """Runs of the batch's distinct texts, or with ``crowds`` (a bitmap of keys) each window of the runs that it lets through, a chunk at a time; and the bytes."""
        seen: set[int] = set()
        for _, keys, data, offsets in _chunks(batch):
            fresh = np.array([k not in seen and not seen.add(k) for k in keys.tolist()], bool)
            r = Runs(data, offsets, length)
            at, windows, owner, key, content = r.start, r.windows, r.owner, r.key, r.content
            ok = np.flatnonzero(fresh[owner] & (True if crowds is None else _has(crowds.value, key)))
            if crowds is None:
                at, windows, owner, key, content = at[ok], windows[ok], owner[ok], key[ok], content[ok]
            else:
                owner = np.repeat(owner[ok], windows[ok])
                at = np.repeat(at[ok], windows[ok]) + np.arange(len(owner)) - np.repeat(np.cumsum(windows[ok]) - windows[ok], windows[ok])
                windows, key, content = np.ones(len(at), np.int64), span_hash(r.prefix, at, at + length).view(np.int64), r.hash_of(at, at + length)
            yield data, at, {"key": key, "content": content, "text": keys[owner], "start": at - offsets[owner], "windows": windows}

    def places_of(crowds=None):
        def run(batches):
            for batch in batches:
                for _, _, cols in runs(batch, crowds):
                    if out := _deal(cols, parts * 4):
                        yield out

        return texts.mapInArrow(run, _PLACES)

    def candidates_of(marks, crowds=None):
        """The bytes of the places that stand for a content."""

        def run(batches):
            for batch in batches:
                for data, at, cols in runs(batch, crowds):
                    ok = np.flatnonzero(_has(marks.value, _mark(cols["text"], cols["start"])))
                    if not len(ok):
                        continue
                    size = cols["windows"][ok] + length - 1
                    held = [data[s : s + n].tobytes() for s, n in zip(at[ok].tolist(), size.tolist(), strict=True)]
                    grp = _group(cols["key"][ok], cols["content"][ok])
                    yield pa.RecordBatch.from_arrays([*[pa.array(cols[n][ok]) for n in ("key", "text", "start")], pa.array(grp), pa.array(held, pa.binary())], names=["key", "text", "start", "grp", "run"])

        return texts.mapInArrow(run, "key long, text long, start long, grp long, run binary")

    def sort(batches):
        """Covered spans of the runs; and, as rows of no size, the contents that are covered whole."""
        now, size, held = None, 0, {}

        def solve():
            ids, found = list(held), [x[0] for x in held.values()]
            n = np.array([len(x) for x in found])
            base = np.cumsum(n) - n
            windows = n - length + 1
            owner = np.repeat(np.arange(len(n)), windows)
            starts = base[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
            hit = repeated(np.frombuffer(b"".join(found), np.uint8), starts, length)
            at, who = (starts - base[owner])[hit], owner[hit]
            if len(at):
                cut = np.flatnonzero(np.concatenate(([True], (np.diff(at) != 1) | (np.diff(who) != 0))))
                stop = np.append(cut[1:], len(at)) - 1
                text = np.array([i[0] for i in ids], np.int64)
                first = np.array([i[1] for i in ids], np.int64)
                whole = np.flatnonzero(np.bincount(who, minlength=len(n)) == windows)
                grp = np.unique(np.array([x[1] for x in held.values()], np.int64)[whole])
                none, gone = np.zeros(len(grp), np.int64), np.zeros(len(cut), np.int64)
                cols = [(text[who[cut]], none), (first[who[cut]] + at[cut], none), (at[stop] - at[cut] + length, none), (gone, grp)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in cols], names=["text", "start", "size", "grp"])

        for batch in batches:
            for key, text, start, grp, run in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "start", "grp", "run")), strict=True):
                if key != now and size >= SORTED_AT_ONCE:
                    yield from solve()
                    size, held = 0, {}
                now = key
                if (text, start) not in held:
                    held[text, start] = (run, grp)
                    size += len(run)
        if held:
            yield from solve()

    def covered(settled: DataFrame, crowds=None) -> DataFrame:
        marks = _bits(settled.where("kind = 1"), "size")
        done = durable(candidates_of(marks, crowds).repartition(parts, "key").sortWithinPartitions("key").mapInArrow(sort, "text long, start long, size long, grp long"))
        follow = settled.where("kind = 0")
        # Contents that the sort does not cover whole: none, but for two that share their hashes. Groups meet, not their places.
        refused = durable(follow.select("grp").distinct().join(done.where("size = 0").select("grp").distinct(), "grp", "left_anti"))
        if not refused.isEmpty():
            follow = follow.join(refused, "grp", "left_anti")
        return done.where("size > 0").select("text", "start", "size").unionByName(follow.select("text", "start", "size"))

    settled = durable(_settled(places_of(), parts, length, CROWD))
    found = covered(settled)
    if not settled.where("kind = 2").isEmpty():
        crowds = _bits(settled.where("kind = 2"), "size")
        found = found.unionByName(covered(durable(_settled(places_of(crowds), parts, length, None)), crowds))
    whole = copied.select(F.col("key").alias("text"), F.lit(0).cast("long").alias("start"), F.col("n").alias("size"))
    found = durable(found.unionByName(whole))
    touched = _bits(found.select("text"), "text")

    def spans(batches):
        """The union of each text's covered spans."""
        now, held = None, []

        def out():
            s, n = np.array(held, np.int64).T
            order = np.argsort(s, kind="stable")
            s, e = s[order], np.maximum.accumulate((s + n)[order])
            cut = np.flatnonzero(np.concatenate(([True], s[1:] > e[:-1])))
            stop = np.append(cut[1:], len(s)) - 1
            return now, np.stack((s[cut], e[stop]), 1).astype(np.int64).tobytes()

        for batch in batches:
            rows = []
            for text, start, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if text != now and held:
                    rows.append(out())
                    held = []
                now = text
                held.append((start, size))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["key", "spans"])
        if held:
            k, b = out()
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([b], pa.binary())], names=["key", "spans"])

    merged = found.repartition(parts, "text").sortWithinPartitions("text").mapInArrow(spans, "key long, spans binary")
    result = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"

    def finish(doc: list, text: list[bytes], cover: list) -> pa.RecordBatch:
        rows = []
        for raw, c in zip(text, cover, strict=True):
            s = np.frombuffer(c, np.int64).reshape(-1, 2).tolist() if c else []
            kept, at = [], 0
            for a, b in s:
                kept.append(raw[at:a])
                at = b
            kept.append(raw[at:])
            rows.append((len(raw), sum(b - a for a, b in s), len(s), hashlib.sha256(b"".join(kept)).hexdigest(), [{"start": a, "end": b} for a, b in s]))
        n, gone, count, sha, s = zip(*rows, strict=True)
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(count, pa.int64()), pa.array(sha, pa.string()), pa.array(s, kind)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    def split(touch: bool):
        def run(batches):
            for batch in batches:
                raw = [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]
                keys = np.array([key_of(x) for x in raw], np.int64)
                at = np.flatnonzero(_has(touched.value, keys) == touch).tolist()
                if not at:
                    continue
                doc, some = batch.column("doc_id").take(pa.array(at)), [raw[i] for i in at]
                if touch:
                    yield pa.RecordBatch.from_arrays([doc, pa.array(keys[at]), pa.array(some, pa.binary())], names=["doc_id", "key", "raw"])
                else:
                    yield finish(doc.to_pylist(), some, [None] * len(some))

        return run

    def close(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, 500):
                part = batch.slice(s, 500)
                yield finish(part.column("doc_id").to_pylist(), part.column("raw").to_pylist(), part.column("spans").to_pylist())

    met = texts.mapInArrow(split(True), "doc_id long, key long, raw binary").join(merged, "key", "left").select("doc_id", "raw", "spans").mapInArrow(close, result)
    return texts.mapInArrow(split(False), result).unionByName(met)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document loses to repeats of 400 bytes. See ``remove_repeats``; an empty table gives no rows."""
    return remove_repeats(documents(spark, sf_dir)).drop("spans")
