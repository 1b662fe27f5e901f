"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch keeps the k smallest distinct 64-bit shingle hashes of a text. Sketches of parts merge by
union and the same cut, and estimate resemblance, containment and the number of distinct shingles.
As text a sketch is base64 of its hashes, ascending, little-endian.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import CHUNK_BYTES, documents, shingle_hashes, with_fields

K = 64
#: Documents that share a range of ids, and so a task, when each meets its successor.
RANGE_ROWS = 2000
MAX_RANGES = 100_000


def sketch(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """Bottom-k of sorted distinct hashes."""
    return hashes[:k]


def merge(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of the two texts' shingles together."""
    return np.union1d(a, b)[:k]


def to_text(s: np.ndarray) -> str:
    return base64.b64encode(s.astype("<u8").tobytes()).decode()


def from_text(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), "<u8")


def distinct(s: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below k."""
    return float(len(s)) if len(s) < k else (k - 1) / (float(s[k - 1]) / 2.0**64)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated Jaccard similarity. Two empty sketches are alike (1); an empty and another are not (0)."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = merge(a, b, k)
    return float(np.isin(both, np.intersect1d(a, b, assume_unique=True), assume_unique=True).sum() / len(both))


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    if not len(a):
        return 1.0
    share = resemblance(a, b, k) * distinct(merge(a, b, k), k) / distinct(a, k)
    return min(1.0, share)


def sketches(texts: list[str], k: int = K) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size < CHUNK_BYTES):
            size += len(texts[end])
            end += 1
        raw = [t.encode() for t in texts[at:end]]
        offsets = np.cumsum([0, *map(len, raw)])
        out += [sketch(h, k) for h in shingle_hashes(np.frombuffer(b"".join(raw), np.uint8), offsets)]
        at = end
    return out


def fingerprint(df: DataFrame, *, text: str = "text", k: int = K) -> DataFrame:
    """Add ``fingerprint``; a null text is empty, and an empty one (or one without words) has the empty fingerprint. A column of that name is replaced."""
    out = df.drop("fingerprint")
    fields = with_fields(out, fingerprint="string")

    def run(batches):
        for batch in batches:
            found = [to_text(s) for s in sketches([t or "" for t in batch.column(text).to_pylist()], k)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, "fingerprint"])

    return out.mapInArrow(run, fields)


def _dealt(r: np.ndarray, extra: int, to: np.ndarray) -> list[pa.Array]:
    """Range, whether a row is a copy from the next range, and the value that is dealt by."""
    return [pa.array(r, pa.int64()), pa.array(np.full(len(r), extra, np.int32)), pa.array(to[r % len(to)], pa.int64())]


#: Rows that leave ``with_successor`` at a time.
MET_AT_ONCE = 256


def with_successor(df: DataFrame, key: str, value: str, then: Callable[[pa.RecordBatch], pa.RecordBatch] | None = None, schema: str | None = None) -> DataFrame:
    """key, value and next_value: the value of the row with the next larger key (the smallest, after the largest).

    ``then`` (with its result's ``schema``) is applied to MET_AT_ONCE rows at a time where they meet.

    Rows are dealt by ranges of the key, bounded by approximate quantiles, so each is shuffled once;
    the first row of a range also goes to the range before it. Null keys come first; rows of one key
    are ordered by value, null as empty.
    """
    spark = df.sparkSession
    rows = df.select(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("k"), F.col(key).cast("long").alias(key), F.coalesce(F.col(value).cast("string"), F.lit("")).alias("v"))
    n = rows.select("k").count()
    ranges = max(1, min(MAX_RANGES, -(-n // RANGE_ROWS)))
    cuts = sorted({int(c) for c in rows.select(F.col("k").cast("double")).approxQuantile("k", [i / ranges for i in range(1, ranges)], 0.2 / ranges)}) if ranges > 1 else []
    bounds = np.array(cuts, np.int64)

    def range_of(k: pa.Array) -> np.ndarray:
        return np.searchsorted(bounds, k.to_numpy(), "right")

    def starts(batches):
        low: dict[int, int] = {}
        for batch in batches:
            k = batch.column("k").to_numpy()
            r = range_of(batch.column("k"))
            order = np.lexsort((k, r))
            first = np.flatnonzero(np.diff(r[order], prepend=-1))
            for i, v in zip(r[order][first].tolist(), k[order][first].tolist(), strict=True):
                low[i] = min(v, low.get(i, v))
        yield pa.RecordBatch.from_arrays([pa.array(list(low), pa.int64()), pa.array(list(low.values()), pa.int64())], names=["r", "k"])

    heads = {x["r"]: x["k"] for x in rows.select("k").mapInArrow(starts, "r long, k long").groupBy("r").agg(F.min("k").alias("k")).collect()}
    order = sorted(heads)
    before = {heads[r]: order[i - 1] for i, r in enumerate(order)}
    head_keys, head_to = np.array(sorted(before), np.int64), np.array([before[k] for k in sorted(before)], np.int64)

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), ranges // 4)
    # A value for each partition that Spark's hash deals there, so that ranges are dealt evenly and not by chance.
    asked = spark.range(64 * parts).select("id", F.pmod(F.hash("id"), F.lit(parts)).alias("p")).groupBy("p").agg(F.min("id").alias("id"))
    to = np.zeros(parts, np.int64)
    for x in asked.collect():  # a row a partition
        to[x["p"]] = x["id"]

    def deal(batches):
        for batch in batches:
            k = batch.column("k").to_numpy()
            at = np.minimum(np.searchsorted(head_keys, k), len(head_keys) - 1)
            copies = np.flatnonzero(head_keys[at] == k)
            yield pa.RecordBatch.from_arrays([*batch.columns, *_dealt(range_of(batch.column("k")), 0, to)], names=[*batch.schema.names, "r", "extra", "d"])
            more = batch.take(pa.array(copies))
            if len(copies):
                yield pa.RecordBatch.from_arrays([*more.columns, *_dealt(head_to[at[copies]], 1, to)], names=[*batch.schema.names, "r", "extra", "d"])

    def meet(batches):
        held = None
        for batch in batches:
            for at in range(0, batch.num_rows, MET_AT_ONCE):
                part, out = batch.slice(at, MET_AT_ONCE), []
                for k, v, r, extra in zip(*(part.column(c).to_pylist() for c in (key, "v", "r", "extra")), strict=True):
                    if held and held[2] == r and not held[3]:
                        out.append((held[0], held[1], v))
                    held = (k, v, r, extra)
                if out:
                    a, b, c = zip(*out, strict=True)
                    met = pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.string()), pa.array(c, pa.string())], names=[key, value, "next_value"])
                    yield then(met) if then else met

    dealt = rows.mapInArrow(deal, f"k long, {key} long, v string, r long, extra int, d long")
    return dealt.repartition(parts, "d").sortWithinPartitions("r", "extra", "k", "v").mapInArrow(meet, schema or f"{key} long, {value} string, next_value string")


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's fingerprint, its edited text's, and how alike it is to that and to the next document.

    Repeated doc_ids are rows of their own. An empty table gives no rows.
    """

    def compare(part: pa.RecordBatch) -> pa.RecordBatch:
        texts, after = part.column("text").to_pylist(), part.column("next_value").to_pylist()
        edited = [t[: len(t) - len(t) // 2] + x[: len(t) // 2] for t, x in zip(texts, after, strict=True)]
        own, other, following = sketches(texts), sketches(edited), sketches(after)
        return pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array([to_text(s) for s in own], pa.string()),
                pa.array([to_text(s) for s in other], pa.string()),
                pa.array([resemblance(a, b) for a, b in zip(own, other, strict=True)], pa.float64()),
                pa.array([resemblance(a, b) for a, b in zip(own, following, strict=True)], pa.float64()),
            ],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    columns = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_successor(documents(spark, sf_dir).select("doc_id", "text"), "doc_id", "text", compare, columns)
