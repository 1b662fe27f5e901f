"""What the operators of this package share: folders, Arrow batches, words and their hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that one numpy pass takes at a time; a longer document is a pass of its own.
CHUNK_BYTES = 1 << 20
SHINGLE_WORDS = 5

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only where it is unset and all tasks run in this process, a fresh local one."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage and survives lost executors. Unlike ``checkpoint()`` it runs the plan
    once and stores compressed columns. The files stay until the folder is cleared.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def crc_mod(column: str, modulus: int):
    """crc32 of the column as text, modulo; a null id counts as 0."""
    return F.coalesce(F.crc32(F.encode(F.col(column).cast("string"), "UTF-8")) % modulus, F.lit(0))


def with_fields(df: DataFrame, **fields: str) -> T.StructType:
    """The schema of ``df`` with more fields: name=type."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(", ".join(f"{k} {v}" for k, v in fields.items())).fields])


def text_chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of about CHUNK_BYTES: first row, bytes, offsets of each text (one more than texts)."""
    if column.null_count:
        column = column.fill_null("")
    wide = column.cast(pa.large_string())
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = np.frombuffer(wide.buffers()[2] or b"", np.uint8)
    at, n = 0, len(wide)
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1)
        end = min(end, n)
        yield at, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(max(n, CHUNK_BYTES + (1 << 17)), base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes of a word that are hashed eight at a time; longer words go through xxh3.
_VECTOR_BYTES = 64


def word_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word (byte span): eight bytes a round, each round mixed before the next.

    No sum or polynomial over the bytes, so words of repeated or mirrored parts don't cancel out; two
    given words have one hash with a chance of about 2^-64.
    """
    size = (ends - starts).astype(np.int64)
    h = mix(size.astype(np.uint64) * np.uint64(_BASE) + np.uint64(1))
    if not len(h):
        return h
    eight = np.lib.stride_tricks.sliding_window_view(np.concatenate((data, np.zeros(8, np.uint8))), 8)
    live = np.flatnonzero(size <= _VECTOR_BYTES)
    at = 0
    while len(live):
        left = size[live] - at
        x = np.ascontiguousarray(eight[starts[live] + at]).view("<u8").reshape(-1).astype(np.uint64)
        x &= ~np.uint64(0) >> (8 * (8 - np.minimum(left, 8))).astype(np.uint64)
        h[live] = mix((h[live] ^ x) * np.uint64(_BASE) + np.uint64(0xD6E8FEB86659FD93))
        at += 8
        live = live[left > 8]
    for i in np.flatnonzero(size > _VECTOR_BYTES).tolist():
        h[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return h


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial over the bytes, for ``span_hash``."""
    up, _ = _powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; equal bytes give equal hashes wherever they stand.

    A polynomial modulo 2^64: good for dealing spans out, but long mirrored spans can share a hash,
    so what it says to be equal is compared where that matters. Words take ``word_hash``.
    """
    _, down = _powers(len(prefix))
    return mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word ``[^\\x20\\x09-\\x0D]+``."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    ink = ~SPACE[data]
    first, last = offsets[:-1][np.diff(offsets) > 0], offsets[1:][np.diff(offsets) > 0] - 1
    before, after = np.zeros_like(ink), np.zeros_like(ink)
    before[1:], after[:-1] = ink[:-1], ink[1:]
    before[first] = False
    after[last] = False
    starts, ends = np.flatnonzero(ink & ~before), np.flatnonzero(ink & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


_STEPS = np.array([pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) for i in range(64)], np.uint64)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, words: int = SHINGLE_WORDS) -> list[np.ndarray]:
    """For each text, the sorted distinct 64-bit hashes of its word shingles, A-Z lower-cased.

    A text of fewer words gives its whole sequence as one shingle; one without words gives none.
    """
    data = LOWER[data]
    starts, ends, owner = word_spans(data, offsets)
    n = len(offsets) - 1
    bounds = np.searchsorted(owner, np.arange(n + 1))
    if not len(starts):
        return [np.zeros(0, np.uint64)] * n
    h = word_hash(data, starts, ends)
    full = np.zeros(max(0, len(h) - words + 1), np.uint64)
    for i in range(words):
        full += h[i : i + len(full)] * _STEPS[i]
    full = mix(full)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= words:
            out.append(np.unique(full[a : b - words + 1]))
        elif b > a:
            out.append(mix(np.add.reduce(h[a:b] * _STEPS[: b - a], keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
