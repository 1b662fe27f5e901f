"""Chunk plans for reading a big table next to its stream."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranges import running

#: Slices counted for each chunk, and at most in one pass.
SLICES_PER_CHUNK = 16
MOST_SLICES = 100_000

Counter = Callable[[int, int, int], list[tuple[int, int, int, int]]]


def count_slices(df: DataFrame, key: str) -> Counter:
    """(lo, hi, width) -> (first, last, rows) of the non-empty slices, with the slice's own least and greatest key."""

    def count(lo: int, hi: int, width: int) -> list[tuple[int, int, int, int]]:
        some = df.where((F.col(key) >= lo) & (F.col(key) <= hi))
        slice_ = F.floor((F.col(key).cast("bigint") - lo) / width)
        got = some.groupBy(slice_.alias("s")).agg(F.min(key).alias("a"), F.max(key).alias("b"), F.count(F.lit(1)).alias("n"))
        return [(r["s"], r["a"], r["b"], r["n"]) for r in got.orderBy("s").collect()]  # at most MOST_SLICES rows

    return count


def integer_chunks(extent: tuple[int, int, int], chunk_rows: int, count: Counter) -> list[tuple[int | None, int, int]]:
    """(lo, hi, rows) of chunks over an integer key: [lo, hi), the first open below, the last ending after the maximum.

    Slices of even width are counted, crowded ones again over their own span, then packed greedily.
    """
    if chunk_rows < 1:
        raise ValueError("chunk_rows must be positive")

    def slices(lo: int, hi: int, rows: int) -> list[tuple[int, int, int]]:
        n = min(MOST_SLICES, max(1, math.ceil(SLICES_PER_CHUNK * rows / chunk_rows)))
        width = max(1, math.ceil((hi - lo + 1) / n))
        out = []
        for _, a, b, k in count(lo, hi, width):
            if k > chunk_rows and width > 1 and a < b:
                out += slices(a, b, k)
            else:
                out.append((a, b, k))
        return out

    lo, hi, rows = extent
    chunks: list[list] = []
    for a, _, k in slices(lo, hi, rows) if rows else []:
        if chunks and chunks[-1][2] + k <= chunk_rows:
            chunks[-1][2] += k
        else:
            if chunks:
                chunks[-1][1] = a
            chunks.append([a if chunks else None, None, k])
    if not chunks:
        return [(None, hi + 1, 0)]
    chunks[-1][1] = hi + 1
    return [tuple(c) for c in chunks]


def keyset_bounds(df: DataFrame, keys: list[str], chunk_rows: int) -> DataFrame:
    """The first key of every chunk but the first; a key that repeats is never split. Distinct keys are counted, and the counts summed range by range."""
    at = running(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), keys, "n")
    chunk, prior = F.floor(F.col("_before") / chunk_rows), F.floor(F.col("_prior") / chunk_rows)
    return at.where(chunk != prior).select(chunk.alias("chunk"), *keys)


def wave_rounds(target_seconds: float, pace: float | None, most_seconds: float | None = None) -> int:
    """Rounds of a wave: what fits the target at the pace so far (seconds a round), one at least."""
    if not pace:
        return 1
    rounds = target_seconds / pace
    if most_seconds is not None:
        rounds = min(rounds, most_seconds / pace)
    return max(1, int(rounds))


def pause(headroom_hours: float | None, age_hours: float, least_hours: float) -> bool:
    """Whether a backfill should wait: what the stream has left (less since it was measured) is short, or unknown."""
    return headroom_hours is None or headroom_hours - age_hours < least_hours
