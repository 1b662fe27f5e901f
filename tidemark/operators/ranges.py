"""Global order without one big task: ranges by sampled bounds, and running totals over them."""

from __future__ import annotations

import math
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows that a range is meant to hold, and ranges at most (their bounds are literals of the plan).
ROWS_PER_RANGE = 200_000
MOST_RANGES = 4096


def how_many(rows: int) -> int:
    return max(1, min(MOST_RANGES, math.ceil(rows / ROWS_PER_RANGE)))


def sampled(df: DataFrame, cols: list[str], n: int) -> list[tuple[Any, ...]]:
    """At most ``n`` - 1 rows of ``cols``, least by hash: an even sample of the distinct values; sorted, NULL first."""
    if n < 2:
        return []
    some = df.select(*cols).distinct().orderBy(F.xxhash64(*cols), *cols).limit(n - 1)
    return [tuple(r) for r in some.orderBy(*[F.col(c).asc_nulls_first() for c in cols]).collect()]


def range_of(value: Column, bounds: list[Column]) -> Column:
    """How many of the ascending ``bounds`` are at most ``value``. Bounds are searched in two steps of about sqrt(n) each."""
    if not bounds:
        return F.lit(0)
    width = math.isqrt(len(bounds) - 1) + 1
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    below = lambda array: F.size(F.filter(array, lambda b: b <= value))
    if len(groups) == 1:
        return below(F.array(*bounds))
    first = below(F.array(*[g[0] for g in groups]))
    inside = F.get(F.array(*[F.array(*g) for g in groups]), F.greatest(first - 1, F.lit(0)))
    return F.when(first == 0, 0).otherwise((first - 1) * width + below(inside))


def running(counts: DataFrame, keys: list[str], n: str, *, ranges: int | None = None) -> DataFrame:
    """``counts`` (a row a key) with _before, the sum of ``n`` over all smaller keys, _prior, that of the key before (null for the first), and _total.

    Keys are dealt by ranges; what the ranges before hold is a row a range. NULL comes first.
    """
    parts = ranges or how_many(counts.count())
    packed = counts.schema
    key = F.struct(*keys)
    bounds = [F.struct(*[F.lit(v).cast(packed[k].dataType).alias(k) for k, v in zip(keys, b, strict=True)]) for b in sampled(counts, keys, parts)]
    dealt = counts.withColumn("_p", range_of(key, bounds))
    order = [F.col(k).asc_nulls_first() for k in keys]
    inside = Window.partitionBy("_p").orderBy(*order)
    held = dealt.withColumn("_own", F.sum(n).over(inside.rowsBetween(Window.unboundedPreceding, -1))).withColumn("_lag", F.lag(n).over(inside))
    last = dealt.groupBy("_p").agg(F.sum(n).alias("_sum"), F.max_by(n, key).alias("_last"))
    every = Window.orderBy("_p")  # a row a range
    ahead = last.select("_p", F.coalesce(F.sum("_sum").over(every.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"), F.lag("_last").over(every).alias("_edge"), F.sum("_sum").over(Window.partitionBy()).alias("_total"))
    both = held.join(F.broadcast(ahead), "_p")
    before = F.col("_base") + F.coalesce("_own", F.lit(0))
    return both.select(*counts.columns, before.alias("_before"), (before - F.coalesce("_lag", "_edge")).alias("_prior"), "_total")
