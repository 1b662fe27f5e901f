"""The current state of a table from its change log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .changelog import DELETE

#: Ranges whose rows and size are small enough to broadcast; beyond it they are joined by cell.
MOST_RANGES = 10_000


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def _image_order(columns: list[str]) -> list[Column]:
    out = [F.col("_start_lsn").desc()]
    if "_command_id" in columns:
        out.append(F.col("_command_id").desc_nulls_last())
    return [*out, F.col("_seqval").desc_nulls_last(), F.col("_operation").desc()]


def latest_image(log: DataFrame, keys: list[str]) -> DataFrame:
    """The last row of each key in commit order, deletes included. Ranking to 1 is limited before the shuffle too, so a busy key sends one row a task."""
    order = Window.partitionBy(*keys).orderBy(*_image_order(log.columns))
    return log.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") == 1).drop("_rank")


def latest_image_agg(log: DataFrame, keys: list[str]) -> DataFrame:
    """The same by one aggregation of structs: nothing is sorted, and each task sends a row a key."""
    rank = [F.col("_start_lsn"), *([F.coalesce("_command_id", F.lit(-1))] if "_command_id" in log.columns else []), F.coalesce("_seqval", F.lit("")), F.col("_operation")]
    rest = [c for c in log.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*rank)).alias("_row")
    return log.groupBy(*keys).agg(best).select(*[F.col(k) if k in keys else F.col(f"_row.{k}").alias(k) for k in log.columns])


def state(log: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """Current rows: the latest image of each key unless that deletes it (3 deletes its own key, which an update left)."""
    image = latest_image(log, keys).where(~F.col("_operation").isin(DELETE, 3))
    return image.select(*(columns or [c for c in image.columns if not c.startswith("_")]), "_start_lsn", "_commit_ts")


def semi(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right, null_safe(left, right, keys), "left_semi")


def anti(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right, null_safe(left, right, keys), "left_anti")


def merge(target: DataFrame, images: DataFrame, keys: list[str], *, rebuild: bool = False) -> DataFrame:
    """``target`` after the images (one row a key, with _operation): an image applies only if it is newer than the row.

    Deletes remove, others replace or insert. A rebuild also removes the target's keys that the
    images lack. A full outer join: one shuffle of each side, spilling like any sort-merge join.
    """
    columns = target.columns
    t, s = target.select(F.struct(*columns).alias("t"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]), images
    for c in columns:
        if c not in s.columns:
            s = s.withColumn(c, F.lit(None).cast(target.schema[c].dataType))
    s = s.select(F.struct(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in columns]).alias("s"), F.col("_operation").alias("_op"), *[F.col(k).alias(f"_j{i}") for i, k in enumerate(keys)])
    on = reduce(lambda a, b: a & b, [F.col(f"_k{i}").eqNullSafe(F.col(f"_j{i}")) for i in range(len(keys))])
    both = t.join(s, on, "full_outer")
    gone = F.col("_op").isin(DELETE, 3)
    newer = F.col("s._start_lsn") > F.col("t._start_lsn")
    kept = F.when(F.col("_op").isNull(), F.lit(None) if rebuild else F.col("t")).when(F.col("t").isNull(), F.when(~gone, F.col("s"))).when(newer, F.when(~gone, F.col("s"))).otherwise(F.col("t"))
    return both.select(kept.alias("r")).where("r is not null").select("r.*")


def range_deletes(current: DataFrame, held: DataFrame, ranges: DataFrame, key: str) -> DataFrame:
    """Synthetic deletes: keys of ``current`` in a chunk's [lo, hi) that the chunk does not hold and whose image is older than its stamp.

    ``ranges`` is (lo, hi, stamp), disjoint, nulls open. It has a row a chunk; its size is checked,
    and small sets are broadcast to a nested loop while larger ones meet keys by as-of order.
    """
    n = ranges.limit(MOST_RANGES + 1).count()
    span = ranges.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max(F.col("lo").isNull()).alias("open_lo"), F.max(F.col("hi").isNull()).alias("open_hi")).first()
    some = current
    if span and span["lo"] is not None and not span["open_lo"]:
        some = some.where(F.col(key) >= F.lit(span["lo"]))  # literal ends let file statistics skip
    if span and span["hi"] is not None and not span["open_hi"]:
        some = some.where(F.col(key) < F.lit(span["hi"]))
    if n <= MOST_RANGES:
        r = F.broadcast(ranges)
        inside = (F.col("lo").isNull() | (F.col(key) >= F.col("lo"))) & (F.col("hi").isNull() | (F.col(key) < F.col("hi"))) & F.col(key).isNotNull()
        hit = some.join(r, inside & (F.col("_start_lsn") < F.col("stamp")))
    else:
        # Disjoint ranges: a key can only be in the last that starts at or before it.
        from .asof import asof_join

        at = asof_join(some.where(F.col(key).isNotNull()), ranges.withColumnRenamed("lo", "_lo"), key, "_lo", ["hi", "stamp"])
        hit = at.where((F.col("hi").isNull() | (F.col(key) < F.col("hi"))) & (F.col("_start_lsn") < F.col("stamp")))
    return anti(hit.select(key, F.col("stamp").alias("_start_lsn"), F.lit(DELETE).alias("_operation")), held.select(key).distinct(), [key])
