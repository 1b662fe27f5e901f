"""Cutting reads in parts of even work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranges import running

LEAST_ROWS = 50_000


def _tile_start(tile: Column, n: int, total: Column) -> Column:
    """First row (from 0) of a tile (from 0) of NTILE(n): the first ``total % n`` tiles have one row more."""
    return tile * F.floor(total / n) + F.least(tile, total % n)


def _tile_of(row: Column, n: int, total: Column) -> Column:
    size, more = F.floor(total / n), total % n
    long = more * (size + 1)
    return F.when(row < long, F.floor(row / (size + 1))).otherwise(more + F.floor((row - long) / F.greatest(size, F.lit(1)))).cast("int")


def ntile(df: DataFrame, n: int, *order: str) -> DataFrame:
    """NTILE(n) over one global order, without a task that sees all rows: (tile, the order columns, rows of that value in that tile).

    Rows are counted by distinct value, and the counts summed along the order range by range. A value
    whose rows lie in several tiles gives a row for each.
    """
    counts = df.groupBy(*order).agg(F.count(F.lit(1)).alias("_n"))
    at = running(counts, list(order), "_n")
    first, last = _tile_of(F.col("_before"), n, F.col("_total")), _tile_of(F.col("_before") + F.col("_n") - 1, n, F.col("_total"))
    tiles = at.withColumn("_tile", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("_before"), _tile_start(F.col("_tile"), n, F.col("_total")))
    end = F.least(F.col("_before") + F.col("_n"), _tile_start(F.col("_tile") + 1, n, F.col("_total")))
    return tiles.select((F.col("_tile") + 1).alias("tile"), *order, (end - begin).alias("rows"), (begin == _tile_start(F.col("_tile"), n, F.col("_total"))).alias("starts"))


def lsn_tiles(log: DataFrame, n: int) -> DataFrame:
    """tile, hi (its last position) and rows of ``n`` tiles of change rows; a commit's rows may lie in two tiles, as NTILE deals them."""
    return ntile(log, n, "_start_lsn").groupBy("tile").agg(F.max("_start_lsn").alias("hi"), F.sum("rows").alias("rows"))


def lsn_tiles_by_commit(log: DataFrame, n: int) -> DataFrame:
    """Tiles of whole commits: a commit lies in the tile of its last row."""
    commits = running(log.groupBy("_start_lsn").agg(F.count(F.lit(1)).alias("n")), ["_start_lsn"], "n")
    tile = (F.floor((F.col("_before") + F.col("n") - 1) * n / F.col("_total")) + 1).cast("int")
    return commits.select("_start_lsn", "n", tile.alias("tile")).groupBy("tile").agg(F.max("_start_lsn").alias("hi"), F.sum("n").alias("rows"))


def merge_tiles(tiles: list[tuple[str, int]], least: int = LEAST_ROWS) -> list[tuple[str, int]]:
    """(last position, rows) united until each has ``least`` rows; a short tail joins the one before."""
    out: list[tuple[str, int]] = []
    rows = 0
    for hi, n in tiles:
        rows += n
        if rows >= least:
            out.append((hi, rows))
            rows = 0
    if rows:
        out = [*out[:-1], (tiles[-1][0], out[-1][1] + rows)] if out else [(tiles[-1][0], rows)]
    return out


def key_tiles(df: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """The first key of tiles 2..n, nulls first."""
    return ntile(df, n, *keys).where("starts and tile > 1").select("tile", *keys)
