"""Time: verdict periods, lags, offsets and the source's clock."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

GRANULARITIES = ("minute", "hour", "day")


def check_granularity(g: str) -> str:
    if g not in GRANULARITIES:
        raise ValueError(f"granularity is one of {', '.join(GRANULARITIES)}, not {g!r}")
    return g


def truncate(ts: datetime, granularity: str) -> datetime:
    check_granularity(granularity)
    ts = ts.replace(second=0, microsecond=0)
    return ts if granularity == "minute" else ts.replace(minute=0) if granularity == "hour" else ts.replace(minute=0, hour=0)


def truncated(c: Column, granularity: str) -> Column:
    """The start of the period; date_trunc gives an instant, so the cast back keeps the wall clock."""
    return F.date_trunc(check_granularity(granularity), c).cast("timestamp_ntz")


def seconds_between(a: Column, b: Column) -> Column:
    """b - a in seconds, to the microsecond."""
    return F.timestamp_diff("MICROSECOND", a, b) / F.lit(1_000_000)


def _rounded(a: Column, b: Column, micros: int, per_unit: int) -> Column:
    """b - a in steps of ``micros``, half up, over the steps of a unit: whole numbers until the last division, so engines agree."""
    return F.floor((F.timestamp_diff("MICROSECOND", a, b) + F.lit(micros // 2)) / F.lit(micros)) / F.lit(per_unit)


def headroom_hours(position: Column, watermark: Column) -> Column:
    """How far the position is ahead of what the source still keeps, to the hundredth."""
    return _rounded(watermark, position, 36_000_000, 100)


def lag_seconds(position: Column, newest: Column) -> Column:
    return _rounded(position, newest, 1000, 1000)


def to_utc(local: Column, zone: str) -> Column:
    """Wall-clock time of a zone as UTC wall-clock time; a repeated hour is read as its first passage."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), local)


def parse_offset(text: Column) -> Column:
    """UTC wall clock of text like ``2026-01-02 03:04:05.1234567 -03:00``; digits below the microsecond are cut."""
    m = lambda g: F.regexp_extract(text, r"^(\d{4}-\d\d-\d\d)[ T](\d\d:\d\d:\d\d)(?:\.(\d{1,9}))? ?([+-])(\d\d):(\d\d)$", g)
    wall = F.to_timestamp_ntz(F.concat(m(1), F.lit(" "), m(2), F.lit("."), F.substr(F.rpad(m(3), 6, "0"), F.lit(1), F.lit(6))), F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS"))
    minutes = (m(5).cast("int") * 60 + m(6).cast("int")) * F.when(m(4) == "-", 1).otherwise(-1)
    return F.when(m(1) != "", F.timestamp_add("MINUTE", minutes, wall))


def went_back(timeline: DataFrame, *, order: str = "start_lsn", ts: str = "commit_ts", seconds: int = 60, zone: str | None = None, ranges: int | None = None) -> DataFrame:
    """Entries whose time is more than ``seconds`` before the entry before: where a zone's clock fell back.

    The timeline is one global order of ``order``. Entries are dealt by its ranges, and the last entry of
    each range is carried to the next: no task gets the whole timeline. With ``zone`` only a drop into an
    hour that the zone repeats counts: elsewhere it is the server's clock that was set.
    """
    from ..operators.ranges import how_many, range_of, sampled

    n = ranges or how_many(timeline.count())
    bounds = [F.lit(b[0]) for b in sampled(timeline, [order], n)]
    dealt = timeline.withColumn("_p", range_of(F.col(order), bounds))
    lag = F.lag(ts).over(Window.partitionBy("_p").orderBy(order))
    edges = dealt.groupBy("_p").agg(F.max_by(ts, order).alias("_last"))
    prior = edges.withColumn("_carry", F.lag("_last").over(Window.orderBy("_p"))).select("_p", "_carry")  # a row a range
    both = dealt.withColumn("before", lag).join(F.broadcast(prior), "_p").withColumn("before", F.coalesce("before", "_carry"))
    drop = seconds_between(F.col(ts), F.col("before")) > seconds
    if zone:
        drop = drop & repeated_hour(F.col(ts), zone)
    return both.where(drop).select(order, ts, "before")


def repeated_hour(local: Column, zone: str) -> Column:
    """Whether a zone's wall clock shows this time twice: an hour on in UTC it shows it again."""
    first = F.convert_timezone(F.lit(zone), F.lit("UTC"), local)
    again = lambda minutes: F.convert_timezone(F.lit("UTC"), F.lit(zone), F.timestamp_add("MINUTE", F.lit(minutes), first)) == local
    return again(60) | again(30) | again(-60) | again(-30)


def to_utc_in_order(timeline: DataFrame, zone: str, *, order: str = "start_lsn", ts: str = "commit_ts", ranges: int | None = None) -> DataFrame:
    """``timeline`` with utc: the first reading of a repeated hour before the clock fell back in it, the second from there on (by ``order``).

    Drops are a row a fall-back, so they are broadcast; a repeated time after a drop of its own hour takes the later reading.
    """
    drops = went_back(timeline, order=order, ts=ts, zone=zone, ranges=ranges).select(F.col(order).alias("_at"), F.date_trunc("day", F.col(ts)).cast("timestamp_ntz").alias("_day"))
    first = to_utc(F.col(ts), zone)
    # Which of the two readings convert_timezone gives is the platform's; the earlier and the later are its neighbours an hour apart.
    same = lambda minutes: F.convert_timezone(F.lit("UTC"), F.lit(zone), F.timestamp_add("MINUTE", F.lit(minutes), first)) == F.col(ts)
    earliest = F.when(same(-60), F.timestamp_add("MINUTE", F.lit(-60), first)).when(same(-30), F.timestamp_add("MINUTE", F.lit(-30), first)).otherwise(first)
    latest = F.when(same(60), F.timestamp_add("MINUTE", F.lit(60), first)).when(same(30), F.timestamp_add("MINUTE", F.lit(30), first)).otherwise(first)
    t = timeline.withColumn("_day", F.date_trunc("day", F.col(ts)).cast("timestamp_ntz"))
    met = t.join(F.broadcast(drops.groupBy("_day").agg(F.min("_at").alias("_at"))), "_day", "left")
    return met.select(*timeline.columns, F.when(F.col("_at").isNotNull() & (F.col(order) >= F.col("_at")) & repeated_hour(F.col(ts), zone), latest).otherwise(earliest).alias("utc"))


def one_offset(offsets: list[tuple[datetime, int]], first: datetime, last: datetime, *, margin_hours: int = 3, most_days: int = 7) -> int | None:
    """The one offset (minutes) of a range of local times, if there is one: the same from ``margin_hours`` before it to as much after, and the range short.

    ``offsets`` are the zone's (from, minutes) in order. None: each time is converted by itself.
    """
    if last - first >= timedelta(days=most_days):
        return None
    a, b = first - timedelta(hours=margin_hours), last + timedelta(hours=margin_hours)
    at = lambda t: next((m for since, m in reversed(offsets) if since <= t), offsets[0][1] if offsets else 0)
    found = {at(a), at(b), *[m for since, m in offsets if a <= since <= b]}
    return found.pop() if len(found) == 1 else None


@dataclass(frozen=True)
class Clock:
    """How a source's wall clock reads: a zone by name, or a fixed offset in minutes where it has no name for it.

    Read again for every batch, and carried by its ranges, so that all of a batch is read alike.
    """

    zone: str | None = None
    offset_minutes: int = 0

    def name(self) -> str:
        if self.zone:
            return self.zone
        sign = "-" if self.offset_minutes < 0 else "+"
        return f"{sign}{abs(self.offset_minutes) // 60:02d}:{abs(self.offset_minutes) % 60:02d}"

    def utc(self, local: Column) -> Column:
        if self.zone is None:
            return F.timestamp_add("MINUTE", F.lit(-self.offset_minutes), local)
        return local if self.zone.upper() == "UTC" else to_utc(local, self.zone)
