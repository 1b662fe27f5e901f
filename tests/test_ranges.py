"""Global orders dealt by ranges, against plain Python: many ranges, ties, nulls and one hot value."""

import random
from datetime import datetime, timedelta

import pytest

from tidemark.functions import clock
from tidemark.operators import asof, ranges
from tidemark.plans import chunks, tiles


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(ranges, "ROWS_PER_RANGE", 7)


def rows(n=120):
    rng = random.Random(3)
    return [(rng.choice([None, 1, 2, 3, 5, 8]), rng.choice("abcde")) for _ in range(n)] + [(4, "hot")] * 60


def order(r):
    return (r[0] is not None, r[0] or 0, r[1])


def test_tiles_and_keyset_bounds(spark, small):
    data = rows()
    df = spark.createDataFrame(data, "k int, s string").repartition(3)
    ordered = sorted(data, key=order)
    for n in (1, 4, 7, 300):
        size, more = divmod(len(ordered), n)
        starts = [t * size + min(t, more) for t in range(min(n, len(ordered)))]
        want = [(t + 1, *ordered[s]) for t, s in enumerate(starts) if t]
        assert sorted(tuple(r) for r in tiles.key_tiles(df, n, ["k", "s"]).collect()) == sorted(want, key=lambda x: x[0])
    got = {r["tile"]: (r["hi"], r["rows"]) for r in tiles.lsn_tiles(df.withColumnRenamed("s", "_start_lsn"), 6).collect()}
    flat = sorted(s for _, s in data)
    assert got == {t + 1: (flat[30 * t + 29], 30) for t in range(6)}
    bounds, last, seen = [], 0, 0
    for key in sorted(set(data), key=order):
        if seen // 25 != last:
            bounds.append((seen // 25, *key))
        last = seen // 25
        seen += data.count(key)
    assert sorted(tuple(r) for r in chunks.keyset_bounds(df, ["k", "s"], 25).collect()) == bounds
    none = df.limit(0)
    assert tiles.key_tiles(none, 3, ["k", "s"]).count() == 0 and chunks.keyset_bounds(none, ["k"], 5).count() == 0


def test_asof_over_many_ranges(spark):
    rng = random.Random(4)
    right = [(None, "open"), *[(k, f"v{k}") for k in sorted(rng.sample(range(1000), 90))]]
    left = [(i, rng.choice([None, 500, rng.randrange(-20, 1100)])) for i in range(400)]
    got = asof.asof_join(spark.createDataFrame(left, "i int, at int"), spark.createDataFrame(right, "k int, v string"), "at", "k", ["v"], ranges=9).collect()
    want = {(i, at, None if at is None else max((r for r in right if r[0] is None or r[0] <= at), key=lambda r: -99 if r[0] is None else r[0])[1]) for i, at in left}
    assert len(got) == len(left) and {tuple(r) for r in got} == want


@pytest.mark.parametrize("n", [1, 3])
def test_clock_goes_back_over_midnight(spark, n):
    at = lambda h, m, d=0: datetime(2024, 5, 1 + d, h, m)
    t = [("1", at(23, 0)), ("2", at(0, 30, 1)), ("3", at(23, 30)), ("4", at(0, 40, 1))]
    got = clock.went_back(spark.createDataFrame(t, "start_lsn string, commit_ts timestamp_ntz"), ranges=n).collect()
    assert [(r["start_lsn"], r["before"]) for r in got] == [("3", at(0, 30, 1))]


@pytest.mark.parametrize("n", [1, 3])
def test_repeated_hour_is_read_twice(spark, n):
    """America/Sao_Paulo fell back from 2018-02-18 00:00 to 2018-02-17 23:00; New York from 02:00 to 01:00 on 2024-11-03."""
    at = lambda h, m: datetime(2024, 11, 3, h, m)
    t = [("1", at(0, 50)), ("2", at(1, 10)), ("3", at(1, 50)), ("4", at(1, 5)), ("5", at(1, 55)), ("6", at(2, 5)), ("7", datetime(2024, 11, 4, 1, 10))]
    df = spark.createDataFrame(t, "start_lsn string, commit_ts timestamp_ntz")
    got = {r["start_lsn"]: r["utc"] for r in clock.to_utc_in_order(df, "America/New_York", ranges=n).collect()}
    assert got == {"1": at(4, 50), "2": at(5, 10), "3": at(5, 50), "4": at(6, 5), "5": at(6, 55), "6": at(7, 5), "7": datetime(2024, 11, 4, 6, 10)}
    set_back = [("1", at(12, 0)), ("2", at(11, 0))]  # no repeated hour: a clock that was set
    assert clock.went_back(spark.createDataFrame(set_back, "start_lsn string, commit_ts timestamp_ntz"), zone="America/New_York").count() == 0
    night = [("1", datetime(2018, 2, 17, 23, 50)), ("2", datetime(2018, 2, 17, 23, 10)), ("3", datetime(2018, 2, 18, 0, 10))]
    got = [r["utc"] for r in clock.to_utc_in_order(spark.createDataFrame(night, "start_lsn string, commit_ts timestamp_ntz"), "America/Sao_Paulo").orderBy("start_lsn").collect()]
    assert got == [datetime(2018, 2, 18, 1, 50), datetime(2018, 2, 18, 2, 10), datetime(2018, 2, 18, 3, 10)]


def test_one_offset_of_a_range():
    zone = [(datetime(2024, 1, 1), -300), (datetime(2024, 3, 10, 3), -240), (datetime(2024, 11, 3, 1), -300)]
    day = datetime(2024, 6, 1)
    assert clock.one_offset(zone, day, day + timedelta(days=6)) == -240
    assert clock.one_offset(zone, day, day + timedelta(days=7)) is None
    assert clock.one_offset(zone, datetime(2024, 3, 10, 5, 30), datetime(2024, 3, 10, 9)) is None
    assert clock.Clock(None, -210).name() == "-03:30" and clock.Clock("Europe/Paris").name() == "Europe/Paris"
