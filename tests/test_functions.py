import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import clock, keys, lsn, types
from tidemark.operators import audit, changelog, facts
from tidemark.plans import chunks, tiles


@given(st.integers(0, lsn.MAX), st.integers(0, lsn.MAX))
def test_position_text_orders_like_numbers(a, b):
    assert (lsn.from_int(a) < lsn.from_int(b)) == (a < b)
    assert lsn.to_int(lsn.from_int(a)) == a


def test_positions():
    assert lsn.normalize("0xab") == lsn.normalize(b"\0" * 9 + b"\xab") == "0x" + "0" * 18 + "AB"
    assert lsn.before(lsn.ZERO) == lsn.ZERO and lsn.after(lsn.ZERO) == lsn.from_int(1)
    for bad in ("", "0x", "0xG", "1" * 21, b"\0"):
        with pytest.raises(ValueError):
            lsn.normalize(bad)


def test_position_columns(spark):
    numbers = [0, 1, 15, 16**10 - 1, 16**10, 2**79 + 12345, lsn.MAX - 1]
    df = spark.createDataFrame([(lsn.from_int(n),) for n in numbers] + [("junk",), (None,)], "p string")
    got = df.select(lsn.normalized(F.col("p")).alias("n"), lsn.as_number(lsn.normalized(F.col("p"))).alias("i"), lsn.shifted(lsn.normalized(F.col("p")), 1).alias("s")).collect()
    assert [r["i"] for r in got[:-2]] == numbers and [r["s"] for r in got[:-2]] == [lsn.from_int(n + 1) for n in numbers]
    assert got[-2]["n"] is None and got[-1]["i"] is None


def test_types():
    yes = [("smallint", "int"), ("tinyint", "double"), ("float", "double"), ("date", "timestamp_ntz"), ("int", "decimal(10,0)"), ("bigint", "decimal(22,2)"), ("decimal(10,2)", "decimal(12,4)"), ("STRING", "string"), ("decimal(10, 2)", "decimal(10,2)")]
    no = [("bigint", "int"), ("bigint", "double"), ("int", "decimal(9,0)"), ("decimal(10,2)", "decimal(10,3)"), ("string", "int"), ("timestamp_ntz", "date"), ("double", "float")]
    assert all(types.fits(*p) for p in yes) and not any(types.fits(*p) for p in no)
    assert types.spark_type("NVARCHAR") == "string" and types.spark_type("numeric", 12, 3) == "decimal(12,3)"
    with pytest.raises(types.UnmappedType):
        types.spark_type("geography")
    assert types.union_schema([("Id", "int"), ("amount", "decimal(10,2)")], [("id", "bigint"), ("amount", "decimal(20,4)"), ("note", "string")]) == [("Id", "bigint"), ("amount", "decimal(20,4)"), ("note", "string")]
    with pytest.raises(types.SchemaChanged):
        types.union_schema([("amount", "decimal(18,2)")], [("amount", "decimal(10,2)")])
    assert types.columns_of("a int, `b,``c` decimal(10,2)") == [("a", "int"), ("b,`c", "decimal(10,2)")]
    assert types.is_kind(RuntimeError("x tidemark.functions.types.DataLoss: y"), types.DataLoss)


def test_periods_and_bounds():
    t = datetime(2026, 1, 2, 3, 4, 5, 6)
    assert [clock.truncate(t, g) for g in clock.GRANULARITIES] == [datetime(2026, 1, 2, 3, 4), datetime(2026, 1, 2, 3), datetime(2026, 1, 2)]
    with pytest.raises(ValueError):
        clock.truncate(t, "week")
    assert keys.bound(20000, "date") == "2024-10-04" and keys.bound(10**9, "date") is None and keys.bound(1 << 63, "int") is None
    assert keys.bound_to_json((1, None, Decimal("1.50"))) == '[1, null, "1.50"]' and keys.bound_to_json((b"\x01",)) == '"0x01"' and keys.bound_to_json((date(2026, 1, 1),)) == '"2026-01-01"'
    assert keys.bound_from_json("[1, null]") == (1, None) and keys.bound_from_json("5") == (5,) and keys.bound_from_json(None) is None


def test_tuple_ranges_split_every_row_once(spark):
    rows = [(a, b) for a in (None, 1, 2, 3) for b in (None, 1, 2, 3)]
    df = spark.createDataFrame(rows, "a int, b int")
    first = lambda r: tuple((v is not None, v or 0) for v in r)
    for cut in rows:
        low = {tuple(r) for r in df.where(keys.in_range(["a", "b"], None, cut)).collect()}
        high = {tuple(r) for r in df.where(keys.in_range(["a", "b"], cut, None)).collect()}
        assert low == {r for r in rows if first(r) < first(cut)} and high == set(rows) - low


def counter(values):
    def count(lo, hi, width):
        out = {}
        for v in values:
            if lo <= v <= hi:
                out.setdefault((v - lo) // width, []).append(v)
        return [(s, min(x), max(x), len(x)) for s, x in sorted(out.items())]

    return count


def sizes(values, n):
    """Of a table that has one null key besides, which counts in the extent and is in no slice."""
    return [c[2] for c in chunks.integer_chunks((min(values), max(values), len(values) + 1), n, counter(values))]


def test_integer_chunks():
    assert sizes(range(12), 5) == [5, 5, 2]
    assert sizes([*range(10), *range(100, 110)], 3) == [3, 3, 3, 3, 3, 3, 2]
    got = chunks.integer_chunks((0, 11, 12), 5, counter(range(12)))
    assert got[0][0] is None and got[-1][1] == 12 and [c[1] for c in got[:-1]] == [c[0] for c in got[1:]]


@settings(deadline=None)
@given(st.lists(st.integers(-(10**6), 10**6), min_size=1, max_size=200), st.integers(1, 50))
def test_integer_chunks_tile(values, n):
    got = chunks.integer_chunks((min(values), max(values), len(values)), n, counter(values))
    assert got[0][0] is None and got[-1][1] == max(values) + 1
    assert all(a[1] == b[0] for a, b in zip(got, got[1:], strict=False))
    for lo, hi, rows in got:
        assert rows == sum((lo is None or v >= lo) and v < hi for v in values)


def test_waves_and_tiles():
    assert chunks.wave_rounds(60, 10) == 6 and chunks.wave_rounds(60, 10, 30) == 3 and chunks.wave_rounds(60, 100) == 1 and chunks.wave_rounds(60, None) == 1
    assert chunks.pause(None, 0, 1) and chunks.pause(5, 3, 4) and not chunks.pause(9, 3, 4)
    assert tiles.merge_tiles([("a", 3), ("b", 3), ("c", 3)], 5) == [("c", 9)] and tiles.merge_tiles([("a", 6), ("b", 5)], 5) == [("a", 6), ("b", 5)]
    assert changelog.pieces("b", "f", None) == [("older", "b", "f")]
    s = lsn.from_int(100)
    assert changelog.pieces(lsn.from_int(90), lsn.from_int(120), s) == [("older", lsn.from_int(90), lsn.from_int(99)), ("newer", s, lsn.from_int(120))]


def test_buckets_and_samples():
    fine = [(0, 3, 1, 3, 1), (1, 3, 1, 2, 1), (2, 1, 1, 9, 1), (3, 1, 1, 1, 1)]
    assert audit.merge_buckets(fine, 5) == [(0, 1, 6, 2, 5, 2), (2, 2, 1, 1, 9, 1), (3, 3, 1, 1, 1, 1)]
    assert audit.pick([(1, "MATCH"), (2, "MISMATCH"), (3, "IN_FLIGHT"), (4, "MATCH")], 1.0, 1)[0] == 2
    assert len(audit.pick([(i, "MATCH") for i in range(100)], 0.011)) == 2
    assert audit.fine_width(0, 99_999) == 1 and audit.fine_width(0, 100_000) == 2


def test_chunk_checks():
    c = lambda n, lo, hi, last=False, rows=1: {"chunk": n, "lo": lo, "hi": hi, "last": last, "rows": rows}
    good = [c(0, None, "5"), c(1, "5", "9", True)]
    held = {0: (1, "S1"), 1: (1, "S1")}
    kinds = lambda *a, **k: [(f[0], f[1]) for f in audit.check_chunks(*a, **k)]
    assert kinds("S1", good, held) == []
    assert kinds("S1", good[1:], held) == [("CHUNK_TILING", 0), ("CHUNK_ROWS", 0)]
    assert kinds("S1", [*good, good[1]], held) == [("CHUNK_TILING", 1)]
    assert kinds("S1", [c(0, "1", "5"), good[1]], held) == [("CHUNK_TILING", 0)]
    assert kinds("S1", [good[0], c(1, "6", "9", True)], held) == [("CHUNK_TILING", 1)]
    assert kinds("S1", good, {0: (2, "S1"), 1: (1, "S0")}) == [("CHUNK_ROWS", 0), ("CHUNK_STAMP", 1)]
    assert kinds("S1", good[:1], {0: (1, "S1")}) == [("CHUNK_TILING", 0)] and kinds("S1", good[:1], {0: (1, "S1")}, complete=False) == []
    assert kinds("S1", good, held | {7: (1, "S1")}) == [("CHUNK_ROWS", 7)]


def test_metrics_fold():
    a = {"to_lsn": "0x1", "rtt_ms": 3.0, "read_seconds": 0.5, "read_mb": 1.0, "network_wait_ms": 5}
    b = {"to_lsn": "0x2", "rtt_ms": 4.0, "read_seconds": 0.25, "read_mb": 0.5, "network_wait_ms": None}
    got = facts.fold_metrics([a, b])
    assert got["end_lsn"] == "0x2" and got["source_rtt_ms"] == 3.5 and got["read_seconds"] == 0.75 and got["network_wait_ms"] is None
    assert facts.fold_metrics([])["end_lsn"] is None


def test_latest_image_is_the_last_in_any_order(spark):
    from tidemark.operators import current

    rng = random.Random(5)
    log = [(rng.choice([None, 1, 2, 3]), lsn.from_int(16 * rng.randrange(6)), rng.randrange(4), lsn.from_int(i), rng.choice([1, 2, 4]), f"v{i}") for i in range(200)]
    rng.shuffle(log)
    df = spark.createDataFrame(log, "k int, _start_lsn string, _command_id int, _seqval string, _operation int, v string")
    want = {}
    for r in log:
        if r[0] not in want or r[1:5] > want[r[0]][1:5]:
            want[r[0]] = r
    for f in (current.latest_image, current.latest_image_agg):
        assert {r["k"]: r["v"] for r in f(df, ["k"]).collect()} == {k: r[5] for k, r in want.items()}
