"""Every change-data query against its SQL, on the smallest tables."""

import decimal
from pathlib import Path

import duckdb
import pytest

from tidemark import job_queries  # noqa: F401  registers more
from tidemark.queries import ORACLES, QUERIES

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    if not DATA.exists():
        pytest.skip("no test tables")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(v):
    return float(v) if isinstance(v, decimal.Decimal | int) and not isinstance(v, bool) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sql, name):
    df = QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    got = sorted(([plain(v) for v in r] for r in df.select(*columns).collect()), key=repr)
    names = ", ".join(f'"{c}"' for c in columns)
    want = sorted(([plain(v) for v in r] for r in sql.execute(f"SELECT {names} FROM ({ORACLES[name]})").fetchall()), key=repr)
    assert got == want


def test_positions_of_large_ids(spark, tmp_path):
    """No event is left out, whatever its id: its position may need over 64 bits."""
    ids = [0, 1, 4_999_999, 5_000_000, 8_388_608, 20_000_000, 10**11]
    spark.createDataFrame([(i,) for i in ids], "event_id bigint").write.parquet(f"{tmp_path}/events.parquet")
    got = {r["event_id"]: r for r in QUERIES["h1_position_arithmetic"](spark, str(tmp_path)).collect()}
    text = lambda n: f"0x{n:020X}"
    assert sorted(got) == ids
    for i, r in got.items():
        n = i * (2**40 + 7)
        assert (r["canonical"], r["round_trip"], r["next"], r["previous"]) == (text(n), text(n), text(n + 1), text(max(n - 1, 0)))
