"""Queries that must give no row on no input."""

import pytest

from tidemark.queries import QUERIES

EMPTY = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


@pytest.mark.parametrize("name", ["f3_key_maximum", "f6_newest_facts", "f2_next_commits", "f5_newest_open_snapshot"])
def test_no_row_without_input(spark, tmp_path, name):
    for table, ddl in EMPTY.items():
        spark.createDataFrame([], ddl).write.parquet(f"{tmp_path}/{table}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).count() == 0
