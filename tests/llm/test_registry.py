"""Every query on empty tables, and on tables with null and repeated rows."""

import pytest

from tidemark.llm.registry import QUERIES

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}
ROWS = {
    "documents": [(1, "one two three four five six", "en", "a", 27), (2, "un deux trois quatre cinq", "fr", "a", 25)],
    "labels": [(1, 1, 0), (2, 0, 1)],
    "pages": [(1, "http://a.net/x", "<p>"), (2, "http://b.org/fr/y", "<p>")],
    "embeddings": [(0, [1.0, 2.0], 0), (1, [2.0, 1.0], 1)],
}


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    none, odd = tmp_path_factory.mktemp("none"), tmp_path_factory.mktemp("odd")
    for name, ddl in SCHEMAS.items():
        spark.createDataFrame([], ddl).write.parquet(f"{none}/{name}.parquet")
        null = tuple(None for _ in ROWS[name][0])
        spark.createDataFrame([*ROWS[name], ROWS[name][0], null, null], ddl).write.parquet(f"{odd}/{name}.parquet")
    return str(none), str(odd)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_and_odd_tables(spark, folders, name):
    assert QUERIES[name](spark, folders[0]).count() == 0
    n = QUERIES[name](spark, folders[1]).count()
    assert n == (1 if name == "op3_ann" else 5)
