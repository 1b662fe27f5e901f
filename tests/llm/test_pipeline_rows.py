"""Odd rows through the pipeline: repeated and null ids, null and empty texts, clashing columns, no rows at all."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tidemark.llm import ngram_join

DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"
A, B, C = "one two three four five six seven eight", "uno dos tres cuatro cinco seis siete", "eins zwei drei vier sechs sieben acht"


def rows(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in pairs], DDL).repartition(3)


def test_one_of_each_decides_by_text_not_by_id(spark):
    pairs = [(3, A), (5, A), (5, B), (5, B), (None, C), (None, C), (None, A), (None, None), (None, None), (7, ""), (7, ""), (9, "  ")]
    got = sorted(((r["doc_id"], r["text"]) for r in ngram_join.one_of_each(rows(spark, pairs)).collect()), key=repr)
    assert got == sorted([(3, A), (5, B), (None, C), (None, None), (None, None), (7, ""), (7, ""), (9, "  ")], key=repr)


def test_one_of_each_keeps_clashing_columns(spark):
    df = rows(spark, [(1, A), (2, A), (3, B)]).withColumns({"key": F.lit(1), "stays": F.lit("x"), "rep": F.lit(1.5), "h": F.lit(2), "root": F.lit(None).cast("int")})
    got = ngram_join.one_of_each(df)
    assert got.columns == df.columns and sorted(r["doc_id"] for r in got.collect()) == [1, 3]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    def write(pairs, labels):
        d = str(tmp_path_factory.mktemp("p"))
        rows(spark, pairs).write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        return d

    return write


def test_run_on_no_rows(spark, folder):
    assert P.run(spark, folder([], [])).count() == 0


def test_run_on_odd_rows(spark, folder):
    pairs = [(1, A), (1, A), (2, B), (2, C), (None, None), (None, "password=hunter2hunter2 stands here in a text of its own"), (4, "")]
    d = folder(pairs, [(1, 1, 0), (1, 1, 0), (2, 1, 0), (None, 0, 0), (3, None, None)])
    got = P.run(spark, d).select("doc_id", "length").collect()
    assert sorted({str(r["doc_id"]) for r in got}) == ["1", "2", "4", "None"]
    assert sum(r["doc_id"] == 2 for r in got) >= 2 and all(0 < r["length"] <= 2048 for r in got)


def test_mirrored_words_are_no_copies(spark):
    """Words built like Thue-Morse sequences collide in a polynomial hash modulo a power of two."""
    word = "a"
    for _ in range(11):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.near_components(rows(spark, [(1, word), (2, other), (3, word[:1024]), (4, other[:1024]), (5, word[:32]), (6, other[:32])])).collect()}
    assert got == {i: i for i in range(1, 7)}
