"""The pipeline's stages on a small corpus, each against what it must keep."""

import brute
from pyspark.sql import functions as F

import corpus_pipeline as P


def test_stages(spark, docs, corpus, tmp_path):
    extra = [(5000, "my password=hunter2hunter2 is here and it is long enough to be a text", "de", "s", 69)]
    all_ = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    all_.write.parquet(str(tmp_path / "documents.parquet"))
    labels = all_.where("doc_id % 2 = 0").select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    d = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = P.drop_poor(spark, d, str(tmp_path))
    assert kept.count() == d.count() and kept.columns == d.columns  # all labels are good
    unique = P.drop_near_copies(spark, kept, str(tmp_path))
    want = {c for _, c in brute.near_components(corpus).values()} | {5000}
    assert {r["doc_id"] for r in unique.collect()} == want and unique.columns == d.columns
    clean = P.redact_secrets(spark, unique, str(tmp_path))
    assert clean.where("doc_id = 5000").first()["text"].startswith("my [SECRET] is here") and clean.columns == d.columns and clean.count() == unique.count()
    mixed = P.mix_domains(spark, clean, str(tmp_path))
    assert mixed.select("doc_id").distinct().count() == unique.count() and mixed.columns == d.columns
    assert [n for n, _ in P.STAGES] == ["quality", "near copies", "secrets", "mixing", "packing"]
    packed = P.run(spark, str(tmp_path))
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 2048").count() == 0
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == want
