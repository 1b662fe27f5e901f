"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents. Other columns of
documents are carried along, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, ngram_join, packing, quality, secrets
from tidemark.llm.shared import documents, durable


#: Rows of an Arrow batch: texts are long, and a batch is held several times over on its way to and from Python.
BATCH_ROWS = 2000


def _bounded(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; the rest stay as they are. A null text is empty and scored like any other; repeated rows share their score; without labels all have one score."""
    _bounded(spark)
    model = quality.train_on_labels(spark, docs, sf_dir)
    return quality.score(docs, model).where(F.col("score") >= quality.THRESHOLD).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays; of rows equal in doc_id and text, one.

    Different texts under one doc_id, or under none, are judged apart. Rows without words all stay.
    """
    _bounded(spark)
    return ngram_join.one_of_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret becomes a mark, and n_chars follows; documents without secrets stay as they are, null and empty texts too. Every row stays."""
    found = secrets.scan(docs, secrets.train(secrets.labelled_samples(spark)))
    n = F.when(F.size("secret_spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return secrets.redact(found).withColumn("n_chars", n).select(docs.columns)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rate says, so that languages meet their target shares of tokens. Every row stays, repeated ones and those without a text or an id too; those of scarce languages repeat."""
    _bounded(spark)
    rated = mixing.mixed(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return rated.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and their places in sequences of 2048. A null text is empty: its end token is packed."""
    _bounded(spark)
    return packing.pack(docs, packing.tokenizer_path())


STAGES = [
    ("quality", drop_poor),
    ("near copies", drop_near_copies),
    ("secrets", redact_secrets),
    ("mixing", mix_domains),
    ("packing", pack_sequences),
]

#: SQL expresses none of the models, so the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir))
    return docs
