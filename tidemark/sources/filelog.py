"""A change log as Parquet files, one file a group of commits: Spark's own file source then gives batches that end on a commit.

``maxFilesPerTrigger`` is the admission control, and predicates on positions reach the files' statistics.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def write_groups(log: DataFrame, path: str, commits: int) -> None:
    """Append the log as files of ``commits`` commits each, in commit order. The global window sees a row a commit."""
    order = Window.orderBy("_start_lsn")
    groups = log.select("_start_lsn").distinct().withColumn("_group", F.floor((F.row_number().over(order) - 1) / commits).cast("int"))
    dealt = log.join(groups, "_start_lsn")
    n = (groups.agg(F.max("_group")).first()[0] or 0) + 1
    ordered = dealt.repartitionByRange(n, "_group").sortWithinPartitions("_group", "_start_lsn", "_command_id", "_seqval", "_operation")
    ordered.write.mode("append").partitionBy("_group").parquet(path)


def read_groups(spark: SparkSession, path: str, schema, groups: int = 1) -> DataFrame:
    """The stream of the files, ``groups`` files a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", groups).option("recursiveFileLookup", "true").parquet(path)
