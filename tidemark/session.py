"""A session for the jobs: the active one, or a local one whose times are UTC."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_spark(name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """The active session as it is; else a remote one if SPARK_REMOTE names it, else a local one (all cores, UTC, adaptive plans)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    if master is None and (remote := os.environ.get("SPARK_REMOTE")):
        return SparkSession.builder.remote(remote).appName(name).getOrCreate()
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true"} | conf
    return SparkSession.builder.appName(name).master(master or "local[*]").config(map=settings).getOrCreate()


def available_cores(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)
