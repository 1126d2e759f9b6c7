"""Session settings that the engine expects."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: UTC everywhere, re-planning at run time, aggregates answered from Parquet footers.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build(master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName("tidemark").config(map=SETTINGS | extra)
    return (builder.master(master) if master else builder).getOrCreate()


def workdir(spark: SparkSession, name: str) -> str:
    """A new folder in spark.checkpoint.dir; only a local session without that setting gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-tidemark-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
