"""SparkSession settings that the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_spark(app: str = "spanlake", **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for k, v in (SETTINGS | more).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
