"""One row for each identity, for tables that are appended to at least once.

The derived partition column follows from the time in the keys, so with it in the window's
keys a filter on the partition reaches the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SPAN_KEYS = ["start_time", "service_name", "trace_id", "span_id", "name"]
LOG_KEYS = ["timestamp", "time_unix_nano", "service_name", "trace_id", "span_id", "severity_number", "log_name", "insert_id"]
METRIC_KEYS = ["timestamp", "time_unix_nano", "service_name", "metric_name", "metric_type", "point_fingerprint"]


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by descending ``order``."""
    keys = keys + [c for c in ("start_hour", "log_date", "metric_date") if c in df.columns]
    w = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def spans_dedup(spans: DataFrame) -> DataFrame:
    return latest(spans, SPAN_KEYS, ["end_time_unix_nano", "receive_time_unix_nano"])


def logs_dedup(logs: DataFrame) -> DataFrame:
    return latest(logs, LOG_KEYS, ["receive_time_unix_nano"])


def metrics_dedup(metrics: DataFrame) -> DataFrame:
    return latest(metrics, METRIC_KEYS, ["receive_time_unix_nano"])
