"""Quarantined records from files, and replayed requests as files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality
from ..operators.stage import staged

_RECORD = "ingest_time string, signal string, error_code string, error_message string, service_name string, trace_id string, span_id string, raw_payload string"
#: Names of the signals in replayed envelopes.
ENVELOPES = {"traces": "spans", "logs": "logs", "metrics": "metrics"}
MICROSECONDS_FROM = 1_000_000_000_000


def time_of(text: Column) -> Column:
    """A time from ISO text (also with a trailing ``UTC``), or from a number of seconds, or of microseconds from 1e12 on."""
    number = text.try_cast("decimal(38,9)")
    micros = F.when(number >= MICROSECONDS_FROM, number).otherwise(number * 1_000_000)
    plain = F.regexp_replace(F.trim(text), " UTC$", "")
    return F.when(number.isNotNull(), F.timestamp_micros(micros.cast("bigint"))).otherwise(plain.try_cast("timestamp"))


def quarantine_files(spark: SparkSession, path: str) -> DataFrame:
    """Records of quarantine exports: files of one JSON array, or of one record a line. The files' names,
    which the driver lists anyway, say how each is read; an array is read by one task."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.ltrim("value").alias("value"))
    arrays = [r.file for r in lines.where(F.col("value").startswith("[")).select("file").distinct().collect()]
    rest = [r.file for r in lines.where(F.col("value").startswith("{")).select("file").distinct().collect() if r.file not in set(arrays)]
    parts = [spark.read.schema(_RECORD).json(rest)] if rest else []
    parts += [spark.read.schema(_RECORD).option("multiLine", True).json(arrays)] if arrays else []
    rows = parts[0] if parts else spark.createDataFrame([], _RECORD)
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.withColumn("ingest_time", time_of(F.col("ingest_time")))


def envelopes(requests: DataFrame, signal: str) -> DataFrame:
    """Request lines (column ``value``) in envelopes that name their signal."""
    return requests.select(F.concat(F.lit(f'{{"signal":"{ENVELOPES[signal]}","otlp":'), F.trim("value"), F.lit("}")).alias("value"))


def write_replay(quarantined: DataFrame, signal: str, path: str, **filters: object) -> None:
    """Writes the quarantined requests of a signal as lines of JSON, in the canonical order over the files. Rows are staged,
    so that what rejected them isn't part of the plan that orders them."""
    rows = staged(quarantined.where(F.col("signal") == signal), "quarantined")
    envelopes(quality.replayable(rows, signal, **filters), signal).write.mode("append").text(path)
