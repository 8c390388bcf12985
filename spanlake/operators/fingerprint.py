"""Identities of records that have none of their own: digests of all their content.

Every field is framed as ``name=<bytes>:<value>`` and a line end, so no two records have the same
frame. Records that are equal within one batch are told apart by their number in it, which counts
stored records only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PREFIX = "fp1"


def framed(fields: dict[str, Column]) -> Column:
    """The fields in order, each with the number of bytes of its value; NULL counts as empty."""
    parts = []
    for name, c in fields.items():
        text = F.coalesce(c.cast("string"), F.lit(""))
        parts += [F.lit(f"{name}="), F.octet_length(text).cast("string"), F.lit(":"), text, F.lit("\n")]
    return F.concat(*parts)


def _origin() -> dict[str, Column]:
    c = F.col
    return {
        "resource.attributes": c("resource.attributes"), "resource.attributes_schema": c("resource.attributes_schema"), "resource.dropped_attributes_count": c("resource.dropped_attributes_count"),
        "resource_schema_url": c("resource_schema_url"), "instrumentation_scope.name": c("instrumentation_scope.name"), "instrumentation_scope.version": c("instrumentation_scope.version"),
        "instrumentation_scope.attributes": c("instrumentation_scope.attributes"), "instrumentation_scope.attributes_schema": c("instrumentation_scope.attributes_schema"),
        "instrumentation_scope.dropped_attributes_count": c("instrumentation_scope.dropped_attributes_count"), "scope_schema_url": c("scope_schema_url"),
    }


def _columns(names: list[str]) -> dict[str, Column]:
    return {n: F.col(n) for n in names}


def log_fields(rows: DataFrame) -> dict[str, Column]:
    """What identifies a log record: its values as they came (``identity``), where large ones were put away."""
    own = [
        "time_unix_nano", "observed_time_unix_nano", "trace_id", "span_id", "flags", "event_name", "severity_number", "severity_text",
        "body", "body_schema", "attributes", "attributes_schema", "dropped_attributes_count",
    ]
    fields = {"version": F.lit(PREFIX)} | _columns(own) | _origin()
    if "identity" in rows.columns:
        i = lambda c: F.col(f"identity.{c}")
        fields |= {"body": F.coalesce(i("body_plain"), F.lit("null")), "body_schema": F.coalesce(i("body_types"), F.lit('"empty"')), "attributes": i("own_plain"), "attributes_schema": i("own_types")}
        for part in ("resource", "instrumentation_scope"):
            fields |= {f"{part}.attributes": i(f"{part}_plain"), f"{part}.attributes_schema": i(f"{part}_types")}
    return fields


def metric_fields() -> dict[str, Column]:
    """As of logs; the description isn't part of a point's identity. Nested values go in as JSON."""
    own = [
        "service_name", "metric_name", "metric_type", "metric_unit", "aggregation_temporality", "is_monotonic", "time_unix_nano", "start_time_unix_nano", "flags",
        "attributes", "attributes_schema", "metadata", "metadata_schema", "value_type", "value_double", "value_int64", "count", "sum", "min", "max",
        "exp_scale", "exp_zero_count", "exp_zero_threshold",
    ]
    nested = {n: F.to_json(F.struct(n)) for n in ("explicit_bounds", "bucket_counts", "exp_positive", "exp_negative", "summary_quantiles", "exemplars")}
    return {"version": F.lit(PREFIX)} | _columns(own) | nested | _origin()


def with_fingerprint(rows: DataFrame, fields: dict[str, Column], out: str) -> DataFrame:
    """Sets ``out`` from the frame and the number of equal stored records before it in its batch."""
    kept = F.col("reason").isNull()
    rows = rows.withColumns({"__frame": framed(fields), "__kept": kept}).withColumn("__key", F.sha2("__frame", 256))
    nth = F.row_number().over(Window.partitionBy("batch", "__kept", "__key").orderBy("place")) - 1
    rows = rows.withColumn("__nth", nth)
    digest = F.sha2(F.concat("__frame", framed({"intra_batch_ordinal": F.col("__nth")})), 256)
    return rows.withColumn(out, F.concat(F.lit(f"{PREFIX}:"), digest)).drop("__frame", "__kept", "__key", "__nth")


def log_fingerprints(rows: DataFrame) -> DataFrame:
    """Log rows with ``record_fingerprint``; an entry without an identifier of its own gets it as ``insert_id``."""
    rows = with_fingerprint(rows, log_fields(rows), "record_fingerprint").drop("identity")
    return rows.withColumn("insert_id", F.coalesce("insert_id", "record_fingerprint"))


def metric_fingerprints(rows: DataFrame) -> DataFrame:
    return with_fingerprint(rows, metric_fields(), "point_fingerprint")


def retry_subset(rows: DataFrame, fields: dict[str, Column] | None = None) -> DataFrame:
    """Of the stored records of batches those to send again, so that each keeps its number and fingerprint.

    ``rows`` (as of ``backfill.transformed`` before helper columns are dropped) has two truth columns: ``sent`` (delivered to the
    service, whether acknowledged or not) and ``retry`` (not acknowledged). A record is sent again if it is to be retried, or was sent and has
    the same content as one of its batch that is: its number among equal records is only right if they come along. Records
    that were acknowledged come twice and fall together by their fingerprints. A record marked for retry but not as sent is kept all the same.
    """
    framed_rows = rows.withColumn("__frame", F.sha2(framed(log_fields(rows) if fields is None else fields), 256)).where(F.col("reason").isNull())
    owed = framed_rows.where("retry").select(F.col("batch").alias("__batch"), F.col("__frame").alias("__owed")).distinct()
    same = (F.col("batch") == F.col("__batch")) & (F.col("__frame") == F.col("__owed"))
    return framed_rows.where("sent OR retry").join(owed, same, "left_semi").drop("__frame")
