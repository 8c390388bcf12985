"""Schemas of the five tables, their partition columns, and a compatibility check."""

from __future__ import annotations

from pyspark.sql import types as T

SCHEMA_VERSION = "v0alpha2"

_RESOURCE = "resource struct<attributes:string, attributes_schema:string, dropped_attributes_count:bigint>"
_SCOPE = "instrumentation_scope struct<name:string, version:string, attributes:string, attributes_schema:string, dropped_attributes_count:bigint>"
_REFS = (
    "payload_refs array<struct<attribute_path:string, part_index:bigint, mime_type:string, storage_mode:string, byte_size:bigint, sha256:string, "
    "object_ref:struct<uri:string, version:string, authorizer:string, details:string>>>"
)
_BUCKETS = "struct<offset:bigint, bucket_counts:array<bigint>>"

SPANS = f"""
start_time timestamp NOT NULL, start_time_unix_nano bigint NOT NULL, end_time timestamp NOT NULL, end_time_unix_nano bigint NOT NULL,
receive_time timestamp NOT NULL, receive_time_unix_nano bigint NOT NULL, duration_nano bigint NOT NULL,
trace_id string NOT NULL, span_id string NOT NULL, parent_span_id string, trace_state string, flags bigint,
name string, kind bigint, kind_name string, status struct<code:bigint, code_name:string, message:string>,
attributes string, attributes_schema string, dropped_attributes_count bigint, dropped_events_count bigint, dropped_links_count bigint,
service_name string, {_RESOURCE}, resource_schema_url string, {_SCOPE}, scope_schema_url string,
events array<struct<time:timestamp, time_unix_nano:bigint, name:string, attributes:string, attributes_schema:string, dropped_attributes_count:bigint>>,
links array<struct<trace_id:string, span_id:string, trace_state:string, attributes:string, attributes_schema:string, dropped_attributes_count:bigint>>,
{_REFS}, schema_version string
"""

LOGS = f"""
timestamp timestamp NOT NULL, timestamp_source string, time_unix_nano bigint, observed_time timestamp, observed_time_unix_nano bigint,
receive_time timestamp NOT NULL, receive_time_unix_nano bigint NOT NULL, trace_id string, span_id string, flags bigint, event_name string,
severity_number bigint, severity_text string, body string, body_schema string, attributes string, attributes_schema string, dropped_attributes_count bigint,
service_name string, {_RESOURCE}, resource_schema_url string, {_SCOPE}, scope_schema_url string, {_REFS},
log_name string, insert_id string, record_fingerprint string, schema_version string
"""

METRICS = f"""
timestamp timestamp NOT NULL, time_unix_nano bigint NOT NULL, start_time timestamp, start_time_unix_nano bigint, receive_time timestamp NOT NULL, receive_time_unix_nano bigint NOT NULL,
service_name string, metric_name string NOT NULL, metric_description string, metric_unit string, metric_type string NOT NULL,
aggregation_temporality string, is_monotonic boolean, flags bigint, value_type string, value_double double, value_int64 bigint,
count bigint, sum double, min double, max double, explicit_bounds array<double>, bucket_counts array<bigint>,
exp_scale bigint, exp_zero_count bigint, exp_zero_threshold double, exp_positive {_BUCKETS}, exp_negative {_BUCKETS},
summary_quantiles array<struct<quantile:double, value:double>>,
exemplars array<struct<time:timestamp, time_unix_nano:bigint, value_double:double, value_int64:bigint, trace_id:string, span_id:string, filtered_attributes:string, filtered_attributes_schema:string>>,
attributes string, attributes_schema string, metadata string, metadata_schema string, {_RESOURCE}, resource_schema_url string, {_SCOPE}, scope_schema_url string,
point_fingerprint string, schema_version string
"""

QUARANTINE = """
ingest_time timestamp NOT NULL, signal string NOT NULL, error_code string NOT NULL, error_message string, service_name string, trace_id string, span_id string,
raw_payload string, raw_attributes string, payload_ref string, exporter_instance string, schema_version string
"""

ALERTS = """
alert_id string NOT NULL, alert_kind string NOT NULL, event_time timestamp NOT NULL, service_name string, trace_id string, span_id string, payload string
"""

#: Table: schema, partition column (derived from the time column) and the columns files are sorted by.
TABLES = {
    "otel_spans": (SPANS, ("start_hour", "date_trunc('HOUR', start_time)"), ["service_name", "trace_id", "name"]),
    "otel_logs": (LOGS, ("log_date", "to_date(timestamp)"), ["service_name", "trace_id", "severity_number"]),
    "otel_metrics": (METRICS, ("metric_date", "to_date(timestamp)"), ["service_name", "metric_name", "metric_type"]),
    "otel_quarantine": (QUARANTINE, ("ingest_date", "to_date(ingest_time)"), ["signal", "error_code", "service_name"]),
    "otel_alerts": (ALERTS, ("event_date", "to_date(event_time)"), ["alert_kind", "service_name"]),
}


def table_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table][0])


def compatibility(want: T.StructType, have: T.StructType, path: str = "") -> list[str]:
    """What keeps a stored table of schema ``have`` from taking rows of ``want``: missing or
    changed columns, and required ones that were added. More nullable columns are fine."""
    found = []
    stored = {f.name: f for f in have.fields}
    for f in want.fields:
        at = f"{path}{f.name}"
        if f.name not in stored:
            found.append(f"missing column {at}")
            continue
        a, b = f.dataType, stored[f.name].dataType
        while isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
            a, b, at = a.elementType, b.elementType, at + "[]"
        if isinstance(a, T.StructType) and isinstance(b, T.StructType):
            found += compatibility(a, b, f"{at}.")
        elif a.typeName() != b.typeName():
            found.append(f"column {at} is {b.simpleString()}, not {a.simpleString()}")
        if f.nullable and not stored[f.name].nullable:
            found.append(f"column {at} must not be required")
    names = {f.name for f in want.fields}
    found += [f"unknown required column {path}{f.name}" for f in have.fields if f.name not in names and not f.nullable]
    return found


def additions(want: T.StructType, have: T.StructType) -> list[T.StructField]:
    """Columns that an additive migration appends: always nullable."""
    stored = {f.name for f in have.fields}
    return [T.StructField(f.name, f.dataType, True) for f in want.fields if f.name not in stored]
