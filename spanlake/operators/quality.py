"""Stored and rejected records: the split, error codes and quarantine rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..sources import otlp
from .stage import spread

MAX_ROW_BYTES = 1 << 20
MAX_PAYLOAD_BYTES, MAX_MESSAGE_BYTES = 8 << 20, 4 << 10
HELPERS = ["batch", "place", "reason", "field_path", "record", "resource_text", "scope_text", "payloads"]
_SPECIFIC = {("invalid_id", "trace_id"): "INVALID_TRACE_ID", ("invalid_id", "span_id"): "INVALID_SPAN_ID", ("missing_timestamp", "start_time"): "MISSING_START_TIME", ("missing_timestamp", "end_time"): "MISSING_END_TIME"}


def error_code(reason: str = "reason", path: str = "field_path") -> Column:
    """The published code of a rejection; reasons without one of their own in upper case."""
    out = F.when(F.col(reason) == "row_bytes", "OVERSIZE_ROW")
    for (r, p), code in _SPECIFIC.items():
        out = out.when((F.col(reason) == r) & (F.col(path) == p), code)
    return out.otherwise(F.upper(reason))


def with_row_limit(rows: DataFrame, table: str, max_bytes: int = MAX_ROW_BYTES) -> DataFrame:
    """Rejects rows whose JSON form is larger than ``max_bytes`` (the text's bytes, not those of a wire format)."""
    columns = [f.name for f in schemas.table_schema(table).fields]
    large = F.octet_length(F.to_json(F.struct(*columns))) > max_bytes
    found = F.col("reason").isNull() & large
    return rows.withColumns({"reason": F.when(found, "row_bytes").otherwise(F.col("reason")), "field_path": F.when(found, "row").otherwise(F.col("field_path"))})


def stored(rows: DataFrame) -> DataFrame:
    """Records without a problem, with all that came of them."""
    return rows.where("reason IS NULL")


def accepted(rows: DataFrame) -> DataFrame:
    """Rows of the table; records with a problem are left out."""
    return stored(rows).drop(*HELPERS)


def truncated(text: Column, max_bytes: int) -> Column:
    """At most ``max_bytes`` bytes of a text, cut between characters (of at most four bytes)."""
    raw = F.encode(text, "UTF-8")
    cut = [F.try_validate_utf8(F.substring(raw, 1, max(0, max_bytes - k)).cast("string")) for k in range(4)]
    return F.when(F.octet_length(text) <= max_bytes, text).otherwise(F.coalesce(*cut))


def quarantine(rows: DataFrame, signal: str, instance: str = "spanlake", payload: bool = True, max_payload: int = MAX_PAYLOAD_BYTES) -> DataFrame:
    """A row of ``otel_quarantine`` for each record with a problem: the record alone as an export
    request, so that it can be read again. ``payload=False`` keeps the identifiers only."""
    top, middle, leaf = otlp.SIGNALS[signal]
    part = lambda name, text: F.concat(F.lit(f'"{name}":'), F.coalesce(text, F.lit("{}")))
    url = lambda c: otlp.members(F.col(c).alias("schemaUrl"))
    inner = F.concat_ws(",", part("scope", "scope_text"), url("scope_schema_url"), F.concat(F.lit(f'"{leaf}":['), "record", F.lit("]")))
    outer = F.concat_ws(",", part("resource", "resource_text"), url("resource_schema_url"), F.concat(F.lit(f'"{middle}":[{{'), inner, F.lit("}]")))
    body = F.concat(F.lit(f'{{"{top}":[{{'), outer, F.lit("}]}"))
    ids = {c: F.col(c) if c in rows.columns else F.lit(None).cast("string") for c in ("trace_id", "span_id", "attributes")}
    out = rows.where("reason IS NOT NULL").select(
        F.col("receive_time").alias("ingest_time"), F.lit(signal).alias("signal"), error_code().alias("error_code"),
        truncated(F.concat_ws(": ", "reason", "field_path"), MAX_MESSAGE_BYTES).alias("error_message"), "service_name", ids["trace_id"].alias("trace_id"), ids["span_id"].alias("span_id"),
        (truncated(body, max_payload) if payload else F.lit(None).cast("string")).alias("raw_payload"), (ids["attributes"] if payload else F.lit(None).cast("string")).alias("raw_attributes"),
        F.lit(None).cast("string").alias("payload_ref"), F.lit(instance).alias("exporter_instance"), F.lit(schemas.SCHEMA_VERSION).alias("schema_version"),
    )
    return out


def replayable(quarantined: DataFrame, signal: str, codes: list[str] | None = None, start: str | None = None, end: str | None = None) -> DataFrame:
    """Payloads of a quarantine table as request lines (column ``value``), filtered by signal, code and time (both ends included), in a fixed order."""
    q = quarantined.where((F.col("signal") == signal) & F.col("raw_payload").isNotNull())
    q = q.where(F.col("error_code").isin(codes)) if codes else q
    q = q.where(F.col("ingest_time") >= F.lit(start).cast("timestamp")) if start else q
    q = q.where(F.col("ingest_time") <= F.lit(end).cast("timestamp")) if end else q
    # ``row_ord`` tells the rows of a group apart, so no texts go into the sample of sort keys that the driver takes
    return canonical(q).orderBy("ingest_time", "row_fp", "row_ord").select(F.col("raw_payload").alias("value"), "ingest_time", *CURSOR[1:])


#: What tells where a scan of quarantined rows stands.
CURSOR = ["ingest_time", "row_fp", "row_ord", "row_key", "group_size", "prefix_sha256", "group_sha256"]


def canonical(q: DataFrame) -> DataFrame:
    """Rows with the columns of ``CURSOR``. Rows of one microsecond and one hash (``row_fp``) are a group, in
    the order of their keys; equal rows are told apart by ``row_ord``, their number in the group. The
    digests cover the group's keys with their counts: up to the row, and all. A group has one key unless hashes
    collide, so keys and counts of a group are few however often a row repeats."""
    key = F.to_json(F.struct("signal", "error_code", "error_message", "service_name", "trace_id", "span_id", "raw_payload"), {"ignoreNullFields": "false"})
    q = q.withColumn("row_key", key).withColumn("row_fp", F.conv(F.substring(F.sha2("row_key", 256), 1, 15), 16, 10).cast("bigint"))
    group = ["row_fp", "ingest_time"]  # a sort compares the first key's bits, and times recur
    counts = q.groupBy(*group, "row_key").agg(F.count("*").alias("n"))
    framed = F.concat(F.octet_length("row_key").cast("string"), F.lit(":"), "row_key", F.lit(":"), F.col("n").cast("string"), F.lit(";"))
    w = Window.partitionBy(*group).orderBy("row_key")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    keys = counts.select(
        *group, "row_key", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"), F.sum("n").over(whole).alias("group_size"),
        F.array_join(F.collect_list(framed).over(before), "").alias("__head"), F.sha2(F.array_join(F.collect_list(framed).over(whole), ""), 256).alias("group_sha256"),
    )
    nth = F.row_number().over(Window.partitionBy(*group, "row_key").orderBy(F.lit(0)))
    rows = q.withColumn("__nth", nth.cast("bigint")).join(spread(keys), [*group, "row_key"])
    own = F.concat("__head", F.octet_length("row_key").cast("string"), F.lit(":"), "row_key", F.lit(":"), F.col("__nth").cast("string"), F.lit(";"))
    return rows.select(*q.columns, (F.col("__before") + F.col("__nth") - 1).alias("row_ord"), "group_size", F.sha2(own, 256).alias("prefix_sha256"), "group_sha256")
