"""Registered queries over the driver tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle
from .functions import anyvalue, jsonx
from .operators import dedup, fingerprint, offload, quality
from .operators.stage import dealt, shared_path, staged
from .plans import dashboards, marts, registry, sketches, trajectory, tvf, views
from .sources import archive, otlp, projection
from .streaming import alerts
from .tools import backfill, exchange

#: Bounds of the time-bounded queries, and the days of the reports.
START, END, CONTEXT_START, CONTEXT_END = "2024-01-05", "2024-01-12", "2024-01-04", "2024-01-13"
FIRST_DAY, LAST_DAY = "20240105", "20240111"


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.spans_dedup(projection.spans(spark, sf_dir))


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.logs_dedup(projection.logs(spark, sf_dir))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.metrics_dedup(projection.metrics(spark, sf_dir))


def genai(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.gen_ai_spans(spans(spark, sf_dir))


def once(g: DataFrame, tag: str, *bulky: str) -> DataFrame:
    """Semantic spans written once for several reads, without nested columns and those named."""
    return staged(g.drop("resource", "instrumentation_scope", "events", "links", "payload_refs", *bulky), tag)


def flat_top(df: DataFrame) -> DataFrame:
    """The top counts as text, ``value:count`` joined by commas."""
    text = F.array_join(F.transform("top_error_types", lambda x: F.concat(x["value"], F.lit(":"), x["count"].cast("string"))), ",")
    return df.withColumn("top_errors", text).drop("top_error_types")


def w1_spans_dedup(spark, d):
    return spans(spark, d).select("trace_id", "span_id", "service_name", "name", "start_time", "end_time", "duration_nano", "receive_time_unix_nano")


def w2_logs_dedup(spark, d):
    return logs(spark, d).select("trace_id", "span_id", "service_name", "timestamp", "receive_time_unix_nano", "severity_number", "event_name")


def w3_metrics_dedup(spark, d):
    return metrics(spark, d).select("point_fingerprint", "metric_name", "metric_type", "service_name", "timestamp", "value_double", "receive_time_unix_nano")


def v1_all_spans(spark, d):
    s = views.all_spans(spans(spark, d))
    return s.select("trace_id", "span_id", "parent_span_id", "name", "kind", "start_time", F.col("status.code").alias("status_code"), F.col("status.message").alias("status_message"))


def v2_gen_ai_spans(spark, d):
    return genai(spark, d).select(
        "start_time", "end_time", "duration_nano", "duration_ms", "trace_id", "span_id", "parent_span_id", "service_name", "span_name", "span_kind", "status_code", "status_message",
        "gen_ai_operation_name", "gen_ai_system", "gen_ai_provider_name", "gen_ai_request_model", "gen_ai_response_model", "gen_ai_agent_name", "gen_ai_conversation_id", "adk_session_id",
        "adk_invocation_id", "adk_user_id", "gen_ai_usage_input_tokens", "gen_ai_usage_output_tokens", "gen_ai_usage_reasoning_tokens", "gen_ai_usage_cache_read_input_tokens", "gen_ai_tool_name",
        "gen_ai_tool_type", "error_type", "gen_ai_main_agent_name",
    )


def v3_mcp_spans(spark, d):
    return views.mcp_spans(spans(spark, d)).select(
        "trace_id", "span_id", "service_name", "start_time", "duration_ms", "mcp_method_name", "mcp_session_id", "mcp_resource_uri", "server_address", "server_port",
        "gen_ai_tool_name", "gen_ai_agent_name", "is_tool_call", "also_in_gen_ai_view",
    )


def v4_gen_ai_metrics(spark, d):
    return views.gen_ai_metrics(metrics(spark, d)).select(
        "point_fingerprint", "metric_name", "metric_type", "service_name", "timestamp", "value_double", "gen_ai_system", "gen_ai_request_model", "gen_ai_token_type", "gen_ai_agent_name",
        "error_type", "gen_ai_inference_usage_dimension",
    )


def v5_spans_redacted(spark, d):
    s = views.spans_redacted(spans(spark, d))
    return s.select("trace_id", "span_id", "name", "start_time", F.col("status.code").alias("status_code"), F.col("status.message").alias("status_message"), "attributes")


def v5_logs_redacted(spark, d):
    return views.logs_redacted(logs(spark, d)).select("trace_id", "span_id", "event_name", "timestamp", "body", "attributes")


def j1_gen_ai_logs(spark, d):
    return views.gen_ai_logs(logs(spark, d), spans(spark, d)).select(
        "trace_id", "span_id", "service_name", "timestamp", "event_name", "severity_number", "gen_ai_operation_name", "gen_ai_system", "gen_ai_agent_name", "adk_session_id", "adk_user_id", "error_type"
    )


def j2_metric_exemplars(spark, d):
    points = views.gen_ai_metrics(metrics(spark, d))
    x = views.metric_exemplars(points.withColumn("metric_unit", F.regexp_replace("point_fingerprint", "^fp1:", "p")), spans(spark, d))
    return x.select(
        F.col("metric_unit").alias("point"), "metric_name", "service_name", "metric_timestamp", "trace_id", "span_id", "span_start_time", "span_duration_ms", "span_name", "span_gen_ai_agent_name",
        "span_gen_ai_tool_name", "adk_session_id", "span_error_type",
    )


def a1_model_costs(spark, d):
    c = flat_top(views.model_costs(genai(spark, d)))
    return c.withColumnRenamed("gen_ai_agent_name", "agent_name").drop("total_cache_creation_input_tokens")


def a2_sessions(spark, d):
    return flat_top(views.sessions(genai(spark, d))).drop("total_cache_creation_input_tokens")


def a3_tool_usage(spark, d):
    return flat_top(views.tool_usage(genai(spark, d))).withColumnsRenamed({"gen_ai_agent_name": "agent_name", "gen_ai_tool_name": "tool_name", "gen_ai_tool_type": "tool_type"})


def a4_mcp_tool_usage(spark, d):
    m = flat_top(views.mcp_tool_usage(views.mcp_spans(spans(spark, d)))).withColumnRenamed("gen_ai_tool_name", "tool_name").drop("mcp_protocol_version")
    return m.withColumn("span_kind", F.col("span_kind").cast("int"))


def _flat_trajectory(t: DataFrame) -> DataFrame:
    return t.select(
        "trace_id", "span_id", "service_name", "start_time", "depth", "root_span_id", "nearest_agent_name", F.array_join("agent_path", " > ").alias("agent_path"), "is_orphan", F.col("step_index").cast("long"),
        "is_leaf", "is_token_leaf", "gen_ai_usage_input_tokens", "gen_ai_usage_output_tokens", "gen_ai_usage_reasoning_tokens",
    )


def q1_agent_trajectory(spark, d):
    return _flat_trajectory(trajectory.trajectory(genai(spark, d)))


def q2_tvf_agent_trajectory(spark, d):
    return _flat_trajectory(tvf.agent_trajectory(genai(spark, d), START, END, CONTEXT_START, CONTEXT_END))


def q4_tvf_logs(spark, d):
    return tvf.gen_ai_logs(logs(spark, d), spans(spark, d), "2024-01-01 12:00:00", "2024-01-02 12:00:00").select("trace_id", "span_id", "service_name", "timestamp", "event_name", "gen_ai_agent_name", "adk_user_id")


def q5_tvf_metric_exemplars(spark, d):
    x = tvf.gen_ai_metric_exemplars(views.gen_ai_metrics(metrics(spark, d)), spans(spark, d), START, END)
    return x.select("metric_name", "service_name", "metric_timestamp", "exemplar_value_double", "trace_id", "span_id", "span_start_time", "span_gen_ai_agent_name")


def q7_unhandled_cycles(spark, d):
    g = once(genai(spark, d), "genai")
    return marts.unhandled_cycles(g, trajectory.trajectory(g))


def q3_quarantine_scan(spark, d):
    """Events as quarantined rows, many of them equal: their canonical order and digests."""
    e = spark.read.parquet(f"{d}/events.parquet").select(
        F.date_trunc("day", F.col("ts").cast("timestamp")).alias("ingest_time"), F.lit("traces").alias("signal"), F.col("event_type").alias("error_code"), F.lit("m").alias("error_message"), F.lit(None).cast("string").alias("service_name"),
        F.lit(None).cast("string").alias("trace_id"), F.lit(None).cast("string").alias("span_id"), F.col("props").alias("raw_payload"),
    )
    return quality.canonical(e).select(*quality.CURSOR)


def q6_trajectory_mart(spark, d):
    """The trajectory mart after a first run."""
    return _flat_trajectory(marts.trajectory_mart(once(genai(spark, d), "genai"), shared_path(spark, "marts"), marts.EPOCH))


def q7_cycles(spark, d):
    """Spans that are missing from the trajectory because some are their own parents."""
    own = F.expr("CASE WHEN CAST(span_id AS BIGINT) % 17 = 0 THEN span_id ELSE parent_span_id END")
    g = once(genai(spark, d).withColumn("parent_span_id", own), "genai")
    return marts.unhandled_cycles(g, trajectory.trajectory(g))


def q9_executive_summary(spark, d):
    return dashboards.executive_summary(views.model_costs(genai(spark, d)), FIRST_DAY, LAST_DAY).drop("total_cache_creation_input_tokens")


def q10_agent_sessions(spark, d):
    s = dashboards.agent_sessions(views.sessions(genai(spark, d)), FIRST_DAY, LAST_DAY).withColumn("turn_count_bucket", dashboards.turn_count_bucket())
    return s.select("session_start_date", "session_id", "service_name", "turn_count", "turn_count_bucket", "error_count", "total_input_tokens", "top_error_types")


def q11_tool_and_mcp_usage(spark, d):
    u = dashboards.tool_and_mcp_usage(views.mcp_tool_usage(views.mcp_spans(spans(spark, d))), views.tool_usage(genai(spark, d)), FIRST_DAY, LAST_DAY)
    return u.select("source", "usage_hour", "usage_date", "service_name", "gen_ai_tool_name", "mcp_target_name", "gen_ai_agent_name", "server_address", "span_kind", "call_count", "mcp_only_call_count", "error_count", "p50_duration_ms", "top_error_types")


def _alerts(spark, d):
    # staged once, as three kinds of alerts and two deliveries read it
    s = staged(spans(spark, d).select("trace_id", "span_id", "service_name", "name", "start_time", "duration_nano", "status", "attributes"), "alert-spans")
    return alerts.tool_errors(s).unionByName(alerts.token_budget(s, 60, 120)).unionByName(alerts.agent_latency(s, 150.0))


def r1_span_alerts(spark, d):
    """Alerts delivered twice and read once, with their payloads as columns."""
    a = _alerts(spark, d)
    found = dashboards.alerts(a.unionByName(a), FIRST_DAY, LAST_DAY)
    return found.select("alert_id", "alert_kind", "event_time", "service_name", "trace_id", "tool_name", "mcp_method_name", "error_type", "status_code", "session_id", "input_tokens", "output_tokens", "duration_ms")


def r4_tool_error_windows(spark, d):
    a = alerts.tool_error_windows(spans(spark, d), "6 hours", 2)
    return a.select("alert_kind", "event_time", "service_name", F.get_json_object("payload", "$.tool_name").alias("tool_name"), F.get_json_object("payload", "$.error_spans").cast("long").alias("error_spans"))


def q14_metric_exemplars(spark, d):
    x = views.metric_exemplars(views.gen_ai_metrics(metrics(spark, d)), spans(spark, d))
    x = dashboards.metric_exemplars(x, FIRST_DAY, LAST_DAY).withColumn("span_key", dashboards.exemplar_span_key())
    return x.select("metric_name", "service_name", "metric_date", "exemplar_value", "span_key", "trace_url", "span_name", "span_duration_ms")


def q15_report_fields(spark, d):
    g, mcp = once(genai(spark, d), "genai", "attributes"), once(views.mcp_spans(spans(spark, d)), "mcp", "attributes")
    c = views.model_costs(g).groupBy(F.to_date("usage_hour").alias("usage_date")).agg(dashboards.error_rate(), dashboards.estimated_cost(2.5, 10.0))
    m = views.mcp_tool_usage(mcp).groupBy(F.to_date("usage_hour").alias("usage_date")).agg(dashboards.dual_tagged_share(), dashboards.weighted_avg_duration_ms())
    s = views.sessions(g).groupBy(F.col("session_start_date").alias("usage_date")).agg(dashboards.sessions_with_errors())
    return c.join(m, "usage_date").join(s, "usage_date")


def q16_model_costs_mart(spark, d):
    """The hourly mart after a first run and a second one over part of it."""
    root, g = shared_path(spark, "marts"), once(genai(spark, d), "genai", "attributes")
    for run in ("2024-01-10T05:30:00Z", "2024-01-10T09:10:00Z"):
        now, start = marts.run_window(spark, root, run)
        fresh = views.model_costs(g.where(F.col("start_time") >= F.lit(start).cast("timestamp")))
        marts.replace_partitions(fresh, f"{root}/costs", "usage_hour", start)
        marts._book(spark, root, now, start, True)
    c = flat_top(spark.read.parquet(f"{root}/costs")).withColumn("usage_hour", F.col("usage_hour").cast("timestamp"))
    return c.withColumnRenamed("gen_ai_agent_name", "agent_name").drop("total_cache_creation_input_tokens")


def _kv(key: str, **value: Column) -> Column:
    """An attribute; of the kinds of value one is given."""
    kinds = {"stringValue": "string", "intValue": "string", "doubleValue": "double", "boolValue": "boolean"}
    return F.struct(F.lit(key).alias("key"), F.struct(*[value.get(k, F.lit(None)).cast(t).alias(k) for k, t in kinds.items()]).alias("value"))


def _requests(df: DataFrame, signal: str, record: Column) -> DataFrame:
    """One export request for each row (column ``value``), with schema addresses."""
    top, middle, leaf = otlp.SIGNALS[signal]
    scope = F.struct(F.struct(F.lit("gen").alias("name")).alias("scope"), F.lit("urn:scope").alias("schemaUrl"), F.array(record).alias(leaf))
    resource = F.struct(F.array(_kv("service.name", stringValue=F.lit("svc"))).alias("attributes"))
    return df.select(F.to_json(F.struct(F.array(F.struct(resource.alias("resource"), F.lit("urn:resource").alias("schemaUrl"), F.array(scope).alias(middle))).alias(top))).alias("value"))


RECEIVED = 1_704_067_200_000_000_000


def t1_span_rows(spark, d):
    """Events as trace requests with attributes of all kinds; some break the contract."""
    e = spark.read.parquet(f"{d}/events.parquet").withColumn("nano", F.expr("unix_micros(CAST(ts AS TIMESTAMP)) * 1000"))
    case = F.col("event_id") % 50
    span = F.struct(
        F.when(case == 0, F.lit("0" * 32)).otherwise(F.lpad(F.lower(F.hex(F.col("user_id") + 1)), 32, "0")).alias("traceId"), F.lpad(F.hex(F.col("event_id") + 1), 16, "0").alias("spanId"),
        F.col("event_id").cast("string").alias("name"), F.when(case == 7, "0").otherwise(F.col("nano").cast("string")).alias("startTimeUnixNano"),
        F.when(case == 9, "18446744073709551615").otherwise((F.col("nano") + 1_500).cast("string")).alias("endTimeUnixNano"),
        F.array(
            _kv("whole", intValue=F.col("event_id")), _kv("real", doubleValue=F.col("value")), _kv("truth", boolValue=F.col("event_id") % 2 == 0), _kv("text", stringValue=F.col("event_type")),
            _kv("digits", stringValue=F.concat(F.col("event_id").cast("string"), F.when(case == 3, ".5").otherwise(".0"))), *[_kv("more", intValue=case)] * 2,
        ).alias("attributes"),
    )
    limits = anyvalue.Limits(attributes=7)
    rows = otlp.spans(_requests(e, "traces", span), limits, receive_nano=RECEIVED)
    a = jsonx.bag("attributes")
    return rows.select(
        "name", "trace_id", "span_id", "start_time", "duration_nano", "service_name", "resource_schema_url", F.when(F.col("reason").isNotNull(), quality.error_code()).alias("error_code"), jsonx.lax_int64(a, "whole").alias("whole"),
        jsonx.lax_float64(a, "real").alias("real"), jsonx.json_value(a, "truth").alias("truth"), jsonx.lax_int64(a, "truth").alias("truth_number"), jsonx.json_value(a, "text").alias("text"), jsonx.lax_int64(a, "digits").alias("digits"), jsonx.lax_int64(a, "more").alias("more"),
    )


def s1_odd_requests(spark, d):
    """Events as requests of an archive: some in snake_case with names of enumerations, some with a value that is none, some cut or with text behind them."""
    e = spark.read.parquet(f"{d}/events.parquet").select("event_id", F.expr("unix_micros(CAST(ts AS TIMESTAMP)) * 1000").cast("string").alias("nano"))
    case, hex_ = F.col("event_id") % 6, F.lpad(F.hex(F.col("event_id") + 1), 16, "0")
    number = F.when(case == 1, '"x"').otherwise(F.concat(F.lit('"'), F.col("event_id").cast("string"), F.lit('"')))
    camel = F.concat(
        F.lit('{"resourceSpans":[{"scopeSpans":[{"spans":[{"traceId":"00000000000000000000000000000001","spanId":"'), hex_, F.lit('","name":"'), F.col("event_id").cast("string"), F.lit('","kind":'),
        F.when(case == 2, '"SPAN_KIND_SERVER"').when(case == 3, '"nothing"').otherwise("3"), F.lit(',"startTimeUnixNano":"'), "nano", F.lit('","endTimeUnixNano":"'), "nano",
        F.lit('","attributes":[{"key":"n","value":{"intValue":'), number, F.lit("}}]}]}]}]}"),
    )
    snake = camel
    for m in ("resourceSpans", "scopeSpans", "traceId", "spanId", "startTimeUnixNano", "endTimeUnixNano", "intValue"):
        snake = F.replace(snake, F.lit(f'"{m}"'), F.lit(f'"{otlp._snake(m)}"'))
    line = F.when(case == 2, snake).when(case == 4, F.concat(camel, F.lit(" x"))).when(case == 5, F.substring(camel, 1, 60)).otherwise(camel)
    path = shared_path(spark, "archive")
    e.select(line.alias("value")).write.option("compression", "gzip").text(path)
    lines = staged(otlp.with_signal(archive.lines(spark, path)), "lines")
    rows = otlp.spans(lines, receive_nano=RECEIVED)
    found = rows.select(F.coalesce("name", F.lit("")).alias("name"), "kind_name", F.when(F.col("reason").isNotNull(), quality.error_code()).alias("error_code"), jsonx.lax_int64(jsonx.bag("attributes"), "n").alias("n"), F.lit(1).cast("bigint").alias("lines"))
    bad = lines.where("signal = 'malformed'").agg(F.count("*").alias("lines")).select(F.lit("malformed lines").alias("name"), F.lit(None).cast("string").alias("kind_name"), F.lit(None).cast("string").alias("error_code"), F.lit(None).cast("bigint").alias("n"), "lines")
    return found.unionByName(bad)


def a1_daily_sketches(spark, d):
    """Days of model calls, merged from hourly sketches; of the percentiles only whether they are in order, as they are approximate."""
    days = sketches.merged(sketches.model_cost_sketches(genai(spark, d)), [F.to_date("usage_hour").alias("usage_date"), "service_name"])
    ordered = (F.col("p50_duration_ms") <= F.col("p95_duration_ms")) & (F.col("p95_duration_ms") <= F.col("p99_duration_ms"))
    return days.select("usage_date", "service_name", "call_count", "error_count", "total_input_tokens", "total_output_tokens", "typed_error_count", ordered.alias("in_order"))


def t2_log_rows(spark, d):
    """Turns as log requests: times, names of events, logs and entries."""
    c = spark.read.parquet(f"{d}/conversations.parquet")
    uid = _kv("log.record.uid", stringValue=F.concat_ws("-", "conv_id", "turn"))
    name = _kv("log.iostream", stringValue=F.when(F.col("turn") % 2 == 0, F.col("role")).otherwise(""))
    nano = F.lit(RECEIVED) + F.col("conv_id") * 1_000_000_000
    record = F.struct(
        F.when(F.col("turn") % 3 == 0, nano.cast("string")).alias("timeUnixNano"), F.when(F.col("turn") % 3 == 1, nano.cast("string")).alias("observedTimeUnixNano"), F.when(F.col("turn") % 2 == 1, "named").alias("eventName"),
        F.struct(F.col("text").alias("stringValue")).alias("body"), F.array(uid, name, _kv("event.name", stringValue=F.lit("fallback"))).alias("attributes"),
    )
    rows = fingerprint.log_fingerprints(otlp.logs(_requests(c, "logs", record), receive_nano=RECEIVED))
    return rows.where("reason IS NULL").select("insert_id", "timestamp", "timestamp_source", "event_name", "log_name", F.get_json_object(F.concat(F.lit('{"b":'), "body", F.lit("}")), "$.b").alias("body"))


def t14_metric_replay(spark, d):
    """Orders as points of three kinds: all break a limit, are put away, and are read again without it."""
    o = dealt(spark.read.parquet(f"{d}/orders.parquet").select("o_orderkey", "o_totalprice"), "o_orderkey")
    attributes = F.array(_kv("a", intValue=F.col("o_orderkey")), _kv("b", stringValue=F.lit("x")))
    time = (F.lit(RECEIVED) + F.col("o_orderkey") * 1_000_000_000).cast("string").alias("timeUnixNano")
    number = F.struct(time, attributes.alias("attributes"), F.col("o_totalprice").alias("asDouble"))
    shape = F.struct(time, attributes.alias("attributes"), F.lit("2").alias("count"), F.col("o_totalprice").alias("sum"), F.array(F.lit("1"), F.lit("1")).alias("bucketCounts"), F.array(F.lit(10.5)).alias("explicitBounds"))
    kind = F.col("o_orderkey") % 3
    metric = F.struct(
        F.lit("orders").alias("name"), F.col("o_orderkey").cast("string").alias("description"), F.when(kind == 0, F.struct(F.array(number).alias("dataPoints"))).alias("gauge"),
        F.when(kind == 1, F.struct(F.lit(1).alias("aggregationTemporality"), F.lit(True).alias("isMonotonic"), F.array(number).alias("dataPoints"))).alias("sum"),
        F.when(kind == 2, F.struct(F.lit(2).alias("aggregationTemporality"), F.array(shape).alias("dataPoints"))).alias("histogram"),
    )
    rejected = backfill.transformed(_requests(o, "metrics", metric), "metrics", anyvalue.Limits(attributes=1), receive_nano=RECEIVED)
    again = backfill.replay(quality.quarantine(rejected, "metrics"), "metrics", codes=["ATTRIBUTE_COUNT"])
    return again.where("reason IS NULL").select(
        "metric_name", "metric_description", "metric_type", "aggregation_temporality", "is_monotonic", "timestamp", "value_double", F.col("count").alias("n"), F.col("sum").alias("total"),
        F.get_json_object("attributes", "$.a").cast("long").alias("a"), "resource_schema_url", "scope_schema_url", "service_name",
    )


def t7_redaction(spark, d):
    """Turns as attribute bags: a user's is under a key that is masked, numbers in others are."""
    c = spark.read.parquet(f"{d}/conversations.parquet")
    key = F.when(F.col("role") == "user", "session_token").otherwise("note")
    raw = F.to_json(F.array(F.struct(key.alias("key"), F.struct(F.col("text").alias("stringValue")).alias("value"))))
    rules = anyvalue.Redaction(patterns=("[0-9]{2,}",))
    out = c.select("conv_id", "turn", anyvalue.encoded_bags([(raw, "attributes")], anyvalue.Limits(), rules)[0]["plain"].alias("bag"))
    return out.select("conv_id", "turn", F.get_json_object("bag", "$.session_token").alias("session_token"), F.get_json_object("bag", "$.note").alias("note"))


def t8_offload(spark, d):
    """Documents of 2 to 64 kB put away once for each content, and the references to them."""
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    rows, objects = offload.offloaded(docs, "text", F.lit("2024-01-01").cast("date"), "store/payloads", "logs", 2_000, 64_000)
    refs = rows.where(F.size("payload_refs") > 0).groupBy(F.col("payload_refs")[0]["sha256"].alias("sha256")).agg(F.count("*").alias("refs"), F.min("text").alias("text"))
    return objects.drop("content").join(refs, "sha256")


def t10_fingerprints(spark, d):
    """Digests of turns by role and text; repeated ones in a conversation are numbered."""
    c = spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text", F.col("conv_id").alias("batch"), F.col("turn").alias("place"), F.lit(None).cast("string").alias("reason"))
    return fingerprint.with_fingerprint(c, {"role": F.col("role"), "text": F.col("text")}, "record_fingerprint").select("conv_id", "turn", "record_fingerprint")


def t8_attribute_offload(spark, d):
    """Documents as bodies and nested attributes of log records: all values of 2 to 64 kB put away, and the references to them."""
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text")
    text = F.struct(F.col("text").alias("stringValue"))
    items = F.struct(F.struct(F.array(F.struct(F.lit("x").alias("stringValue")), text).alias("values")).alias("arrayValue"))
    nested = F.struct(F.struct(F.array(F.struct(F.lit("text").alias("key"), text.alias("value"))).alias("values")).alias("kvlistValue"))
    # members of an array have one type, so the bag is put together as text
    bag = F.concat_ws(",", *[F.concat(F.lit(f'{{"key":"{k}","value":'), v, F.lit("}")) for k, v in (("nested", F.to_json(nested)), ("list", F.to_json(items)), ("id", F.concat(F.lit('{"intValue":"'), F.col("doc_id").cast("string"), F.lit('"}'))))])
    line = F.concat(F.lit('{"resourceLogs":[{"scopeLogs":[{"logRecords":[{"body":'), F.to_json(text), F.lit(',"attributes":['), bag, F.lit("]}]}]}]}"))
    rows = otlp.logs(docs.select(line.alias("value")), receive_nano=RECEIVED, store=offload.Store("store/payloads", 2_000, 64_000))
    rows = staged(rows.select("attributes", "body", "payload_refs", "payloads"), "offloaded")
    one = rows.select(F.get_json_object("attributes", "$.id").cast("long").alias("doc_id"), F.get_json_object("attributes", "$.nested.text").alias("left_behind"), F.posexplode("payload_refs").alias("place", "r"))
    stored = offload.objects(rows).select(F.col("uri").alias("object_uri"), F.octet_length("content").cast("long").alias("stored_bytes"))
    return one.join(stored, F.col("r.object_ref.uri") == F.col("object_uri")).select("doc_id", "place", "left_behind", F.col("r.attribute_path").alias("attribute_path"), F.col("r.mime_type").alias("mime_type"), F.col("r.sha256").alias("sha256"), F.col("r.byte_size").alias("byte_size"), "stored_bytes")


def s4_quarantine_files(spark, d):
    """Events written as quarantine exports, with times in four forms, and read again."""
    e = spark.read.parquet(f"{d}/events.parquet")
    ts, case = F.col("ts").cast("timestamp"), F.col("event_id") % 4
    time = F.when(case == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")).when(case == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS 'UTC'")).when(case == 2, F.unix_micros(ts).cast("string")).otherwise(F.unix_seconds(ts).cast("string"))
    path = shared_path(spark, "export")
    e.select(time.alias("ingest_time"), F.lit("traces").alias("signal"), F.col("event_id").cast("string").alias("span_id"), F.col("props").alias("raw_payload")).write.json(path)
    return exchange.quarantine_files(spark, path).select("ingest_time", "signal", "error_code", "span_id", "raw_payload")


def k8_registered_views(spark, d):
    """The rows of every view that can prune, read by name."""
    tables = {f"otel_{t.__name__}": staged(t(spark, d), t.__name__) for t in (projection.spans, projection.logs, projection.metrics)}
    names = registry.register(spark, tables, need_bounds=True)
    return otlp.union_all([spark.sql(f"SELECT '{n}' AS view_name, count(*) AS n_rows FROM {n}") for n in names])


def o3_agent_paths(spark, d):
    return dashboards.agent_paths(trajectory.trajectory(genai(spark, d)))


def o5_service_names(spark, d):
    g, m = genai(spark, d), views.mcp_spans(spans(spark, d))
    return dashboards.service_names([views.model_costs(g), views.tool_usage(g), views.mcp_tool_usage(m)], views.sessions(g), FIRST_DAY, LAST_DAY)


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return a1_model_costs(spark, sf_dir)


_QUERIES = [
    w1_spans_dedup, w2_logs_dedup, w3_metrics_dedup, v1_all_spans, v2_gen_ai_spans, v3_mcp_spans, v4_gen_ai_metrics, v5_spans_redacted, v5_logs_redacted,
    j1_gen_ai_logs, j2_metric_exemplars, a1_model_costs, a2_sessions, a3_tool_usage, a4_mcp_tool_usage, q1_agent_trajectory, q2_tvf_agent_trajectory, q4_tvf_logs, q5_tvf_metric_exemplars, q7_unhandled_cycles,
    q9_executive_summary, q10_agent_sessions, q11_tool_and_mcp_usage, r1_span_alerts, r4_tool_error_windows, q3_quarantine_scan, q6_trajectory_mart, q7_cycles, t1_span_rows, t2_log_rows, t14_metric_replay, q14_metric_exemplars, q15_report_fields, q16_model_costs_mart, t7_redaction, t8_offload, t10_fingerprints, t8_attribute_offload,
    s4_quarantine_files, k8_registered_views, o3_agent_paths, o5_service_names, s1_odd_requests, a1_daily_sketches,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.QUERIES)
