"""Reads for reports: date ranges (both ends inclusive, ``yyyyMMdd``), arrays as text, derived measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.otlp import union_all

from ..functions.jsonx import bag, json_value

TRACE_URL = "https://console.cloud.google.com/traces/explorer;traceId={}?project={}"


def within_days(df: DataFrame, column: str, start: str, end: str) -> DataFrame:
    """Rows from the first day to the last, for timestamp and date columns."""
    low, high = F.to_date(F.lit(start), "yyyyMMdd"), F.to_date(F.lit(end), "yyyyMMdd")
    if dict(df.dtypes)[column] == "date":
        return df.where((F.col(column) >= low) & (F.col(column) <= high))
    return df.where((F.col(column) >= low.cast("timestamp")) & (F.col(column) < F.date_add(high, 1).cast("timestamp")))


def counts_text(column: str = "top_error_types") -> Column:
    """``value (count), ...``; NULL for none."""
    text = F.array_join(F.transform(column, lambda e: F.concat(F.coalesce(e["value"], F.lit("")), F.lit(" ("), e["count"].cast("string"), F.lit(")"))), ", ")
    return F.nullif(text, F.lit("")).alias(column)


def trace_url(project: str) -> Column:
    head, tail = TRACE_URL.format("\0", project).split("\0")
    return F.concat(F.lit(head), "trace_id", F.lit(tail))


def executive_summary(costs: DataFrame, start: str, end: str) -> DataFrame:
    c = within_days(costs, "usage_hour", start, end).withColumn("usage_date", F.to_date("usage_hour"))
    names = (
        "usage_hour usage_date service_name gen_ai_agent_name provider model call_count error_count typed_error_count total_input_tokens total_output_tokens total_cache_read_input_tokens "
        "total_cache_creation_input_tokens total_reasoning_tokens p50_duration_ms p95_duration_ms p99_duration_ms"
    )
    return c.select(*names.split(), counts_text())


def agent_sessions(sessions: DataFrame, start: str, end: str) -> DataFrame:
    names = (
        "session_start_date session_start_time session_end_time session_id user_id service_name agent_name session_duration_ms turn_count invocation_count llm_call_count agent_invocation_count "
        "tool_call_count error_count typed_error_count total_input_tokens total_output_tokens total_cache_read_input_tokens total_cache_creation_input_tokens total_reasoning_tokens"
    )
    return within_days(sessions, "session_start_date", start, end).select(*names.split(), counts_text())


def tool_and_mcp_usage(mcp: DataFrame, tools: DataFrame, start: str, end: str) -> DataFrame:
    """Both tool rollups in one table; what only one of them has is NULL for the other."""
    shared = "usage_hour service_name gen_ai_tool_name call_count error_count typed_error_count p50_duration_ms p95_duration_ms".split()
    m = within_days(mcp, "usage_hour", start, end).select(
        F.lit("mcp").alias("source"), *shared, "mcp_method_name", "mcp_protocol_version", "mcp_target_name", "server_address", F.col("span_kind").cast("long").alias("span_kind"), "gen_ai_tagged_call_count",
        (F.col("call_count") - F.coalesce("gen_ai_tagged_call_count", F.lit(0))).alias("mcp_only_call_count"), "avg_duration_ms", "p99_duration_ms", counts_text(),
    )
    t = within_days(tools, "usage_hour", start, end).select(F.lit("gen_ai").alias("source"), *shared, "gen_ai_agent_name", "gen_ai_tool_type", counts_text())
    return m.unionByName(t, allowMissingColumns=True).withColumn("usage_date", F.to_date("usage_hour"))


def agent_trajectory(trajectory: DataFrame, start: str, end: str, project: str = "project") -> DataFrame:
    t = within_days(trajectory, "start_time", start, end)
    names = (
        "start_time end_time duration_ms trace_id span_id parent_span_id service_name span_name span_kind status_code gen_ai_operation_name gen_ai_provider_name gen_ai_request_model gen_ai_agent_name "
        "gen_ai_main_agent_name gen_ai_tool_name gen_ai_usage_input_tokens gen_ai_usage_output_tokens gen_ai_usage_reasoning_tokens adk_session_id adk_invocation_id adk_user_id error_type depth "
        "root_span_id nearest_agent_name is_orphan step_index is_leaf is_token_leaf"
    )
    leaf = lambda c: F.when(F.col("is_token_leaf"), F.coalesce(f"gen_ai_usage_{c}_tokens", F.lit(0))).otherwise(0).alias(f"leaf_{c}_tokens")
    return t.select(
        *names.split(), F.to_date("start_time").alias("start_date"), leaf("input"), leaf("output"), leaf("reasoning"),
        F.array_join("agent_path", " > ").alias("agent_path"), F.size("agent_path").alias("agent_path_length"), trace_url(project).alias("trace_url"),
    )


def alerts(table: DataFrame, start: str, end: str, project: str = "project") -> DataFrame:
    """One row for each alert, the first; the payload's members as columns."""
    w = Window.partitionBy("alert_id").orderBy("event_time", "payload")
    a = within_days(table, "event_time", start, end).withColumn("__n", F.row_number().over(w)).where("__n = 1").withColumn("__p", bag("payload"))
    text = lambda k: json_value(F.col("__p"), k)
    names = "span_name operation_name agent_name tool_name mcp_method_name error_type session_id request_model response_model".split()
    numbers = "status_code input_tokens output_tokens reasoning_tokens error_spans".split()
    return a.select(
        "alert_id", "alert_kind", "event_time", F.to_date("event_time").alias("event_date"), "service_name", F.nullif("trace_id", F.lit("")).alias("trace_id"), F.nullif("span_id", F.lit("")).alias("span_id"),
        F.when(F.col("trace_id") != "", trace_url(project)).alias("trace_url"), *[text(n).alias(n) for n in names], *[text(n).try_cast("bigint").alias(n) for n in numbers],
        text("duration_ms").try_cast("double").alias("duration_ms"), F.col("payload").alias("payload_json"),
    )


def metric_exemplars(exemplars: DataFrame, start: str, end: str, project: str = "project") -> DataFrame:
    names = (
        "metric_timestamp service_name metric_name metric_unit metric_type gen_ai_operation_name gen_ai_system gen_ai_request_model gen_ai_response_model gen_ai_agent_name gen_ai_token_type gen_ai_token_modality "
        "metric_error_type exemplar_timestamp trace_id span_id exemplar_filtered_attributes span_start_time span_end_time span_duration_ms span_name span_status_code span_gen_ai_agent_name span_gen_ai_tool_name "
        "adk_session_id span_error_type"
    )
    return within_days(exemplars, "metric_timestamp", start, end).select(
        *names.split(), F.to_date("metric_timestamp").alias("metric_date"), F.coalesce("exemplar_value_double", F.col("exemplar_value_int64").cast("double")).alias("exemplar_value"), trace_url(project).alias("trace_url")
    )


# calculated fields --------------------------------------------------------------------------------


def error_rate() -> Column:
    return F.try_divide(F.sum("error_count"), F.sum("call_count")).alias("error_rate")


def estimated_cost(input_price: float, output_price: float) -> Column:
    """From prices of a million tokens."""
    return ((F.sum("total_input_tokens") * input_price + F.sum("total_output_tokens") * output_price) / 1_000_000).alias("estimated_cost")


def turn_count_bucket() -> Column:
    n = F.col("turn_count")
    return F.when(n <= 1, "01").when(n <= 3, "02-03").when(n <= 6, "04-06").when(n <= 10, "07-10").otherwise("11+").alias("turn_count_bucket")


def sessions_with_errors() -> Column:
    return F.count_distinct(F.when(F.col("error_count") > 0, F.col("session_id"))).alias("sessions_with_errors")


def dual_tagged_share() -> Column:
    return F.try_divide(F.sum("gen_ai_tagged_call_count"), F.sum("call_count")).alias("dual_tagged_share")


def weighted_avg_duration_ms() -> Column:
    return F.try_divide(F.sum(F.col("avg_duration_ms") * F.col("call_count")), F.sum("call_count")).alias("weighted_avg_duration_ms")


def orphan_roots() -> Column:
    return F.count_distinct(F.when(F.col("is_orphan") & (F.col("depth") == 0), F.concat("trace_id", F.lit(":"), "span_id"))).alias("orphan_roots")


def exemplar_span_key() -> Column:
    return F.concat("trace_id", F.lit(":"), "span_id").alias("exemplar_span_key")


def chart(table: DataFrame, dimensions: list[str], measures: dict[str, Column], by: str, limit: int) -> DataFrame:
    """The ``limit`` groups with the largest value of the measure ``by``; of equal ones those whose dimensions sort first."""
    out = table.groupBy(*dimensions).agg(*[c.alias(n) for n, c in measures.items()])
    return out.orderBy(F.col(by).desc_nulls_last(), *[F.col(d).asc_nulls_first() for d in dimensions]).limit(limit)


def agent_paths(trajectory: DataFrame, limit: int = 50) -> DataFrame:
    """The agent paths that most traces take."""
    t = trajectory.select(F.array_join("agent_path", " > ").alias("agent_path"), F.size("agent_path").alias("agent_path_length"), "trace_id", "span_id", *[F.when(F.col("is_token_leaf"), F.col(f"gen_ai_usage_{k}_tokens")).alias(k) for k in ("input", "output")])
    measures = {"traces": F.count_distinct("trace_id"), "spans": F.count("span_id"), "leaf_input_tokens": F.sum("input"), "leaf_output_tokens": F.sum("output")}
    return chart(t.where("agent_path_length > 0"), ["agent_path", "agent_path_length"], measures, "traces", limit)


def error_types(alerts_table: DataFrame, limit: int = 15) -> DataFrame:
    """The error types of most alerts on tools."""
    return chart(alerts_table.where("alert_kind = 'TOOL_ERROR'"), ["error_type"], {"alerts": F.count_distinct("alert_id")}, "alerts", limit)


#: Characters that a service's name may not have in a report's filter: control characters, quotes, back-ticks, backslashes.
UNSAFE = r"""[\x00-\x1f'"\\`]"""


def service_names(hourly: list[DataFrame], sessions: DataFrame, start: str, end: str) -> DataFrame:
    """The distinct services of the hourly rollups and the sessions between two days; one without name is ``(none)``."""
    parts = [within_days(h, "usage_hour", start, end) for h in hourly] + [within_days(sessions, "session_start_date", start, end)]
    name = F.coalesce("service_name", F.lit("(none)"))
    # distinct in each part first, so that the union is of few rows
    parts = [p.where(~F.coalesce("service_name", F.lit("")).rlike(UNSAFE)).select(name.alias("service_name")).distinct() for p in parts]
    return union_all(parts).distinct()
