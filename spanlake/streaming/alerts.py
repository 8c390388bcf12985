"""Alerts over appended spans. The same functions serve batches and streams.

Single-span alerts are stateless, so a late span still alerts. The windowed alert counts by the
time rows are stored (``receive_time``), and a window comes out once the watermark has passed it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.jsonx import json_value, lax_int64, with_bags

MAX_INPUT_TOKENS, MAX_OUTPUT_TOKENS, MAX_DURATION_MS = 100_000, 32_000, 30_000
WINDOW, MIN_ERRORS = "5 minutes", 5
LATENCY_OPS = ["invoke_agent", "chat", "generate_content", "execute_tool"]
COLUMNS = ["alert_id", "alert_kind", "event_time", "service_name", "trace_id", "span_id", "payload"]


def _v(key: str) -> Column:
    return json_value(F.col("__a"), key)


def _first(*keys: str) -> Column:
    return F.coalesce(*map(_v, keys))


def _agent() -> Column:
    return _first("gen_ai.agent.name", "gcp.vertex.agent.name", "gen_ai.main_agent.name")


def _alert(spans: DataFrame, kind: str, payload: dict[str, Column]) -> DataFrame:
    body = F.to_json(F.struct(*[c.alias(n) for n, c in payload.items()]), {"ignoreNullFields": "false"})
    return spans.select(
        F.concat(F.lit(f"{kind}:"), "trace_id", F.lit(":"), "span_id").alias("alert_id"), F.lit(kind).alias("alert_kind"), F.col("start_time").alias("event_time"),
        "service_name", "trace_id", "span_id", body.alias("payload"),
    )


def _failed_tools(spans: DataFrame) -> DataFrame:
    failed = (F.col("status.code") == 2) | _v("error.type").isNotNull()
    tool = (_v("gen_ai.operation.name") == "execute_tool") | _v("gen_ai.tool.name").isNotNull() | _v("mcp.method.name").isNotNull()
    return with_bags(spans, __a="attributes").where(failed & tool)


def tool_errors(spans: DataFrame) -> DataFrame:
    """A tool or protocol call that failed."""
    return _alert(_failed_tools(spans), "TOOL_ERROR", {
        "span_name": F.col("name"), "operation_name": _v("gen_ai.operation.name"), "agent_name": _agent(), "tool_name": _v("gen_ai.tool.name"),
        "mcp_method_name": _v("mcp.method.name"), "error_type": _v("error.type"), "status_code": F.col("status.code"),
    })


def token_budget(spans: DataFrame, max_input: int = MAX_INPUT_TOKENS, max_output: int = MAX_OUTPUT_TOKENS) -> DataFrame:
    """A call that used more tokens than the budget of one turn."""
    s = with_bags(spans, __a="attributes")
    used = {k: lax_int64(F.col("__a"), f"gen_ai.usage.{k}_tokens") for k in ("input", "output")}
    s = s.where((F.coalesce(used["input"], F.lit(0)) > max_input) | (F.coalesce(used["output"], F.lit(0)) > max_output))
    reasoning = F.coalesce(lax_int64(F.col("__a"), "gen_ai.usage.reasoning.output_tokens"), lax_int64(F.col("__a"), "gen_ai.usage.reasoning_tokens"))
    return _alert(s, "TOKEN_BUDGET_BURN", {
        "session_id": _first("gen_ai.conversation.id", "session.id", "gcp.vertex.agent.session_id"), "agent_name": _agent(), "request_model": _v("gen_ai.request.model"),
        "response_model": _v("gen_ai.response.model"), "input_tokens": used["input"], "output_tokens": used["output"], "reasoning_tokens": reasoning,
    })


def agent_latency(spans: DataFrame, max_ms: float = MAX_DURATION_MS) -> DataFrame:
    """A call of an agent, a model or a tool that took longer than ``max_ms``."""
    s = with_bags(spans.where(F.col("duration_nano") / 1e6 > max_ms), __a="attributes").where(_v("gen_ai.operation.name").isin(LATENCY_OPS))
    return _alert(s, "AGENT_LATENCY_HIGH", {
        "span_name": F.col("name"), "duration_ms": F.round(F.col("duration_nano") / 1e6, 3), "operation_name": _v("gen_ai.operation.name"), "agent_name": _agent(),
        "request_model": _v("gen_ai.request.model"), "tool_name": _v("gen_ai.tool.name"),
    })


def tool_error_windows(spans: DataFrame, window: str = WINDOW, min_errors: int = MIN_ERRORS, late: str = "10 minutes") -> DataFrame:
    """Windows of the storing time in which a service's tool failed at least ``min_errors`` times."""
    s = _failed_tools(spans).select("receive_time", "service_name", _v("gen_ai.tool.name").alias("tool_name"))
    s = s.withWatermark("receive_time", late) if s.isStreaming else s
    w = s.groupBy(F.window("receive_time", window).alias("w"), "service_name", "tool_name").agg(F.count("*").alias("error_spans")).where(F.col("error_spans") >= min_errors)
    keep = {"ignoreNullFields": "false"}
    key = F.to_json(F.struct("service_name", "tool_name", F.col("w.start").alias("window_start")), keep)
    body = F.to_json(F.struct("tool_name", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "error_spans"), keep)
    return w.select(
        F.concat(F.lit("TOOL_ERROR_WINDOW:"), key).alias("alert_id"), F.lit("TOOL_ERROR_WINDOW").alias("alert_kind"), F.col("w.end").alias("event_time"), "service_name",
        F.lit("").alias("trace_id"), F.lit("").alias("span_id"), body.alias("payload"),
    )


def single_span_alerts(spans: DataFrame) -> DataFrame:
    return tool_errors(spans).unionByName(token_budget(spans)).unionByName(agent_latency(spans))


def once(alerts: DataFrame, within: str = "10 minutes") -> DataFrame:
    """Each alert once. In a stream, alerts that come again within ``within`` of the first, as after a restart, are left
    out. That is a time of arrival, so no alert is too late, however old its span; state is held no longer than needed."""
    if not alerts.isStreaming:
        return alerts.dropDuplicates(["alert_id"])
    seen = alerts.withColumn("__seen", F.current_timestamp()).withWatermark("__seen", within)
    return seen.dropDuplicatesWithinWatermark(["alert_id"]).drop("__seen")


def start(alerts: DataFrame, path: str, checkpoint: str, **trigger: object) -> StreamingQuery:
    """Appends a stream of alerts to the Parquet table at ``path``, partitioned by day; at least once."""
    day = alerts.withColumn("event_date", F.to_date("event_time"))
    return day.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy("event_date").outputMode("append").trigger(**(trigger or {"availableNow": True})).start()


def messages(alerts: DataFrame) -> DataFrame:
    """Alerts as JSON texts (column ``value``), as message sinks take them; all of the payload's members at the top."""
    head = F.to_json(F.struct("alert_id", "alert_kind", "event_time", "service_name", "trace_id", "span_id"), {"ignoreNullFields": "false"})
    return alerts.withColumn("h", head).select("alert_id", F.expr("concat(left(h, length(h) - 1), ',', substring(payload, 2))").alias("value"))
