"""Semantic views over deduplicated spans, logs and metrics.

Each view is a function of DataFrames; composing them gives Catalyst one plan, so filters and
column pruning reach the scan. Attribute bags are parsed once in each view.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.jsonx import json_value, lax_float64, lax_int64, with_bags
from ..operators.stage import spread

INFERENCE_OPS = ["chat", "generate_content", "text_completion", "embeddings"]
AGENT_OPS = ["invoke_agent", "create_agent"]
TOP = 5

#: Simple promotions of v_gen_ai_spans: column and key.
_SPAN_TEXT = {
    "gen_ai_operation_name": "gen_ai.operation.name", "gen_ai_request_model": "gen_ai.request.model", "gen_ai_response_model": "gen_ai.response.model",
    "gen_ai_agent_id": "gen_ai.agent.id", "gen_ai_tool_name": "gen_ai.tool.name", "gen_ai_tool_call_id": "gen_ai.tool.call.id", "adk_event_id": "gcp.vertex.agent.event_id",
    "adk_invocation_id": "gcp.vertex.agent.invocation_id", "gen_ai_provider_name": "gen_ai.provider.name", "gen_ai_output_type": "gen_ai.output.type",
    "gen_ai_tool_type": "gen_ai.tool.type", "gen_ai_tool_description": "gen_ai.tool.description", "gen_ai_agent_description": "gen_ai.agent.description",
    "gen_ai_agent_parent_id": "gen_ai.agent.parent.id", "gen_ai_data_source_id": "gen_ai.data_source.id", "gen_ai_evaluation_name": "gen_ai.evaluation.name",
    "error_type": "error.type", "gen_ai_response_id": "gen_ai.response.id",
}
#: Promotions with alternatives: column, reader and keys in order; ``resource:`` keys are the resource's.
_SPAN_CHAINS = {
    "gen_ai_system": (json_value, ["gen_ai.system", "gen_ai.provider.name"]),
    "gen_ai_conversation_id": (json_value, ["gen_ai.conversation.id", "gcp.vertex.agent.session_id"]),
    "adk_session_id": (json_value, ["gcp.vertex.agent.session_id", "gen_ai.conversation.id"]),
    "adk_user_id": (json_value, ["user.id", "gen_ai.user.id"]),
    "gen_ai_usage_input_tokens": (lax_int64, ["gen_ai.usage.input_tokens"]),
    "gen_ai_usage_output_tokens": (lax_int64, ["gen_ai.usage.output_tokens"]),
    "gen_ai_request_temperature": (lax_float64, ["gen_ai.request.temperature"]),
    "gen_ai_usage_cache_read_input_tokens": (lax_int64, ["gen_ai.usage.cache_read.input_tokens", "gen_ai.usage.cache_read_input_tokens"]),
    "gen_ai_usage_cache_creation_input_tokens": (lax_int64, ["gen_ai.usage.cache_creation.input_tokens", "gen_ai.usage.cache_creation_input_tokens"]),
    "gen_ai_usage_reasoning_tokens": (lax_int64, ["gen_ai.usage.reasoning.output_tokens", "gen_ai.usage.reasoning_tokens"]),
    "gen_ai_request_top_p": (lax_float64, ["gen_ai.request.top_p"]),
    "gen_ai_request_top_k": (lax_int64, ["gen_ai.request.top_k"]),
    "gen_ai_request_max_tokens": (lax_int64, ["gen_ai.request.max_tokens"]),
    "gen_ai_evaluation_score": (lax_float64, ["gen_ai.evaluation.score.value", "gen_ai.evaluation.score"]),
    "gen_ai_main_agent_id": (json_value, ["gen_ai.main_agent.id", "resource:gen_ai.main_agent.id"]),
    "gen_ai_main_agent_name": (json_value, ["gen_ai.main_agent.name", "resource:gen_ai.main_agent.name"]),
    "gen_ai_main_agent_description": (json_value, ["gen_ai.main_agent.description", "resource:gen_ai.main_agent.description"]),
    "gen_ai_agent_version": (json_value, ["gen_ai.agent.version", "resource:gen_ai.agent.version"]),
    "gen_ai_response_time_to_first_chunk": (lax_float64, ["gen_ai.response.time_to_first_chunk"]),
}
#: Any of these keys makes a span a GenAI span.
_SPAN_MARKS = ["gen_ai.operation.name", "gen_ai.system", "gen_ai.provider.name", "gcp.vertex.agent.invocation_id", "gen_ai.main_agent.name", "gen_ai.main_agent.id"]

_MCP_KEYS = [
    "mcp.method.name", "mcp.protocol.version", "mcp.session.id", "mcp.resource.uri", "jsonrpc.request.id", "rpc.response.status_code", "gen_ai.operation.name", "gen_ai.tool.name",
    "gen_ai.tool.call.id", "gen_ai.prompt.name", "gen_ai.agent.name", "gcp.vertex.agent.name", "error.type", "server.address", "server.port", "network.transport",
]
_AGENT_KEYS = ["gen_ai.agent.name", "gcp.vertex.agent.name", "gen_ai.main_agent.name"]
_SPAN_KEYS = [*_SPAN_TEXT.values(), *[k.removeprefix("resource:") for _, ks in _SPAN_CHAINS.values() for k in ks], *_AGENT_KEYS, *_SPAN_MARKS]


def _chain(reader, keys: list[str], own: str = "__a", resource: str = "__r") -> Column:
    return F.coalesce(*[reader(resource, k[9:]) if k.startswith("resource:") else reader(own, k) for k in keys])


def _any_key(keys: list[str], own: str = "__a") -> Column:
    test = F.lit(False)
    for k in keys:
        test = test | json_value(own, k).isNotNull()
    return test


def _milliseconds(nanos: str) -> Column:
    return F.round(F.col(nanos) / 1e6, 3)


def all_spans(spans: DataFrame) -> DataFrame:
    """The spans in the column set of a plain span table, with the status reduced to code and message."""
    names = (
        "trace_id span_id trace_state parent_span_id name kind start_time start_time_unix_nano end_time end_time_unix_nano receive_time receive_time_unix_nano "
        "duration_nano attributes attributes_schema dropped_attributes_count events dropped_events_count links dropped_links_count"
    ).split()
    status = F.struct(F.col("status.code").alias("code"), F.col("status.message").alias("message")).alias("status")
    return spans.select(*names, status, "resource", "resource_schema_url", "instrumentation_scope", "scope_schema_url")


HOUR = "start_hour"


def _hour(df: DataFrame) -> Column:
    """The hour of a span: the partition's where it is carried along, so that a bound on the hour prunes partitions."""
    return F.col(HOUR) if HOUR in df.columns else F.date_trunc("hour", "start_time")


def gen_ai_spans(spans: DataFrame, partition: bool = False) -> DataFrame:
    """Spans with GenAI attributes, promoted to typed columns; with ``partition`` also the table's hour, for rollups."""
    s = with_bags(spans, _SPAN_KEYS, __a="attributes", __r="resource.attributes").where(_any_key(_SPAN_MARKS))
    text = {c: json_value("__a", k) for c, k in _SPAN_TEXT.items()}
    chains = {c: _chain(f, ks) for c, (f, ks) in _SPAN_CHAINS.items()}
    agent = F.coalesce(_chain(json_value, ["gen_ai.agent.name", "gcp.vertex.agent.name"]), F.col("service_name"))
    more = {"gen_ai_agent_name": agent, "gen_ai_response_finish_reason": json_value("__a", "gen_ai.response.finish_reasons", 0)}
    promoted = text | chains | more
    first = (
        "gen_ai_operation_name gen_ai_system gen_ai_request_model gen_ai_response_model gen_ai_agent_name gen_ai_agent_id gen_ai_conversation_id gen_ai_usage_input_tokens "
        "gen_ai_usage_output_tokens gen_ai_request_temperature gen_ai_response_finish_reason gen_ai_tool_name gen_ai_tool_call_id adk_event_id adk_session_id adk_invocation_id adk_user_id"
    ).split()
    last = (
        "gen_ai_provider_name gen_ai_usage_cache_read_input_tokens gen_ai_usage_cache_creation_input_tokens gen_ai_usage_reasoning_tokens gen_ai_request_top_p gen_ai_request_top_k "
        "gen_ai_request_max_tokens gen_ai_output_type gen_ai_tool_type gen_ai_tool_description gen_ai_agent_description gen_ai_agent_parent_id gen_ai_data_source_id gen_ai_evaluation_name "
        "gen_ai_evaluation_score error_type gen_ai_main_agent_id gen_ai_main_agent_name gen_ai_main_agent_description gen_ai_agent_version gen_ai_response_id gen_ai_response_time_to_first_chunk"
    ).split()
    return s.select(
        "start_time", "end_time", "duration_nano", _milliseconds("duration_nano").alias("duration_ms"), "trace_id", "span_id", "parent_span_id", "service_name",
        F.col("name").alias("span_name"), F.col("kind").alias("span_kind"), F.col("status.code").alias("status_code"), F.col("status.message").alias("status_message"),
        *[promoted[c].alias(c) for c in first], "payload_refs", "attributes", "resource", "instrumentation_scope", "events", "links", *[promoted[c].alias(c) for c in last],
        *([HOUR] if partition and HOUR in spans.columns else []),
    )


def mcp_spans(spans: DataFrame, partition: bool = False) -> DataFrame:
    """Spans of the Model Context Protocol, and whether the GenAI view has them too; ``partition`` as of ``gen_ai_spans``."""
    s = with_bags(spans, [*_MCP_KEYS, *_SPAN_MARKS], __a="attributes").where(_any_key(["mcp.method.name", "mcp.session.id", "mcp.resource.uri"]))
    v = lambda k: json_value("__a", k)
    return s.select(
        "start_time", "end_time", "duration_nano", _milliseconds("duration_nano").alias("duration_ms"), "trace_id", "span_id", "parent_span_id", "service_name",
        F.col("name").alias("span_name"), F.col("kind").alias("span_kind"), F.col("status.code").alias("status_code"), F.col("status.message").alias("status_message"),
        *[v(k).alias(k.replace(".", "_")) for k in ("mcp.method.name", "mcp.protocol.version", "mcp.session.id", "mcp.resource.uri", "jsonrpc.request.id", "rpc.response.status_code", "gen_ai.operation.name")],
        _chain(json_value, ["gen_ai.system", "gen_ai.provider.name"]).alias("gen_ai_system"),
        *[v(k).alias(k.replace(".", "_")) for k in ("gen_ai.tool.name", "gen_ai.tool.call.id", "gen_ai.prompt.name")],
        _chain(json_value, ["gen_ai.agent.name", "gcp.vertex.agent.name", "gen_ai.main_agent.name"]).alias("gen_ai_agent_name"),
        v("error.type").alias("error_type"), v("server.address").alias("server_address"), lax_int64("__a", "server.port").alias("server_port"),
        v("network.transport").alias("network_transport"), F.coalesce(v("mcp.method.name") == "tools/call", F.lit(False)).alias("is_tool_call"),
        _any_key(_SPAN_MARKS).alias("also_in_gen_ai_view"), "payload_refs", "attributes", "resource", "instrumentation_scope",
        *([HOUR] if partition and HOUR in spans.columns else []),
    )


def spans_redacted(spans: DataFrame) -> DataFrame:
    """Spans without content: bags and sensitive text are NULL, nested records are left out."""
    gone = {"attributes", "status_message", "trace_state"}
    out = spans.drop("events", "links", "payload_refs")
    status = F.struct(F.col("status.code").alias("code"), F.col("status.code_name").alias("code_name"), F.lit(None).cast("string").alias("message"))
    changed = {c: F.lit(None).cast(out.schema[c].dataType) for c in gone if c in out.columns}
    changed |= {"status": status, "resource": F.col("resource").withField("attributes", F.lit(None).cast("string")), "instrumentation_scope": F.col("instrumentation_scope").withField("attributes", F.lit(None).cast("string"))}
    return out.withColumns(changed)


def logs_redacted(logs: DataFrame) -> DataFrame:
    """Logs without content: body and bags are NULL."""
    out = logs.drop("payload_refs")
    null = F.lit(None).cast("string")
    return out.withColumns({"body": null, "attributes": null, "resource": F.col("resource").withField("attributes", null), "instrumentation_scope": F.col("instrumentation_scope").withField("attributes", null)})


_LOG_CHAINS = {
    "gen_ai_operation_name": ["gen_ai.operation.name"],
    "gen_ai_system": ["gen_ai.system", "gen_ai.provider.name"],
    "gen_ai_agent_name": ["gen_ai.agent.name", "gcp.vertex.agent.name"],
    "adk_session_id": ["gcp.vertex.agent.session_id", "gen_ai.conversation.id"],
    "adk_invocation_id": ["gcp.vertex.agent.invocation_id"],
    "adk_event_id": ["gcp.vertex.agent.event_id"],
    "adk_user_id": ["user.id", "gen_ai.user.id"],
}
_LOG_KEYS = [k for ks in _LOG_CHAINS.values() for k in ks]


def near(time: str, span_start: str) -> Column:
    """The span began from a day before to an hour after."""
    return F.col(span_start).between(F.col(time) - F.expr("INTERVAL 24 HOURS"), F.col(time) + F.expr("INTERVAL 1 HOUR"))


def log_facts(logs: DataFrame) -> DataFrame:
    """GenAI log records with what their own attributes say."""
    event = F.coalesce(F.nullif("event_name", F.lit("")), json_value("__a", "event.name"))
    rows = with_bags(logs, [*_LOG_KEYS, "event.name", "error.type"], __a="attributes").withColumn("__event", event)
    rows = rows.where(F.col("__event").like("gen_ai.%") | _any_key(["gen_ai.system", "gen_ai.provider.name", "gcp.vertex.agent.invocation_id"]))
    own = {f"own_{c}": _chain(json_value, ks) for c, ks in _LOG_CHAINS.items()}
    return rows.withColumns(own | {"event_name": F.col("__event"), "error_type": json_value("__a", "error.type")}).drop("__a", "__a_text", "__event")


def span_facts(spans: DataFrame) -> DataFrame:
    """What a log record may take from its span."""
    s = spans.select("trace_id", "span_id", "service_name", "start_time", *[c for c in ("start_hour",) if c in spans.columns], "attributes")
    s = with_bags(s, _LOG_KEYS, __sa="attributes").drop("attributes")
    return s.withColumns({f"span_{c}": _chain(json_value, ks, own="__sa") for c, ks in _LOG_CHAINS.items()}).drop("__sa", "__sa_text")


_LOG_FIRST = ["timestamp", "receive_time", "trace_id", "span_id", "service_name", "event_name", "severity_number", "severity_text"]
_LOG_LAST = ["body", "payload_refs", "attributes", "resource", "instrumentation_scope", "error_type"]


def gen_ai_logs(logs: DataFrame, spans: DataFrame) -> DataFrame:
    """GenAI log records, with what they lack taken from their span. A record of two matching spans stays twice."""
    names = {"trace_id": "__t", "span_id": "__s", "service_name": "__n", "start_time": "__b"}
    s = span_facts(spans).withColumnsRenamed(names)
    same = (F.col("trace_id") == F.col("__t")) & (F.col("span_id") == F.col("__s")) & F.col("service_name").eqNullSafe(F.col("__n")) & near("timestamp", "__b")
    j = log_facts(logs).join(spread(s), same, "left")
    return j.select(*_LOG_FIRST, *[F.coalesce(f"own_{c}", f"span_{c}").alias(c) for c in _LOG_CHAINS], *_LOG_LAST)


#: Usage metrics and the dimension each one counts.
_DIMENSIONS = {
    "gen_ai.client.inference.usage.input_tokens": "input",
    "gen_ai.client.inference.usage.output_tokens": "output",
    "gen_ai.client.inference.usage.cache_read.input_tokens": "cache_read_input",
    "gen_ai.client.inference.usage.cache_write.input_tokens": "cache_write_input",
    "gen_ai.client.inference.usage.reasoning.output_tokens": "reasoning_output",
}
_METRIC_KEYS = [
    "gen_ai.operation.name", "gen_ai.system", "gen_ai.provider.name", "gen_ai.request.model", "gen_ai.response.model", "gen_ai.token.type", "gen_ai.token.modality", "gen_ai.agent.name",
    "gen_ai.main_agent.name", "error.type",
]


def gen_ai_metrics(metrics: DataFrame) -> DataFrame:
    """Points of GenAI metrics with promoted attributes; ``_`` in the pattern is any character."""
    m = with_bags(metrics.where(F.col("metric_name").like("gen_ai.%")), _METRIC_KEYS, __a="attributes", __r="resource.attributes")
    v = lambda k: json_value("__a", k)
    dimension = F.coalesce(F.create_map(*[F.lit(x) for kv in _DIMENSIONS.items() for x in kv])[F.col("metric_name")], v("gen_ai.token.type"))
    return m.select(
        "timestamp", "start_time", "receive_time", "service_name", "metric_name", "metric_description", "metric_unit", "metric_type", "aggregation_temporality", "is_monotonic",
        v("gen_ai.operation.name").alias("gen_ai_operation_name"), _chain(json_value, ["gen_ai.system", "gen_ai.provider.name"]).alias("gen_ai_system"),
        *[v(k).alias(k.replace(".", "_")) for k in ("gen_ai.provider.name", "gen_ai.request.model", "gen_ai.response.model", "gen_ai.token.type", "error.type")],
        "value_type", "value_double", "value_int64", "count", "sum", "min", "max", "explicit_bounds", "bucket_counts", "exp_scale", "exp_zero_count", "exp_zero_threshold", "exp_positive", "exp_negative",
        "summary_quantiles", "exemplars", "attributes", "resource", "instrumentation_scope", v("gen_ai.token.modality").alias("gen_ai_token_modality"),
        _chain(json_value, ["gen_ai.agent.name", "gen_ai.main_agent.name", "resource:gen_ai.main_agent.name"]).alias("gen_ai_agent_name"),
        dimension.alias("gen_ai_inference_usage_dimension"), "time_unix_nano", "point_fingerprint",
    )


def exemplar_facts(gen_ai_points: DataFrame) -> DataFrame:
    """Each exemplar of a point that names a span."""
    points = gen_ai_points.select("*", F.posexplode("exemplars").alias("nth", "ex"))
    return points.where(F.coalesce(F.col("ex.trace_id"), F.lit("")) != "").where(F.coalesce(F.col("ex.span_id"), F.lit("")) != "")


def exemplar_span_facts(spans: DataFrame) -> DataFrame:
    """What is told of an exemplar's span."""
    agent = ["gen_ai.agent.name", "gcp.vertex.agent.name", "resource:gen_ai.agent.name", "gen_ai.main_agent.name", "resource:gen_ai.main_agent.name"]
    s = with_bags(spans, [*_AGENT_KEYS, "gen_ai.tool.name", "gcp.vertex.agent.session_id", "gen_ai.conversation.id", "error.type"], __a="attributes", __r="resource.attributes")
    return s.select(
        "trace_id", "span_id", "service_name", "receive_time", F.col("start_time").alias("span_start_time"), F.col("end_time").alias("span_end_time"), *[c for c in ("start_hour",) if c in spans.columns],
        F.col("duration_nano").alias("span_duration_nano"), F.col("name").alias("span_name"), F.col("status.code").alias("span_status_code"), F.col("status.message").alias("span_status_message"),
        _chain(json_value, agent).alias("span_gen_ai_agent_name"), json_value("__a", "gen_ai.tool.name").alias("span_gen_ai_tool_name"),
        _chain(json_value, ["gcp.vertex.agent.session_id", "gen_ai.conversation.id"]).alias("adk_session_id"), json_value("__a", "error.type").alias("span_error_type"),
    )


#: Columns of exemplars: expressions over points ``m`` and spans ``s``, and names.
EXEMPLAR_COLUMNS = [
    ("m.timestamp", "metric_timestamp"), ("m.service_name", "service_name"), ("m.metric_name", "metric_name"), ("m.metric_unit", "metric_unit"), ("m.metric_type", "metric_type"),
    ("m.gen_ai_operation_name", "gen_ai_operation_name"), ("m.gen_ai_system", "gen_ai_system"), ("m.gen_ai_request_model", "gen_ai_request_model"), ("m.gen_ai_response_model", "gen_ai_response_model"),
    ("m.gen_ai_agent_name", "gen_ai_agent_name"), ("m.gen_ai_token_type", "gen_ai_token_type"), ("m.gen_ai_token_modality", "gen_ai_token_modality"), ("m.error_type", "metric_error_type"),
    ("m.ex.time", "exemplar_timestamp"), ("m.ex.value_double", "exemplar_value_double"), ("m.ex.value_int64", "exemplar_value_int64"), ("m.ex.trace_id", "trace_id"), ("m.ex.span_id", "span_id"),
    ("m.ex.filtered_attributes", "exemplar_filtered_attributes"), ("s.span_start_time", "span_start_time"), ("s.span_end_time", "span_end_time"), ("s.span_duration_nano", "span_duration_nano"),
    ("round(s.span_duration_nano / 1e6D, 3)", "span_duration_ms"), ("s.span_name", "span_name"), ("s.span_status_code", "span_status_code"), ("s.span_status_message", "span_status_message"),
    ("s.span_gen_ai_agent_name", "span_gen_ai_agent_name"), ("s.span_gen_ai_tool_name", "span_gen_ai_tool_name"), ("s.adk_session_id", "adk_session_id"), ("s.span_error_type", "span_error_type"),
]
EXEMPLAR_KEYS = ["timestamp", "time_unix_nano", "service_name", "metric_name", "metric_type", "point_fingerprint", "nth"]


def metric_exemplars(gen_ai_points: DataFrame, spans: DataFrame) -> DataFrame:
    """Each exemplar with ids, and the one span it names: of several the one that ended last."""
    m, s = exemplar_facts(gen_ai_points).alias("m"), exemplar_span_facts(spans).alias("s")
    same = F.expr("s.trace_id = m.ex.trace_id AND s.span_id = m.ex.span_id AND s.service_name <=> m.service_name") & near("m.timestamp", "s.span_start_time")
    w = Window.partitionBy(*[f"m.{k}" for k in EXEMPLAR_KEYS]).orderBy(F.desc("s.span_end_time"), F.desc("s.span_start_time"), F.desc("s.receive_time"), F.asc("s.span_name"))
    j = m.join(spread(s), same, "left").withColumn("__rank", F.row_number().over(w)).where("__rank = 1")
    return j.select(*[F.expr(c).alias(n) for c, n in EXEMPLAR_COLUMNS])


# rollups ------------------------------------------------------------------------------------------


def top_counts(df: DataFrame, keys: list[str], value: str, out: str = "top_error_types", n: int = TOP) -> DataFrame:
    """The ``n`` most frequent values of each key as an array of (value, count); exact, aggregated in two levels."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("__n"), F.asc(value)))
    best = counted.withColumn("__rank", rank).where(F.col("__rank") <= n)
    packed = F.sort_array(F.collect_list(F.struct("__rank", F.col(value).alias("value"), F.col("__n").alias("count"))))
    return best.groupBy(*keys).agg(F.transform(packed, lambda x: F.struct(x["value"].alias("value"), x["count"].alias("count"))).alias(out))


TIME_KEYS = ["usage_hour", "session_start_date"]


def with_top(agg: DataFrame, top: DataFrame, keys: list[str], out: str = "top_error_types") -> DataFrame:
    """Joins the top counts to the rollup; groups without any value get an empty array."""
    t = top.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], out)
    same = F.lit(True)
    for i, k in enumerate(keys):
        # times are never NULL; by a plain equality a bound on them reaches both sides
        same = same & (F.col(k) == F.col(f"__k{i}") if k in TIME_KEYS else F.col(k).eqNullSafe(F.col(f"__k{i}")))
    empty = F.array().cast("array<struct<value:string,count:bigint>>")
    return agg.join(spread(t), same, "left").select(*agg.columns, F.coalesce(F.col(out), empty).alias(out))


def quantile(column: str, q: float, exact: bool = True) -> Column:
    """A percentile that is one of the values; ``exact=False`` uses the bounded sketch."""
    if exact:
        return F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY {column})")
    return F.percentile_approx(column, q, 10_000)


def _reports_tokens() -> Column:
    return F.col("gen_ai_usage_input_tokens").isNotNull() | F.col("gen_ai_usage_output_tokens").isNotNull()


def with_token_leaf(spans: DataFrame, keys: list[str]) -> DataFrame:
    """``is_token_leaf``: no span of the same keys that reports tokens has this one as its parent."""
    # each span stands under its own id and, if it reports tokens, once more under its parent's as a mark there
    own = F.struct(F.col("span_id").alias("__id"), F.lit(False).alias("__mark"))
    above = F.struct(F.col("parent_span_id").alias("__id"), F.lit(True).alias("__mark"))
    reports = F.col("parent_span_id").isNotNull() & _reports_tokens()
    # dealt anew: the tasks that deduplicated whole spans would also hold the sorts from here on
    rows = spans.repartition(*keys).select("*", F.inline(F.when(reports, F.array(own, above)).otherwise(F.array(own))))
    marked = F.max("__mark").over(Window.partitionBy(*keys, "__id"))
    # the id's own column has the order of the sort
    return rows.withColumn("is_token_leaf", ~marked).where("NOT __mark").withColumn("span_id", F.col("__id")).drop("__id", "__mark")


def llm_call() -> Column:
    """A call of a model that counts once; NULL where the operation's comparison is."""
    op = F.col("gen_ai_operation_name")
    called = op.isin(INFERENCE_OPS) | F.col("gen_ai_request_model").isNotNull()
    own = ~F.coalesce(op, F.lit("")).isin([*AGENT_OPS, "execute_tool"]) | _reports_tokens()
    return F.col("is_token_leaf") & called & own


def _total(column: str, when: Column | None = None) -> Column:
    value = F.coalesce(F.col(column), F.lit(0))
    return F.sum(value if when is None else F.when(when, value).otherwise(0))


COST_KEYS = ["usage_hour", "service_name", "gen_ai_agent_name", "provider", "model"]


def llm_calls(g: DataFrame) -> DataFrame:
    """Calls of models that count once, with hour, provider and model."""
    s = with_token_leaf(g.withColumn("usage_hour", _hour(g)), ["usage_hour", "service_name", "trace_id"])
    return s.where(llm_call()).withColumns({"provider": F.coalesce("gen_ai_provider_name", "gen_ai_system"), "model": F.coalesce("gen_ai_response_model", "gen_ai_request_model")})


def model_costs(g: DataFrame, exact: bool = True) -> DataFrame:
    """Hourly calls, errors, tokens and latencies of models."""
    s = llm_calls(g)
    agg = s.groupBy(*COST_KEYS).agg(
        F.count("*").alias("call_count"), F.count_if(F.col("status_code") == 2).alias("error_count"),
        *[_total(f"gen_ai_usage_{c}_tokens").alias(f"total_{c}_tokens") for c in ("input", "output", "cache_read_input", "cache_creation_input", "reasoning")],
        *[quantile("duration_ms", q / 100, exact).alias(f"p{q}_duration_ms") for q in (50, 95, 99)],
        F.count("error_type").alias("typed_error_count"),
    )
    return with_top(agg, top_counts(s, COST_KEYS, "error_type"), COST_KEYS)


SESSION_KEYS = ["service_name", "session_start_date", "session_id"]


def sessions(g: DataFrame) -> DataFrame:
    """Sessions by service and UTC date. Where the reference takes any value, the smallest is taken."""
    s = g.withColumns({"session_start_date": F.to_date(_hour(g)), "session_id": F.coalesce("adk_session_id", "gen_ai_conversation_id")})
    s = with_token_leaf(s.where("session_id IS NOT NULL"), [*SESSION_KEYS, "trace_id"])
    # traces are counted by their first spans: two distinct counts would make three rows of each
    first = F.row_number().over(Window.partitionBy(*SESSION_KEYS, "trace_id").orderBy("span_id")) == 1
    s = s.withColumns({"is_llm_call": F.coalesce(llm_call(), F.lit(False)), "is_first": first & F.col("trace_id").isNotNull()})
    op, leaf = F.col("gen_ai_operation_name"), F.col("is_token_leaf")
    total = lambda c, out: _total(f"gen_ai_usage_{c}_tokens", leaf).alias(out)
    agg = s.groupBy(*SESSION_KEYS).agg(
        F.min("adk_user_id").alias("user_id"), F.min("gen_ai_agent_name").alias("agent_name"),
        F.min("start_time").alias("session_start_time"), F.max("end_time").alias("session_end_time"),
        F.expr("timestampdiff(MILLISECOND, min(start_time), max(end_time))").alias("session_duration_ms"),
        F.count_if("is_first").alias("turn_count"), F.count_distinct("adk_invocation_id").alias("invocation_count"),
        F.count_if((op == "execute_tool") | F.col("gen_ai_tool_name").isNotNull()).alias("tool_call_count"), F.count_if(F.col("status_code") == 2).alias("error_count"),
        total("input", "total_input_tokens"), total("output", "total_output_tokens"), total("cache_read_input", "total_cache_read_input_tokens"), total("reasoning", "total_reasoning_tokens"),
        total("cache_creation_input", "total_cache_creation_input_tokens"), F.count_if("is_llm_call").alias("llm_call_count"), F.count_if(op == "invoke_agent").alias("agent_invocation_count"),
        F.count("error_type").alias("typed_error_count"),
    )
    out = with_top(agg, top_counts(s, SESSION_KEYS, "error_type"), SESSION_KEYS)
    order = (
        "session_id user_id service_name agent_name session_start_time session_end_time session_duration_ms turn_count invocation_count tool_call_count error_count total_input_tokens "
        "total_output_tokens total_cache_read_input_tokens total_reasoning_tokens session_start_date total_cache_creation_input_tokens llm_call_count agent_invocation_count typed_error_count top_error_types"
    )
    return out.select(*order.split())


TOOL_KEYS = ["usage_hour", "service_name", "gen_ai_agent_name", "gen_ai_tool_name", "gen_ai_tool_type"]


def tool_usage(g: DataFrame, exact: bool = True) -> DataFrame:
    """Hourly calls, errors and latencies of tools."""
    s = g.where((F.col("gen_ai_operation_name") == "execute_tool") | F.col("gen_ai_tool_name").isNotNull()).withColumn("usage_hour", _hour(g))
    errors = F.count_if(F.col("status_code") == 2)
    agg = s.groupBy(*TOOL_KEYS).agg(
        F.count("*").alias("call_count"), errors.alias("error_count"), (errors / F.count("*")).alias("error_rate"),
        quantile("duration_ms", 0.5, exact).alias("p50_duration_ms"), quantile("duration_ms", 0.95, exact).alias("p95_duration_ms"), F.count("error_type").alias("typed_error_count"),
    )
    return with_top(agg, top_counts(s, TOOL_KEYS, "error_type"), TOOL_KEYS)


MCP_KEYS = ["usage_hour", "service_name", "mcp_method_name", "mcp_protocol_version", "gen_ai_tool_name", "mcp_target_name", "span_kind", "server_address"]


def mcp_tool_usage(m: DataFrame, exact: bool = True) -> DataFrame:
    """Hourly calls, errors and latencies of protocol methods; errors also count by type."""
    s = m.withColumns({"usage_hour": _hour(m), "mcp_target_name": F.coalesce("gen_ai_tool_name", "mcp_resource_uri", "gen_ai_prompt_name")})
    errors = F.count_if((F.col("status_code") == 2) | F.col("error_type").isNotNull())
    agg = s.groupBy(*MCP_KEYS).agg(
        F.count("*").alias("call_count"), F.count_if("also_in_gen_ai_view").alias("gen_ai_tagged_call_count"), errors.alias("error_count"), F.count("error_type").alias("typed_error_count"),
        (errors / F.count("*")).alias("error_rate"), F.round(F.avg("duration_ms"), 3).alias("avg_duration_ms"),
        *[quantile("duration_ms", q / 100, exact).alias(f"p{q}_duration_ms") for q in (50, 95, 99)],
    )
    out = with_top(agg, top_counts(s, MCP_KEYS, "error_type"), MCP_KEYS)
    return out.select(*MCP_KEYS, "call_count", "gen_ai_tagged_call_count", "error_count", "typed_error_count", "top_error_types", "error_rate", "avg_duration_ms", "p50_duration_ms", "p95_duration_ms", "p99_duration_ms")
