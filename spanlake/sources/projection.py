"""Driver tables as telemetry: spans from ``events``, logs from ``conversations``, metric points from ``orders``.

Each derived column is one expression that Spark and DuckDB both understand, so the same text
serves the engine and the SQL that checks it. Every tenth record arrives twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.stage import spread

#: Columns of an event as a span, over event_id, user_id, event_type, value, k.
OP = "CASE event_type WHEN 'click' THEN 'execute_tool' WHEN 'error' THEN 'execute_tool' WHEN 'view' THEN 'chat' WHEN 'purchase' THEN 'invoke_agent' ELSE 'text_completion' END"
SPAN_COLUMNS = {
    "service_name": "CASE WHEN user_id % 7 <> 0 THEN 'svc-' || CAST(user_id % 5 AS STRING) END",
    "name": "event_type || '-span'",
    "kind": "CASE WHEN event_id % 4 = 2 THEN 2 ELSE 3 END",
    "status_code": "CASE WHEN event_type = 'error' THEN 2 ELSE 1 END",
    "status_message": "CASE WHEN event_type = 'error' THEN 'failed with ' || CAST(event_id % 3 AS STRING) END",
}
_GENAI = "event_id % 13 <> 0"
_TOOL = f"({OP}) = 'execute_tool'"
_MODEL = "event_type IN ('view', 'signup')"
_MCP = f"{_TOOL} AND event_id % 2 = 0"
#: Attributes of a span: key and expression; NULL leaves the key out.
SPAN_ATTRIBUTES = {
    "gen_ai.operation.name": f"CASE WHEN {_GENAI} THEN {OP} END",
    "gen_ai.provider.name": f"CASE WHEN {_GENAI} THEN 'prov' || CAST(user_id % 3 AS STRING) END",
    "gen_ai.system": f"CASE WHEN {_GENAI} AND event_id % 4 = 0 THEN 'sys' || CAST(user_id % 2 AS STRING) END",
    "gen_ai.request.model": f"CASE WHEN {_MODEL} THEN 'model' || CAST(event_id % 4 AS STRING) END",
    "gen_ai.response.model": f"CASE WHEN {_MODEL} AND event_id % 2 = 0 THEN 'model' || CAST(event_id % 4 AS STRING) || '-r' END",
    "gen_ai.agent.name": "CASE WHEN event_id % 2 = 0 THEN 'agent' || CAST(event_id % 3 AS STRING) END",
    "gen_ai.conversation.id": "CASE WHEN user_id % 10 <> 0 THEN 'conv-' || CAST(user_id AS STRING) END",
    "gcp.vertex.agent.session_id": "CASE WHEN user_id % 10 = 1 THEN 'sess-' || CAST(user_id AS STRING) END",
    "gcp.vertex.agent.invocation_id": "CASE WHEN event_id % 6 = 0 THEN 'inv-' || CAST(CAST(floor(event_id / 5) AS BIGINT) AS STRING) END",
    "gen_ai.usage.input_tokens": "CASE WHEN event_type IN ('view', 'signup', 'purchase') THEN CAST(k AS STRING) END",
    "gen_ai.usage.output_tokens": "CASE WHEN event_type IN ('view', 'signup', 'purchase') AND event_id % 3 <> 1 THEN CAST(k * 2 AS STRING) END",
    "gen_ai.usage.reasoning.output_tokens": "CASE WHEN event_id % 5 = 0 THEN CAST(k % 7 AS STRING) END",
    "gen_ai.usage.cache_read.input_tokens": "CASE WHEN event_id % 4 = 1 THEN CAST(k % 5 AS STRING) END",
    "gen_ai.tool.name": f"CASE WHEN {_TOOL} THEN 'tool' || CAST(event_id % 6 AS STRING) END",
    "gen_ai.tool.type": f"CASE WHEN {_TOOL} AND event_id % 2 = 0 THEN 'function' END",
    "error.type": "CASE WHEN event_type = 'error' AND event_id % 3 <> 0 THEN 'E' || CAST(event_id % 8 AS STRING) END",
    "mcp.method.name": f"CASE WHEN {_MCP} THEN CASE WHEN event_id % 4 = 0 THEN 'tools/call' ELSE 'resources/read' END END",
    "mcp.session.id": f"CASE WHEN {_MCP} THEN 'm' || CAST(user_id AS STRING) END",
    "mcp.resource.uri": f"CASE WHEN {_MCP} AND event_id % 4 = 2 THEN 'bq://t/' || CAST(event_id % 9 AS STRING) END",
    "mcp.protocol.version": f"CASE WHEN {_MCP} THEN '2025-06-18' END",
    "server.address": f"CASE WHEN {_MCP} THEN 'host' || CAST(event_id % 3 AS STRING) END",
    "server.port": f"CASE WHEN {_MCP} THEN CAST(8000 + event_id % 2 AS STRING) END",
    "user.id": "'u' || CAST(user_id AS STRING)",
}
RESOURCE_ATTRIBUTES = {"gen_ai.main_agent.name": "CASE WHEN user_id % 4 = 0 THEN 'main' || CAST(user_id % 3 AS STRING) END"}
TRACE = "'t' || CAST(user_id AS STRING) || '-' || CAST(CAST(floor(event_id / 1000) AS BIGINT) AS STRING)"


def _json(attributes: dict[str, str]):
    return F.to_json(F.struct(*[F.expr(e).alias(k) for k, e in attributes.items()]))


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``k``, nanosecond times, ids and the parent within the trace."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    e = e.withColumns({"ts": F.col("ts").cast("timestamp"), "k": F.get_json_object("props", "$.k").cast("bigint")})
    e = e.withColumns({"trace_id": F.expr(TRACE), "span_id": F.lpad(F.col("event_id").cast("string"), 16, "0")})
    return e.selectExpr(
        "*",
        "lag(span_id) OVER (PARTITION BY trace_id ORDER BY ts, event_id) AS prev_span",
        "first_value(span_id) OVER (PARTITION BY trace_id ORDER BY ts, event_id) AS head_span",
    ).withColumn(
        "parent_span_id",
        F.expr("CASE WHEN prev_span IS NULL THEN NULL WHEN event_id % 11 = 0 THEN 'ffffffffffffffff' WHEN event_id % 3 = 0 THEN head_span ELSE prev_span END"),
    )


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw spans table; every tenth span twice, the second longer and later."""
    e = event_rows(spark, sf_dir)
    copies = F.explode(F.expr("CASE WHEN event_id % 10 = 0 THEN array(0, 1) ELSE array(0) END"))
    e = e.withColumn("copy", copies)
    nano = F.unix_micros("ts") * 1000
    length = F.expr("CAST(round(value * 100) AS BIGINT) * 10000") + F.col("copy") * 1000
    columns = {c: F.expr(x) for c, x in SPAN_COLUMNS.items()}
    out = e.select(
        F.col("ts").alias("start_time"), nano.alias("start_time_unix_nano"),
        F.timestamp_micros(F.expr("unix_micros(ts)") + F.floor(length / 1000).cast("bigint")).alias("end_time"), (nano + length).alias("end_time_unix_nano"),
        F.timestamp_micros(F.unix_micros("ts") + 5_000_000 + F.col("copy") * 1_000_000).alias("receive_time"),
        (nano + 5_000_000_000 + F.col("copy") * 1_000_000_000).alias("receive_time_unix_nano"), length.alias("duration_nano"),
        "trace_id", "span_id", "parent_span_id", F.lit(None).cast("string").alias("trace_state"), F.lit(1).cast("bigint").alias("flags"),
        columns["name"].alias("name"), columns["kind"].cast("bigint").alias("kind"),
        F.expr("CASE WHEN event_id % 4 = 2 THEN 'SERVER' ELSE 'CLIENT' END").alias("kind_name"),
        F.struct(
            columns["status_code"].cast("bigint").alias("code"),
            F.when(columns["status_code"] == 2, "ERROR").otherwise("OK").alias("code_name"), columns["status_message"].alias("message"),
        ).alias("status"),
        _json(SPAN_ATTRIBUTES).alias("attributes"), F.lit("{}").alias("attributes_schema"),
        *[F.lit(0).cast("bigint").alias(f"dropped_{c}_count") for c in ("attributes", "events", "links")],
        columns["service_name"].alias("service_name"),
        F.struct(_json(RESOURCE_ATTRIBUTES).alias("attributes"), F.lit("{}").alias("attributes_schema"), F.lit(0).cast("bigint").alias("dropped_attributes_count")).alias("resource"),
    )
    return complete(out, "otel_spans")


def complete(df: DataFrame, table: str) -> DataFrame:
    """All columns of a table in its order; missing ones are NULL."""
    want = schemas.table_schema(table)
    version = {"schema_version": F.lit(schemas.SCHEMA_VERSION)}
    have = {c: F.col(c) for c in df.columns} | version
    return df.select(*[have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in want.fields])


#: Attributes of a log record, over conv_id, turn, role.
LOG_ATTRIBUTES = {
    "gen_ai.provider.name": "CASE WHEN conv_id % 3 = 0 THEN 'prov' || CAST(conv_id % 2 AS STRING) END",
    "gen_ai.agent.name": "CASE WHEN turn % 2 = 1 THEN 'agent' || CAST(conv_id % 4 AS STRING) END",
    "error.type": "CASE WHEN (conv_id + turn) % 9 = 0 THEN 'L' || CAST(turn AS STRING) END",
    "event.name": "CASE WHEN turn % 4 = 3 THEN 'gen_ai.fallback' END",
}
LOG_EVENT = "CASE WHEN turn % 4 = 3 THEN '' WHEN conv_id % 5 = 4 THEN 'app.note' ELSE 'gen_ai.' || role || '.message' END"
#: The span a record belongs to: one event for each conversation and turn.
LOG_SPAN = "conv_id * 7 + turn"


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw logs table: turns of conversations, tied to an event's span and half an hour later; every tenth twice."""
    c = spark.read.parquet(f"{sf_dir}/conversations.parquet").withColumn("span_no", F.expr(LOG_SPAN))
    e = event_rows(spark, sf_dir).select(F.col("event_id").alias("span_no"), "ts", "trace_id", "span_id", "user_id")
    r = c.join(spread(e), "span_no").withColumn("copy", F.explode(F.expr("CASE WHEN span_no % 10 = 0 THEN array(0, 1) ELSE array(0) END")))
    micros = F.unix_micros("ts") + 1_800_000_000
    out = r.select(
        F.timestamp_micros(micros).alias("timestamp"), F.lit("event").alias("timestamp_source"), (micros * 1000).alias("time_unix_nano"),
        F.timestamp_micros(micros + F.col("copy") * 1_000_000).alias("receive_time"), (micros * 1000 + F.col("copy") * 1_000_000_000).alias("receive_time_unix_nano"),
        "trace_id", "span_id", F.expr(LOG_EVENT).alias("event_name"), F.expr("CAST(9 + turn % 3 AS BIGINT)").alias("severity_number"), F.lit("INFO").alias("severity_text"),
        F.to_json(F.struct("text")).alias("body"), _json(LOG_ATTRIBUTES).alias("attributes"),
        F.expr(SPAN_COLUMNS["service_name"]).alias("service_name"), F.lit("default").alias("log_name"), F.expr("CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING)").alias("insert_id"),
    )
    return complete(out, "otel_logs")


#: Attributes of a metric point, over o_orderkey, o_custkey.
METRIC_NAME = "CASE o_orderkey % 4 WHEN 0 THEN 'gen_ai.client.token.usage' WHEN 1 THEN 'gen_ai.client.inference.usage.input_tokens' WHEN 2 THEN 'genXai.other' ELSE 'app.requests' END"
METRIC_ATTRIBUTES = {
    "gen_ai.operation.name": "'chat'",
    "gen_ai.provider.name": "'prov' || CAST(o_custkey % 3 AS STRING)",
    "gen_ai.request.model": "CASE WHEN o_custkey % 2 = 0 THEN 'model' || CAST(o_custkey % 4 AS STRING) END",
    "gen_ai.token.type": "CASE WHEN o_orderkey % 8 = 0 THEN 'input' ELSE 'output' END",
    "gen_ai.agent.name": "CASE WHEN o_orderkey % 3 = 0 THEN 'agent' || CAST(o_orderkey % 5 AS STRING) END",
    "error.type": "CASE WHEN o_orderkey % 10 = 9 THEN 'M' END",
}
#: The event whose span a point's first exemplar names, over o_orderkey and n_events; the second names none.
METRIC_SPAN = "(o_orderkey * 7) % n_events"


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw metrics table: orders as points with exemplars that name spans; every tenth twice."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_totalprice")
    e = event_rows(spark, sf_dir).select("event_id", "ts", "trace_id", "span_id", "user_id")
    n = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    o = o.withColumn("event_id", F.expr(METRIC_SPAN.replace("n_events", str(n)))).join(spread(e), "event_id")
    o = o.withColumn("copy", F.explode(F.expr("CASE WHEN o_orderkey % 10 = 0 THEN array(0, 1) ELSE array(0) END")))
    micros = F.unix_micros("ts") + 60_000_000
    exemplar = F.struct(
        F.col("ts").alias("time"), (F.unix_micros("ts") * 1000).alias("time_unix_nano"), F.col("o_totalprice").alias("value_double"), F.lit(None).cast("bigint").alias("value_int64"),
        "trace_id", "span_id", F.lit("{}").alias("filtered_attributes"), F.lit("{}").alias("filtered_attributes_schema"),
    )
    no_span = exemplar.withField("trace_id", F.lit("")).withField("span_id", F.lit(""))
    out = o.select(
        F.timestamp_micros(micros).alias("timestamp"), (micros * 1000).alias("time_unix_nano"), F.timestamp_micros(micros + F.col("copy") * 1_000_000).alias("receive_time"),
        (micros * 1000 + F.col("copy") * 1_000_000_000).alias("receive_time_unix_nano"), F.expr(SPAN_COLUMNS["service_name"]).alias("service_name"),
        F.expr(METRIC_NAME).alias("metric_name"), F.lit("{token}").alias("metric_unit"), F.expr("CASE WHEN o_orderkey % 2 = 0 THEN 'HISTOGRAM' ELSE 'SUM' END").alias("metric_type"),
        F.lit("DELTA").alias("aggregation_temporality"), F.lit("DOUBLE").alias("value_type"), F.col("o_totalprice").alias("value_double"),
        F.array(exemplar, no_span, exemplar.withField("span_id", F.lit("0000000000none00"))).alias("exemplars"),
        _json(METRIC_ATTRIBUTES).alias("attributes"), F.expr("'fp1:' || CAST(o_orderkey AS STRING)").alias("point_fingerprint"),
    )
    return complete(out, "otel_metrics")
