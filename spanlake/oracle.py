"""DuckDB SQL that checks the registered queries, over the same projected tables."""

from __future__ import annotations

from .sources import projection as P


def _columns(table: dict[str, str]) -> str:
    return ", ".join(f'{e} AS "{k}"' for k, e in table.items())


EVENTS = f"""
ev0 AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, {P.TRACE} AS trace_id, lpad(CAST(event_id AS VARCHAR), 16, '0') AS span_id FROM events),
ev1 AS (SELECT *, lag(span_id) OVER (PARTITION BY trace_id ORDER BY ts, event_id) AS prev_span, first_value(span_id) OVER (PARTITION BY trace_id ORDER BY ts, event_id) AS head_span FROM ev0),
ev AS (SELECT *, CASE WHEN prev_span IS NULL THEN NULL WHEN event_id % 11 = 0 THEN 'ffffffffffffffff' WHEN event_id % 3 = 0 THEN head_span ELSE prev_span END AS parent_span_id FROM ev1)
"""

#: Spans with attributes as columns, deduplicated as the view does.
SPANS = f"""{EVENTS},
raw AS (
    SELECT *, ts AS start_time, epoch_us(ts) * 1000 AS start_nano, CAST(round(value * 100) AS BIGINT) * 10000 + copy * 1000 AS duration_nano,
           epoch_us(ts) * 1000 + 5000000000 + copy * 1000000000 AS receive_nano, {_columns(P.SPAN_COLUMNS)}, {_columns(P.SPAN_ATTRIBUTES)}, {_columns(P.RESOURCE_ATTRIBUTES)}
    FROM (SELECT *, unnest(CASE WHEN event_id % 10 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM ev)
),
spans AS (
    SELECT *, make_timestamp((start_nano + duration_nano) // 1000) AS end_time, round(duration_nano / 1e6, 3) AS duration_ms FROM raw
    QUALIFY row_number() OVER (PARTITION BY start_time, service_name, trace_id, span_id, name ORDER BY start_nano + duration_nano DESC, receive_nano DESC) = 1
)
"""

GENAI = f"""{SPANS},
g AS (
    SELECT start_time, end_time, duration_nano, duration_ms, trace_id, span_id, parent_span_id, service_name, name AS span_name, kind AS span_kind, status_code, status_message,
           "gen_ai.operation.name" AS op, coalesce("gen_ai.system", "gen_ai.provider.name") AS gen_ai_system, "gen_ai.provider.name" AS provider_name, "gen_ai.request.model" AS request_model,
           "gen_ai.response.model" AS response_model, coalesce("gen_ai.agent.name", service_name) AS agent_name, "gen_ai.agent.name" AS declared,
           coalesce("gen_ai.conversation.id", "gcp.vertex.agent.session_id") AS conversation_id, coalesce("gcp.vertex.agent.session_id", "gen_ai.conversation.id") AS session_id,
           "gcp.vertex.agent.invocation_id" AS invocation_id, "user.id" AS adk_user, CAST("gen_ai.usage.input_tokens" AS BIGINT) AS t_in, CAST("gen_ai.usage.output_tokens" AS BIGINT) AS t_out,
           CAST("gen_ai.usage.reasoning.output_tokens" AS BIGINT) AS t_reason, CAST("gen_ai.usage.cache_read.input_tokens" AS BIGINT) AS t_read, "gen_ai.tool.name" AS tool_name, "gen_ai.tool.type" AS tool_type,
           "error.type" AS error_type, "gen_ai.main_agent.name" AS main_agent
    FROM spans
    WHERE "gen_ai.operation.name" IS NOT NULL OR "gen_ai.system" IS NOT NULL OR "gen_ai.provider.name" IS NOT NULL OR "gcp.vertex.agent.invocation_id" IS NOT NULL
)
"""

MCP = f"""{SPANS},
m AS (
    SELECT *, ("gen_ai.operation.name" IS NOT NULL OR "gen_ai.provider.name" IS NOT NULL OR "gcp.vertex.agent.invocation_id" IS NOT NULL) AS also
    FROM spans WHERE "mcp.method.name" IS NOT NULL OR "mcp.session.id" IS NOT NULL OR "mcp.resource.uri" IS NOT NULL
)
"""

LOGS = f"""{SPANS},
raw_logs AS (
    SELECT c.conv_id, c.turn, c.role, e.*, {_columns({"event_name": P.LOG_EVENT} | {f"l:{k}": v for k, v in P.LOG_ATTRIBUTES.items()})}, {_columns({"service_name": P.SPAN_COLUMNS["service_name"]})},
           e.ts + INTERVAL 30 MINUTE AS log_time, epoch_us(e.ts + INTERVAL 30 MINUTE) * 1000 + copy * 1000000000 AS log_receive, CAST(9 + turn % 3 AS BIGINT) AS severity
    FROM (SELECT *, {P.LOG_SPAN} AS span_no, unnest(CASE WHEN ({P.LOG_SPAN}) % 10 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM conversations) c JOIN ev e ON e.event_id = c.span_no
),
logs AS (SELECT * FROM raw_logs QUALIFY row_number() OVER (PARTITION BY log_time, service_name, trace_id, span_id, severity, conv_id, turn ORDER BY log_receive DESC) = 1)
"""

METRICS = f"""{SPANS},
n AS (SELECT count(*) AS n_events FROM events),
raw_points AS (
    SELECT o.*, e.ts, e.trace_id, e.span_id, {_columns({"service_name": P.SPAN_COLUMNS["service_name"], "metric_name": P.METRIC_NAME} | {f"m:{k}": v for k, v in P.METRIC_ATTRIBUTES.items()})},
           e.ts + INTERVAL 1 MINUTE AS point_time, CASE WHEN o_orderkey % 2 = 0 THEN 'HISTOGRAM' ELSE 'SUM' END AS metric_type, copy
    FROM (SELECT *, unnest(CASE WHEN o_orderkey % 10 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM orders, n) o JOIN ev e ON e.event_id = {P.METRIC_SPAN}
),
points AS (SELECT * FROM raw_points QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY copy DESC) = 1)
"""


def _top(source: str, keys: str, value: str = "error_type") -> str:
    """Of each key the five most frequent values, as ``value:count`` joined by commas."""
    ks = [k.strip() for k in keys.split(",")]
    return f"""
    (SELECT {keys}, string_agg({value} || ':' || n, ',' ORDER BY n DESC, {value}) AS top_errors FROM (
        SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY n DESC, {value}) AS r FROM (SELECT {keys}, {value}, count(*) AS n FROM {source} WHERE {value} IS NOT NULL GROUP BY ALL))
     WHERE r <= 5 GROUP BY {keys})""" if ks else ""


def _with_top(agg: str, source: str, keys: str) -> str:
    same = " AND ".join(f"a.{k.strip()} IS NOT DISTINCT FROM t.{k.strip()}" for k in keys.split(","))
    return f"SELECT a.*, coalesce(t.top_errors, '') AS top_errors FROM ({agg}) a LEFT JOIN {_top(source, keys)} t ON {same}"


_LEAF = "NOT coalesce(list_contains(list(CASE WHEN parent_span_id IS NOT NULL AND (t_in IS NOT NULL OR t_out IS NOT NULL) THEN parent_span_id END) OVER (PARTITION BY {0}), span_id), FALSE)"
_CALL = """(leaf AND (op IN ('chat', 'generate_content', 'text_completion', 'embeddings') OR request_model IS NOT NULL)
    AND (coalesce(op, '') NOT IN ('invoke_agent', 'create_agent', 'execute_tool') OR t_in IS NOT NULL OR t_out IS NOT NULL))"""

COSTS = f"""{GENAI},
h AS (SELECT *, date_trunc('hour', start_time) AS usage_hour FROM g),
leafs AS (SELECT *, {_LEAF.format("usage_hour, service_name, trace_id")} AS leaf FROM h),
calls AS (SELECT *, coalesce(provider_name, gen_ai_system) AS provider, coalesce(response_model, request_model) AS model FROM leafs WHERE {_CALL}),
costs AS ({_with_top('''
    SELECT usage_hour, service_name, agent_name, provider, model, count(*) AS call_count, count_if(status_code = 2)::BIGINT AS error_count, sum(coalesce(t_in, 0))::BIGINT AS total_input_tokens,
           sum(coalesce(t_out, 0))::BIGINT AS total_output_tokens, sum(coalesce(t_read, 0))::BIGINT AS total_cache_read_input_tokens, sum(coalesce(t_reason, 0))::BIGINT AS total_reasoning_tokens,
           quantile_disc(duration_ms, 0.5) AS p50_duration_ms, quantile_disc(duration_ms, 0.95) AS p95_duration_ms, quantile_disc(duration_ms, 0.99) AS p99_duration_ms, count(error_type) AS typed_error_count
    FROM calls GROUP BY ALL''', "calls", "usage_hour, service_name, agent_name, provider, model")})
"""

SESSIONS = f"""{GENAI},
s0 AS (SELECT *, CAST(start_time AS DATE) AS session_start_date FROM (SELECT * REPLACE (coalesce(session_id, conversation_id) AS session_id) FROM g) WHERE session_id IS NOT NULL),
s1 AS (SELECT *, {_LEAF.format("service_name, session_start_date, session_id, trace_id")} AS leaf FROM s0),
s2 AS (SELECT *, coalesce({_CALL}, FALSE) AS is_call FROM s1),
sessions AS ({_with_top('''
    SELECT session_id, service_name, session_start_date, min(adk_user) AS user_id, min(agent_name) AS agent_name, min(start_time) AS session_start_time, max(end_time) AS session_end_time,
           CAST(floor((epoch_us(max(end_time)) - epoch_us(min(start_time))) / 1000) AS BIGINT) AS session_duration_ms, count(DISTINCT trace_id) AS turn_count, count(DISTINCT invocation_id) AS invocation_count,
           count_if(coalesce(op = 'execute_tool', FALSE) OR tool_name IS NOT NULL)::BIGINT AS tool_call_count, count_if(status_code = 2)::BIGINT AS error_count, sum(CASE WHEN leaf THEN coalesce(t_in, 0) ELSE 0 END)::BIGINT AS total_input_tokens,
           sum(CASE WHEN leaf THEN coalesce(t_out, 0) ELSE 0 END)::BIGINT AS total_output_tokens, sum(CASE WHEN leaf THEN coalesce(t_read, 0) ELSE 0 END)::BIGINT AS total_cache_read_input_tokens,
           sum(CASE WHEN leaf THEN coalesce(t_reason, 0) ELSE 0 END)::BIGINT AS total_reasoning_tokens, count_if(is_call)::BIGINT AS llm_call_count, count_if(coalesce(op = 'invoke_agent', FALSE))::BIGINT AS agent_invocation_count,
           count(error_type) AS typed_error_count
    FROM s2 GROUP BY session_id, service_name, session_start_date''', "s2", "service_name, session_start_date, session_id")})
"""

TOOLS = f"""{GENAI},
u AS (SELECT *, date_trunc('hour', start_time) AS usage_hour FROM g WHERE op = 'execute_tool' OR tool_name IS NOT NULL),
tools AS ({_with_top('''
    SELECT usage_hour, service_name, agent_name, tool_name, tool_type, count(*) AS call_count, count_if(status_code = 2)::BIGINT AS error_count, count_if(status_code = 2) / count(*) AS error_rate,
           quantile_disc(duration_ms, 0.5) AS p50_duration_ms, quantile_disc(duration_ms, 0.95) AS p95_duration_ms, count(error_type) AS typed_error_count
    FROM u GROUP BY ALL''', "u", "usage_hour, service_name, agent_name, tool_name, tool_type")})
"""

MCP_USAGE = f"""{MCP},
mm AS (SELECT *, date_trunc('hour', start_time) AS usage_hour, "mcp.method.name" AS mcp_method_name, "gen_ai.tool.name" AS tool_name, coalesce("gen_ai.tool.name", "mcp.resource.uri") AS mcp_target_name,
       kind AS span_kind, "server.address" AS server_address, "error.type" AS error_type FROM m),
mcp AS ({_with_top('''
    SELECT usage_hour, service_name, mcp_method_name, tool_name, mcp_target_name, span_kind, server_address, count(*) AS call_count, count_if(also)::BIGINT AS gen_ai_tagged_call_count,
           count_if(status_code = 2 OR error_type IS NOT NULL)::BIGINT AS error_count, count(error_type) AS typed_error_count, count_if(status_code = 2 OR error_type IS NOT NULL) / count(*) AS error_rate,
           round(avg(duration_ms), 3) AS avg_duration_ms, quantile_disc(duration_ms, 0.5) AS p50_duration_ms, quantile_disc(duration_ms, 0.95) AS p95_duration_ms, quantile_disc(duration_ms, 0.99) AS p99_duration_ms
    FROM mm GROUP BY ALL''', "mm", "usage_hour, service_name, mcp_method_name, tool_name, mcp_target_name, span_kind, server_address")})
"""



def _trajectory(where: str = "TRUE", out: str = "TRUE") -> str:
    """Trees over the spans of ``where``; rows of ``out``."""
    same = "c.trace_id = t.trace_id AND c.service_name IS NOT DISTINCT FROM t.service_name"
    starts = "(agent_op OR declared IS NOT NULL)"
    below = "(c.agent_op OR (t.nearest_span IS NULL AND c.declared IS NOT NULL))"
    return f"""WITH RECURSIVE {GENAI},
    canon AS (
        SELECT *, CASE WHEN agent_op THEN coalesce(declared, agent_name) ELSE declared END AS path_name
        FROM (SELECT *, coalesce(op IN ('invoke_agent', 'create_agent'), FALSE) AS agent_op FROM g WHERE {where})
        QUALIFY row_number() OVER (PARTITION BY trace_id, service_name, span_id ORDER BY start_time, end_time DESC, span_name, duration_nano DESC) = 1
    ),
    tree AS (
        SELECT c.*, 0 AS depth, span_id AS root_span_id, CASE WHEN {starts} THEN span_id END AS nearest_span, CASE WHEN {starts} THEN coalesce(declared, agent_name) END AS nearest_name,
               CASE WHEN path_name IS NULL THEN CAST([] AS VARCHAR[]) ELSE [path_name] END AS agent_path, coalesce(parent_span_id, '') <> '' AS is_orphan, [span_id] AS visited
        FROM canon c WHERE coalesce(parent_span_id, '') = '' OR NOT EXISTS (
            SELECT 1 FROM canon t WHERE {same} AND c.parent_span_id = t.span_id AND c.start_time BETWEEN t.start_time - INTERVAL 1 HOUR AND t.start_time + INTERVAL 24 HOUR)
        UNION ALL
        SELECT c.*, t.depth + 1, t.root_span_id, CASE WHEN {below} THEN c.span_id ELSE t.nearest_span END, CASE WHEN {below} THEN coalesce(c.declared, c.agent_name) ELSE t.nearest_name END,
               CASE WHEN c.path_name IS NULL OR (len(t.agent_path) > 0 AND t.agent_path[-1] = c.path_name) THEN t.agent_path ELSE list_append(t.agent_path, c.path_name) END, t.is_orphan, list_append(t.visited, c.span_id)
        FROM canon c JOIN tree t ON {same} AND c.parent_span_id = t.span_id AND c.start_time BETWEEN t.start_time - INTERVAL 1 HOUR AND t.start_time + INTERVAL 24 HOUR
        WHERE t.depth < 16 AND NOT list_contains(t.visited, c.span_id)
    ),
    closure AS (
        SELECT c.trace_id, c.service_name, c.span_id AS d, c.t_in, c.t_out, c.t_reason, t.span_id AS p, t.parent_span_id AS up, [c.span_id, t.span_id] AS path
        FROM tree c JOIN tree t ON {same} AND c.parent_span_id = t.span_id AND c.span_id <> t.span_id
        UNION ALL
        SELECT c.trace_id, c.service_name, c.d, c.t_in, c.t_out, c.t_reason, t.span_id, t.parent_span_id, list_append(path, t.span_id)
        FROM closure c JOIN tree t ON {same} AND c.up = t.span_id WHERE NOT list_contains(path, t.span_id) AND len(path) <= 32
    ),
    cover AS (SELECT trace_id, service_name, p, bool_or(t_in IS NOT NULL) AS c_in, bool_or(t_out IS NOT NULL) AS c_out, bool_or(t_reason IS NOT NULL) AS c_reason FROM closure GROUP BY ALL),
    marked AS (
        SELECT t.*, t_in IS NOT NULL AND NOT coalesce(c_in, FALSE) AS o_in, t_out IS NOT NULL AND NOT coalesce(c_out, FALSE) AS o_out, t_reason IS NOT NULL AND NOT coalesce(c_reason, FALSE) AS o_reason, c_in, c_out, c_reason,
               row_number() OVER (PARTITION BY t.trace_id, t.service_name ORDER BY start_time, span_id) AS step_index,
               NOT EXISTS (SELECT 1 FROM canon c WHERE {same} AND c.parent_span_id = t.span_id) AS is_leaf
        FROM tree t LEFT JOIN cover v ON v.trace_id = t.trace_id AND v.service_name IS NOT DISTINCT FROM t.service_name AND v.p = t.span_id
    )
    SELECT trace_id, span_id, service_name, start_time, depth, root_span_id, nearest_name AS nearest_agent_name, array_to_string(agent_path, ' > ') AS agent_path, is_orphan, step_index, is_leaf, o_in OR o_out OR o_reason AS is_token_leaf,
           CASE WHEN coalesce(c_in, FALSE) AND (o_out OR o_reason) THEN NULL ELSE t_in END AS gen_ai_usage_input_tokens, CASE WHEN coalesce(c_out, FALSE) AND (o_in OR o_reason) THEN NULL ELSE t_out END AS gen_ai_usage_output_tokens,
           CASE WHEN coalesce(c_reason, FALSE) AND (o_in OR o_out) THEN NULL ELSE t_reason END AS gen_ai_usage_reasoning_tokens
    FROM marked WHERE {out}"""


_DAYS = "{0} >= TIMESTAMP '2024-01-05' AND {0} < TIMESTAMP '2024-01-12'"
#: ``a:2,b:1`` as ``a (2), b (1)``; NULL for none.
_TOP_TEXT = r"nullif(regexp_replace(regexp_replace({0}, ':([0-9]+)', ' (\1)', 'g'), '\),', '), ', 'g'), '')"
_FAILED = """(status_code = 2 OR "error.type" IS NOT NULL) AND ("gen_ai.operation.name" = 'execute_tool' OR "gen_ai.tool.name" IS NOT NULL OR "mcp.method.name" IS NOT NULL)"""
_ALERT = "service_name, trace_id, start_time AS event_time"

QUERIES = {
    "w1_spans_dedup": f"WITH {SPANS} SELECT trace_id, span_id, service_name, name, start_time, end_time, duration_nano, receive_nano AS receive_time_unix_nano FROM spans",
    "w2_logs_dedup": f"WITH {LOGS} SELECT trace_id, span_id, service_name, log_time AS timestamp, log_receive AS receive_time_unix_nano, severity AS severity_number, event_name FROM logs",
    "w3_metrics_dedup": f"WITH {METRICS} SELECT 'fp1:' || o_orderkey AS point_fingerprint, metric_name, metric_type, service_name, point_time AS timestamp, o_totalprice AS value_double, epoch_us(point_time) * 1000 + copy * 1000000000 AS receive_time_unix_nano FROM points",
    "v1_all_spans": f"WITH {SPANS} SELECT trace_id, span_id, parent_span_id, name, CAST(kind AS BIGINT) AS kind, start_time, CAST(status_code AS BIGINT) AS status_code, status_message FROM spans",
    "v2_gen_ai_spans": f"""WITH {GENAI} SELECT start_time, end_time, duration_nano, duration_ms, trace_id, span_id, parent_span_id, service_name, span_name, CAST(span_kind AS BIGINT) AS span_kind, CAST(status_code AS BIGINT) AS status_code, status_message,
        op AS gen_ai_operation_name, gen_ai_system, provider_name AS gen_ai_provider_name, request_model AS gen_ai_request_model, response_model AS gen_ai_response_model, agent_name AS gen_ai_agent_name,
        conversation_id AS gen_ai_conversation_id, session_id AS adk_session_id, invocation_id AS adk_invocation_id, adk_user AS adk_user_id, t_in AS gen_ai_usage_input_tokens, t_out AS gen_ai_usage_output_tokens,
        t_reason AS gen_ai_usage_reasoning_tokens, t_read AS gen_ai_usage_cache_read_input_tokens, tool_name AS gen_ai_tool_name, tool_type AS gen_ai_tool_type, error_type, main_agent AS gen_ai_main_agent_name FROM g""",
    "v3_mcp_spans": f"""WITH {MCP} SELECT trace_id, span_id, service_name, start_time, duration_ms, "mcp.method.name" AS mcp_method_name, "mcp.session.id" AS mcp_session_id, "mcp.resource.uri" AS mcp_resource_uri,
        "server.address" AS server_address, CAST("server.port" AS BIGINT) AS server_port, "gen_ai.tool.name" AS gen_ai_tool_name, "gen_ai.agent.name" AS gen_ai_agent_name, coalesce("mcp.method.name" = 'tools/call', FALSE) AS is_tool_call, also AS also_in_gen_ai_view FROM m""",
    "v4_gen_ai_metrics": f"""WITH {METRICS} SELECT 'fp1:' || o_orderkey AS point_fingerprint, metric_name, metric_type, service_name, point_time AS timestamp, o_totalprice AS value_double, "m:gen_ai.provider.name" AS gen_ai_system,
        "m:gen_ai.request.model" AS gen_ai_request_model, "m:gen_ai.token.type" AS gen_ai_token_type, "m:gen_ai.agent.name" AS gen_ai_agent_name, "m:error.type" AS error_type,
        CASE WHEN metric_name = 'gen_ai.client.inference.usage.input_tokens' THEN 'input' ELSE "m:gen_ai.token.type" END AS gen_ai_inference_usage_dimension FROM points WHERE metric_name LIKE 'gen_ai.%'""",
    "v5_spans_redacted": f"WITH {SPANS} SELECT trace_id, span_id, name, start_time, CAST(status_code AS BIGINT) AS status_code, CAST(NULL AS VARCHAR) AS status_message, CAST(NULL AS VARCHAR) AS attributes FROM spans",
    "v5_logs_redacted": f"WITH {LOGS} SELECT trace_id, span_id, event_name, log_time AS timestamp, CAST(NULL AS VARCHAR) AS body, CAST(NULL AS VARCHAR) AS attributes FROM logs",
    "j1_gen_ai_logs": f"""WITH {LOGS} SELECT l.trace_id, l.span_id, l.service_name, l.log_time AS timestamp, coalesce(nullif(l.event_name, ''), "l:event.name") AS event_name, l.severity AS severity_number,
        s."gen_ai.operation.name" AS gen_ai_operation_name, coalesce("l:gen_ai.provider.name", s."gen_ai.system", s."gen_ai.provider.name") AS gen_ai_system, coalesce("l:gen_ai.agent.name", s."gen_ai.agent.name") AS gen_ai_agent_name,
        coalesce(s."gcp.vertex.agent.session_id", s."gen_ai.conversation.id") AS adk_session_id, s."user.id" AS adk_user_id, "l:error.type" AS error_type
        FROM logs l LEFT JOIN spans s ON l.trace_id = s.trace_id AND l.span_id = s.span_id AND l.service_name IS NOT DISTINCT FROM s.service_name AND s.start_time BETWEEN l.log_time - INTERVAL 24 HOUR AND l.log_time + INTERVAL 1 HOUR
        WHERE coalesce(nullif(l.event_name, ''), "l:event.name") LIKE 'gen_ai.%' OR "l:gen_ai.provider.name" IS NOT NULL""",
    "j2_metric_exemplars": f"""WITH {METRICS}, x AS (SELECT p.*, u.ex_span FROM points p, (SELECT unnest([1, 3]) AS nth) n, LATERAL (SELECT CASE WHEN nth = 1 THEN p.span_id ELSE '0000000000none00' END AS ex_span) u WHERE metric_name LIKE 'gen_ai.%')
        SELECT 'p' || x.o_orderkey AS point, x.metric_name, x.service_name, x.point_time AS metric_timestamp, x.trace_id, x.ex_span AS span_id, s.start_time AS span_start_time, s.duration_ms AS span_duration_ms, s.name AS span_name,
        coalesce(s."gen_ai.agent.name", s."gen_ai.main_agent.name") AS span_gen_ai_agent_name, s."gen_ai.tool.name" AS span_gen_ai_tool_name, coalesce(s."gcp.vertex.agent.session_id", s."gen_ai.conversation.id") AS adk_session_id, s."error.type" AS span_error_type
        FROM x LEFT JOIN spans s ON s.trace_id = x.trace_id AND s.span_id = x.ex_span AND s.service_name IS NOT DISTINCT FROM x.service_name""",
    "a1_model_costs": f"WITH {COSTS} SELECT * FROM costs",
    "a2_sessions": f"WITH {SESSIONS} SELECT * FROM sessions",
    "a3_tool_usage": f"WITH {TOOLS} SELECT * FROM tools",
    "a4_mcp_tool_usage": f"WITH {MCP_USAGE} SELECT * FROM mcp",
    "q1_agent_trajectory": _trajectory(),
    "q2_tvf_agent_trajectory": _trajectory("start_time >= TIMESTAMP '2024-01-04' AND start_time < TIMESTAMP '2024-01-13'", _DAYS.format("start_time")),
    "q9_executive_summary": f"""WITH {COSTS} SELECT usage_hour, CAST(usage_hour AS DATE) AS usage_date, service_name, agent_name AS gen_ai_agent_name, provider, model, call_count, error_count, typed_error_count, total_input_tokens,
        total_output_tokens, total_cache_read_input_tokens, total_reasoning_tokens, p50_duration_ms, p95_duration_ms, p99_duration_ms, {_TOP_TEXT.format("top_errors")} AS top_error_types FROM costs WHERE {_DAYS.format("usage_hour")}""",
    "q10_agent_sessions": f"""WITH {SESSIONS} SELECT session_start_date, session_id, service_name, turn_count, CASE WHEN turn_count <= 1 THEN '01' WHEN turn_count <= 3 THEN '02-03' WHEN turn_count <= 6 THEN '04-06' WHEN turn_count <= 10 THEN '07-10' ELSE '11+' END AS turn_count_bucket,
        error_count, total_input_tokens, {_TOP_TEXT.format("top_errors")} AS top_error_types FROM sessions WHERE {_DAYS.format("session_start_date")}""",
    "q11_tool_and_mcp_usage": f"""WITH {MCP_USAGE}, g AS ({GENAI.rpartition("g AS (")[2].rstrip().removesuffix(")")}), {TOOLS.removeprefix(GENAI + ",")}
        SELECT 'mcp' AS source, usage_hour, CAST(usage_hour AS DATE) AS usage_date, service_name, tool_name AS gen_ai_tool_name, mcp_target_name, NULL AS gen_ai_agent_name, server_address, CAST(span_kind AS BIGINT) AS span_kind, call_count,
               call_count - gen_ai_tagged_call_count AS mcp_only_call_count, error_count, p50_duration_ms, {_TOP_TEXT.format("top_errors")} AS top_error_types FROM mcp WHERE {_DAYS.format("usage_hour")}
        UNION ALL
        SELECT 'gen_ai', usage_hour, CAST(usage_hour AS DATE), service_name, tool_name, NULL, agent_name, NULL, NULL, call_count, NULL, error_count, p50_duration_ms, {_TOP_TEXT.format("top_errors")} FROM tools WHERE {_DAYS.format("usage_hour")}""",
    "q4_tvf_logs": "",
    "q5_tvf_metric_exemplars": f"""WITH {METRICS}, x AS (SELECT p.*, u.ex_span FROM points p, (SELECT unnest([1, 3]) AS nth) n, LATERAL (SELECT CASE WHEN nth = 1 THEN p.span_id ELSE '0000000000none00' END AS ex_span) u WHERE metric_name LIKE 'gen_ai.%' AND {_DAYS.format("point_time")})
        SELECT x.metric_name, x.service_name, x.point_time AS metric_timestamp, x.o_totalprice AS exemplar_value_double, x.trace_id, x.ex_span AS span_id, s.start_time AS span_start_time, coalesce(s."gen_ai.agent.name", s."gen_ai.main_agent.name") AS span_gen_ai_agent_name
        FROM x LEFT JOIN spans s ON s.trace_id = x.trace_id AND s.span_id = x.ex_span AND s.service_name IS NOT DISTINCT FROM x.service_name""",
    "q7_unhandled_cycles": f"""WITH t AS ({_trajectory()}), {GENAI}
        SELECT g.trace_id, g.service_name, g.span_id, count(t.span_id) AS emitted_rows, CASE WHEN count(t.span_id) = 0 THEN 'span_missing_from_trajectory' ELSE 'span_in_trajectory_more_than_once' END AS violation
        FROM (SELECT DISTINCT trace_id, service_name, span_id FROM g) g LEFT JOIN t ON g.trace_id = t.trace_id AND g.service_name IS NOT DISTINCT FROM t.service_name AND g.span_id = t.span_id GROUP BY ALL HAVING count(t.span_id) <> 1""",
    "r1_span_alerts": f"""WITH {SPANS}, al AS (
        SELECT 'TOOL_ERROR:' || trace_id || ':' || span_id AS alert_id, 'TOOL_ERROR' AS alert_kind, {_ALERT}, "gen_ai.tool.name" AS tool_name, "mcp.method.name" AS mcp_method_name, "error.type" AS error_type, CAST(status_code AS BIGINT) AS status_code,
               CAST(NULL AS VARCHAR) AS session_id, CAST(NULL AS BIGINT) AS input_tokens, CAST(NULL AS BIGINT) AS output_tokens, CAST(NULL AS DOUBLE) AS duration_ms FROM spans WHERE {_FAILED}
        UNION ALL
        SELECT 'TOKEN_BUDGET_BURN:' || trace_id || ':' || span_id, 'TOKEN_BUDGET_BURN', {_ALERT}, NULL, NULL, NULL, NULL, coalesce("gen_ai.conversation.id", "gcp.vertex.agent.session_id"), CAST("gen_ai.usage.input_tokens" AS BIGINT), CAST("gen_ai.usage.output_tokens" AS BIGINT), NULL
        FROM spans WHERE coalesce(CAST("gen_ai.usage.input_tokens" AS BIGINT), 0) > 60 OR coalesce(CAST("gen_ai.usage.output_tokens" AS BIGINT), 0) > 120
        UNION ALL
        SELECT 'AGENT_LATENCY_HIGH:' || trace_id || ':' || span_id, 'AGENT_LATENCY_HIGH', {_ALERT}, "gen_ai.tool.name", NULL, NULL, NULL, NULL, NULL, NULL, duration_ms
        FROM spans WHERE duration_nano / 1e6 > 150 AND "gen_ai.operation.name" IN ('invoke_agent', 'chat', 'generate_content', 'execute_tool'))
        SELECT * FROM al WHERE {_DAYS.format("event_time")}""",
    "r4_tool_error_windows": f"""WITH {SPANS} SELECT 'TOOL_ERROR_WINDOW' AS alert_kind, time_bucket(INTERVAL 6 HOUR, make_timestamp(receive_nano // 1000), TIMESTAMP '2000-01-01') + INTERVAL 6 HOUR AS event_time, service_name, "gen_ai.tool.name" AS tool_name, count(*) AS error_spans
        FROM spans WHERE {_FAILED} GROUP BY ALL HAVING count(*) >= 2""",
    "q15_report_fields": f"""WITH {COSTS}, {MCP_USAGE.removeprefix(SPANS + ",")}, {SESSIONS.removeprefix(GENAI + ",")},
        c AS (SELECT CAST(usage_hour AS DATE) AS usage_date, sum(error_count) / sum(call_count) AS error_rate, (sum(total_input_tokens) * 2.5 + sum(total_output_tokens) * 10.0) / 1000000 AS estimated_cost FROM costs GROUP BY 1),
        u AS (SELECT CAST(usage_hour AS DATE) AS usage_date, sum(gen_ai_tagged_call_count) / sum(call_count) AS dual_tagged_share, sum(avg_duration_ms * call_count) / sum(call_count) AS weighted_avg_duration_ms FROM mcp GROUP BY 1),
        z AS (SELECT session_start_date AS usage_date, count(DISTINCT CASE WHEN error_count > 0 THEN session_id END) AS sessions_with_errors FROM sessions GROUP BY 1)
        SELECT * FROM c JOIN u USING (usage_date) JOIN z USING (usage_date)""",
    "q16_model_costs_mart": f"WITH {COSTS} SELECT * FROM costs",
    "t7_redaction": "SELECT conv_id, turn, CASE WHEN role = 'user' THEN '[REDACTED]' END AS session_token, CASE WHEN coalesce(role, '') <> 'user' THEN regexp_replace(text, '[0-9]{2,}', '[REDACTED]', 'g') END AS note FROM conversations",
    "t8_offload": """WITH l AS (SELECT sha256(text) AS sha256, strlen(text) AS byte_size FROM documents WHERE strlen(text) BETWEEN 2000 AND 64000)
        SELECT 'store/payloads/logs/2024-01-01/' || sha256 AS uri, sha256, byte_size, count(*) AS refs, '<offloaded:store/payloads/logs/2024-01-01/' || sha256 || '>' AS text FROM l GROUP BY ALL""",
    "t10_fingerprints": """WITH f AS (SELECT conv_id, turn, 'role=' || strlen(coalesce(role, '')) || ':' || coalesce(role, '') || chr(10) || 'text=' || strlen(coalesce(text, '')) || ':' || coalesce(text, '') || chr(10) AS frame FROM conversations),
        n AS (SELECT *, CAST(row_number() OVER (PARTITION BY conv_id, frame ORDER BY turn) - 1 AS VARCHAR) AS nth FROM f)
        SELECT conv_id, turn, 'fp1:' || sha256(frame || 'intra_batch_ordinal=' || strlen(nth) || ':' || nth || chr(10)) AS record_fingerprint FROM n""",
}
QUERIES["q4_tvf_logs"] = f"SELECT trace_id, span_id, service_name, timestamp, event_name, gen_ai_agent_name, adk_user_id FROM ({QUERIES['j1_gen_ai_logs']}) WHERE timestamp >= TIMESTAMP '2024-01-01 12:00:00' AND timestamp < TIMESTAMP '2024-01-02 12:00:00'"
QUERIES["q14_metric_exemplars"] = f"""SELECT metric_name, service_name, CAST(metric_timestamp AS DATE) AS metric_date, exemplar_value_double AS exemplar_value, trace_id || ':' || span_id AS span_key,
    'https://console.cloud.google.com/traces/explorer;traceId=' || trace_id || '?project=project' AS trace_url, span_name, span_duration_ms FROM ({QUERIES["q5_tvf_metric_exemplars"].replace("AS span_start_time,", "AS span_start_time, s.name AS span_name, s.duration_ms AS span_duration_ms,")})"""
QUERIES["q6_trajectory_mart"] = QUERIES["q1_agent_trajectory"]
_OWN_PARENTS = "CASE WHEN CAST(span_id AS BIGINT) % 17 = 0 THEN span_id ELSE parent_span_id END AS parent_span_id"
QUERIES["q7_cycles"] = QUERIES["q7_unhandled_cycles"].replace("trace_id, span_id, parent_span_id, service_name, name AS span_name", f"trace_id, span_id, {_OWN_PARENTS}, service_name, name AS span_name")
QUERIES["t1_span_rows"] = """WITH e AS (SELECT *, event_id % 50 AS c FROM events)
    SELECT CAST(event_id AS VARCHAR) AS name, CASE WHEN c <> 0 THEN lpad(lower(to_hex(user_id + 1)), 32, '0') END AS trace_id, lpad(lower(to_hex(event_id + 1)), 16, '0') AS span_id,
           CASE WHEN c = 7 THEN TIMESTAMP '1970-01-01' ELSE ts END AS start_time, CASE WHEN c = 7 THEN epoch_us(ts) * 1000 + 1500 WHEN c = 9 THEN 0 ELSE 1500 END AS duration_nano, 'svc' AS service_name, 'urn:resource' AS resource_schema_url,
           CASE c WHEN 0 THEN 'INVALID_TRACE_ID' WHEN 7 THEN 'MISSING_START_TIME' WHEN 9 THEN 'TIMESTAMP_OVERFLOW' END AS error_code, event_id AS whole, value AS real,
           CASE WHEN event_id % 2 = 0 THEN 'true' ELSE 'false' END AS truth, CAST(NULL AS BIGINT) AS truth_number, event_type AS text, CASE WHEN c <> 3 THEN event_id END AS digits, c AS more FROM e"""
QUERIES["t2_log_rows"] = """WITH c AS (SELECT *, TIMESTAMP '2024-01-01' + to_seconds(conv_id) AS tm FROM conversations)
    SELECT conv_id || '-' || turn AS insert_id, CASE WHEN turn % 3 = 2 THEN TIMESTAMP '2024-01-01' ELSE tm END AS timestamp, CASE turn % 3 WHEN 0 THEN 'event' WHEN 1 THEN 'observed' ELSE 'receive' END AS timestamp_source,
           CASE WHEN turn % 2 = 1 THEN 'named' ELSE 'fallback' END AS event_name, CASE WHEN turn % 2 = 0 THEN role ELSE 'svc' END AS log_name, text AS body FROM c"""
QUERIES["t14_metric_replay"] = """SELECT 'orders' AS metric_name, CAST(o_orderkey AS VARCHAR) AS metric_description, ['GAUGE', 'SUM', 'HISTOGRAM'][o_orderkey % 3 + 1] AS metric_type, CASE o_orderkey % 3 WHEN 1 THEN 'DELTA' WHEN 2 THEN 'CUMULATIVE' END AS aggregation_temporality,
    CASE WHEN o_orderkey % 3 = 1 THEN TRUE END AS is_monotonic, TIMESTAMP '2024-01-01' + to_seconds(o_orderkey) AS timestamp, CASE WHEN o_orderkey % 3 <> 2 THEN o_totalprice END AS value_double, CASE WHEN o_orderkey % 3 = 2 THEN 2::BIGINT END AS n,
    CASE WHEN o_orderkey % 3 = 2 THEN o_totalprice END AS total, o_orderkey AS a, 'urn:resource' AS resource_schema_url, 'urn:scope' AS scope_schema_url, 'svc' AS service_name FROM orders"""
QUERIES["q3_quarantine_scan"] = """WITH k AS (SELECT date_trunc('day', ts)::TIMESTAMP AS ingest_time,
        to_json({signal: 'traces', error_code: event_type, error_message: 'm', service_name: NULL::VARCHAR, trace_id: NULL::VARCHAR, span_id: NULL::VARCHAR, raw_payload: props})::VARCHAR AS row_key FROM events),
    f AS (SELECT *, ('0x' || sha256(row_key)[1:15])::BIGINT AS row_fp FROM k),
    o AS (SELECT *, row_number() OVER (PARTITION BY ingest_time, row_fp ORDER BY row_key) - 1 AS row_ord, count(*) OVER (PARTITION BY ingest_time, row_fp) AS group_size FROM f)
    SELECT ingest_time, row_fp, row_ord, row_key, group_size, sha256(strlen(row_key) || ':' || row_key || ':' || (row_ord + 1) || ';') AS prefix_sha256, sha256(strlen(row_key) || ':' || row_key || ':' || group_size || ';') AS group_sha256 FROM o"""
QUERIES["t8_attribute_offload"] = """SELECT doc_id, place, '<offloaded:store/payloads/logs/2024-01-01/' || sha256(text) || '>' AS left_behind, ['body', 'attributes.list[1]', 'attributes.nested.text'][place + 1] AS attribute_path,
    'text/plain; charset=utf-8' AS mime_type, sha256(text) AS sha256, strlen(text) AS byte_size, strlen(text) AS stored_bytes FROM documents, (SELECT unnest([0, 1, 2]) AS place) WHERE strlen(text) BETWEEN 2000 AND 64000"""
QUERIES["s4_quarantine_files"] = """SELECT CASE WHEN event_id % 4 = 3 THEN date_trunc('second', ts) ELSE ts END AS ingest_time, 'traces' AS signal, NULL::VARCHAR AS error_code, CAST(event_id AS VARCHAR) AS span_id, props AS raw_payload FROM events"""
QUERIES["k8_registered_views"] = f"""WITH {COSTS}, {SESSIONS.removeprefix(GENAI + ",")}, {TOOLS.removeprefix(GENAI + ",")}, {MCP_USAGE.removeprefix(SPANS + ",")}, {LOGS.removeprefix(SPANS + ",")}, {METRICS.removeprefix(SPANS + ",")}
    SELECT unnest(['otel_spans_dedup', 'otel_spans_as_allspans']) AS view_name, (SELECT count(*) FROM spans) AS n_rows
    UNION ALL SELECT 'v_gen_ai_spans', count(*) FROM g UNION ALL SELECT 'v_gen_ai_model_costs', count(*) FROM costs UNION ALL SELECT 'v_gen_ai_sessions', count(*) FROM sessions
    UNION ALL SELECT 'v_gen_ai_tool_usage', count(*) FROM tools UNION ALL SELECT 'v_mcp_spans', count(*) FROM m UNION ALL SELECT 'v_mcp_tool_usage', count(*) FROM mcp UNION ALL SELECT 'otel_logs_dedup', count(*) FROM logs
    UNION ALL SELECT 'otel_metrics_dedup', count(*) FROM points UNION ALL SELECT 'v_gen_ai_metrics', count(*) FROM points WHERE metric_name LIKE 'gen_ai.%'"""
QUERIES["o3_agent_paths"] = f"""SELECT agent_path, len(string_split(agent_path, ' > '))::INT AS agent_path_length, count(DISTINCT trace_id) AS traces, count(span_id) AS spans, sum(CASE WHEN is_token_leaf THEN gen_ai_usage_input_tokens END)::BIGINT AS leaf_input_tokens,
    sum(CASE WHEN is_token_leaf THEN gen_ai_usage_output_tokens END)::BIGINT AS leaf_output_tokens FROM ({_trajectory()}) WHERE agent_path <> '' GROUP BY 1, 2 ORDER BY traces DESC, agent_path LIMIT 50"""
QUERIES["o5_service_names"] = f"""WITH {COSTS}, {SESSIONS.removeprefix(GENAI + ",")}, {TOOLS.removeprefix(GENAI + ",")}, {MCP_USAGE.removeprefix(SPANS + ",")}
    SELECT coalesce(service_name, '(none)') AS service_name FROM costs WHERE {_DAYS.format("usage_hour")} UNION SELECT coalesce(service_name, '(none)') FROM tools WHERE {_DAYS.format("usage_hour")}
    UNION SELECT coalesce(service_name, '(none)') FROM mcp WHERE {_DAYS.format("usage_hour")} UNION SELECT coalesce(service_name, '(none)') FROM sessions WHERE {_DAYS.format("session_start_date")}"""
QUERIES["s1_odd_requests"] = """SELECT CAST(event_id AS VARCHAR) AS name, CASE c WHEN 2 THEN 'SERVER' WHEN 3 THEN NULL ELSE 'CLIENT' END AS kind_name, CASE WHEN c IN (1, 3) THEN 'MALFORMED' END AS error_code,
        CASE WHEN c <> 1 THEN event_id END AS n, 1::BIGINT AS lines FROM (SELECT event_id, event_id % 6 AS c FROM events) WHERE c < 4
    UNION ALL SELECT 'malformed lines', NULL, NULL, NULL, count(*) FROM events WHERE event_id % 6 >= 4"""
QUERIES["a1_daily_sketches"] = f"""WITH {COSTS} SELECT CAST(usage_hour AS DATE) AS usage_date, service_name, sum(call_count)::BIGINT AS call_count, sum(error_count)::BIGINT AS error_count, sum(total_input_tokens)::BIGINT AS total_input_tokens,
    sum(total_output_tokens)::BIGINT AS total_output_tokens, sum(typed_error_count)::BIGINT AS typed_error_count, TRUE AS in_order FROM costs GROUP BY 1, 2"""
