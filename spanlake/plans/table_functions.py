"""Table functions and the trajectory view for SQL users.

``tvf_gen_ai_logs(start, end)``, ``tvf_gen_ai_metric_exemplars(start, end)`` and
``tvf_gen_ai_agent_trajectory(start, end, context_start, context_end)`` are SQL functions of the session: their bounds
are constants in the plan, so they reach the scans on both sides of the joins, and the hour and day partitions.

The trajectory view is a recursive query over the spans. It shows the spans of the moment in which it is read. Spark runs a
recursion again for each place that names it, so for large ranges ``trajectory.trajectory``, whose levels are written once,
takes less.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import trajectory as trees
from . import views
from .trajectory import CARRIED, FAMILIES, MAX_DEPTH, MAX_HOPS

_KEYS = ["trace_id", "service_name", "span_id"]


def _same(a: str, b: str, span: str = "span_id", of: str = "span_id") -> str:
    return f"{a}.trace_id = {b}.trace_id AND {a}.service_name <=> {b}.service_name AND {a}.{span} = {b}.{of}"


def _columns(of: str, names: list[str]) -> str:
    return ", ".join(f"{of}.{n}" for n in names)


def trajectory_query(source: str) -> str:
    """The rows of all trees over the spans of ``source``, a query over ``gen_ai_declared_spans``."""
    starts, resolved = "({0}.agent_op OR {0}.declared IS NOT NULL)", "coalesce({0}.declared, {0}.gen_ai_agent_name)"
    opens = "(c.agent_op OR (t.nearest_agent_span_id IS NULL AND c.declared IS NOT NULL))"
    fresh = "(c.path_name IS NOT NULL AND (size(t.agent_path) = 0 OR try_element_at(t.agent_path, -1) <> c.path_name))"
    flags = ", ".join(f"c.{c} IS NOT NULL AS has_{f}" for f, c in FAMILIES.items())
    has = [f"has_{f}" for f in FAMILIES]
    own = {f: f"(s.{c} IS NOT NULL AND NOT coalesce(v.has_{f}, FALSE))" for f, c in FAMILIES.items()}
    tokens = {c: f"CASE WHEN coalesce(v.has_{f}, FALSE) AND ({' OR '.join(own[x] for x in FAMILIES if x != f)}) THEN NULL ELSE s.{c} END AS {c}" for f, c in FAMILIES.items()}
    placed = ["depth", "root_span_id", "nearest_agent_span_id", "nearest_agent_name", "agent_path", "is_orphan"]
    return f"""
WITH RECURSIVE ranked AS (
    SELECT *, row_number() OVER (PARTITION BY trace_id, service_name, span_id ORDER BY start_time, end_time DESC, span_name, duration_nano DESC) AS pick FROM ({source})
), spans AS (SELECT * FROM ranked WHERE pick = 1
), tree AS (
    SELECT {_columns("s", _KEYS)}, s.start_time, 0 AS depth, s.span_id AS root_span_id, CASE WHEN {starts.format("s")} THEN s.span_id END AS nearest_agent_span_id,
           CASE WHEN {starts.format("s")} THEN {resolved.format("s")} END AS nearest_agent_name, filter(array(s.path_name), x -> x IS NOT NULL) AS agent_path,
           coalesce(s.parent_span_id, '') <> '' AS is_orphan, array(s.span_id) AS visited
    FROM spans s LEFT JOIN spans p ON {_same("p", "s", "span_id", "parent_span_id")} AND s.start_time BETWEEN p.start_time - INTERVAL 1 HOUR AND p.start_time + INTERVAL 24 HOURS
    WHERE coalesce(s.parent_span_id, '') = '' OR p.span_id IS NULL
    UNION ALL
    SELECT {_columns("c", _KEYS)}, c.start_time, t.depth + 1, t.root_span_id, CASE WHEN {opens} THEN c.span_id ELSE t.nearest_agent_span_id END,
           CASE WHEN {opens} THEN {resolved.format("c")} ELSE t.nearest_agent_name END, CASE WHEN {fresh} THEN concat(t.agent_path, array(c.path_name)) ELSE t.agent_path END,
           t.is_orphan, concat(t.visited, array(c.span_id))
    FROM tree t JOIN spans c ON {_same("t", "c", "span_id", "parent_span_id")} AND c.start_time BETWEEN t.start_time - INTERVAL 1 HOUR AND t.start_time + INTERVAL 24 HOURS
    WHERE t.depth < {MAX_DEPTH} AND NOT array_contains(t.visited, c.span_id)
), emitted AS (SELECT trace_id, service_name, span_id FROM tree
), above AS (
    SELECT {_columns("c", _KEYS)}, c.start_time, {flags}, p.span_id AS p_span, p.parent_span_id AS p_parent, p.start_time AS p_start, 1 AS hop, array(c.span_id, p.span_id) AS path
    FROM spans c JOIN spans p ON {_same("p", "c", "span_id", "parent_span_id")} WHERE p.span_id <> c.span_id
    UNION ALL
    SELECT {_columns("a", _KEYS)}, a.start_time, {_columns("a", has)}, p.span_id, p.parent_span_id, p.start_time, a.hop + 1, concat(a.path, array(p.span_id))
    FROM above a JOIN spans p ON {_same("p", "a", "span_id", "p_parent")} WHERE a.hop < {MAX_HOPS} AND NOT array_contains(a.path, p.span_id)
), stopped AS (
    -- a walk ends before the first span that is in no tree; what starts outside of the trees is no walk
    SELECT a.*, min(CASE WHEN e.span_id IS NULL THEN a.hop END) OVER (PARTITION BY a.trace_id, a.service_name, a.span_id) AS stop
    FROM above a LEFT SEMI JOIN emitted d ON {_same("d", "a")} LEFT JOIN emitted e ON {_same("e", "a", "span_id", "p_span")}
), walks AS (SELECT * FROM stopped WHERE stop IS NULL OR hop < stop
), cover AS (
    SELECT a.trace_id, a.service_name, a.p_span AS span_id, {", ".join(f"bool_or(a.{h}) AS {h}" for h in has)}
    FROM (SELECT *, count(*) OVER w AS pairs FROM (
              SELECT *, least(span_id, p_span) AS one, greatest(span_id, p_span) AS other FROM walks) WINDOW w AS (PARTITION BY trace_id, service_name, one, other)) a
    WHERE ({" OR ".join(f"a.{h}" for h in has)}) AND (a.pairs = 1 OR a.start_time > a.p_start OR (a.start_time = a.p_start AND a.span_id > a.p_span))
    GROUP BY a.trace_id, a.service_name, a.p_span
), parents AS (SELECT DISTINCT trace_id, service_name, parent_span_id FROM spans WHERE coalesce(parent_span_id, '') <> '')
SELECT {", ".join(tokens.get(c, f"s.{c}") for c in CARRIED)}, {_columns("t", placed)},
       row_number() OVER (PARTITION BY s.trace_id, s.service_name ORDER BY s.start_time, s.span_id) AS step_index, l.parent_span_id IS NULL AS is_leaf, ({" OR ".join(own.values())}) AS is_token_leaf
FROM tree t JOIN spans s ON {_same("s", "t")} LEFT JOIN cover v ON {_same("v", "s")} LEFT JOIN parents l ON {_same("l", "s", "parent_span_id")}
"""


def _within(column: str, low: str, high: str, closed: bool, hour: str | None, date: str | None = None) -> str:
    """Rows of a time range, also by the partition where there is one."""
    found = f"{column} >= {low} AND {column} {'<=' if closed else '<'} {high}"
    if hour:
        found += f" AND {hour} >= date_trunc('HOUR', {low}) AND {hour} <= date_trunc('HOUR', {high})"
    return found + (f" AND {date} >= to_date({low}) AND {date} <= to_date({high})" if date else "")


def _part(df: DataFrame, name: str) -> str | None:
    return name if name in df.columns else None


def allow_recursion(spark: SparkSession) -> None:
    """A level of a tree may have any number of rows."""
    spark.conf.set("spark.sql.cteRecursionRowLimit", "-1")


def trajectory_view(spark: SparkSession, gen_ai_spans: DataFrame) -> DataFrame:
    """The trajectory of the spans as they are when it is read."""
    allow_recursion(spark)
    trees.declared_spans(gen_ai_spans).createOrReplaceTempView("gen_ai_declared_spans")
    return spark.sql(trajectory_query("SELECT * FROM gen_ai_declared_spans"))


def _create(spark: SparkSession, name: str, arguments: list[str], df: DataFrame, body: str) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({', '.join(f'{a} TIMESTAMP' for a in arguments)}) RETURNS TABLE ({columns}) RETURN {body}")


def register(spark: SparkSession, spans: DataFrame, logs: DataFrame | None = None, gen_ai_metrics: DataFrame | None = None) -> list[str]:
    """Makes the table functions over deduplicated spans, logs and points; gives their names."""
    allow_recursion(spark)
    made = ["tvf_gen_ai_agent_trajectory"]
    g = views.gen_ai_spans(spans)
    hour = _part(spans, "start_hour")
    trees.declared_spans(g).createOrReplaceTempView("gen_ai_declared_spans")
    source = f"SELECT * FROM gen_ai_declared_spans WHERE {_within('start_time', 'context_start', 'context_end', False, None)}"
    shape = spark.sql(trajectory_query("SELECT * FROM gen_ai_declared_spans"))
    _create(spark, made[0], ["start_ts", "end_ts", "context_start", "context_end"], shape, f"SELECT * FROM ({trajectory_query(source)}) WHERE start_time >= start_ts AND start_time < end_ts")
    low, high = "start_ts - INTERVAL 24 HOURS", "end_ts + INTERVAL 1 HOUR"
    if logs is not None:
        views.log_facts(logs).createOrReplaceTempView("gen_ai_log_facts")
        views.span_facts(spans).createOrReplaceTempView("gen_ai_span_facts")
        columns = [*(f"l.{c}" for c in views._LOG_FIRST), *(f"coalesce(l.own_{c}, s.span_{c}) AS {c}" for c in views._LOG_CHAINS), *(f"l.{c}" for c in views._LOG_LAST)]
        body = f"""SELECT {", ".join(columns)}
            FROM (SELECT * FROM gen_ai_log_facts WHERE {_within("timestamp", "start_ts", "end_ts", False, None, _part(logs, "log_date"))}) l
            LEFT JOIN (SELECT * FROM gen_ai_span_facts WHERE {_within("start_time", low, high, True, hour)}) s
            ON l.trace_id = s.trace_id AND l.span_id = s.span_id AND l.service_name <=> s.service_name AND s.start_time BETWEEN l.timestamp - INTERVAL 24 HOURS AND l.timestamp + INTERVAL 1 HOUR"""
        _create(spark, "tvf_gen_ai_logs", ["start_ts", "end_ts"], views.gen_ai_logs(logs, spans), body)
        made.append("tvf_gen_ai_logs")
    if gen_ai_metrics is not None:
        views.exemplar_facts(gen_ai_metrics).createOrReplaceTempView("gen_ai_exemplar_facts")
        views.exemplar_span_facts(spans).createOrReplaceTempView("gen_ai_exemplar_span_facts")
        columns = ", ".join(f"{c} AS {n}" for c, n in views.EXEMPLAR_COLUMNS)
        rank = f"row_number() OVER (PARTITION BY {', '.join(f'm.{k}' for k in views.EXEMPLAR_KEYS)} ORDER BY s.span_end_time DESC, s.span_start_time DESC, s.receive_time DESC, s.span_name) AS pick"
        names = ", ".join(n for _, n in views.EXEMPLAR_COLUMNS)
        body = f"""SELECT {names} FROM (SELECT {columns}, {rank}
            FROM (SELECT * FROM gen_ai_exemplar_facts WHERE {_within("timestamp", "start_ts", "end_ts", False, None, _part(gen_ai_metrics, "metric_date"))}) m
            LEFT JOIN (SELECT * FROM gen_ai_exemplar_span_facts WHERE {_within("span_start_time", low, high, True, hour)}) s
            ON s.trace_id = m.ex.trace_id AND s.span_id = m.ex.span_id AND s.service_name <=> m.service_name AND s.span_start_time BETWEEN m.timestamp - INTERVAL 24 HOURS AND m.timestamp + INTERVAL 1 HOUR) WHERE pick = 1"""
        _create(spark, "tvf_gen_ai_metric_exemplars", ["start_ts", "end_ts"], views.metric_exemplars(gen_ai_metrics, spans), body)
        made.append("tvf_gen_ai_metric_exemplars")
    return made
