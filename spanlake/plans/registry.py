"""The views by name, for SQL users, each after those that it reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import dedup
from . import table_functions, views

Read = Callable[[str], DataFrame]

#: Name, table that it rests on, and how it is made. A view stands behind those that it reads.
VIEWS: list[tuple[str, str, Callable[[Read], DataFrame]]] = [
    ("otel_spans_dedup", "otel_spans", lambda t: dedup.spans_dedup(t("otel_spans"))),
    ("otel_spans_as_allspans", "otel_spans", lambda t: views.all_spans(t("otel_spans_dedup"))),
    ("v_gen_ai_spans", "otel_spans", lambda t: views.gen_ai_spans(t("otel_spans_dedup"))),
    ("v_gen_ai_model_costs", "otel_spans", lambda t: views.model_costs(views.gen_ai_spans(t("otel_spans_dedup"), partition=True))),
    ("v_gen_ai_sessions", "otel_spans", lambda t: views.sessions(views.gen_ai_spans(t("otel_spans_dedup"), partition=True))),
    ("v_gen_ai_tool_usage", "otel_spans", lambda t: views.tool_usage(views.gen_ai_spans(t("otel_spans_dedup"), partition=True))),
    ("v_gen_ai_agent_trajectory", "otel_spans", lambda t: table_functions.trajectory_view(t("v_gen_ai_spans").sparkSession, t("v_gen_ai_spans"))),
    ("v_mcp_spans", "otel_spans", lambda t: views.mcp_spans(t("otel_spans_dedup"))),
    ("v_mcp_tool_usage", "otel_spans", lambda t: views.mcp_tool_usage(views.mcp_spans(t("otel_spans_dedup"), partition=True))),
    ("otel_logs_dedup", "otel_logs", lambda t: dedup.logs_dedup(t("otel_logs"))),
    ("v_gen_ai_logs", "otel_logs", lambda t: views.gen_ai_logs(t("otel_logs_dedup"), t("otel_spans_dedup"))),
    ("otel_metrics_dedup", "otel_metrics", lambda t: dedup.metrics_dedup(t("otel_metrics"))),
    ("v_gen_ai_metrics", "otel_metrics", lambda t: views.gen_ai_metrics(t("otel_metrics_dedup"))),
    ("v_gen_ai_metric_exemplars", "otel_metrics", lambda t: views.metric_exemplars(t("v_gen_ai_metrics"), t("otel_spans_dedup"))),
]

#: Views that a filter on time doesn't reach: their tables are read whole unless bounds are given (see ``tvf``).
UNPRUNABLE = ["v_gen_ai_agent_trajectory", "v_gen_ai_logs", "v_gen_ai_metric_exemplars"]


def register(spark: SparkSession, tables: dict[str, DataFrame], need_bounds: bool = False) -> list[str]:
    """Makes temporary views of the tables and of all views on them; gives the views' names in the order they were made.

    Views on a table that isn't given are left out. With ``need_bounds`` (tables that may only be
    read by time range) so are those that can't prune; the table functions (``table_functions``) take their place.
    Every view shows its tables as they are when it is read."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    known, made = set(tables), []
    for name, table, make in VIEWS:
        if table not in known or (need_bounds and name in UNPRUNABLE):
            continue
        if name in ("v_gen_ai_logs", "v_gen_ai_metric_exemplars") and "otel_spans" not in known:
            continue
        make(spark.table).createOrReplaceTempView(name)
        made.append(name)
    if "otel_spans" in known:
        logs = spark.table("otel_logs_dedup") if "otel_logs" in known else None
        points = spark.table("v_gen_ai_metrics") if "otel_metrics" in known else None
        table_functions.register(spark, spark.table("otel_spans_dedup"), logs, points)
    return made


def refresh(spark: SparkSession) -> None:
    """Lets the views see files that others have added to the tables since they were registered; rows that this session
    writes to catalog tables are seen anyway."""
    names = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    for table in {t for _, t, _ in VIEWS} & names:
        spark.catalog.refreshTable(table)
