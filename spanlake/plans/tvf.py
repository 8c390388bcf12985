"""Time-bounded forms of the views: static bounds on both sides of a join reach the scans."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import trajectory as trees
from . import views


def between(df: DataFrame, column: str, start: datetime | str, end: datetime | str, before: str = "0 HOURS", after: str = "0 HOURS") -> DataFrame:
    """Rows with ``start - before <= column < end + after``; also by the hour partition where there is one."""
    low = F.lit(start).cast("timestamp") - F.expr(f"INTERVAL {before}")
    high = F.lit(end).cast("timestamp") + F.expr(f"INTERVAL {after}")
    out = df.where((F.col(column) >= low) & (F.col(column) < high))
    if column == "start_time" and "start_hour" in df.columns:
        out = out.where((F.col("start_hour") >= F.date_trunc("hour", low)) & (F.col("start_hour") <= F.date_trunc("hour", high)))
    return out


def gen_ai_logs(logs: DataFrame, spans: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    """GenAI logs of [start, end) with spans from a day before to an hour after."""
    return views.gen_ai_logs(between(logs, "timestamp", start, end), between(spans, "start_time", start, end, "24 HOURS", "1 HOUR"))


def gen_ai_metric_exemplars(points: DataFrame, spans: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    """Exemplars of GenAI points of [start, end), with the same bounds on spans."""
    near = between(spans, "start_time", start, end, "24 HOURS", "1 HOUR")
    return views.metric_exemplars(between(points, "timestamp", start, end), near)


def agent_trajectory(g: DataFrame, start: datetime | str, end: datetime | str, context_start: datetime | str, context_end: datetime | str) -> DataFrame:
    """Trajectory rows of [start, end), from trees over the spans of the context; steps are counted in the context."""
    return between(trees.trajectory(between(g, "start_time", context_start, context_end)), "start_time", start, end)


def require_bounds(start: object, end: object) -> None:
    """Raises where a view that can't prune is read without bounds."""
    if start is None or end is None:
        raise ValueError("this table is read by time range: give start and end")
