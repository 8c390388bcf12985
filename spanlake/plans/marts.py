"""Incremental marts: each run computes anew what lies in its window and swaps those partitions.

The window's start is fixed once for a run. It goes back three hours to the full hour, and further
if the run before didn't end: until a run is committed, the next one covers its window again. So a
run that breaks off between two tables is repaired by the next. ``versions`` commits all marts of a run at once.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..operators.stage import exists as _exists
from ..operators.stage import spread, staged
from . import trajectory as trees
from . import views

LOOKBACK, CONTEXT = timedelta(hours=3), timedelta(hours=24)
EPOCH = datetime(1970, 1, 1)
_ISO = re.compile(r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|\+00:00)")


def run_window(spark: SparkSession, root: str, run_ts: str | None = None) -> tuple[datetime, datetime]:
    """(run time, window start) of a new run, booked as not committed. ``run_ts`` is an ISO time in UTC."""
    if run_ts and not _ISO.fullmatch(run_ts):
        raise ValueError(f"not an ISO 8601 time in UTC: {run_ts}")
    now = datetime.fromisoformat(run_ts.replace("Z", "+00:00")) if run_ts else datetime.now(timezone.utc)
    now = now.astimezone(timezone.utc).replace(tzinfo=None)
    start = (now - LOOKBACK).replace(minute=0, second=0, microsecond=0)
    last = _last_run(spark, root)
    start = EPOCH if last is None else start if last["is_committed"] else min(start, last["window_start"])
    _book(spark, root, now, start, False)
    return now, start


RUNS = "seq bigint, run_ts timestamp_ntz, window_start timestamp_ntz, is_committed boolean"


def _last_run(spark: SparkSession, root: str) -> Row | None:
    """The newest booking. Bookings are only ever appended, so one that breaks off loses nothing."""
    path = f"{root}/stg_run_window"
    return spark.read.schema(RUNS).parquet(path).orderBy(F.desc("seq")).first() if _exists(spark, path) else None


def _book(spark: SparkSession, root: str, now: datetime, start: datetime, done: bool) -> None:
    last = _last_run(spark, root)
    row = spark.createDataFrame([(last["seq"] + 1 if last else 0, now, start, done)], RUNS)
    row.coalesce(1).write.mode("append").parquet(f"{root}/stg_run_window")


def replace_partitions(fresh: DataFrame, path: str, column: str, start: datetime) -> None:
    """Swaps the partitions from ``start`` on for those of ``fresh``; partitions that have no rows any more go."""
    spark = fresh.sparkSession
    fresh = staged(fresh, "fresh")
    stale = []
    if _exists(spark, path):
        low = F.lit(start).cast("timestamp")
        old = spark.read.parquet(path).where(F.col(column) >= (F.to_date(low) if dict(fresh.dtypes)[column] == "date" else low)).select(column).distinct()
        gone = old.join(fresh.select(column).distinct(), column, "left_anti")
        stale = [r[0] for r in gone.select(F.col(column).cast("string")).collect()]  # hours or days of one window
    fresh.repartition(column).sortWithinPartitions(column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    for value in stale:
        p = spark._jvm.org.apache.hadoop.fs.Path(path, f"{column}={value.replace(':', '%3A')}")
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _since(df: DataFrame, column: str, start: datetime) -> DataFrame:
    return df.where(F.col(column) >= F.lit(start).cast("timestamp"))


def staging(gen_ai: DataFrame, root: str, start: datetime) -> DataFrame:
    """Deduplicated GenAI spans by day; the days of the window are written anew."""
    day = datetime(start.year, start.month, start.day)
    replace_partitions(_since(gen_ai, "start_time", day).withColumn("start_date", F.to_date("start_time")), f"{root}/stg_spans_dedup", "start_date", day)
    return gen_ai.sparkSession.read.parquet(f"{root}/stg_spans_dedup")


def trajectory_rows(spans: DataFrame, old: DataFrame | None, start: datetime) -> tuple[DataFrame, datetime]:
    """The mart's rows from the given day on: every trace touched in the window is computed anew from its spans since a day before."""
    near = _since(spans, "start_time", start - CONTEXT) if start > EPOCH else spans
    touched = staged(_since(spans, "start_time", start).select(F.col("trace_id").alias("t_trace"), F.col("service_name").alias("t_service")).distinct(), "touched")
    same = (F.col("trace_id") == F.col("t_trace")) & F.col("service_name").eqNullSafe(F.col("t_service"))
    fresh = trees.trajectory(near.join(spread(touched), same, "left_semi")).drop("status_message").withColumn("start_date", F.to_date("start_time"))
    first = start - CONTEXT if start > EPOCH else start
    day = datetime(first.year, first.month, first.day)
    if old is not None:
        untouched = old.join(spread(touched), same, "left_anti").where(F.col("start_date") >= F.lit(day).cast("date"))
        before = old.join(spread(touched), same, "left_semi").where((F.col("start_date") >= F.lit(day).cast("date")) & (F.col("start_time") < F.lit(first).cast("timestamp")))
        fresh = fresh.unionByName(untouched).unionByName(before)
    return fresh, day


def trajectory_mart(spans: DataFrame, root: str, start: datetime) -> DataFrame:
    """Every trace touched in the window is computed anew from its spans since a day before."""
    spark, path = spans.sparkSession, f"{root}/m_gen_ai_agent_trajectory"
    fresh, day = trajectory_rows(spans, spark.read.parquet(path) if _exists(spark, path) else None, start)
    replace_partitions(fresh, path, "start_date", day)
    return spark.read.parquet(path)


def refresh(gen_ai: DataFrame, mcp: DataFrame, root: str, run_ts: str | None = None) -> dict[str, DataFrame]:
    """One run over deduplicated GenAI and protocol spans; gives the marts as tables. Raises if an assertion finds rows."""
    spark = gen_ai.sparkSession
    now, start = run_window(spark, root, run_ts)
    day = datetime(start.year, start.month, start.day)
    spans = staging(gen_ai, root, start)
    replace_partitions(views.model_costs(_since(spans, "start_time", start)), f"{root}/m_gen_ai_model_costs_hourly", "usage_hour", start)
    replace_partitions(views.mcp_tool_usage(_since(mcp, "start_time", start)), f"{root}/m_mcp_tool_usage_hourly", "usage_hour", start)
    # a session's row covers its whole day
    replace_partitions(views.sessions(_since(spans, "start_time", day)), f"{root}/m_gen_ai_sessions_daily", "session_start_date", day)
    mart = trajectory_mart(spans, root, start)
    broken = orphan_tokens(_since(spans, "start_time", start), mart)
    if broken.head(1):
        raise ValueError(f"token counts of the trajectory mart are broken: {broken.head(5)}")
    _book(spark, root, now, start, True)
    return {n: spark.read.parquet(f"{root}/{n}") for n in ("m_gen_ai_model_costs_hourly", "m_mcp_tool_usage_hourly", "m_gen_ai_sessions_daily", "m_gen_ai_agent_trajectory", "stg_spans_dedup")}


def unhandled_cycles(spans: DataFrame, mart: DataFrame) -> DataFrame:
    """Staged spans that are missing from the trajectory mart, or in it more than once."""
    keys = ["trace_id", "service_name", "span_id"]
    emitted = mart.groupBy(*[F.col(k).alias(f"e_{k}") for k in keys]).agg(F.count("*").alias("emitted_rows"))
    same = (F.col("trace_id") == F.col("e_trace_id")) & F.col("service_name").eqNullSafe(F.col("e_service_name")) & (F.col("span_id") == F.col("e_span_id"))
    j = spans.select(*keys).distinct().join(spread(emitted), same, "left").where("emitted_rows IS NULL OR emitted_rows <> 1")
    kind = F.when(F.col("emitted_rows").isNull(), "span_missing_from_trajectory").otherwise("span_in_trajectory_more_than_once")
    return j.select(*keys, F.coalesce("emitted_rows", F.lit(0)).alias("emitted_rows"), kind.alias("violation"))


def orphan_tokens(spans: DataFrame, mart: DataFrame) -> DataFrame:
    """Rows that break a rule of token counting: see the names in ``violation``.

    Reported counts of the spans are compared with those the mart projects; which families
    descendants cover is worked out anew from the emitted rows.
    """
    keys = ["trace_id", "service_name", "span_id"]
    raw = trees.canonical(spans).select(*[F.col(k).alias(f"r_{k}") for k in keys], *[F.col(c).alias(f"raw_{f}") for f, c in trees.FAMILIES.items()])
    same = (F.col("trace_id") == F.col("r_trace_id")) & F.col("service_name").eqNullSafe(F.col("r_service_name")) & (F.col("span_id") == F.col("r_span_id"))
    rows = mart.join(spread(raw), same).select(*keys, "parent_span_id", "start_time", "is_token_leaf", *[F.col(c).alias(f"own_{f}") for f, c in trees.FAMILIES.items()], *[f"raw_{f}" for f in trees.FAMILIES])
    reported = rows.select("*", *[F.col(f"raw_{f}").alias(c) for f, c in trees.FAMILIES.items()])
    cover = trees.covered(reported).select(*[F.col(k).alias(f"c_{k}") for k in keys], *[f"has_{f}" for f in trees.FAMILIES])
    hit = (F.col("trace_id") == F.col("c_trace_id")) & F.col("service_name").eqNullSafe(F.col("c_service_name")) & (F.col("span_id") == F.col("c_span_id"))
    j = rows.join(spread(cover), hit, "left")
    any_of = lambda make: F.greatest(*[make(f).cast("int") for f in trees.FAMILIES]) == 1
    done = {f: F.coalesce(f"has_{f}", F.lit(False)) for f in trees.FAMILIES}
    leaf, own, given = F.col("is_token_leaf"), lambda f: F.col(f"own_{f}"), lambda f: F.col(f"raw_{f}")
    open_family = any_of(lambda f: given(f).isNotNull() & ~done[f])
    kinds = {
        "projected_token_differs_from_raw": any_of(lambda f: own(f).isNotNull() & ~own(f).eqNullSafe(given(f))),
        "rollup_token_changed": (~leaf & (open_family | any_of(lambda f: ~own(f).eqNullSafe(given(f))))) | (leaf & any_of(lambda f: own(f).isNull() & given(f).isNotNull() & ~done[f])),
        "token_leaf_without_tokens": leaf & ~any_of(lambda f: own(f).isNotNull()),
        "token_double_counted_with_child": leaf & (~open_family | any_of(lambda f: own(f).isNotNull() & done[f])),
    }
    names = F.filter(F.array(*[F.when(c, n) for n, c in kinds.items()]), lambda n: n.isNotNull())
    emitted = j.select(*keys, F.explode(names).alias("violation"))
    tokens = raw.where(" OR ".join(f"raw_{f} IS NOT NULL" for f in trees.FAMILIES))
    missing = tokens.join(spread(mart.select(*keys)), same, "left_anti").select(*[F.col(f"r_{k}").alias(k) for k in keys], F.lit("span_missing_from_trajectory").alias("violation"))
    return emitted.unionByName(missing)


def differs(view: DataFrame, mart: DataFrame) -> DataFrame:
    """Rows that only one of the two has, told apart by ``side``."""
    m = mart.select(*view.columns)
    return view.subtract(m).withColumn("side", F.lit("view")).unionByName(m.subtract(view).withColumn("side", F.lit("mart")))
