"""Marts whose runs are committed together: versioned folders, and one pointer that readers resolve.

A run writes the partitions that it changes into folders of its own; what was there before stays as it is. The
manifest of a version names the folder of each partition of each mart. It is written last, and counts once its write has
succeeded, so readers see all marts of one run or none. ``vacuum`` deletes folders that no kept version names.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.stage import delete, exists, hadoop_path, staged
from . import marts, views

MANIFEST = "mart string, part string, path string"
_PART = "__part"


def _versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of committed versions."""
    if not exists(spark, f"{root}/_versions"):
        return []
    p, system = hadoop_path(spark, f"{root}/_versions")
    names = [s.getPath().getName() for s in system.listStatus(p)]
    return sorted(int(n[1:]) for n in names if n[:1] == "v" and exists(spark, f"{root}/_versions/{n}/_SUCCESS"))


def manifest(spark: SparkSession, root: str, version: int | None = None) -> dict[tuple[str, str], str]:
    """The folder of each partition (its value as text) of each mart, of a version or the newest."""
    known = _versions(spark, root)
    if not known:
        return {}
    rows = spark.read.schema(MANIFEST).parquet(f"{root}/_versions/v{known[-1] if version is None else version}").collect()  # a row for each hour or day of a mart
    return {(r["mart"], r["part"]): r["path"] for r in rows}


def read(spark: SparkSession, root: str, mart: str, version: int | None = None) -> DataFrame:
    """A mart as of a version; the newest by default. A reader that keeps the DataFrame keeps its version."""
    return _table(spark, manifest(spark, root, version), mart)


def _table(spark: SparkSession, entries: dict[tuple[str, str], str], mart: str) -> DataFrame:
    paths = [p for (m, _), p in sorted(entries.items()) if m == mart]
    if not paths:
        raise LookupError(f"no version of {mart}")
    return spark.read.parquet(*paths)


class Run:
    """One run over several marts: ``replace`` as often as needed, then ``commit``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.entries = manifest(spark, root)
        known = _versions(spark, root)
        self.version = known[-1] + 1 if known else 0
        while exists(spark, f"{root}/_versions/v{self.version}") or exists(spark, f"{root}/_runs/{self.version}"):
            self.version += 1  # of a run that broke off

    def table(self, mart: str) -> DataFrame | None:
        """The mart as this run leaves it so far."""
        return _table(self.spark, self.entries, mart) if any(m == mart for m, _ in self.entries) else None

    def replace(self, mart: str, fresh: DataFrame, column: str, start: datetime) -> DataFrame | None:
        """Puts the partitions of ``fresh`` in the place of those from ``start`` on."""
        path = f"{self.root}/_runs/{self.version}/{mart}"
        day = dict(fresh.dtypes)[column] == "date"
        text = F.date_format(column, "yyyy-MM-dd" if day else "yyyy-MM-dd HH")
        fresh.withColumn(_PART, text).repartition(_PART).sortWithinPartitions(column).write.partitionBy(_PART).parquet(path)
        low = start.strftime("%Y-%m-%d" if day else "%Y-%m-%d %H")
        kept = {k: p for k, p in self.entries.items() if k[0] != mart or k[1] < low}
        p, system = hadoop_path(self.spark, path)
        names = [s.getPath().getName() for s in system.listStatus(p)]  # hours or days of the window
        kept |= {(mart, n.partition("=")[2]): f"{path}/{n}" for n in names if n.startswith(f"{_PART}=")}
        self.entries = kept
        return self.table(mart)

    def commit(self) -> int:
        rows = self.spark.createDataFrame([(m, part, p) for (m, part), p in sorted(self.entries.items())], MANIFEST)
        rows.coalesce(1).write.parquet(f"{self.root}/_versions/v{self.version}")
        return self.version


def refresh(gen_ai: DataFrame, mcp: DataFrame, root: str, run_ts: str | None = None) -> int:
    """One run over all marts, as of ``marts.refresh``; gives its version. A run that breaks off changes nothing for readers."""
    spark = gen_ai.sparkSession
    now, start = marts.run_window(spark, root, run_ts)
    day = datetime(start.year, start.month, start.day)
    run = Run(spark, root)
    since = marts._since
    spans = run.replace("stg_spans_dedup", since(gen_ai, "start_time", day).withColumn("start_date", F.to_date("start_time")), "start_date", day)
    if spans is not None:
        run.replace("m_gen_ai_model_costs_hourly", views.model_costs(since(spans, "start_time", start)), "usage_hour", start)
        run.replace("m_mcp_tool_usage_hourly", views.mcp_tool_usage(since(mcp, "start_time", start)), "usage_hour", start)
        run.replace("m_gen_ai_sessions_daily", views.sessions(since(spans, "start_time", day)), "session_start_date", day)
        fresh, first = marts.trajectory_rows(spans, run.table("m_gen_ai_agent_trajectory"), start)
        mart = run.replace("m_gen_ai_agent_trajectory", staged(fresh, "fresh"), "start_date", first)
        broken = marts.orphan_tokens(since(spans, "start_time", start), mart)
        if broken.head(1):
            raise ValueError(f"token counts of the trajectory mart are broken: {broken.head(5)}")
    version = run.commit()
    marts._book(spark, root, now, start, True)
    return version


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Deletes folders that none of the newest ``keep`` versions names; gives how many. For times when no run is under way."""
    known = _versions(spark, root)
    used = {p for v in known[-keep:] for p in manifest(spark, root, v).values()}
    gone = 0
    for v in known[:-keep]:
        for p in set(manifest(spark, root, v).values()) - used:
            delete(spark, p)
            gone += 1
        delete(spark, f"{root}/_versions/v{v}")
    return gone
