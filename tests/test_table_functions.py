"""Table functions, the trajectory view, and ancestor paths that double."""

import random

from pyspark.sql import functions as F

from spanlake import catalog
from spanlake.operators import dedup
from spanlake.plans import registry, table_functions, trajectory, tvf, views
from spanlake.sources import projection

from .test_trajectory import SCHEMA, T0, span


def rows(df):
    return sorted(str(r) for r in df.collect())


def test_table_functions_equal_the_bounded_forms(spark, sf_dir, tmp_path):
    tables = {"otel_spans": (projection.spans(spark, sf_dir), "start_hour", F.date_trunc("hour", "start_time")), "otel_logs": (projection.logs(spark, sf_dir), "log_date", F.to_date("timestamp")), "otel_metrics": (projection.metrics(spark, sf_dir), "metric_date", F.to_date("timestamp"))}
    for name, (df, part, by) in tables.items():
        df.withColumn(part, by).coalesce(1).write.partitionBy(part).parquet(f"{tmp_path}/{name}")
    registry.register(spark, {n: spark.read.parquet(f"{tmp_path}/{n}") for n in tables})
    s, logs = dedup.spans_dedup(spark.table("otel_spans")), dedup.logs_dedup(spark.table("otel_logs"))
    found = spark.sql("SELECT * FROM tvf_gen_ai_logs(TIMESTAMP'2024-01-01 12:00:00', TIMESTAMP'2024-01-02 12:00:00')")
    want = tvf.gen_ai_logs(logs, s, "2024-01-01 12:00:00", "2024-01-02 12:00:00")
    assert found.columns == want.columns and rows(found) == rows(want) and found.count() > 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert all(f"{p}#" in plan.split("PartitionFilters: ")[k + 1].split("]")[0] for k, p in enumerate(("log_date", "start_hour")))
    found = spark.sql(f"SELECT * FROM tvf_gen_ai_metric_exemplars(TIMESTAMP'{catalog.START}', TIMESTAMP'{catalog.END}')")
    points = views.gen_ai_metrics(dedup.metrics_dedup(spark.table("otel_metrics")))
    want = tvf.gen_ai_metric_exemplars(points, s, catalog.START, catalog.END)
    assert found.columns == want.columns and rows(found) == rows(want) and found.count() > 0


def test_trajectory_function(spark):
    g = forest(random.Random(2), 40)
    table = spark.createDataFrame(g, SCHEMA)
    table_functions.register(spark, table)
    found = spark.sql("SELECT * FROM tvf_gen_ai_agent_trajectory(TIMESTAMP'2024-08-12', TIMESTAMP'2024-08-13', TIMESTAMP'2024-08-12', TIMESTAMP'2024-08-14')")
    want = tvf.agent_trajectory(views.gen_ai_spans(table), "2024-08-12", "2024-08-13", "2024-08-12", "2024-08-14")
    assert found.columns == want.columns and rows(found) == rows(want) and 10 < want.count() < 40


def forest(rng, n):
    """Spans of chains, trees, cycles, own parents, orphans, and children far from their parents in time."""
    out = []
    for i in range(n):
        kind = rng.random()
        parent = None if kind < 0.1 else f"{i:03d}" if kind < 0.13 else "gone" if kind < 0.18 else f"{rng.randrange(n):03d}" if kind < 0.3 else f"{max(0, i - rng.choice((1, 1, 1, 2, 5))):03d}"
        tokens = tuple(rng.choice((None, None, rng.randrange(9))) for _ in range(3))
        out.append(span(f"{i:03d}", parent, rng.choice((0.0, 0.1, 0.5, 30.0)) + i / 1000, rng.choice(("chat", "invoke_agent", "execute_tool")), rng.choice((None, None, "a", "b")), tokens, rng.choice(("svc", "svc", None)), rng.choice("tu")))
    return out


def test_the_view_equals_the_staged_form(spark):
    g = views.gen_ai_spans(spark.createDataFrame(forest(random.Random(1), 60), SCHEMA))
    found = table_functions.trajectory_view(spark, g)
    want = trajectory.trajectory(g)
    assert found.columns == want.columns and rows(found) == rows(want) and want.count() > 30


def test_the_view_stays_current(spark, tmp_path):
    path = f"{tmp_path}/spans"

    def add(*spans):
        df = spark.createDataFrame(list(spans), SCHEMA).withColumns({"end_time_unix_nano": F.lit(1), "receive_time_unix_nano": F.lit(1)})
        df.coalesce(1).write.mode("append").parquet(path)

    add(span("a", op="invoke_agent", agent="x"))
    spark.read.parquet(path).createOrReplaceTempView("otel_spans")
    g = views.gen_ai_spans(dedup.spans_dedup(spark.table("otel_spans")))
    table_functions.trajectory_view(spark, g).createOrReplaceTempView("v_gen_ai_agent_trajectory")
    view = lambda: {r.span_id: (r.depth, r.step_index) for r in spark.table("v_gen_ai_agent_trajectory").collect()}
    assert view() == {"a": (0, 1)}
    add(span("b", "a", 0.1))
    registry.refresh(spark)
    assert view() == {"a": (0, 1), "b": (1, 2)}


def walked(parents, node, hops):
    path, at = [node], parents.get(node)
    while at in parents and at not in path and len(path) <= hops:
        path.append(at)
        at = parents[at]
    return path[1:]


def test_paths_double(spark, monkeypatch):
    rng = random.Random(4)
    parents = {f"{i}": f"{i - 1}" if i else None for i in range(70)}  # a long chain
    parents |= {f"c{i}": f"c{(i + 1) % 9}" for i in range(9)} | {f"d{i}": f"d{(i + 1) % 40}" for i in range(40)} | {"self": "self", "below": "self", "tail": "c3", "tail2": "tail", "two": "owt", "owt": "two", "lost": "gone"}
    parents |= {f"r{i}": f"r{rng.randrange(60)}" for i in range(60)}
    table = spark.createDataFrame([("t", None, k, v, T0) for k, v in parents.items()], "trace_id string, service_name string, span_id string, parent_span_id string, start_time timestamp")
    staged, written = trajectory.staged, []
    monkeypatch.setattr(trajectory, "staged", lambda df, tag: written.append(tag) or staged(df, tag))
    for hops in (32, 5):
        written.clear()
        found = {r.span_id: [x.span for x in r.path] for r in trajectory.ancestors(table, hops).collect()}
        assert found == {k: walked(parents, k, hops) for k in parents}
        assert written.count("hops") <= 6
