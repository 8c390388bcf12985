"""Incremental marts equal the views; alerts over a stream of files equal those of a batch."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from spanlake import catalog, schemas
from spanlake.functions.jsonx import bag, json_value, lax_float64, lax_int64
from spanlake.plans import dashboards, marts, trajectory, tvf, views
from spanlake.streaming import alerts


def test_runs_end_equal_to_the_views(spark, sf_dir, tmp_path):
    # no trace is longer than the context, a day before the second run's window
    recent = F.col("start_time") >= F.lit("2024-01-19").cast("timestamp")
    g, mcp, root = catalog.genai(spark, sf_dir).where(recent), views.mcp_spans(catalog.spans(spark, sf_dir)).where(recent), str(tmp_path)
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp")
    marts.refresh(g.where(F.col("start_time") < cut), mcp.where(F.col("start_time") < cut), root, "2024-01-20T00:00:00Z")
    out = marts.refresh(g, mcp, root, "2024-01-20T03:00:00Z")
    for name, view, keys in (
        ("m_gen_ai_model_costs_hourly", views.model_costs(g), "usage_hour"), ("m_mcp_tool_usage_hourly", views.mcp_tool_usage(mcp), "usage_hour"), ("m_gen_ai_sessions_daily", views.sessions(g), "session_start_date"),
        ("m_gen_ai_agent_trajectory", trajectory.trajectory(g).drop("status_message"), "start_time"),
    ):
        mart = out[name].withColumn(keys, F.col(keys).cast(dict(view.dtypes)[keys]))
        assert view.count() > 50 and marts.differs(view, mart).count() == 0, name
    assert marts.unhandled_cycles(g, out["m_gen_ai_agent_trajectory"]).count() == 0


def test_window_goes_back_to_a_run_that_broke_off(spark, tmp_path):
    root = str(tmp_path)
    assert marts.run_window(spark, root, "2024-01-10T05:30:00Z")[1] == marts.EPOCH
    assert marts.run_window(spark, root, "2024-01-10T09:10:00.5Z")[1] == marts.EPOCH
    marts._book(spark, root, datetime(2024, 1, 10, 9), datetime(2024, 1, 10, 6), True)
    assert marts.run_window(spark, root, "2024-01-10T12:45:00+00:00")[1] == datetime(2024, 1, 10, 9)
    assert marts.run_window(spark, root, "2024-01-11T12:45:00Z")[1] == datetime(2024, 1, 10, 9)
    with pytest.raises(ValueError):
        marts.run_window(spark, root, "10 January")


def test_second_run_of_the_query_rewrites_its_window_only(spark, sf_dir, monkeypatch):
    swap, starts, hours = marts.replace_partitions, [], []

    def noted(fresh, path, column, start):
        starts.append(start)
        hours.append(fresh.agg(F.min(column).cast("string")).first()[0])
        swap(fresh, path, column, start)

    monkeypatch.setattr(marts, "replace_partitions", noted)
    assert catalog.q16_model_costs_mart(spark, sf_dir).count() == views.model_costs(catalog.genai(spark, sf_dir)).count()
    assert starts == [marts.EPOCH, datetime(2024, 1, 10, 6)] and hours[0] < "2024-01-10 06:00:00" <= hours[1]


def test_stream_of_files(spark, sf_dir, tmp_path):
    s = catalog.spans(spark, sf_dir)
    spans, out = f"{tmp_path}/spans", f"{tmp_path}/alerts"
    s.repartition(3).write.parquet(spans)
    stream = spark.readStream.schema(schemas.table_schema("otel_spans")).option("maxFilesPerTrigger", 1).parquet(spans)
    alerts.start(alerts.tool_errors(stream), out, f"{tmp_path}/c1").awaitTermination()
    found = spark.read.parquet(out)
    assert marts.differs(alerts.tool_errors(s), found).count() == 0
    s.limit(20).write.mode("append").parquet(spans)
    alerts.start(alerts.tool_errors(stream), out, f"{tmp_path}/c1").awaitTermination()
    everything = spark.read.parquet(out)
    assert dashboards.alerts(everything, "20200101", "20300101").count() == alerts.tool_errors(s).count()
    # a window comes out once the watermark, ten minutes behind the last row, has passed its end
    s.coalesce(1).write.parquet(f"{spans}-w")
    stream = spark.readStream.schema(schemas.table_schema("otel_spans")).parquet(f"{spans}-w")
    alerts.start(alerts.tool_error_windows(stream, "5 days", 1), f"{out}-w", f"{tmp_path}/c2").awaitTermination()
    windows = spark.read.schema(schemas.table_schema("otel_alerts")).parquet(f"{out}-w")
    last = s.agg(F.max("receive_time")).first()[0]
    closed = alerts.tool_error_windows(s, "5 days", 1).where(F.col("event_time") <= F.lit(last).cast("timestamp") - F.expr("INTERVAL 10 MINUTES"))
    assert closed.count() > 20 and marts.differs(closed, windows).count() == 0
    assert alerts.messages(alerts.tool_errors(s)).where(F.get_json_object("value", "$.alert_id") == F.col("alert_id")).count() == alerts.tool_errors(s).count()


def test_readers_of_attributes(spark):
    texts = ['{"a.b":"5","c":1.5,"d":true,"e":{"x":1},"f":[1],"g":null,"h":"1e3","i":"x","j":"{}","k":9223372036854775807}', None, "not json"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(bag("t").alias("v"))
    v = F.col("v")
    r = df.select(*[json_value(v, k).alias(k.replace(".", "_")) for k in ("a.b", "c", "d", "e", "f", "g", "j")]).first()
    assert (r.a_b, r.c, r.d, r.e, r.f, r.g, r.j) == ("5", "1.5", "true", None, None, None, "{}")
    n = df.select(*[lax_int64(v, k).alias(k.replace(".", "_")) for k in ("a.b", "c", "d", "h", "i", "k")], lax_float64(v, "c").alias("real"), lax_float64(v, "i").alias("none")).first()
    assert (n.a_b, n.c, n.d, n.h, n.i, n.k, n.real, n.none) == (5, None, None, 1000, None, 9223372036854775807, 1.5, None)


def test_bounds(spark, sf_dir):
    with pytest.raises(ValueError):
        tvf.require_bounds(None, "2024-01-01")
    whole = trajectory.trajectory(catalog.genai(spark, sf_dir))
    parts = [tvf.agent_trajectory(catalog.genai(spark, sf_dir), a, b, "2023-01-01", "2025-01-01") for a, b in (("2023-12-01", "2024-01-10"), ("2024-01-10", "2024-03-01"))]
    assert marts.differs(whole, parts[0].unionByName(parts[1])).count() == 0


def test_schema_compatibility():
    want = schemas.table_schema("otel_alerts")
    have = type(want)([f for f in want.fields if f.name != "payload"])
    assert schemas.compatibility(want, want) == [] and schemas.compatibility(want, have) == ["missing column payload"]
    assert [f.name for f in schemas.additions(want, have)] == ["payload"] and schemas.additions(want, have)[0].nullable


def test_a_booking_that_breaks_off_loses_nothing(spark, tmp_path):
    root = f"{tmp_path}/marts"
    marts.run_window(spark, root, "2024-01-10T05:30:00Z")
    marts._book(spark, root, datetime(2024, 1, 10, 5, 30), marts.EPOCH, True)
    first = marts.run_window(spark, root, "2024-01-10T09:10:00Z")[1]
    # a write that ended before its commit leaves the folder of its attempt only
    (tmp_path / "marts/stg_run_window/_temporary/0").mkdir(parents=True)
    assert marts.run_window(spark, root, "2024-01-10T20:10:00Z")[1] == first == datetime(2024, 1, 10, 6)
    (tmp_path / "none/stg_run_window").mkdir(parents=True)
    assert marts.run_window(spark, f"{tmp_path}/none", "2024-01-10T20:10:00Z")[1] == marts.EPOCH
