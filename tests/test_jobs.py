"""Replay with a cursor, retry subsets, lookups by Bloom filter, view checks, marts committed together, sketches that merge."""

import json

import pytest
from pyspark.sql import functions as F

from spanlake import catalog
from spanlake.functions import anyvalue as av
from spanlake.operators import fingerprint, quality
from spanlake.plans import registry, sketches, versions, views
from spanlake.sources import otlp, projection
from spanlake.tools import backfill

from .test_otlp import NOW, kv, lines, span, trace_request


def test_replay_goes_on_behind_its_cursor(spark, tmp_path):
    root = f"{tmp_path}/tables"
    requests = [trace_request(span(spanId=f"{k + 1:016x}", attributes=[kv(f"k{i}", intValue=i) for i in range(3)])) for k in range(10)]
    rejected = quality.quarantine(backfill.transformed(lines(spark, *requests), "traces", av.Limits(attributes=1), receive_nano=NOW), "traces")
    # of three records the payload lies in the object table, of one it is lost
    ids = F.conv("span_id", 16, 10).cast("int")
    uri = F.concat(F.lit("store/"), "span_id")
    objects = rejected.where(ids <= 3).select(uri.alias("uri"), F.col("raw_payload").cast("binary").alias("content"))
    q = rejected.withColumns({"payload_ref": F.when(ids <= 4, uri), "raw_payload": F.when(ids > 4, F.col("raw_payload"))})
    q.coalesce(1).write.parquet(f"{tmp_path}/q")
    objects.coalesce(1).write.parquet(f"{tmp_path}/o")
    q, objects = spark.read.parquet(f"{tmp_path}/q"), spark.read.parquet(f"{tmp_path}/o")
    assert backfill.replay_job(q, root, "j", "traces", 4, 1, objects) == [(4, 4, 0)]
    assert spark.read.parquet(f"{root}/otel_spans").count() == 4
    assert backfill.replay_job(q, root, "j", "traces", 4, None, objects) == [(4, 4, 0), (1, 1, 0)]
    assert backfill.replay_job(q, root, "j", "traces", 4, None, objects) == []
    stored = spark.read.parquet(f"{root}/otel_spans")
    assert stored.count() == 9 and {int(r.span_id, 16) for r in stored.collect()} == {1, 2, 3, 5, 6, 7, 8, 9, 10}
    assert [r[0] for r in backfill.replay_job(q, root, "strict", "traces", limits=av.Limits(attributes=2), codes=["ATTRIBUTE_COUNT"])] == [6]


def test_retried_records_keep_their_fingerprints(spark):
    a, b, c = ({"body": {"stringValue": t}} for t in "abc")
    logs = lambda *scopes: json.dumps({"resourceLogs": [{"resource": {"attributes": [kv("service.name", stringValue="s")]}, "schemaUrl": "u", "scopeLogs": [{"scope": {"name": f"n{k}"}, "logRecords": list(r)} for k, r in enumerate(scopes)]}]})
    batch = lines(spark, logs([a, a, b, a, c], [a, b]), logs([a, b])).coalesce(1)
    rows = backfill.transformed(batch, "logs", receive_nano=NOW).cache()
    whole = {(r.batch, tuple(r.place)): r.record_fingerprint for r in rows.collect()}
    first = min(k for k, _ in whole)
    owed = {(first, (0, 0, 1)), (first, (0, 0, 4)), (first, (0, 1, 1))}  # the second a, c, and the other scope's b
    marked = rows.withColumns({"sent": F.lit(True), "retry": F.concat_ws("-", "batch", "place.i", "place.j", "place.k").isin([f"{k}-{i}-{j}-{n}" for k, (i, j, n) in owed])})
    subset = fingerprint.retry_subset(marked)
    assert {(r.batch, tuple(r.place)) for r in subset.collect()} == owed | {(first, (0, 0, 0)), (first, (0, 0, 3))}
    again = otlp.requests(subset, "logs")
    request = json.loads(again.first().value)
    assert again.count() == 1 and [[x["body"]["stringValue"] for x in s["logRecords"]] for s in request["resourceLogs"][0]["scopeLogs"]] == [["a", "a", "a", "c"], ["b"]]
    found = {r.record_fingerprint for r in backfill.transformed(again, "logs", receive_nano=NOW).collect()}
    assert found == {whole[k] for k in owed | {(first, (0, 0, 0)), (first, (0, 0, 3))}}
    assert fingerprint.retry_subset(marked.withColumn("retry", F.lit(False))).count() == 0
    everything = fingerprint.retry_subset(marked.withColumn("retry", F.lit(True)))
    assert sorted(json.loads(r.value)["resourceLogs"][0]["scopeLogs"][0]["scope"]["name"] for r in otlp.requests(everything, "logs").collect()) == ["n0", "n0"]


def test_a_lookup_skips_row_groups(spark, tmp_path):
    df = spark.range(0, 60_000, 1, 1).select(F.sha2(F.col("id").cast("string"), 256).substr(1, 32).alias("trace_id"), F.lit("x" * 50).alias("name"))
    wanted = df.first().trace_id
    read = {}
    for name, options in (("plain", {}), ("bloom", backfill.trace_lookup(df, 10_000))):
        df.write.options(**options).option("parquet.block.size", 150_000).option("parquet.enable.dictionary", "false").option("parquet.page.row.count.limit", 1_000).parquet(f"{tmp_path}/{name}")
        found = spark.read.parquet(f"{tmp_path}/{name}").where(F.col("trace_id") == wanted)
        rows = found._jdf.collectAsList().size()
        plan = found._jdf.queryExecution().executedPlan()
        leaves = plan.collectLeaves()
        read[name] = leaves.apply(0).metrics().apply("numOutputRows").value()
        assert rows == 1
    assert 0 < read["bloom"] <= read["plain"] / 3


def test_views_are_checked(spark, sf_dir, tmp_path):
    tables = {"otel_spans": (projection.spans(spark, sf_dir), "start_hour", F.date_trunc("hour", "start_time")), "otel_logs": (projection.logs(spark, sf_dir), "log_date", F.to_date("timestamp")), "otel_metrics": (projection.metrics(spark, sf_dir), "metric_date", F.to_date("timestamp"))}
    for name, (df, part, by) in tables.items():
        df.withColumn(part, by).limit(50).coalesce(1).write.partitionBy(part).parquet(f"{tmp_path}/{name}")
    made = registry.register(spark, {n: spark.read.parquet(f"{tmp_path}/{n}") for n in tables})
    found = {n: (level, why) for n, level, why in backfill.validate_views(spark, made)}
    assert set(found) == set(backfill.VIEW_TIMES) and "fail" not in {level for level, _ in found.values()}, found
    assert all(found[n][0] == "pass" for n in ("v_gen_ai_model_costs", "v_gen_ai_sessions", "v_gen_ai_tool_usage", "v_mcp_tool_usage"))
    assert found["v_gen_ai_spans"][0] == "warn" and found["v_gen_ai_agent_trajectory"] == ("warn", "it can't prune: read it by its table function")
    spark.table("v_gen_ai_spans").withColumn("start_time", F.col("start_time") + F.expr("INTERVAL 1 SECOND") * F.length("trace_id")).createOrReplaceTempView("v_gen_ai_spans")
    assert dict((n, level) for n, level, _ in backfill.validate_views(spark, ["v_gen_ai_spans"]))["v_gen_ai_spans"] == "fail"
    plain = spark.table("otel_spans").where(F.col("start_hour") >= F.lit("2024-01-01").cast("timestamp"))
    assert backfill.scans(plain)[0][0] and not any(backfill.scans(spark.table("otel_spans"))[0])


def test_marts_of_a_run_are_committed_together(spark, sf_dir, tmp_path, monkeypatch):
    root = f"{tmp_path}/marts"
    recent = F.col("start_time") >= F.lit("2024-01-19 12:00:00").cast("timestamp")
    g, mcp = (catalog.staged(df.where(recent), "recent") for df in (catalog.genai(spark, sf_dir), views.mcp_spans(catalog.spans(spark, sf_dir))))
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp")
    with pytest.raises(LookupError):
        versions.read(spark, root, "m_gen_ai_model_costs_hourly")
    assert versions.refresh(g.where(F.col("start_time") < cut), mcp.where(F.col("start_time") < cut), root, "2024-01-20T00:00:00Z") == 0
    names = ["m_gen_ai_model_costs_hourly", "m_gen_ai_sessions_daily"]
    before = {n: sorted(map(str, versions.read(spark, root, n).collect())) for n in names}

    def breaks(df):
        raise RuntimeError("broken off")

    with monkeypatch.context() as m:  # after the first mart, before the third
        m.setattr(views, "sessions", breaks)
        with pytest.raises(RuntimeError):
            versions.refresh(g, mcp, root, "2024-01-20T03:00:00Z")
    assert before == {n: sorted(map(str, versions.read(spark, root, n).collect())) for n in names}
    version = versions.refresh(g, mcp, root, "2024-01-20T03:30:00Z")
    assert version > 0
    costs = versions.read(spark, root, names[0])
    want = views.model_costs(g)
    assert sorted(map(str, costs.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert sorted(map(str, versions.read(spark, root, names[0], 0).collect())) == before[names[0]]
    assert versions.vacuum(spark, root, 1) > 0 and costs.count() == want.count()


def test_percentiles_of_a_day_from_its_hours(spark, sf_dir):
    g = catalog.genai(spark, sf_dir)
    day = F.to_date("usage_hour").alias("usage_date")
    found = {r.usage_date: r for r in sketches.merged(sketches.model_cost_sketches(g), [day]).collect()}
    calls = views.llm_calls(g).withColumn("usage_date", F.to_date("usage_hour"))
    exact = {r.usage_date: r for r in calls.groupBy("usage_date").agg(F.sort_array(F.collect_list("duration_ms")).alias("d"), F.count("*").alias("n"), F.count("error_type").alias("errors")).collect()}
    top = {}
    for r in calls.where("error_type IS NOT NULL").groupBy("usage_date", "error_type").count().collect():
        top.setdefault(r.usage_date, {})[r.error_type] = r["count"]
    assert set(found) == set(exact) and len(exact) > 10
    for k, r in found.items():
        d = exact[k].d
        assert r.call_count == exact[k].n and r.typed_error_count == exact[k].errors
        for q in (0.5, 0.95, 0.99):
            value = r[f"p{round(100 * q)}_duration_ms"]
            low, high = sum(x < value for x in d) / len(d), sum(x <= value for x in d) / len(d)
            assert low - 0.01 - 1 / len(d) <= q <= high + 0.01 + 1 / len(d)
        assert {x.value: x["count"] for x in r.top_error_types} == dict(sorted(top.get(k, {}).items(), key=lambda x: (-x[1], x[0]))[:5]) or len(top[k]) > 5
