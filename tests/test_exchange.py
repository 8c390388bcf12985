"""Large values put away, quarantine files, replayed envelopes, alerts once, counters, views by name."""

import base64
import hashlib
import json

from pyspark.sql import functions as F

from spanlake.functions.anyvalue import Redaction
from spanlake.operators import offload, quality
from spanlake.plans import dashboards, registry
from spanlake.sources import projection
from spanlake.streaming import alerts
from spanlake.tools import backfill, exchange, telemetry

from .test_otlp import NOW, kv, lines, span, trace_request

STORE = offload.Store("s", 10, 20)


def test_walk_order_bounds_and_first_key():
    big = lambda c: c * 12
    record = {
        "attributes": [
            kv("z", stringValue=big("z")), kv("a", arrayValue={"values": [{"stringValue": "short"}, {"kvlistValue": {"values": [kv("k", bytesValue=base64.b64encode(b"q" * 10).decode())]}}]}),
            kv("z", stringValue=big("y")), kv("n", stringValue="n" * 21), kv("e"),
        ],
        "events": [{"attributes": [kv("e", stringValue=big("e"))]}], "links": [{}, {"attributes": [kv("l", stringValue="é" * 5)]}],
    }
    scope = {"attributes": [kv("s", stringValue=big("s"))]}
    texts, found = offload.without_large([None, json.dumps(scope), json.dumps(record)], STORE, "s/traces/d")
    assert [f["path"] for f in found] == ["instrumentation_scope.attributes.s", "attributes.a[1].k", "attributes.z", "events[0].attributes.e", "links[1].attributes.l"]
    assert found[1]["content"] == b"q" * 10 and found[1]["mime"] == offload.BYTES_TYPE
    assert all(f["sha256"] == hashlib.sha256(f["content"]).hexdigest() and f["uri"] == f"s/traces/d/{f['sha256']}" for f in found)
    light = json.loads(texts[2])
    assert light["attributes"][0]["value"] == {"stringValue": f"<offloaded:{found[2]['uri']}>"} and light["attributes"][3]["value"]["stringValue"] == "n" * 21
    assert texts[0] is None
    assert offload.without_large([None, None, "{}"], offload.Store("s"), "x") == ([None, None, "{}"], [])


def test_masked_before_put_away(spark):
    s = span(attributes=[kv("token", stringValue="t" * 15), kv("note", stringValue="w" * 9 + "1234567"), kv("kept", stringValue="k" * 15)])
    rows = backfill.transformed(lines(spark, trace_request(s)), "traces", redaction=Redaction(patterns=("[0-9]+",)), receive_nano=NOW, store=offload.Store("s", 12, 20))
    row = rows.collect()[0]
    assert row.reason is None and json.loads(row.attributes)["token"].startswith("[REDACTED]") and [bytes(p.content) for p in row.payloads if p.path == "attributes.kept"] == [b"k" * 15]
    assert not any(b"t" * 15 in bytes(p.content) or b"1234567" in bytes(p.content) for p in row.payloads)
    assert [r.attribute_path for r in row.payload_refs] == [p.path for p in row.payloads]
    assert "payloads" not in quality.accepted(rows).columns


def test_backfill_with_a_store(spark, tmp_path):
    path, root = str(tmp_path / "in"), str(tmp_path / "out")
    s = span(attributes=[kv("big", stringValue="b" * 15)])
    lines(spark, trace_request(s), trace_request(s | {"spanId": "00000000000000aa"})).write.text(path)
    backfill.backfill(spark, path, root, ("traces",), store=STORE).collect()
    assert spark.read.parquet(f"{root}/otel_payloads").select("content").collect() == [(b"b" * 15,)]
    assert spark.read.parquet(f"{root}/otel_spans").where(F.size("payload_refs") == 1).count() == 2


def test_quarantine_files_of_both_forms(spark, tmp_path):
    one, two = {"ingest_time": "2024-01-01T00:00:00.5Z", "signal": "logs", "raw_payload": "[1"}, {"ingest_time": 1704067200, "signal": "traces", "span_id": "é"}
    (tmp_path / "a.json").write_text("\n  " + json.dumps([one, two], indent=1))
    (tmp_path / "b.json").write_text(json.dumps(one | {"ingest_time": 1704067200000001}) + "\n\n" + json.dumps(two | {"ingest_time": None}) + "\n")
    (tmp_path / "c.json").write_text("")
    rows = exchange.quarantine_files(spark, str(tmp_path)).withColumn("t", F.unix_micros("ingest_time")).collect()
    assert sorted((r.t or 0, r.signal) for r in rows) == [(0, "traces"), (1704067200000000, "traces"), (1704067200000001, "logs"), (1704067200500000, "logs")]


def test_replay_as_lines(spark, tmp_path):
    rows = backfill.transformed(lines(spark, trace_request(span(spanId=""), span())), "traces", receive_nano=NOW)
    exchange.write_replay(quality.quarantine(rows, "traces"), "traces", str(tmp_path / "r"))
    found = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "r")).collect()]
    assert len(found) == 1 and found[0]["signal"] == "spans" and found[0]["otlp"]["resourceSpans"][0]["scopeSpans"][0]["spans"][0]["name"] == "n"


def test_counters(spark):
    text = "x" * 15
    seen_lines = lines(spark, trace_request(span(spanId=""), span(attributes=[kv("a", stringValue=text)])))
    rows, seen = telemetry.observed(backfill.transformed(seen_lines, "traces", receive_nano=NOW, store=STORE), "traces")
    rows.write.format("noop").mode("overwrite").save()
    got = seen.get
    assert (got["rows"], got["acknowledged_rows"], got["rejected_rows"], got["rejected_rows.INVALID_SPAN_ID"]) == (2, 1, 1, 1)
    assert (got["offloaded_payloads"], got["offloaded_bytes"]) == (1, 15)


def test_alerts_once_in_a_stream(spark, tmp_path):
    schema = "alert_id string, event_time timestamp"
    spark.sql("SELECT explode(array('a', 'b', 'a')) AS alert_id, TIMESTAMP '2001-01-01' AS event_time").write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
    for again in range(2):
        q = alerts.once(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination()
        # what came before comes again, and a late alert with it
        spark.sql("SELECT explode(array('a', 'c')) AS alert_id, TIMESTAMP '1999-01-01' AS event_time").write.mode("append").json(str(tmp_path / "in"))
    assert sorted(r.alert_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]


def test_views_by_name(spark, sf_dir):
    made = registry.register(spark, {"otel_spans": projection.spans(spark, sf_dir)}, need_bounds=True)
    assert made[:3] == ["otel_spans_dedup", "otel_spans_as_allspans", "v_gen_ai_spans"] and "v_gen_ai_agent_trajectory" not in made and "v_gen_ai_logs" not in made
    assert spark.sql("SELECT count(*) AS n FROM v_mcp_tool_usage").collect()[0].n > 0


def test_charts_and_service_names(spark):
    a = spark.sql("SELECT * FROM VALUES ('TOOL_ERROR', 'x', '1'), ('TOOL_ERROR', 'x', '1'), ('TOOL_ERROR', 'y', '2'), ('TOOL_ERROR', 'z', '3'), ('TOOL_ERROR', 'z', '4'), ('OTHER', 'o', '5') AS t(alert_kind, error_type, alert_id)")
    assert [tuple(r) for r in dashboards.error_types(a, 2).collect()] == [("z", 2), ("x", 1)]
    h = spark.sql("SELECT explode(array('a', NULL, 'it''s', 'b`', 'c\\\\\\\\d', 'a')) AS service_name, TIMESTAMP '2024-01-05 10:00:00' AS usage_hour")
    s = spark.sql("SELECT explode(array('a', 'z')) AS service_name, DATE '2024-01-06' AS session_start_date")
    assert sorted(r.service_name for r in dashboards.service_names([h], s, "20240105", "20240111").collect()) == ["(none)", "a", "z"]
