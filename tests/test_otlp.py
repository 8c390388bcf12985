"""Export requests into rows: encoding, contract, limits, redaction, quarantine and replay."""

import json

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanlake import schemas
from spanlake.functions import anyvalue as av
from spanlake.operators import dedup, quality
from spanlake.plans import views
from spanlake.sources import otlp
from spanlake.tools import backfill

NOW = 1_800_000_000_000_000_000


def kv(key, **value):
    return {"key": key, "value": value}


def trace_request(*spans, service="svc"):
    return json.dumps({"resourceSpans": [{"resource": {"attributes": [kv("service.name", stringValue=service)]}, "scopeSpans": [{"scope": {"name": "s"}, "spans": list(spans)}]}]})


def span(**more):
    return {"traceId": "4BF92F3577B34DA6A3CE929D0E0E4736", "spanId": "00f067aa0ba902b7", "name": "n", "kind": 3, "startTimeUnixNano": "1723420800000000123", "endTimeUnixNano": "1723420801000000000"} | more


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_values_and_types():
    raw = json.dumps([kv("b", intValue="9007199254740993"), kv("a.b", doubleValue=1.5), kv("a", arrayValue={"values": [{"boolValue": True}, {}]}), kv("m", kvlistValue={"values": [kv("z", stringValue="1"), kv("z", stringValue="2"), kv("y", bytesValue="AQ==")]}), kv("n", doubleValue="NaN"), kv("b", stringValue="later")])
    e = av.encode_bag(raw)
    assert e["plain"] == '{"a":[true,null],"a.b":1.5,"b":"9007199254740993","m":{"y":"AQ==","z":"1"},"n":"NaN"}'
    assert e["types"] == '{"a":["bool","empty"],"a.b":"double","b":"int64","m":{"y":"bytes","z":"string"},"n":"double"}'
    assert av.encode_bag(None)["plain"] == "{}" and av.encode_value("{}")["types"] == '"empty"'


@pytest.mark.parametrize(("x", "text"), [(0.0, "0"), (-0.0, "-0"), (1e21, "1e+21"), (1e20, "100000000000000000000"), (1e-6, "0.000001"), (1e-7, "1e-7"), (123.456, "123.456"), (-2.5e-9, "-2.5e-9")])
def test_number_text(x, text):
    assert av.number_text(x) == text


@given(st.floats(allow_nan=False, allow_infinity=False))
def test_numbers_read_back(x):
    assert float(av.number_text(x)) == x


@pytest.mark.parametrize(
    ("bag", "limits", "reason"),
    [
        ([kv("a", intValue=1), kv("b", intValue=1)], {"attributes": 1}, "attribute_count"), ([kv("abc", intValue=1)], {"key_bytes": 2}, "attribute_key_size"), ([kv("a", stringValue="éé")], {"value_bytes": 3}, "value_size"),
        ([kv("a", arrayValue={"values": [{}, {}]})], {"collection": 1}, "collection_size"), ([kv("a", arrayValue={"values": [{"arrayValue": {"values": [{}]}}]})], {"depth": 2}, "nesting_depth"),
    ],
)
def test_limits(bag, limits, reason):
    assert av.encode_bag(json.dumps(bag), limits=av.Limits(**limits))["reason"] == reason
    assert av.encode_bag(json.dumps(bag))["reason"] is None


def test_redaction():
    bag = [kv(" Authorization ", kvlistValue={"values": []}), kv("my_api_key", intValue=1), kv("tokens", stringValue="card 1234"), kv("m", kvlistValue={"values": [kv("password", stringValue="x"), kv("k", arrayValue={"values": [{"stringValue": "5678"}]})]}), kv("n", intValue=1234)]
    e = av.encode_bag(json.dumps(bag), redaction=av.Redaction(patterns=(r"\d{4}",), mask="$1"))
    assert json.loads(e["plain"]) == {" Authorization ": "$1", "my_api_key": "$1", "tokens": "card $1", "m": {"password": "$1", "k": ["$1"]}, "n": "1234"}


def test_spans(spark):
    request = trace_request(span(parentSpanId="0000000000000000", attributes=[kv("gen_ai.operation.name", stringValue="chat")], events=[{"timeUnixNano": "0", "name": "e", "attributes": [kv("x", intValue=1)]}], status={"code": 2, "message": "bad"}, endTimeUnixNano="1723420799000000000"))
    r = otlp.spans(lines(spark, request), receive_nano=NOW).first()
    assert (r.trace_id, r.parent_span_id, r.service_name, r.kind_name, r.status.code_name) == ("4bf92f3577b34da6a3ce929d0e0e4736", None, "svc", "CLIENT", "ERROR")
    assert r.start_time_unix_nano == 1723420800000000123 and r.duration_nano == 0 and r.reason is None
    assert r.events[0].time is None and r.events[0].time_unix_nano == 0 and r.events[0].attributes == '{"x":"1"}'


def test_contract_and_quarantine(spark):
    bad = {
        "INVALID_TRACE_ID": {"traceId": "0" * 32}, "INVALID_SPAN_ID": {"spanId": ""}, "MISSING_START_TIME": {"startTimeUnixNano": "0"}, "MISSING_END_TIME": {"endTimeUnixNano": None},
        "TIMESTAMP_OVERFLOW": {"endTimeUnixNano": "18446744073709551615"}, "ATTRIBUTE_COUNT": {"attributes": [kv(f"k{i}", intValue=i) for i in range(1025)]}, "EVENT_COUNT": {"events": [{"name": "e"}] * 1025},
    }
    rows = backfill.transformed(lines(spark, trace_request(span(), *[span(**b) for b in bad.values()])), "traces", receive_nano=NOW).cache()
    assert quality.accepted(rows).count() == 1 and rows.count() == 1 + len(bad)
    q = quality.quarantine(rows, "traces")
    assert q.columns == schemas.table_schema("otel_quarantine").names
    assert sorted(r.error_code for r in q.collect()) == sorted(bad)
    again = backfill.replay(q, "traces", av.Limits(attributes=2000), codes=["ATTRIBUTE_COUNT", "EVENT_COUNT"])
    assert sorted(str(r.reason) for r in again.collect()) == ["None", "event_count"]
    assert quality.accepted(backfill.transformed(lines(spark, trace_request(span())), "traces", max_row_bytes=100)).count() == 0


def test_logs_and_fingerprints(spark):
    record = {"body": {"stringValue": "hi"}, "attributes": [kv("event.name", stringValue="gen_ai.user.message"), kv("log.iostream", intValue=3)]}
    request = json.dumps({"resourceLogs": [{"resource": {"attributes": []}, "scopeLogs": [{"logRecords": [record, record, {"observedTimeUnixNano": "1723420800000000000", "timeUnixNano": "18446744073709551615"}]}]}]})
    rows = backfill.transformed(lines(spark, request, request), "logs", receive_nano=NOW)
    good = quality.accepted(rows).collect()
    assert len(good) == 4 and {r.timestamp_source for r in good} == {"receive"} and {r.log_name for r in good} == {"default"}
    assert {r.event_name for r in good} == {"gen_ai.user.message"} and all(r.insert_id == r.record_fingerprint for r in good)
    # equal records of a request are told apart, a request that is sent again isn't
    assert len({r.record_fingerprint for r in good}) == 2
    assert dedup.logs_dedup(quality.accepted(rows)).count() == 2


def test_metrics(spark):
    point = {"timeUnixNano": "1723420800000000000", "attributes": [kv("gen_ai.token.type", stringValue="input")]}
    metrics = [
        {"name": "g", "gauge": {"dataPoints": [point | {"asInt": "3"}, point | {"asDouble": 1.5, "flags": 1}]}}, {"name": "gen_ai.client.token.usage", "histogram": {"aggregationTemporality": 1, "dataPoints": [point | {"count": "2", "sum": 30, "bucketCounts": ["1", "1"], "explicitBounds": [10], "exemplars": [{"asInt": "7", "traceId": "ab", "spanId": "00"}]}]}},
        {"name": "e", "exponentialHistogram": {"dataPoints": [point | {"count": 1, "scale": 2, "positive": {"offset": 1, "bucketCounts": ["1"]}, "negative": {}}]}}, {"name": "s", "summary": {"dataPoints": [point | {"count": 1, "sum": 2.0, "quantileValues": [{"quantile": 0.5, "value": 2.0}]}]}},
        {"name": "", "sum": {"isMonotonic": True, "dataPoints": [point]}},
    ]
    request = json.dumps({"resource_metrics": [{"resource": {"attributes": []}, "scope_metrics": [{"scope": {}, "metrics": metrics}]}]})
    rows = backfill.transformed(lines(spark, request), "metrics", receive_nano=NOW)
    found = {(r.metric_name, r.value_type): r for r in rows.collect()}
    assert found["g", "INT64"].value_int64 == 3 and found["g", None].value_double is None
    h = found["gen_ai.client.token.usage", None]
    assert (h.metric_type, h.aggregation_temporality, h["count"], h.sum, list(h.bucket_counts)) == ("HISTOGRAM", "DELTA", 2, 30.0, [1, 1]) and h.exemplars[0].trace_id == "ab" and h.exemplars[0].span_id is None
    assert found["e", None].exp_positive.bucket_counts == [1] and found["e", None].exp_negative is None and found["s", None].summary_quantiles[0].value == 2.0
    assert found["", None].reason == "invalid_id" and len({r.point_fingerprint for r in found.values()}) == 6
    assert views.gen_ai_metrics(quality.accepted(rows)).count() == 1


def test_rejected_points_replay(spark):
    """A point that broke a limit comes back by replay: value, kind, addresses; straight from the plan that rejected it."""
    point = {"timeUnixNano": "1723420800000000000", "attributes": [kv("a", stringValue="1"), kv("b", stringValue="2")]}
    metrics = [
        {"name": "g", "unit": "s", "gauge": {"dataPoints": [point | {"asInt": "3"}, point | {"asDouble": 1.5}]}}, {"name": "c", "description": 'of "c"', "sum": {"isMonotonic": True, "aggregationTemporality": 2, "dataPoints": [point | {"asInt": "4"}]}},
        {"name": "h", "metadata": [kv("m", intValue="1")], "histogram": {"aggregationTemporality": 1, "dataPoints": [point | {"count": "2", "sum": 30, "bucketCounts": ["1", "1"], "explicitBounds": [10]}]}},
    ]
    request = json.dumps({"resourceMetrics": [{"resource": {"attributes": [kv("service.name", stringValue="svc")]}, "schemaUrl": "urn:r", "scopeMetrics": [{"scope": {"name": "x"}, "schemaUrl": "urn:s", "metrics": metrics}]}]})
    whole = {(r.metric_name, r.value_int64, r.value_double): r for r in backfill.transformed(lines(spark, request), "metrics", receive_nano=NOW).collect()}
    q = quality.quarantine(backfill.transformed(lines(spark, request), "metrics", av.Limits(attributes=1), receive_nano=NOW), "metrics")
    again = backfill.replay(q, "metrics").collect()
    assert len(again) == 4 and all(r.reason is None for r in again)
    for r in again:
        w = whole[r.metric_name, r.value_int64, r.value_double]
        for c in ("metric_type", "metric_unit", "metric_description", "metadata", "aggregation_temporality", "is_monotonic", "sum", "count", "bucket_counts", "explicit_bounds", "attributes", "service_name", "instrumentation_scope", "resource_schema_url", "scope_schema_url", "timestamp"):
            assert r[c] == w[c], (r.metric_name, c)


def test_texts_are_cut_between_characters(spark):
    texts = ["abc", "aé", "字字", "a\U0001f600b", "end\ufffd", ""]
    df = spark.createDataFrame([(t, n) for t in texts for n in range(8)], "t string, n int")
    for n in range(8):
        for r in df.where(F.col("n") == n).select("t", quality.truncated(F.col("t"), n).alias("cut")).collect():
            assert r.cut == r.t.encode()[:n].decode("utf-8", "ignore")


def test_ranges_of_replay_hold_both_ends(spark):
    row = {"signal": "traces", "raw_payload": "{}", "error_code": "X", "error_message": "m", "service_name": None, "trace_id": None, "span_id": None}
    q = spark.createDataFrame([tuple(row.values())], "signal string, raw_payload string, error_code string, error_message string, service_name string, trace_id string, span_id string").withColumn("ingest_time", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    assert quality.replayable(q, "traces", start="2024-01-01 00:00:00", end="2024-01-01 00:00:00").count() == 1


def test_backfill_keeps_every_record(spark, tmp_path):
    archive, root = f"{tmp_path}/in", f"{tmp_path}/out"
    requests = backfill.workload(spark, 50).unionByName(lines(spark, "", "not json", '{"other": 1}', trace_request(span(spanId=""))))
    requests.write.option("compression", "gzip").text(archive)
    report = {r.signal: (r.records, r.stored, r.rejected) for r in backfill.backfill(spark, archive, root, receive_nano=NOW).collect()}
    assert report == {"traces": (201, 200, 1), "logs": (0, 0, 0), "metrics": (0, 0, 0), "malformed": (2, 0, 2)}
    stored = spark.read.parquet(f"{root}/otel_spans")
    costs = views.model_costs(views.gen_ai_spans(dedup.spans_dedup(stored.unionByName(stored))))
    assert costs.agg(F.sum("call_count")).first()[0] == 100
    assert backfill.validate({"otel_spans": stored}) [0] == ("otel_spans", "pass", "")
    hour = dedup.spans_dedup(stored).where(F.col("start_hour") == F.lit("2023-11-14 22:00:00").cast("timestamp"))
    assert "start_hour" in hour._jdf.queryExecution().executedPlan().toString().split("PartitionFilters:")[1].split("]")[0]


def test_resume_rewinds_a_changed_group(spark):
    names = "signal string, error_code string, error_message string, service_name string, trace_id string, span_id string, raw_payload string, ingest_time string"
    row = lambda k, t: ("traces", "X", "m", None, None, None, f"{{{k}}}", f"2024-01-01 00:00:0{t}")
    def table(rows):
        return quality.canonical(spark.createDataFrame(rows, names).withColumn("ingest_time", F.col("ingest_time").cast("timestamp")))
    rows = [row(1, 0), row(2, 1), row(2, 1), row(2, 1), row(3, 1), row(4, 2)]
    scan = table(rows)
    every = scan.orderBy("ingest_time", "row_fp", "row_ord").collect()
    assert sorted(r.row_ord for r in every if "{2}" in r.row_key) == [0, 1, 2] and len({(r.row_fp, r.row_ord, r.ingest_time) for r in every}) == 6
    for i, r in enumerate(every):
        again = backfill.resume(scan, r).orderBy("ingest_time", "row_fp", "row_ord").collect()
        assert [tuple(x) for x in again] == [tuple(x) for x in every[i + 1 :]]
    middle = next(r for r in every if "{2}" in r.row_key and r.row_ord == 1)
    # one more row in another group changes nothing; one in the cursor's group brings its microsecond back
    assert backfill.resume(table([*rows, row(9, 1)]), middle).where(F.col("ingest_time") == F.lit(middle.ingest_time)).count() in (1, 2, 3)
    changed = backfill.resume(table([*rows, row(2, 1)]), middle)
    assert changed.count() == 6 and {r.raw_payload for r in changed.collect()} == {"{2}", "{3}", "{4}"}
    assert backfill.resume(table(rows[:1] + rows[4:]), middle).count() == 2
