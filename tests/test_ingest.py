"""Archives and streams with odd records: nothing stops a job, nothing is lost, nothing comes twice."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from spanlake.functions import anyvalue as av
from spanlake.operators import quality
from spanlake.operators.offload import Store, without_large
from spanlake.sources import archive, otlp
from spanlake.streaming import ingest
from spanlake.tools import backfill

from .test_otlp import NOW, kv, lines, span, trace_request

ODD_BAGS = {
    "a bad int": [kv("a", intValue="x")], "an int too large": [kv("a", intValue=str(1 << 63))], "a real int": [kv("a", intValue=1.5)], "a true int": [kv("a", intValue=True)],
    "a bad double": [kv("a", doubleValue="abc")], "a huge double": [kv("a", doubleValue="1" * 400)], "a number as text": [kv("a", stringValue=5)], "no list": {"a": 1}, "a text": "text", "a number": 7,
    "texts in the list": ["a"], "a key that is none": [{"key": 5}], "bytes": [kv("a", bytesValue="$$$")], "half of bytes": [kv("a", bytesValue="QQ")], "a list of lists": [kv("a", arrayValue=[1])],
    "values that are none": [kv("a", arrayValue={"values": {}})], "members that are none": [kv("a", kvlistValue={"values": [1]})], "a truth": [kv("a", boolValue="yes")], "a value that is none": [{"key": "a", "value": 5}],
}


@pytest.mark.parametrize("redaction", [None, av.Redaction(patterns=("x",), log_body=True)])
def test_odd_bags_are_malformed(redaction):
    for name, bag in ODD_BAGS.items():
        found = av.encode_bag(json.dumps(bag) if not isinstance(bag, str) else bag, redaction=redaction)
        if name == "a huge double":
            continue
        assert (found["reason"], found["path"]) == ("malformed", "attributes"), name
    deep = '{"arrayValue":{"values":[' * 5_000 + "{}" + "]}}" * 5_000
    assert av.encode_value(deep, redaction=redaction)["reason"] in ("malformed", "nesting_depth")
    assert av.encode_bag(json.dumps([kv("a", intValue=None), kv("b", stringValue=None), kv("c", arrayValue=None), {"key": "d"}]), redaction=redaction)["plain"] == '{"a":"0","b":"","c":[],"d":null}'


def test_one_odd_record_stops_nothing(spark, tmp_path):
    good = span(attributes=[kv("k", stringValue="v")])
    odd = [span(attributes=b) for n, b in ODD_BAGS.items() if n != "a huge double"] + [
        span(kind={"a": 1}), span(kind="no such kind"), span(flags="many"), span(events={"a": 1}), span(events=[7]), span(events=[{"attributes": [kv("a", intValue="x")]}]), span(links=[{"attributes": "x"}]), span(status=7),
        span(status={"code": "x"}), span(droppedAttributesCount="x"), 5, "text", [1],
    ]
    broken_resource = json.dumps({"resourceSpans": [{"resource": "none", "scopeSpans": [{"spans": [good]}]}, {"scopeSpans": [{"scope": 4, "spans": [good]}]}]})
    requests = [trace_request(good, *odd, good), broken_resource, '{"resourceSpans":5}', '{"resourceSpans":[{"scopeSpans":{"a":1}}]}', trace_request(good) + " x", trace_request(good) + "{}", "[]", '{"resourceSpans":null}']
    for store in (None, Store(f"{tmp_path}/p", 1, 100)):
        rows = backfill.transformed(otlp.with_signal(lines(spark, *requests)), "traces", receive_nano=NOW, store=store).select("reason", "field_path", "record").collect()
        assert len(rows) == len(odd) + 4 and sum(r.reason is None for r in rows) == 2
        assert {r.reason for r in rows} == {None, "malformed"} and all(r.field_path for r in rows if r.reason)
    assert otlp.malformed(lines(spark, *requests)).count() == 5
    report = {r.signal: (r.records, r.stored, r.rejected) for r in backfill_of(spark, tmp_path, requests)}
    assert report == {"traces": (len(odd) + 4, 2, len(odd) + 2), "logs": (0, 0, 0), "metrics": (0, 0, 0), "malformed": (5, 0, 5)}
    assert spark.read.parquet(f"{tmp_path}/out/otel_quarantine").where("error_code = 'MALFORMED'").count() == len(odd) + 2


def backfill_of(spark, tmp_path, requests, name="in.json", **options):
    with open(f"{tmp_path}/{name}", "w") as f:
        f.write("\n".join(requests))
    return backfill.backfill(spark, f"{tmp_path}/{name}", f"{tmp_path}/out", receive_nano=NOW, **options).collect()


def test_odd_logs_and_points(spark):
    records = [{"body": {"intValue": "x"}}, {"body": 5}, {"body": {"stringValue": "fine"}}, {"severityNumber": "loud"}, {"severityNumber": "SEVERITY_NUMBER_WARN2"}, {"attributes": 3}]
    request = json.dumps({"resourceLogs": [{"scopeLogs": [{"logRecords": records}]}]})
    found = backfill.transformed(lines(spark, request), "logs", receive_nano=NOW).select("reason", "severity_number", "body").collect()
    assert sorted(str(r.reason) for r in found) == ["None", "None"] + ["malformed"] * 4 and {r.severity_number for r in found if not r.reason} == {0, 14}
    point = {"timeUnixNano": "1723420800000000000"}
    bad = [{"asDouble": "x"}, {"asInt": "1.5"}, {"count": "few"}, {"bucketCounts": ["a"]}, {"bucketCounts": "a"}, {"scale": "x"}, {"positive": {"offset": "x", "bucketCounts": ["1"]}}, {"exemplars": 3}, {"exemplars": [{"filteredAttributes": "x"}]}, {"quantileValues": 1}]
    metric = {"name": "m", "histogram": {"aggregationTemporality": "AGGREGATION_TEMPORALITY_CUMULATIVE", "dataPoints": [point | {"asInt": "3"}, *[point | b for b in bad], 5]}}
    other = {"name": "n", "sum": {"aggregationTemporality": "SOMETIMES", "dataPoints": [point]}}
    request = json.dumps({"resourceMetrics": [{"scopeMetrics": [{"metrics": [metric, other, "none"]}]}]})
    found = backfill.transformed(lines(spark, request), "metrics", receive_nano=NOW).select("reason", "aggregation_temporality", "metric_name").collect()
    assert [r.reason for r in found].count(None) == 1 and len(found) == len(bad) + 3 and {r.aggregation_temporality for r in found if not r.reason} == {"CUMULATIVE"}


def snake(value):
    if isinstance(value, list):
        return [snake(v) for v in value]
    return {otlp._snake(k): snake(v) for k, v in value.items()} if isinstance(value, dict) else value


def test_snake_case_and_names_of_enumerations(spark):
    tricky = 'quotes "trace_id": and "stringValue": stay, "a_b" : too'
    full = span(
        kind="SPAN_KIND_PRODUCER", status={"code": "STATUS_CODE_ERROR"}, traceState="s", flags=1, droppedAttributesCount=2, parentSpanId="00f067aa0ba902b8", droppedEventsCount="3", droppedLinksCount=4,
        attributes=[kv("string_value", stringValue=tricky), kv("b", boolValue=True), kv("i", intValue="7"), kv("d", doubleValue=1.5), kv("y", bytesValue="AQ=="), kv("m", kvlistValue={"values": [kv("z", arrayValue={"values": [{"stringValue": "1"}]})]})],
        events=[{"timeUnixNano": "5", "name": "e", "attributes": [kv("x", intValue=1)], "droppedAttributesCount": 1}], links=[{"traceId": "ab", "spanId": "cd", "traceState": "t"}],
    )
    camel = {"resourceSpans": [{"resource": {"attributes": [kv("service.name", stringValue="svc")]}, "schemaUrl": "u", "scopeSpans": [{"scope": {"name": "s"}, "schemaUrl": "v", "spans": [full]}]}]}
    for indent in (None, 1):
        texts = [json.dumps(x, indent=indent).replace("\n", " ") for x in (camel, snake(camel))]
        a, b = otlp.spans(lines(spark, *texts), receive_nano=NOW).drop("batch", "record", "resource_text", "scope_text").collect()
        assert a == b and a.reason is None and a.kind == 4 and a.kind_name == "PRODUCER" and a.status.code_name == "ERROR"
        assert json.loads(a.attributes)["string_value"] == tricky and a.resource_schema_url == "u" and a.events[0].time_unix_nano == 5
    point = {"timeUnixNano": "1723420800000000000", "asDouble": 1.5, "exemplars": [{"timeUnixNano": "1", "asInt": "7", "filteredAttributes": [kv("a", intValue=1)]}]}
    shape = {"timeUnixNano": "1723420800000000000", "count": "1", "bucketCounts": ["1"], "explicitBounds": [1.0], "zeroCount": "2"}
    metrics = [{"name": "g", "gauge": {"dataPoints": [point]}}, {"name": "h", "exponentialHistogram": {"aggregationTemporality": 2, "dataPoints": [shape]}}, {"name": "q", "summary": {"dataPoints": [shape | {"quantileValues": [{"quantile": 0.5, "value": 1.0}]}]}}]
    camel = {"resourceMetrics": [{"scopeMetrics": [{"metrics": metrics}]}]}
    rows = backfill.transformed(lines(spark, json.dumps(camel), json.dumps(snake(camel))), "metrics", receive_nano=NOW)
    assert rows.count() == 6 and rows.select("point_fingerprint").distinct().count() == 3 and rows.where("reason IS NOT NULL").count() == 0
    logs = {"resourceLogs": [{"scopeLogs": [{"logRecords": [{"observedTimeUnixNano": "9", "severityNumber": "SEVERITY_NUMBER_FATAL4", "severityText": "x", "eventName": "e", "body": {"stringValue": "b"}}]}]}]}
    rows = backfill.transformed(lines(spark, json.dumps(logs), json.dumps(snake(logs))), "logs", receive_nano=NOW)
    assert rows.select("record_fingerprint").distinct().count() == 1 and {r.severity_number for r in rows.collect()} == {24}


def test_identity_does_not_depend_on_the_store(spark):
    """The same masked, large record with and without a store, on two days, under two prefixes."""
    large = "secret text " * 50
    record = {"body": {"stringValue": large}, "attributes": [kv("event.name", stringValue="e" * 400), kv("log.record.uid", stringValue="u" * 400), kv("log.iostream", stringValue="n" * 400), kv("nested", kvlistValue={"values": [kv("password", stringValue="p" * 400)]})]}
    request = json.dumps({"resourceLogs": [{"resource": {"attributes": [kv("service.name", stringValue="s" * 400)]}, "scopeLogs": [{"logRecords": [record, record | {"body": {"stringValue": "small"}}]}]}]})
    rules = av.Redaction(patterns=("secret",), log_body=True)
    found = []
    for store, day in ((None, 0), (Store("a", 300, 10_000), 0), (Store("b/c", 300, 10_000), 1), (Store("a", 5_000, 10_000), 0)):
        rows = backfill.transformed(lines(spark, request), "logs", redaction=rules, receive_nano=NOW + day * 86_400_000_000_000, store=store)
        found.append({(r.record_fingerprint, r.insert_id, r.log_name, r.event_name, r.service_name) for r in quality.accepted(rows).collect()})
        if store and store.min_bytes < 1_000:
            assert {r.body.startswith('"<offloaded:') for r in rows.collect()} == {True, False}
    assert len(found[0]) == 2 and all(f == found[0] for f in found)
    assert without_large(['{"a":', None, "{}"], Store("a", 1, 10), "f") == (['{"a":', None, "{}"], [])


def test_archive(spark, tmp_path):
    folder = tmp_path / "in"
    (folder / "deep").mkdir(parents=True)
    (folder / "_SUCCESS").write_text("")
    requests = [trace_request(span(spanId=f"{k + 1:016x}")) for k in range(6)]
    (folder / "zipped.json").write_bytes(gzip.compress(f"{requests[0]}\n\n  \n{requests[1]}".encode()) + gzip.compress(b"\nnot json\n"))
    (folder / "deep" / "plain.gz").write_bytes(f"{requests[2]}\r\n{'x' * 5000}\n{requests[3]}\n".encode() + b"\xff\xfe\n" + requests[4].encode())
    (folder / "cut.json.gz").write_bytes(gzip.compress(f"{requests[5]}\n".encode() * 2_000)[:-200])
    (folder / "empty.json").write_text("")
    rows = archive.lines(spark, str(folder), 4_000)
    assert rows.rdd.getNumPartitions() == 4
    found = {(r.file.rpartition("/")[2], r.line): (r.value, r.problem) for r in rows.where("file NOT LIKE '%cut%'").collect()}
    assert found == {
        ("zipped.json", 1): (requests[0], None), ("zipped.json", 4): (requests[1], None), ("zipped.json", 5): ("not json", None), ("plain.gz", 1): (requests[2], None), ("plain.gz", 2): (None, "line_too_long"),
        ("plain.gz", 3): (requests[3], None), ("plain.gz", 4): (None, "not_utf8"), ("plain.gz", 5): (requests[4], None),
    }
    report = {r.file.rpartition("/")[2]: r for r in backfill.file_report(rows).collect()}
    assert (report["zipped.json"].lines, report["zipped.json"].malformed, report["zipped.json"].first_bad_line) == (3, 1, 5) and (report["plain.gz"].malformed, report["plain.gz"].first_bad_line) == (2, 2)
    assert report["cut.json.gz"].broken and report["cut.json.gz"].malformed == 1 and report["cut.json.gz"].lines > 1
    assert {len(archive.files(f"{folder}/{p}")) for p in ("*.json", "**/*.gz", "z*")} == {1, 2} and archive.files(f"file://{folder}/zipped.json") == [f"file://{folder}/zipped.json"]
    with pytest.raises(FileNotFoundError):
        archive.files(f"{folder}/none")
    assert archive.lines(spark, f"{folder}/none*").count() == 0
    # places don't depend on how the lines are dealt out
    for parts in (1, 7):
        places = otlp.records(rows.where("file LIKE '%plain%'").repartition(parts), "traces").select("batch.line", "place").collect()
        assert sorted(p.line for p in places) == [1, 3, 5]


def test_a_batch_run_twice_leaves_each_row_once(spark, tmp_path):
    root = f"{tmp_path}/tables"
    big = kv("big", stringValue="x" * 500)
    log = json.dumps({"resourceLogs": [{"scopeLogs": [{"logRecords": [{"body": {"stringValue": "no time"}}, {"timeUnixNano": "1723420800000000000", "attributes": [big]}]}]}]})
    batch = lines(spark, trace_request(span(attributes=[big]), span(spanId="")), log, "not json")
    write = ingest.sink(root, "s", store=Store("p", 100, 1_000))

    def state():
        return {t: sorted(str(r) for r in spark.read.parquet(f"{root}/{t}").collect()) for t in ("otel_spans", "otel_logs", "otel_quarantine", "otel_payloads", "_ingest_times")}

    write(batch, 0)
    first = state()
    assert {t: len(r) for t, r in first.items()} == {"otel_spans": 1, "otel_logs": 2, "otel_quarantine": 1, "otel_payloads": 2, "_ingest_times": 1}
    write(batch, 0)
    assert state() == first
    write(batch, 1)
    assert {t: len(r) for t, r in state().items()} == {"otel_spans": 2, "otel_logs": 4, "otel_quarantine": 2, "otel_payloads": 4, "_ingest_times": 2}
    counts = spark.read.parquet(f"{root}/_ingest_batches").where("batch = 's-0'").collect()
    assert {r.signal: (r.records, r.stored, r.rejected) for r in counts} == {"traces": (2, 1, 1), "logs": (2, 2, 0), "metrics": (0, 0, 0), "malformed": (1, 0, 1)}


def test_stream(spark, tmp_path):
    source, root = tmp_path / "in", f"{tmp_path}/tables"
    source.mkdir()
    for round_ in range(2):
        (source / f"{round_}.json").write_text(trace_request(span(spanId=f"{round_ + 1:016x}")) + "\nbroken\n")
        query = ingest.start(otlp.export_lines(spark, str(source), stream=True, maxFilesPerTrigger="1"), root, f"{tmp_path}/checkpoint", "spans_stream", {"availableNow": True}, signals=("traces",))
        query.awaitTermination()
        assert query.exception() is None
    stored = spark.read.parquet(f"{root}/otel_spans")
    assert stored.count() == 2 and stored.select("span_id").distinct().count() == 2
    assert spark.read.parquet(f"{root}/_ingest_batches").where("signal = 'malformed'").agg(F.sum("records")).first()[0] == 2
