"""What the driver and single tasks hold doesn't grow with the tables."""

import json
import re

import pyarrow as pa
from pyspark.sql import functions as F

from spanlake import catalog
from spanlake.functions.anyvalue import encode_value, listed_texts, pieces
from spanlake.functions.jsonx import json_value, lax_int64, with_bags
from spanlake.operators import quality, stage
from spanlake.plans import trajectory, views
from spanlake.sources import otlp
from spanlake.tools import backfill


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def quarantined(spark):
    names = ["error_code", "error_message", "service_name", "trace_id", "span_id"]
    texts = [F.lit("x").alias(n) for n in names]
    return spark.range(40).select(F.lit("2024-01-01").cast("timestamp").alias("ingest_time"), F.lit("metrics").alias("signal"), *texts, (F.col("id") % 30).cast("string").alias("raw_payload"))


def test_a_replay_sends_no_payloads_to_the_driver(spark):
    q = quarantined(spark)
    lines = quality.replayable(q, "metrics")
    assert "Broadcast" not in plan(lines)
    (keys,) = re.findall(r"rangepartitioning\((.*?), \d+\)", plan(lines))
    assert "row_key" not in keys
    # without the texts the order is still that of all keys
    rows = [tuple(r) for r in lines.select("ingest_time", "row_fp", "row_ord", "row_key").collect()]
    assert len(rows) == 40 and rows == sorted(rows) and len({r[:3] for r in rows}) == 40


def test_what_rejects_a_record_is_read_once(spark):
    """Rejected and stored records are filtered by what was found, not by finding it again."""
    for signal in backfill.TABLES:
        rows = backfill.transformed(spark.range(1).select(F.lit("{}").alias("value")), signal, receive_nano=0)
        for part in (quality.quarantine(rows, signal), quality.accepted(rows)):
            text = plan(part)
            assert len(re.findall(r"ArrowEvalPython \[", text)) == 1
            assert not [line for line in text.splitlines() if re.match(r"[ :+*()0-9-]*Filter ", line) and "from_json" in line]


def test_orders_are_dealt_before_they_are_read_as_requests(spark, sf_dir, monkeypatch):
    """A small file isn't one task's work."""
    parts = []
    monkeypatch.setattr(backfill, "staged", lambda df, tag: parts.append((tag, df.rdd.getNumPartitions())) or stage.staged(df, tag))
    catalog.t14_metric_replay(spark, sf_dir)
    # the rejected records are written once
    assert [tag for tag, _ in parts] == ["quarantined", "replayed"]
    assert parts[0][1] == int(spark.conf.get("spark.sql.shuffle.partitions")) > 1


def test_no_list_is_null_on_its_way_to_the_encoder(spark):
    """One that is would make the time for a batch grow with the square of its rows."""
    points = otlp.metrics(spark.range(1).select(F.lit("{}").alias("value")))
    (given,) = re.findall(r"encode\(struct\(bags, .*?, list0, (.*?)\)\)#", plan(points.select("attributes")))
    assert given.startswith("coalesce(")


def test_exemplars_meet_their_spans_by_shuffles(spark, sf_dir):
    for query in (catalog.j2_metric_exemplars, catalog.q14_metric_exemplars, catalog.q5_tvf_metric_exemplars):
        assert "Broadcast" not in plan(query(spark, sf_dir))


def test_logs_meet_their_spans_by_shuffles(spark, sf_dir):
    for query in (catalog.j1_gen_ai_logs, catalog.q4_tvf_logs):
        assert "Broadcast" not in plan(query(spark, sf_dir))


def test_texts_read_in_one_pass_are_those_read_one_by_one(spark):
    bags = ['{"a.b": "x", "n": 7}', '{"a.b": 1.50, "n": "8.0"}', '{"a.b": true, "n": true}', '{"a.b": null}', '{"a.b": {"c": 1}, "n": [1]}', '{"a.b": "{x", "n": "[1]"}', '{"a.b": [1]}', '{"A.B": "y"}', "[1]", '"s"', "7", "{", None, '{"a.b": "x", "a.b": "y"}', '{"n": 1e3, "a.b": 12345678901234567890}']
    rows = with_bags(spark.createDataFrame([(b,) for b in bags], "bag string"), ["a.b", "n"], p="bag")
    one = [json_value(F.col("p"), "a.b"), json_value(F.col("p"), "n"), lax_int64(F.col("p"), "n")]
    all_ = [json_value("p", "a.b"), json_value("p", "n"), lax_int64("p", "n")]
    for r in rows.select(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(one)]).alias("one"), F.struct(*[c.alias(f"c{i}") for i, c in enumerate(all_)]).alias("all")).collect():
        assert r["one"] == r["all"]


def test_views_read_a_bag_in_one_pass(spark, sf_dir):
    for view in (views.gen_ai_spans, views.mcp_spans):
        assert "__a_text" in plan(view(catalog.spans(spark, sf_dir)).select("gen_ai_system"))
    assert "__d_text" in plan(trajectory.declared_spans(catalog.genai(spark, sf_dir)).select("declared"))


def test_tree_levels_meet_by_shuffles(spark, sf_dir):
    assert "Broadcast" not in plan(trajectory.trajectory(catalog.genai(spark, sf_dir)))


def test_workers_hold_few_records_of_a_batch_as_values(spark, sf_dir):
    texts = ["x" * n for n in (10, 900, 0, 40, 5_000, *[100] * 50)]
    column = pa.StructArray.from_arrays([pa.array(texts), pa.array([[t] for t in texts])], ["a", "b"])[1:]
    found = list(pieces(iter([column, column[:0]]), 2_000))
    assert [row for p in found for row in p.to_pylist()] == column.to_pylist()
    assert len(found) > 6 and all(p.nbytes <= 2_000 or len(p) == 1 for p in found)
    # functions over a stream of batches (251) give back what they have read piece by piece
    kinds = re.findall(r"ArrowEvalPython \[.*\], (\d+)\n", plan(catalog.t1_span_rows(spark, sf_dir)))
    assert kinds == ["251"]


def test_lists_of_texts_are_turned_at_once():
    rows = [["a", None], [], None, ["é\u2028"], ["x", "y", "z"], []]
    lists = pa.array([["before"], *rows, ["behind"]], pa.list_(pa.string()))[1:-1]
    assert listed_texts(lists) == [r or [] for r in rows] and listed_texts(lists[:0]) == []


def test_plain_texts_are_quoted_as_others_are():
    for s in ["", "plain", 'q"\\/', "".join(map(chr, range(128))), "é", "\u2028", "\ud800"]:
        assert json.loads(encode_value(json.dumps({"stringValue": s}))["plain"]) == s.replace("\ud800", "\ufffd")
        assert encode_value(json.dumps({"stringValue": s + "é"}))["plain"] == encode_value(json.dumps({"stringValue": s}))["plain"][:-1] + 'é"'


def test_sessions_sort_whole_spans_and_their_columns_in_tasks_of_their_own(spark, sf_dir):
    for query in (catalog.a2_sessions, catalog.a1_model_costs):
        text = plan(query(spark, sf_dir))
        # between the window of the leaves and that of the duplicates a shuffle
        assert "REPARTITION_BY_COL" in text[text.index("Window [max(__mark") : text.index("end_time_unix_nano")]
    assert "Expand" not in plan(catalog.a2_sessions(spark, sf_dir))


def test_turns_of_a_session_are_its_traces(spark, sf_dir):
    g = catalog.genai(spark, sf_dir).where("gen_ai_conversation_id IS NOT NULL")
    # a trace may be unknown, and a span's id come twice in one
    g = g.withColumns({"trace_id": F.expr("CASE WHEN span_id % 5 = 0 THEN NULL WHEN span_id % 2 = 0 THEN 'even' ELSE trace_id END"), "span_id": F.expr("CASE WHEN span_id % 2 = 0 THEN '0' ELSE span_id END")})
    found = {tuple(r) for r in views.sessions(g).select(*views.SESSION_KEYS, "turn_count").collect()}
    s = g.withColumns({"session_start_date": F.to_date("start_time"), "session_id": F.coalesce("adk_session_id", "gen_ai_conversation_id")})
    assert found == {tuple(r) for r in s.groupBy(*views.SESSION_KEYS).agg(F.count_distinct("trace_id")).collect()}
