"""Trees of spans: roots, orphans, cycles, windows, agents and token leaves."""

from datetime import datetime, timedelta

import pytest

from spanlake.plans import marts, trajectory, views

T0 = datetime(2024, 8, 12)
SCHEMA = (
    "trace_id string, span_id string, parent_span_id string, service_name string, name string, kind long, status struct<code:long, message:string>, start_time timestamp, end_time timestamp, duration_nano long, "
    "attributes string, resource struct<attributes:string>, instrumentation_scope struct<name:string>, events array<string>, links array<string>, payload_refs array<string>"
)


def span(i, parent=None, at=0.0, op="chat", agent=None, tokens=None, service="svc", trace="t"):
    bag = {"gen_ai.operation.name": op} | ({"gen_ai.agent.name": agent} if agent else {})
    for k, v in zip(("input_tokens", "output_tokens", "reasoning.output_tokens"), tokens or ()):
        if v is not None:
            bag[f"gen_ai.usage.{k}"] = str(v)
    import json

    start = T0 + timedelta(hours=at)
    return (trace, i, parent, service, op, 3, (1, None), start, start + timedelta(seconds=1), 1_000_000_000, json.dumps(bag), ("{}",), (None,), None, None, None)


@pytest.fixture
def grow(spark):
    def run(*spans):
        g = views.gen_ai_spans(spark.createDataFrame(list(spans), SCHEMA))
        return g, {r.span_id: r for r in trajectory.trajectory(g).collect()}

    return run


def test_agents_and_paths(grow):
    _, t = grow(
        span("b7", op="invoke_agent", agent="planner"), span("b8", "b7", 0.1, tokens=(200, 100)), span("b9", "b7", 0.2, op="invoke_agent", agent="researcher"), span("ba", "b9", 0.4, tokens=(300, 200, 120)),
        span("bb", "b9", 0.3), span("bc", "b9", 0.5, op="execute_tool"), span("late", "gone", 0.6, op="invoke_agent", agent="late_worker", trace="u"),
    )
    assert [(t[i].depth, t[i].step_index, list(t[i].agent_path), t[i].is_leaf, t[i].is_token_leaf) for i in ("b7", "b8", "b9", "bb", "ba", "bc")] == [
        (0, 1, ["planner"], False, False), (1, 2, ["planner"], True, True), (1, 3, ["planner", "researcher"], False, False),
        (2, 4, ["planner", "researcher"], True, False), (2, 5, ["planner", "researcher"], True, True), (2, 6, ["planner", "researcher"], True, False),
    ]
    assert t["late"].is_orphan and t["late"].depth == 0 and t["ba"].nearest_agent_name == "researcher" and t["ba"].root_span_id == "b7"


def test_cycles_are_dropped_and_reported(grow):
    g, t = grow(span("self", "self"), span("x", "y"), span("y", "x", 0.1), span("r"), span("c", "r", 0.1))
    assert set(t) == {"r", "c"}


def test_missing_spans_are_reported(spark, grow):
    g, t = grow(span("x", "y", tokens=(1,)), span("y", "x", 0.1), span("r"))
    mart = trajectory.trajectory(g)
    assert {(r.span_id, r.violation) for r in marts.unhandled_cycles(g, mart).collect()} == {("x", "span_missing_from_trajectory"), ("y", "span_missing_from_trajectory")}
    assert [(r.span_id, r.violation) for r in marts.orphan_tokens(g, mart).collect()] == [("x", "span_missing_from_trajectory")]


def test_depth_stops_at_sixteen(grow):
    _, t = grow(*[span(f"n{i:02d}", f"n{i - 1:02d}" if i else None, 0.01 * i) for i in range(18)])
    assert len(t) == 17 and t["n16"].depth == 16


def test_windows_and_services(grow):
    _, t = grow(
        span("p"), span("far", "p", 25), span("early", "p", -0.5), span("before", "p", -1.5), span("n", None, service=None), span("m", "n", 0.1, service=None), span("other", "p", 0.2, service="else"),
    )
    assert t["early"].depth == 1 and t["m"].depth == 1
    assert all(t[i].is_orphan and t[i].depth == 0 for i in ("far", "before", "other"))
    assert not t["p"].is_leaf


def test_token_families_count_once(grow):
    g, t = grow(
        span("a", tokens=(10, 5)), span("b", "a", 0.1), span("c", "b", 0.2, tokens=(10,)), span("z", None, 1, tokens=(0,), trace="u"), span("r", None, 2, tokens=(None, None, 7), trace="v"),
        span("full", None, 3, tokens=(4, 4), trace="w"), span("kid", "full", 3.1, tokens=(4, 4), trace="w"),
    )
    # the child covers the input tokens, so the parent keeps its output tokens only
    assert (t["a"].is_token_leaf, t["a"].gen_ai_usage_input_tokens, t["a"].gen_ai_usage_output_tokens) == (True, None, 5)
    assert t["c"].is_token_leaf and t["z"].is_token_leaf and t["r"].is_token_leaf
    assert (t["full"].is_token_leaf, t["full"].gen_ai_usage_input_tokens) == (False, 4) and t["kid"].is_token_leaf
    assert marts.orphan_tokens(g, trajectory.trajectory(g)).count() == 0


def test_broken_counts_are_found(spark, grow):
    from pyspark.sql import functions as F

    g, _ = grow(span("a", tokens=(10,)), span("b", "a", 0.1, tokens=(10,)))
    bad = trajectory.trajectory(g).withColumn("is_token_leaf", F.lit(True)).withColumn("gen_ai_usage_input_tokens", F.when(F.col("span_id") == "b", 11).otherwise(10).cast("long"))
    found = {(r.span_id, r.violation) for r in marts.orphan_tokens(g, bad).collect()}
    assert found == {("a", "token_double_counted_with_child"), ("b", "projected_token_differs_from_raw")}


def test_repeated_span_identifiers_are_one(grow):
    _, t = grow(span("a"), span("a", None, 0.5), span("c", "a", 0.6))
    assert set(t) == {"a", "c"} and t["a"].start_time == T0
