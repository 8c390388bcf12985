"""Agent trajectories: the tree of spans of each trace and service, with agents and token leaves.

Trees grow level by level from their anchors: one join of the newest level with the spans, at
most ``MAX_DEPTH`` times and only while rows come out. Levels are staged, so the plan of a level
doesn't repeat those before it, and hold keys and places only: the wide columns are joined once at the end. Token coverage
needs all ancestors of a row; their paths double with each join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.jsonx import json_value, with_bags
from ..operators.stage import spread, staged
from .views import AGENT_OPS

MAX_DEPTH, MAX_HOPS = 16, 32

CARRIED = [
    "start_time", "end_time", "duration_nano", "duration_ms", "trace_id", "span_id",
    "parent_span_id", "service_name", "span_name", "span_kind", "status_code", "status_message",
    "gen_ai_operation_name", "gen_ai_system", "gen_ai_provider_name", "gen_ai_request_model", "gen_ai_response_model", "gen_ai_agent_id",
    "gen_ai_agent_name", "gen_ai_agent_version", "gen_ai_main_agent_id", "gen_ai_main_agent_name", "gen_ai_tool_name", "gen_ai_tool_call_id",
    "gen_ai_usage_input_tokens", "gen_ai_usage_output_tokens", "gen_ai_usage_reasoning_tokens", "adk_session_id", "adk_invocation_id", "adk_user_id",
    "error_type",
]
FAMILIES = {"input": "gen_ai_usage_input_tokens", "output": "gen_ai_usage_output_tokens", "reasoning": "gen_ai_usage_reasoning_tokens"}


def declared_spans(g: DataFrame) -> DataFrame:
    """GenAI spans with the names that they declare."""
    names = ["gen_ai.agent.name", "gcp.vertex.agent.name"]
    declared = F.coalesce(*[json_value("__d", k) for k in names])
    starts = F.col("gen_ai_operation_name").isin(AGENT_OPS)
    s = with_bags(g, names, __d="attributes").select(*CARRIED, declared.alias("declared"), F.coalesce(starts, F.lit(False)).alias("agent_op"))
    return s.withColumn("path_name", F.coalesce("declared", F.when(F.col("agent_op"), F.col("gen_ai_agent_name"))))


def canonical(g: DataFrame) -> DataFrame:
    """One row for each span of a trace and service, with the names it declares."""
    s = declared_spans(g)
    w = Window.partitionBy("trace_id", "service_name", "span_id").orderBy(F.asc("start_time"), F.desc("end_time"), F.asc("span_name"), F.desc("duration_nano"))
    return s.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def _same_span(trace: str, service: str, span: str, of: str) -> Column:
    """Equality with the columns ``{of}trace``, ``{of}service`` and ``{of}span``; services may both be NULL."""
    return (F.col(trace) == F.col(f"{of}trace")) & F.col(service).eqNullSafe(F.col(f"{of}service")) & (F.col(span) == F.col(f"{of}span"))


def _after(later: str, earlier: str) -> Column:
    """``later`` lies from an hour before to a day after ``earlier``: the window of parent and child."""
    return F.col(later).between(F.col(earlier) - F.expr("INTERVAL 1 HOUR"), F.col(earlier) + F.expr("INTERVAL 24 HOURS"))


def grown(spans: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """All rows of the trees: depth, root, nearest agent, path of agents."""
    has_parent = F.coalesce(F.col("parent_span_id"), F.lit("")) != ""
    parents = spans.select(F.col("trace_id").alias("p_trace"), F.col("service_name").alias("p_service"), F.col("span_id").alias("p_span"), F.col("start_time").alias("p_start"))
    known = _same_span("trace_id", "service_name", "parent_span_id", "p_") & _after("start_time", "p_start")
    roots = spans.join(spread(parents), known, "left").where(~has_parent | F.col("p_span").isNull())
    starts = F.col("agent_op") | F.col("declared").isNotNull()
    key = ["trace_id", "service_name", "span_id"]
    level = roots.select(
        *key, "start_time", F.lit(0).alias("depth"), F.col("span_id").alias("root_span_id"), F.when(starts, F.col("span_id")).alias("nearest_agent_span_id"),
        F.when(starts, F.coalesce("declared", "gen_ai_agent_name")).alias("nearest_agent_name"),
        F.filter(F.array("path_name"), lambda x: x.isNotNull()).alias("agent_path"), has_parent.alias("is_orphan"), F.array("span_id").alias("visited"),
    )
    levels = [staged(level, "level")]
    for _ in range(max_depth):
        if not levels[-1].head(1):
            break
        up = levels[-1].select(*[F.col(c).alias(f"t_{c}") for c in ("depth", "root_span_id", "nearest_agent_span_id", "nearest_agent_name", "agent_path", "is_orphan", "visited", "start_time")],
                               F.col("trace_id").alias("t_trace"), F.col("service_name").alias("t_service"), F.col("span_id").alias("t_span"))
        child = spans.join(spread(up), _same_span("trace_id", "service_name", "parent_span_id", "t_") & _after("start_time", "t_start_time"))
        child = child.where(~F.array_contains("t_visited", F.col("span_id")))
        starts = F.col("agent_op") | (F.col("t_nearest_agent_span_id").isNull() & F.col("declared").isNotNull())
        fresh = F.col("path_name").isNotNull() & ((F.size("t_agent_path") == 0) | (F.try_element_at("t_agent_path", F.lit(-1)) != F.col("path_name")))
        level = child.select(
            *key, "start_time", (F.col("t_depth") + 1).alias("depth"), F.col("t_root_span_id").alias("root_span_id"),
            F.when(starts, F.col("span_id")).otherwise(F.col("t_nearest_agent_span_id")).alias("nearest_agent_span_id"),
            F.when(starts, F.coalesce("declared", "gen_ai_agent_name")).otherwise(F.col("t_nearest_agent_name")).alias("nearest_agent_name"),
            F.when(fresh, F.concat("t_agent_path", F.array("path_name"))).otherwise(F.col("t_agent_path")).alias("agent_path"),
            F.col("t_is_orphan").alias("is_orphan"), F.concat("t_visited", F.array("span_id")).alias("visited"),
        )
        levels.append(staged(level, "level"))
    placed = reduce(DataFrame.unionByName, levels).drop("start_time").withColumnsRenamed({c: f"n_{c}" for c in key})
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"n_{c}")) for c in key])
    return spans.select(*CARRIED).join(spread(placed), same).drop(*[f"n_{c}" for c in key])


def ancestors(rows: DataFrame, max_hops: int = MAX_HOPS) -> DataFrame:
    """Of each row the spans above it, nearest first: ``path`` (span and start) of at most ``max_hops``, and ``returns``: the
    walk came to a span that it had seen.

    Paths double: one of 2k hops is one of k hops and that of its last span. So 32 hops take five joins, and fewer where
    no path goes on. A path ends before a span that is in it already.
    """
    keys = ["trace_id", "service_name", "span_id"]
    nodes = staged(rows.select(*keys, "parent_span_id", "start_time").dropDuplicates(keys), "nodes")
    up = nodes.select(*[F.col(c).alias(f"p_{k}") for c, k in zip(keys, ("trace", "service", "span"))], F.col("parent_span_id").alias("p_parent"), F.col("start_time").alias("p_start"))
    found = nodes.join(spread(up), _same_span("trace_id", "service_name", "parent_span_id", "p_"), "left")
    above = F.col("p_span").isNotNull() & (F.col("p_span") != F.col("span_id"))
    one = F.struct(F.col("p_span").alias("span"), F.col("p_start").alias("start"))
    chains = staged(found.select(
        *keys, F.when(above, F.array(one)).otherwise(F.filter(F.array(one), lambda _: F.lit(False))).alias("path"),
        F.when(above & ~F.coalesce(F.col("p_parent") == F.col("p_span"), F.lit(False)), F.col("p_parent")).alias("next"), F.coalesce((F.col("p_span") == F.col("span_id")) | (F.col("p_parent") == F.col("p_span")), F.lit(False)).alias("returns"),
    ), "hops")
    hops = 1
    while hops < max_hops and chains.where("next IS NOT NULL").head(1):
        last = chains.where("next IS NOT NULL").select("*", F.concat(F.array("span_id"), F.transform("path", lambda x: x["span"])).alias("seen"))
        # the span that comes next, and all above it as far as is known
        far = chains.select(*[F.col(c).alias(f"f_{k}") for c, k in zip(keys, ("trace", "service", "span"))], F.col("path").alias("f_path"), F.col("next").alias("f_next"), F.col("returns").alias("f_returns"))
        starts = nodes.select(*[F.col(c).alias(f"n_{k}") for c, k in zip(keys, ("trace", "service", "span"))], F.col("start_time").alias("n_start"))
        far = far.join(spread(starts), (F.col("f_trace") == F.col("n_trace")) & F.col("f_service").eqNullSafe(F.col("n_service")) & (F.col("f_span") == F.col("n_span")))
        j = last.join(spread(far), _same_span("trace_id", "service_name", "next", "f_"), "left")
        more = F.when(F.col("f_span").isNotNull(), F.concat(F.array(F.struct(F.col("f_span").alias("span"), F.col("n_start").alias("start"))), "f_path"))
        j = j.withColumn("more", F.coalesce(F.slice(more, 1, max_hops - hops), F.filter("path", lambda _: F.lit(False))))
        # up to the first span that the walk has seen
        seen = F.transform("more", lambda x: F.array_contains("seen", x["span"]))
        cut = F.coalesce(F.nullif(F.array_position(seen, F.lit(True)), F.lit(0)) - 1, F.size("more"))
        j = j.withColumn("cut", cut.cast("int"))
        whole = F.col("cut") == F.size("more")
        doubled = j.select(
            *keys, F.concat("path", F.slice("more", F.lit(1), F.col("cut"))).alias("path"), F.when(whole & (F.size("more") == F.size("f_path") + 1), F.col("f_next")).alias("next"),
            (F.col("returns") | ~whole | F.coalesce("f_returns", F.lit(False))).alias("returns"),
        )
        done = chains.where("next IS NULL")
        chains = staged(doubled.unionByName(done), "hops")
        hops = 2 * hops + 1
    return chains.select(*keys, F.slice("path", 1, max_hops).alias("path"), "returns")


def covered(rows: DataFrame, max_hops: int = MAX_HOPS) -> DataFrame:
    """For each row with descendants that report tokens: which families they report.

    Of two rows that are each other's ancestor only the later one counts for the other.
    """
    flags = [f"has_{f}" for f in FAMILIES]
    reports = rows.groupBy("trace_id", "service_name", "span_id").agg(F.min("start_time").alias("d_start"), *[F.bool_or(F.col(c).isNotNull()).alias(f"has_{f}") for f, c in FAMILIES.items()])
    r = reports.withColumnsRenamed({"trace_id": "r_trace", "service_name": "r_service", "span_id": "r_span"})
    chains = staged(ancestors(rows, max_hops).join(spread(r), _same_span("trace_id", "service_name", "span_id", "r_")), "chains")
    named = [F.col("trace_id"), F.col("service_name"), F.col("span_id").alias("d_span")]
    pairs = chains.where(" OR ".join(flags)).select(*named, "d_start", *flags, F.explode("path").alias("p")).select("*", F.col("p.span").alias("p_span"), F.col("p.start").alias("p_start")).drop("p")
    # only rows whose walk came back can be below their own ancestors
    back = chains.where("returns").select(*named, F.explode("path.span").alias("p_span"))
    back = back.select(F.col("trace_id").alias("b_trace"), F.col("service_name").alias("b_service"), F.col("p_span").alias("b_span"), F.col("d_span").alias("b_of")).distinct()
    both = _same_span("trace_id", "service_name", "d_span", "b_") & (F.col("p_span") == F.col("b_of"))
    later = (F.col("d_start") > F.col("p_start")) | ((F.col("d_start") == F.col("p_start")) & (F.col("d_span") > F.col("p_span")))
    counted = pairs.join(spread(back), both, "left").where(F.col("b_of").isNull() | later)
    return counted.groupBy("trace_id", "service_name", F.col("p_span").alias("span_id")).agg(*[F.bool_or(f).alias(f) for f in flags])


def trajectory(g: DataFrame) -> DataFrame:
    """Rows of all trees over GenAI spans, in the order of the reference's columns."""
    spans = staged(canonical(g), "canonical")
    rows = staged(grown(spans).drop("visited"), "trees")
    cover = covered(rows).select(F.col("trace_id").alias("c_trace"), F.col("service_name").alias("c_service"), F.col("span_id").alias("c_span"), *[F.col(f"has_{f}").alias(f"c_{f}") for f in FAMILIES])
    parents = spans.where("parent_span_id IS NOT NULL AND parent_span_id <> ''").select(F.col("trace_id").alias("l_trace"), F.col("service_name").alias("l_service"), F.col("parent_span_id").alias("l_span")).distinct()
    t = rows.join(spread(parents), _same_span("trace_id", "service_name", "span_id", "l_"), "left").join(spread(cover), _same_span("trace_id", "service_name", "span_id", "c_"), "left")
    done = {f: F.coalesce(F.col(f"c_{f}"), F.lit(False)) for f in FAMILIES}
    own = {f: F.col(c).isNotNull() & ~done[f] for f, c in FAMILIES.items()}
    leaf = own["input"] | own["output"] | own["reasoning"]
    tokens = {}
    for f, c in FAMILIES.items():
        others = reduce(Column.__or__, [own[x] for x in FAMILIES if x != f])
        tokens[c] = F.when(done[f] & others, F.lit(None)).otherwise(F.col(c))
    order = Window.partitionBy("trace_id", "service_name").orderBy(F.asc("start_time"), F.asc("span_id"))
    return t.select(
        *[tokens[c].alias(c) if c in tokens else F.col(c) for c in CARRIED], "depth", "root_span_id", "nearest_agent_span_id", "nearest_agent_name", "agent_path", "is_orphan",
        F.row_number().over(order).alias("step_index"), F.col("l_span").isNull().alias("is_leaf"), leaf.alias("is_token_leaf"),
    )
