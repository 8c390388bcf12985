"""Counts of what a job stores, rejects and puts away, gathered while it runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import quality


def counters(rows: DataFrame) -> dict[str, Column]:
    """Rows of ``backfill.transformed``: all, stored and rejected ones, and those with payloads put away."""
    out = {"rows": F.count(F.lit(1)), "acknowledged_rows": F.count_if(F.col("reason").isNull()), "rejected_rows": F.count("reason")}
    codes = sorted({"INVALID_TRACE_ID", "INVALID_SPAN_ID", "MISSING_START_TIME", "MISSING_END_TIME", "TIMESTAMP_OVERFLOW", "OVERSIZE_ROW"})
    out |= {f"rejected_rows.{c}": F.count_if(quality.error_code() == c) for c in codes}
    if "payload_refs" in rows.columns:
        refs = F.coalesce("payload_refs", F.array().cast(rows.schema["payload_refs"].dataType))
        size = F.aggregate(refs, F.lit(0).cast("bigint"), lambda a, r: a + r["byte_size"])
        out |= {"offloaded_payloads": F.sum(F.size(refs)), "offloaded_bytes": F.sum(size)}
    return out


def observed(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The rows, and an observation whose ``get`` has the counters once an action has run over them. The counts come
    with that action's tasks; no other pass over the rows is made."""
    seen = Observation(name)
    return rows.observe(seen, *[c.alias(n) for n, c in counters(rows).items()]), seen
