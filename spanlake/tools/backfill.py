"""Backfill of archives, replay of quarantined records, and their reports."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.anyvalue import Limits, Redaction
from ..operators import fingerprint, offload, quality
from ..operators.stage import exists, spread, staged, unstage
from ..plans import registry
from ..sources import archive, otlp

TABLES = {"traces": "otel_spans", "logs": "otel_logs", "metrics": "otel_metrics"}


def transformed(lines: DataFrame, signal: str, limits: Limits = Limits(), redaction: Redaction | None = None, receive_nano: int | None = None, max_row_bytes: int = quality.MAX_ROW_BYTES, store: offload.Store | None = None) -> DataFrame:
    """All records of a signal as rows, with their fingerprints and, where they can't be stored, the reason. Large values
    of spans and logs go to ``payloads`` if there is a store for them."""
    more = {"store": store} if store and signal != "metrics" else {}
    rows = quality.with_row_limit(otlp.READERS[signal](lines, limits, redaction, receive_nano, **more), TABLES[signal], max_row_bytes)
    if signal == "logs":
        return fingerprint.log_fingerprints(rows)
    return fingerprint.metric_fingerprints(rows) if signal == "metrics" else rows


#: The partition column below a table's time: which batch wrote the rows.
BATCH = "ingest_batch"


def trace_lookup(df: DataFrame, expected: int = 1_000_000) -> dict[str, str]:
    """Options of a Parquet writer: Bloom filters of trace and span, so that a lookup skips row groups without them."""
    found: dict[str, str] = {}
    for c in ("trace_id", "span_id"):
        if c in df.columns:
            found |= {f"parquet.bloom.filter.enabled#{c}": "true", f"parquet.bloom.filter.expected.ndv#{c}": str(expected), f"parquet.bloom.filter.adaptive.enabled#{c}": "true"}
    return found


def append(df: DataFrame, root: str, table: str, batch: str) -> None:
    """Writes a batch's rows to a table, partitioned by its time and the batch and sorted within files. The same batch
    written again takes the place of what it wrote before."""
    _, (partition, expression), order = schemas.TABLES[table]
    rows = df.withColumns({partition: F.expr(expression), BATCH: F.lit(batch)}).repartition(partition, *order[:1]).sortWithinPartitions(partition, *order)
    rows.write.options(**trace_lookup(df)).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition, BATCH).parquet(f"{root}/{table}")


def ingest(lines: DataFrame, root: str, batch: str, signals: tuple[str, ...] = tuple(TABLES), **options: object) -> list[tuple[str, int, int, int]]:
    """Writes one batch of lines into rows, dead letters and payloads; gives (signal, records, stored, rejected) of each
    signal, and of the malformed lines. A batch that is run again leaves each row once in all tables."""
    spark = lines.sparkSession
    lines = staged(lines if "signal" in lines.columns else otlp.with_signal(lines), "lines")
    report = []
    for signal in signals:
        rows = staged(transformed(lines, signal, **options), f"rows-{signal}")
        append(quality.accepted(rows), root, TABLES[signal], batch)
        append(quality.quarantine(rows, signal), root, "otel_quarantine", f"{batch}-{signal}")
        if "payloads" in rows.columns:
            put_away = offload.objects(quality.stored(rows)).withColumn(BATCH, F.lit(f"{batch}-{signal}"))
            put_away.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(f"{root}/otel_payloads")
        n = rows.agg(F.count("*"), F.count_if(F.col("reason").isNull()), F.count("reason")).first()
        report.append((signal, *n))
        unstage(rows)
    bad = lines.where("signal = 'malformed'").count()
    unstage(lines)
    return [*report, ("malformed", bad, 0, bad)]


REPORT = "signal string, records long, stored long, rejected long"


def backfill(spark: SparkSession, path: str, root: str, signals: tuple[str, ...] = tuple(TABLES), max_line_bytes: int = archive.MAX_LINE_BYTES, batch: str | None = None, **options: object) -> DataFrame:
    """Reads an archive of export requests into the tables below ``root``; gives counts for each signal. With a name
    for the ``batch`` a backfill that broke off can be run again without doubled rows."""
    report = ingest(archive.lines(spark, path, max_line_bytes), root, batch or f"backfill-{uuid.uuid4().hex}", signals, **options)
    return spark.createDataFrame(report, REPORT)


def file_report(lines: DataFrame, signals: tuple[str, ...] = tuple(TABLES)) -> DataFrame:
    """Of each file of an archive: lines that aren't blank, malformed ones, those of other signals, and the first bad line."""
    s = lines if "signal" in lines.columns else otlp.with_signal(lines)
    bad = F.col("signal") == "malformed"
    return s.groupBy("file").agg(
        F.count("*").alias("lines"), F.count_if(bad).alias("malformed"), F.count_if(~bad & ~F.col("signal").isin(*signals)).alias("other_signal"),
        F.min(F.when(bad, F.col("line"))).alias("first_bad_line"), F.max(F.col("problem") == "broken_file").alias("broken"),
    )


def replay(quarantined: DataFrame, signal: str, limits: Limits = Limits(), **filters: object) -> DataFrame:
    """Quarantined records read again, with other limits: rows as of ``transformed``. Rows and payloads are staged, so
    that what rejected them isn't part of the plans that order and read them."""
    rows = staged(quarantined.where(F.col("signal") == signal), "quarantined")
    lines = staged(quality.replayable(rows, signal, **filters).select("value"), "replayed")
    return transformed(lines, signal, limits)


def with_payloads(quarantined: DataFrame, objects: DataFrame | None) -> DataFrame:
    """Quarantined rows with the payloads that they name by ``payload_ref``, from the object table (``uri, content``); what isn't
    there stays without."""
    if objects is None:
        return quarantined
    held = objects.select(F.col("uri").alias("payload_ref"), F.decode("content", "UTF-8").alias("__content")).dropDuplicates(["payload_ref"])
    found = quarantined.join(spread(held), "payload_ref", "left")
    return found.select(*[F.coalesce("raw_payload", "__content").alias(c) if c == "raw_payload" else F.col(c) for c in quarantined.columns])


CURSORS = "_replay_cursors"


def replay_job(quarantined: DataFrame, root: str, job: str, signal: str, batch_rows: int = 100_000, max_batches: int | None = None, objects: DataFrame | None = None, limits: Limits = Limits(), **filters: object) -> list[tuple[int, int, int]]:
    """Replays the quarantined records of a signal into the tables below ``root``, ``batch_rows`` at a time in their canonical
    order; gives (records, stored, rejected) of each batch. The cursor of a job is stored after each batch: a job that
    stopped goes on behind it, and a batch that was written but not booked is written over."""
    spark = quarantined.sparkSession
    rows = staged(with_payloads(quarantined.where(F.col("signal") == signal), objects), "quarantined")
    scan = staged(quality.replayable(rows, signal, **filters), "scan")
    path, order = f"{root}/{CURSORS}/job={job}", ["ingest_time", "row_fp", "row_ord", "row_key"]
    done: list[tuple[int, int, int]] = []
    while max_batches is None or len(done) < max_batches:
        booked = spark.read.parquet(path).orderBy(F.desc("batch")).first() if exists(spark, path) else None
        rest = resume(scan, booked) if booked else scan
        part = staged(rest.orderBy(*order).limit(batch_rows), "part")
        last = part.orderBy(*[F.desc(c) for c in order]).select(*quality.CURSOR).first()
        if last is None:
            break
        number = booked["batch"] + 1 if booked else 0
        found = staged(transformed(part.select("value"), signal, limits), "rows")
        append(quality.accepted(found), root, TABLES[signal], f"replay-{job}-{number}")
        done.append(tuple(found.agg(F.count("*"), F.count_if(F.col("reason").isNull()), F.count("reason")).first()))
        cursor = spark.createDataFrame([(*last, number)], f"{scan.select(*quality.CURSOR).schema.simpleString()[7:-1].replace(':', ' ')}, batch int")
        cursor.coalesce(1).write.mode("append").parquet(path)
        unstage(part, found)
    unstage(rows, scan)
    return done


def resume(scan: DataFrame, cursor: Row | dict) -> DataFrame:
    """Rows of ``canonical`` or ``replayable`` behind a cursor (a row of such a scan, or its columns of ``CURSOR``).

    If the cursor's group isn't what it was, rows may have come before the cursor: then all rows of
    its microsecond come again, and those behind it."""
    at = {c: cursor[c] for c in quality.CURSOR}
    same = F.lit(True)
    for c, v in at.items():
        same = same & (F.col(c) == F.lit(v))
    time, hash_, nth = F.lit(at["ingest_time"]), F.lit(at["row_fp"]), F.lit(at["row_ord"])
    if scan.where(same).head(1):
        here = (F.col("row_fp") > hash_) | ((F.col("row_fp") == hash_) & (F.col("row_ord") > nth))
    else:
        here = F.lit(True)
    return scan.where((F.col("ingest_time") > time) | ((F.col("ingest_time") == time) & here))


def validate(tables: dict[str, DataFrame]) -> list[tuple[str, str, str]]:
    """(table, pass or fail, what is wrong) for each of the engine's tables."""
    found = []
    for name in schemas.TABLES:
        if name not in tables:
            found.append((name, "skip", "not given"))
            continue
        bad = schemas.compatibility(schemas.table_schema(name), tables[name].schema)
        bad = [b for b in bad if "must not be required" not in b]
        found.append((name, "fail" if bad else "pass", "; ".join(bad)))
    return found


#: Of each view the column of time that readers filter by.
VIEW_TIMES = {
    "otel_spans_as_allspans": "start_time", "v_gen_ai_spans": "start_time", "v_gen_ai_model_costs": "usage_hour", "v_gen_ai_sessions": "session_start_date", "v_gen_ai_tool_usage": "usage_hour",
    "v_gen_ai_agent_trajectory": "start_time", "v_mcp_spans": "start_time", "v_mcp_tool_usage": "usage_hour", "v_gen_ai_logs": "timestamp", "v_gen_ai_metrics": "timestamp", "v_gen_ai_metric_exemplars": "metric_timestamp",
}


def scans(df: DataFrame) -> list[tuple[bool, bool]]:
    """Of each file scan in a query's plan: whether it prunes partitions, and whether a filter on values reaches it."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    found = []
    for text in plan.split("FileScan ")[1:]:
        part, pushed = (re.search(name + r": \[(.*?)\](?:, [A-Z]|$)", text.partition("\n")[0]) for name in ("PartitionFilters", "PushedFilters"))
        bounds = lambda m: bool(m) and bool(re.search(r">|<|=|Greater|Less|dynamicpruning", m[1]))
        found.append((bounds(part), bounds(pushed)))
    return found


def validate_views(spark: SparkSession, names: list[str], since: str = "2024-01-01 00:00:00") -> list[tuple[str, str, str]]:
    """(view, pass, warn or fail, why) of registered views, by the plan of a read from a time on: pass if partitions are pruned in
    all its scans, warn if the bound reaches the scans as a filter on values only (row groups are skipped, files are opened) or
    the view can't prune by design, fail if it reads a table whole."""
    out = []
    for name, column in VIEW_TIMES.items():
        if name not in names:
            out.append((name, "skip", "not registered"))
            continue
        view = spark.table(name)
        found = scans(view.where(F.col(column) >= F.lit(since).cast("timestamp").cast(view.schema[column].dataType)))
        if not found or not all(a or b for a, b in found):
            by_design = name in registry.UNPRUNABLE
            out.append((name, "warn" if by_design else "fail", "it can't prune: read it by its table function" if by_design else "it reads a table whole"))
        else:
            out.append((name, *(("pass", "") if all(a for a, _ in found) else ("warn", "files are opened, row groups skipped"))))
    return out


def workload(spark: SparkSession, requests: int, partitions: int = 8) -> DataFrame:
    """Seeded export requests of agent traces (column ``value``), each an agent, a model call, a tool call and another model call."""
    kv = lambda k, v: F.concat(F.lit(f'{{"key":"{k}","value":{{"stringValue":"'), v, F.lit('"}}'))
    number = lambda k, v: F.concat(F.lit(f'{{"key":"{k}","value":{{"intValue":"'), v.cast("string"), F.lit('"}}'))
    n = F.col("id")
    trace = F.lower(F.lpad(F.hex(n + 1), 32, "0"))
    ops = ["invoke_agent", "chat", "execute_tool", "chat"]
    parts = []
    for i, op in enumerate(ops):
        span = F.lower(F.lpad(F.hex(n * 4 + i + 1), 16, "0"))
        parent = F.lit("") if i == 0 else F.lower(F.lpad(F.hex(n * 4 + 1), 16, "0"))
        begin = F.lit(1_700_000_000_000_000_000) + n * 1_000_000_000 + i * 10_000_000
        bags = [kv("gen_ai.operation.name", F.lit(op)), kv("gen_ai.provider.name", F.concat(F.lit("prov"), F.pmod(n, F.lit(7)).cast("string"))), kv("gen_ai.conversation.id", F.concat(F.lit("c"), F.floor(n / 10).cast("string")))]
        if op == "chat":
            bags += [kv("gen_ai.request.model", F.concat(F.lit("m"), F.pmod(n, F.lit(5)).cast("string"))), number("gen_ai.usage.input_tokens", F.pmod(F.xxhash64(n, F.lit(i)), F.lit(1000)) + 1), number("gen_ai.usage.output_tokens", F.pmod(F.xxhash64(n, F.lit(i), F.lit(1)), F.lit(300)) + 1)]
        if op == "execute_tool":
            bags += [kv("gen_ai.tool.name", F.concat(F.lit("tool"), F.pmod(n, F.lit(9)).cast("string")))]
        parts.append(F.concat(
            F.lit('{"traceId":"'), trace, F.lit('","spanId":"'), span, F.lit('","parentSpanId":"'), parent, F.lit(f'","name":"{op}","kind":3,"startTimeUnixNano":"'), begin.cast("string"), F.lit('","endTimeUnixNano":"'),
            (begin + 5_000_000).cast("string"), F.lit('","attributes":['), F.concat_ws(",", *bags), F.lit('],"status":{"code":'), F.when(F.pmod(n, F.lit(20)) == i, "2").otherwise("1"), F.lit("}}"),
        ))
    service = kv("service.name", F.concat(F.lit("svc"), F.pmod(n, F.lit(7)).cast("string")))
    line = F.concat(F.lit('{"resourceSpans":[{"resource":{"attributes":['), service, F.lit(']},"scopeSpans":[{"scope":{"name":"gen"},"spans":['), F.concat_ws(",", *parts), F.lit("]}]}]}"))
    return spark.range(0, requests, 1, partitions).select(line.alias("value"))
