"""OTLP/JSON export requests, one on each line, as rows of the signal tables.

The nesting of resources, scopes and records is read with fixed schemas and exploded by Spark;
each record's own text is kept, so that a rejected one can be put away as it came. Every record
gives a row: ``reason`` and ``field_path`` tell why one can't be stored (NULL: it can). A record with a member
that isn't what it should be is ``malformed``, and stops no other.

Members are read by their camelCase and snake_case names, enumerations by number and by name, whole numbers from
numbers and from texts.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.anyvalue import Encoded, Limits, Redaction, encoded
from ..operators.offload import Store, payload_refs, records_without_large

SIGNALS = {"traces": ("resourceSpans", "scopeSpans", "spans"), "logs": ("resourceLogs", "scopeLogs", "logRecords"), "metrics": ("resourceMetrics", "scopeMetrics", "metrics")}
# whole numbers are read as text: they come as numbers or as texts, and enumerations also by name
_BAG = "attributes string, droppedAttributesCount string"
_SPAN = f"""traceId string, spanId string, parentSpanId string, traceState string, flags string, name string, kind string, startTimeUnixNano string, endTimeUnixNano string, {_BAG},
    events array<struct<timeUnixNano:string, name:string, attributes:string, droppedAttributesCount:string>>, droppedEventsCount string,
    links array<struct<traceId:string, spanId:string, traceState:string, attributes:string, droppedAttributesCount:string>>, droppedLinksCount string, status struct<code:string, message:string>"""
_LOG = f"timeUnixNano string, observedTimeUnixNano string, severityNumber string, severityText string, eventName string, traceId string, spanId string, flags string, body string, {_BAG}"
_KIND = "struct<aggregationTemporality:string, isMonotonic:boolean, dataPoints:array<string>>"
KINDS = {"gauge": "GAUGE", "sum": "SUM", "histogram": "HISTOGRAM", "exponentialHistogram": "EXPONENTIAL_HISTOGRAM", "summary": "SUMMARY"}
_METRIC = "name string, description string, unit string, metadata string, " + ", ".join(f"{k} {_KIND}" for k in KINDS)
_BUCKETS = "struct<offset:string, bucketCounts:array<string>>"
_POINT = f"""attributes string, startTimeUnixNano string, timeUnixNano string, flags string, asDouble string, asInt string, count string, sum string, min string, max string,
    explicitBounds array<double>, bucketCounts array<string>, scale string, zeroCount string, zeroThreshold double, positive {_BUCKETS}, negative {_BUCKETS},
    quantileValues array<struct<quantile:double, value:double>>,
    exemplars array<struct<timeUnixNano:string, asDouble:string, asInt:string, traceId:string, spanId:string, filteredAttributes:string>>"""
_BROKEN = "_broken"
_STRICT = {"columnNameOfCorruptRecord": _BROKEN, "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def _snake(name: str) -> str:
    return "".join(f"_{c.lower()}" if c.isupper() else c for c in name)


#: Members of requests whose snake_case names are read as well: those of the schemas above and of values.
MEMBERS = sorted({
    *re.findall(r"[a-z]+(?:[A-Z][a-z]*)+(?=[ :])", " ".join((_SPAN, _LOG, _METRIC, _POINT))), *(x for names in SIGNALS.values() for x in names if x != x.lower()), "schemaUrl",
    "stringValue", "boolValue", "intValue", "doubleValue", "bytesValue", "arrayValue", "kvlistValue",
}, key=lambda m: (-len(m), m))


MAX_INT64 = 9_223_372_036_854_775_807


def export_lines(spark: SparkSession, path: str, stream: bool = False, **options: str) -> DataFrame:
    """Lines of JSON files (also compressed ones, by their extension) that aren't blank. See ``sources.archive`` for
    lines with file and number."""
    reader = spark.readStream if stream else spark.read
    return reader.options(**options).text(path).where(F.trim("value") != "")


def camel_case(text: Column) -> Column:
    """A request whose members have their camelCase names. Within texts quotes are escaped, and attribute keys are
    values, so a name in quotes before a colon is always a member's."""
    renamed = text
    for m in MEMBERS:
        renamed = F.regexp_replace(renamed, F.lit(f'"{_snake(m)}"\\s*:'), F.lit(f'"{m}":'))
    return F.when(text.rlike(r'"[a-z]+(?:_[a-z]+)+"\s*:'), renamed).otherwise(text)


def _levels(signals: list[str]) -> str:
    found = []
    for top, middle, leaf in (SIGNALS[s] for s in signals):
        found.append(f"{top}:array<struct<resource:string, schemaUrl:string, {middle}:array<struct<scope:string, schemaUrl:string, {leaf}:array<string>>>>>")
    return f"q struct<{', '.join(found)}>, {_BROKEN} string"


def _request(text: Column, signals: list[str]) -> Column:
    """The request, within an object of one member: what follows the request then breaks the whole."""
    return F.from_json(F.concat(F.lit('{"q":'), camel_case(text), F.lit("}")), _levels(signals), _STRICT)


def _signal(request: Column, text: Column) -> Column:
    """The signal of a parsed request, by its first member that names one."""
    has = {s: request["q"][top].isNotNull() for s, (top, _, _) in SIGNALS.items()}
    only = F.when(F.size(F.filter(F.array(*has.values()), lambda x: x)) == 1, F.coalesce(*[F.when(c, s) for s, c in has.items()]))
    names = {k: s for s, (top, _, _) in SIGNALS.items() for k in (top, _snake(top))}
    first = F.try_element_at(F.filter(F.json_object_keys(text), lambda k: k.isin(list(names))), F.lit(1))
    by_name = F.coalesce(*[F.when(first == k, s) for k, s in names.items()])
    found = F.coalesce(only, by_name, F.lit("malformed"))
    return F.when(request.isNull() | request[_BROKEN].isNotNull(), "malformed").otherwise(found)


def signal_of(line: str | Column = "value") -> Column:
    """traces, logs, metrics or, for other lines and malformed JSON, ``malformed``; snake_case keys count as well."""
    text = F.col(line) if isinstance(line, str) else line
    return _signal(_request(text, list(SIGNALS)), text)


def with_signal(lines: DataFrame) -> DataFrame:
    """Lines with their ``signal``; those that the archive couldn't read are malformed."""
    bad = F.col("problem").isNotNull() if "problem" in lines.columns else F.lit(False)
    return lines.withColumn("signal", F.when(bad, "malformed").otherwise(signal_of("value")))


def records(lines: DataFrame, signal: str) -> DataFrame:
    """One row for each record: its text, those of resource and scope, schema addresses, batch and place in it. The batch
    is the line, by file and number if the lines have these. Lines with a ``signal`` (``with_signal``) are parsed once less."""
    top, middle, leaf = SIGNALS[signal]
    batch = F.struct("file", "line") if {"file", "line"} <= set(lines.columns) else F.monotonically_increasing_id()
    if "signal" in lines.columns:
        rows = lines.where(F.col("signal") == signal).select(batch.alias("batch"), _request(F.col("value"), [signal]).alias("r"))
        given = F.col(f"r.q.{top}")
    else:
        rows = lines.select(batch.alias("batch"), "value", _request(F.col("value"), list(SIGNALS)).alias("r"))
        given = F.when(_signal(F.col("r"), F.col("value")) == signal, F.col(f"r.q.{top}"))
    rows = rows.select("batch", F.posexplode(given).alias("i", "r"))
    rows = rows.select("batch", "i", F.col("r.resource").alias("resource_text"), F.col("r.schemaUrl").alias("resource_schema_url"), F.posexplode(f"r.{middle}").alias("j", "s"))
    return rows.select(
        "batch", "resource_text", "resource_schema_url", F.col("s.scope").alias("scope_text"), F.col("s.schemaUrl").alias("scope_schema_url"),
        "i", "j", F.posexplode(f"s.{leaf}").alias("k", "record"),
    ).select("batch", F.struct("i", "j", "k").alias("place"), "resource_text", "resource_schema_url", "scope_text", "scope_schema_url", "record")


def requests(rows: DataFrame, signal: str) -> DataFrame:
    """Records as export requests again (column ``value``), one for each batch, with the resources and scopes that still have records, in
    their old order. ``rows``: those of ``records`` or of the readers, all or some."""
    top, middle, leaf = SIGNALS[signal]
    parts = {c: F.col(c) for c in ("resource_text", "scope_text", "resource_schema_url", "scope_schema_url")}
    ordered = lambda at, text: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at.alias("at"), text.alias("text")))), lambda x: x["text"]), ",")
    named = lambda name, text: F.concat(F.lit(f'"{name}":'), F.coalesce(text, F.lit("{}")))
    url = lambda c: members(F.col(c).alias("schemaUrl"))
    r = rows.select("batch", F.col("place.i").alias("i"), F.col("place.j").alias("j"), F.col("place.k").alias("k"), "record", *[c.alias(n) for n, c in parts.items()])
    scopes = r.groupBy("batch", "i", "j").agg(ordered(F.col("k"), F.col("record")).alias("records"), *[F.first(n).alias(n) for n in parts])
    inner = F.concat(F.lit("{"), F.concat_ws(",", named("scope", F.col("scope_text")), url("scope_schema_url"), F.concat(F.lit(f'"{leaf}":['), "records", F.lit("]"))), F.lit("}"))
    resources = scopes.withColumn("inner", inner).groupBy("batch", "i").agg(ordered(F.col("j"), F.col("inner")).alias("scopes"), *[F.first(n).alias(n) for n in ("resource_text", "resource_schema_url")])
    outer = F.concat(F.lit("{"), F.concat_ws(",", named("resource", F.col("resource_text")), url("resource_schema_url"), F.concat(F.lit(f'"{middle}":['), "scopes", F.lit("]"))), F.lit("}"))
    batches = resources.withColumn("outer", outer).groupBy("batch").agg(ordered(F.col("i"), F.col("outer")).alias("resources"))
    return batches.select(F.concat(F.lit(f'{{"{top}":['), "resources", F.lit("]}")).alias("value"))


def members(*columns: Column) -> Column:
    """Columns that aren't NULL as members of a JSON object, without its braces; NULL if there are none."""
    text = F.to_json(F.struct(*columns))
    return F.nullif(F.substring(text, F.lit(2), F.length(text) - 2), F.lit(""))


def _id(c: Column) -> Column:
    """Lower-case hex; all zeros are no identifier."""
    low = F.lower(c)
    return F.when(~low.rlike("^0*$"), low)


def _nano(c: Column) -> Column:
    """An unsigned count of nanoseconds; missing is 0."""
    return F.coalesce(c.try_cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))


def _fits(nano: Column) -> Column:
    return nano <= F.lit(MAX_INT64).cast("decimal(20,0)")


def _long(nano: Column) -> Column:
    return F.when(_fits(nano), nano.cast("bigint"))


def _time(nano: Column) -> Column:
    return F.timestamp_micros(F.call_function("div", _long(nano), F.lit(1000).cast("bigint")))


def first_problem(*checks: tuple[Column, str, str]) -> Column:
    """(reason, path) of the first condition that holds; NULL if none does."""
    out = F.lit(None).cast("struct<reason:string, path:string>")
    for broken, reason, path in reversed(checks):
        out = F.when(broken, F.struct(F.lit(reason).alias("reason"), F.lit(path).alias("path"))).otherwise(out)
    return out


def _judged(rows: DataFrame, problem: Column) -> DataFrame:
    """Rows with their ``problem``. It comes from a generator of one row: a filter on a plain column would be moved below the encoding of bags,
    with all that it reads in place of names, and so parse a record again for each check and encode it twice. Generators don't compile
    what they are given, so the checks stand before it."""
    return rows.withColumn("found", problem).select("*", F.explode(F.array("found")).alias("problem")).drop("found")


_SCOPE = f"name string, version string, {_BAG}"
_OPEN = {"record": "o", "resource_text": "res", "scope_text": "sc"}


def _opened(rows: DataFrame, schema: str) -> DataFrame:
    light = "light_" if "payloads" in rows.columns else ""
    shapes = dict(zip(_OPEN, (schema, _BAG, _SCOPE)))
    return rows.withColumns({o: F.from_json(f"{light}{c}", f"{shapes[c]}, {_BROKEN} string", _STRICT) for c, o in _OPEN.items()})


def _whole(c: Column | str) -> Column:
    """A whole number of a number or text; NULL if it is none."""
    return (F.col(c) if isinstance(c, str) else c).try_cast("bigint")


def _enum(c: str, names: list[str]) -> Column:
    """A number or one of the names (in the order of their numbers); missing is 0, and another text NULL."""
    text = F.col(c)
    named = F.array_position(F.array(*map(F.lit, names)), text) - 1
    return F.when(text.isNull(), F.lit(0).cast("bigint")).otherwise(F.coalesce(_whole(text), F.when(named >= 0, named)))


def _malformed(wholes: list[str], enums: list[Column] = [], opened: tuple[str, ...] = ("o", "res", "sc")) -> Column:
    """What keeps a record from being read: a part of another shape, or texts in place of numbers."""
    checks = [(F.col(f"{o}.{_BROKEN}").isNotNull(), "malformed", name) for o, name in (("o", "record"), ("res", "resource"), ("sc", "instrumentation_scope"), ("p", "point")) if o in opened]
    checks += [(F.col(c).isNotNull() & _whole(c).isNull(), "malformed", _snake(c.rpartition(".")[2])) for c in wholes]
    checks += [(e.isNull(), "malformed", "enumeration") for e in enums]
    return first_problem(*checks)


def _read(lines: DataFrame, signal: str, redaction: Redaction | None, receive_nano: int | None, store: Store | None) -> tuple[DataFrame, Redaction | None]:
    """Records, without their large values if there is a store for these, and the masking still to be done."""
    rows = records(lines, signal)
    if store is None:
        return rows, redaction
    day = F.to_date(F.timestamp_seconds(F.lit(receive_nano // 1_000_000_000))) if receive_nano is not None else F.current_date()
    # masked before values are put away; references aren't masked after
    return records_without_large(rows, signal, store, day, redaction), None


#: Bags of a log record, in the order of ``Encoded``.
_RESOURCE_BAG, _SCOPE_BAG, _OWN_BAG, _BODY_BAG = range(4)


def _whole_bags(rows: DataFrame, redaction: Redaction | None) -> Encoded:
    """The bags of log records as they were before large values were put away: a record's identity doesn't depend on
    whether and where these are stored. Records without such values aren't encoded again."""
    large = F.size("payloads") > 0
    bag = lambda text, member: F.when(large, F.get_json_object(text, f"$.{member}"))
    bags = [(bag("resource_text", "attributes"), "resource.attributes"), (bag("scope_text", "attributes"), "instrumentation_scope.attributes"), (bag("record", "attributes"), "attributes"), (bag("record", "body"), "body")]
    none = Limits(*[1 << 40] * len(Limits._fields))._replace(depth=Limits().depth)
    return Encoded(encoded(bags, [], none, redaction), 4, [])


def _zero(c: Column | str) -> Column:
    return F.coalesce(_whole(c), F.lit(0).cast("bigint"))


def _origin(e: Encoded) -> dict[str, Column]:
    """Resource and scope, the first two bags."""
    return {
        "resource": F.struct(e.plain(0).alias("attributes"), e.types(0).alias("attributes_schema"), _zero("res.droppedAttributesCount").alias("dropped_attributes_count")),
        "instrumentation_scope": F.struct(F.col("sc.name").alias("name"), F.col("sc.version").alias("version"), e.plain(1).alias("attributes"), e.types(1).alias("attributes_schema"), _zero("sc.droppedAttributesCount").alias("dropped_attributes_count")),
        "service_name": F.get_json_object(e.plain(0), "$['service.name']"),
    }


def _bag_columns(e: Encoded, own: int) -> dict[str, Column]:
    return {"attributes": e.plain(own), "attributes_schema": e.types(own)}


def _finished(rows: DataFrame, columns: dict[str, Column], table: str, receive_nano: int | None) -> DataFrame:
    """All columns of the table, and batch, place, reason, field_path and the texts of the record."""
    now = F.lit(receive_nano).cast("bigint") if receive_nano is not None else F.unix_micros(F.current_timestamp()) * 1000
    columns = columns | {"receive_time_unix_nano": now, "receive_time": F.timestamp_micros(F.call_function("div", now, F.lit(1000).cast("bigint"))), "schema_version": F.lit(schemas.SCHEMA_VERSION)}
    want = schemas.table_schema(table)
    made = [columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in want.fields]
    more = [c for c in ("payloads", "identity") if c in rows.columns]
    return rows.select(*made, "batch", "place", F.col("problem.reason").alias("reason"), F.col("problem.path").alias("field_path"), "record", "resource_text", "scope_text", *more)


_SPAN_KINDS = ["UNSPECIFIED", "INTERNAL", "SERVER", "CLIENT", "PRODUCER", "CONSUMER"]
_STATUS = ["UNSET", "OK", "ERROR"]
_TEMPORALITIES = ["UNSPECIFIED", "DELTA", "CUMULATIVE"]


def _name(names: list[str], number: Column) -> Column:
    return F.try_element_at(F.array(*map(F.lit, names)), F.when((number >= 0) & (number < len(names)), number.cast("int") + 1))


def spans(lines: DataFrame, limits: Limits = Limits(), redaction: Redaction | None = None, receive_nano: int | None = None, store: Store | None = None) -> DataFrame:
    """Every span of the trace requests as a row of ``otel_spans``. With a store, large values are in the column ``payloads``."""
    rows, redaction = _read(lines, "traces", redaction, receive_nano, store)
    rows = _opened(rows, _SPAN)
    bags = [(F.col("res.attributes"), "resource.attributes"), (F.col("sc.attributes"), "instrumentation_scope.attributes"), (F.col("o.attributes"), "attributes")]
    lists = [(F.col("o.events.attributes"), "events.attributes"), (F.col("o.links.attributes"), "links.attributes")]
    rows = rows.withColumn("encoded", encoded(bags, lists, limits, redaction))
    e = Encoded(F.col("encoded"), len(bags), [c for c, _ in lists])
    start, end = _nano(F.col("o.startTimeUnixNano")), _nano(F.col("o.endTimeUnixNano"))
    contract = first_problem(
        (_id(F.col("o.traceId")).isNull(), "invalid_id", "trace_id"), (_id(F.col("o.spanId")).isNull(), "invalid_id", "span_id"),
        (start == 0, "missing_timestamp", "start_time"), (end == 0, "missing_timestamp", "end_time"),
        (~_fits(start), "timestamp_overflow", "start_time_unix_nano"), (~_fits(end), "timestamp_overflow", "end_time_unix_nano"),
    )
    counts = first_problem((F.size("o.events") > limits.events, "event_count", "events"), (F.size("o.links") > limits.links, "link_count", "links"))
    code, kind = _enum("o.status.code", [f"STATUS_CODE_{n}" for n in _STATUS]), _enum("o.kind", [f"SPAN_KIND_{n}" for n in _SPAN_KINDS])
    unread = _malformed(["o.flags", "o.droppedAttributesCount", "o.droppedEventsCount", "o.droppedLinksCount", "res.droppedAttributesCount", "sc.droppedAttributesCount"], [kind, code])
    rows = _judged(rows, F.coalesce(unread, contract, e.problem(), counts, e.problem(lists=True)))
    bag = lambda k, i: [c.alias(n) for c, n in zip(e.member(k, i), ("attributes", "attributes_schema"))]
    events = F.transform("o.events", lambda x, i: F.struct(
        F.when(_nano(x["timeUnixNano"]) > 0, _time(_nano(x["timeUnixNano"]))).alias("time"), _long(_nano(x["timeUnixNano"])).alias("time_unix_nano"), x["name"].alias("name"), *bag(0, i), _zero(x["droppedAttributesCount"]).alias("dropped_attributes_count")))
    links = F.transform("o.links", lambda x, i: F.struct(
        _id(x["traceId"]).alias("trace_id"), _id(x["spanId"]).alias("span_id"), F.nullif(x["traceState"], F.lit("")).alias("trace_state"), *bag(1, i), _zero(x["droppedAttributesCount"]).alias("dropped_attributes_count")))
    columns = {
        "start_time": _time(start), "start_time_unix_nano": _long(start), "end_time": _time(end), "end_time_unix_nano": _long(end), "duration_nano": F.greatest(_long(end) - _long(start), F.lit(0)),
        "trace_id": _id(F.col("o.traceId")), "span_id": _id(F.col("o.spanId")), "parent_span_id": _id(F.col("o.parentSpanId")), "trace_state": F.nullif("o.traceState", F.lit("")), "flags": _zero("o.flags"),
        "name": F.col("o.name"), "kind": kind, "kind_name": _name(_SPAN_KINDS, kind),
        "status": F.struct(code.alias("code"), _name(_STATUS, code).alias("code_name"), F.nullif("o.status.message", F.lit("")).alias("message")),
        **_bag_columns(e, 2), "dropped_attributes_count": _zero("o.droppedAttributesCount"),
        "dropped_events_count": _zero("o.droppedEventsCount"), "dropped_links_count": _zero("o.droppedLinksCount"), "events": events, "links": links,
        "resource_schema_url": F.col("resource_schema_url"), "scope_schema_url": F.col("scope_schema_url"),
    } | _origin(e)
    columns |= {"payload_refs": payload_refs(F.col("payloads"))} if store else {}
    return _finished(rows, columns, "otel_spans", receive_nano)


#: Names of severities in the order of their numbers.
SEVERITIES = ["SEVERITY_NUMBER_UNSPECIFIED", *(f"SEVERITY_NUMBER_{level}{k}" for level in ("TRACE", "DEBUG", "INFO", "WARN", "ERROR", "FATAL") for k in ("", "2", "3", "4"))]

#: Attributes that name a log and an entry, in order.
LOG_NAMES, INSERT_IDS = ["gcp.log_name", "logging.googleapis.com/logName", "log.iostream"], ["logging.googleapis.com/insertId", "gcp.insert.id", "gcp.insert_id", "log.record.uid"]


def _string_attribute(plain: Column, types: Column, keys: list[str]) -> Column:
    """The first string that isn't empty among the keys; values of other types are skipped."""
    found = [F.when(F.get_json_object(types, f"$['{k}']") == "string", F.nullif(F.get_json_object(plain, f"$['{k}']"), F.lit(""))) for k in keys]
    return F.coalesce(*found)


def logs(lines: DataFrame, limits: Limits = Limits(), redaction: Redaction | None = None, receive_nano: int | None = None, store: Store | None = None) -> DataFrame:
    """Every log record as a row of ``otel_logs``; fingerprints are set by ``operators.fingerprint``. With a store, what
    identifies a record (``identity``, names and identifiers) is read from it before its large values are put away."""
    rows, rest = _read(lines, "logs", redaction, receive_nano, store)
    rows = _opened(rows, _LOG)
    bags = [(F.col("res.attributes"), "resource.attributes"), (F.col("sc.attributes"), "instrumentation_scope.attributes"), (F.col("o.attributes"), "attributes"), (F.col("o.body"), "body")]
    rows = rows.withColumn("encoded", encoded(bags, [], limits, rest))
    e = Encoded(F.col("encoded"), len(bags), [])
    whole = e
    if store is not None:
        rows = rows.withColumn("encoded_whole", _whole_bags(rows, redaction).column)
        whole = Encoded(F.when(F.size("payloads") > 0, F.col("encoded_whole")).otherwise(F.col("encoded")), len(bags), [])
        parts = {"resource": _RESOURCE_BAG, "instrumentation_scope": _SCOPE_BAG, "own": _OWN_BAG, "body": _BODY_BAG}
        rows = rows.withColumn("identity", F.struct(*[c.alias(f"{n}_{kind}") for n, k in parts.items() for kind, c in (("plain", whole.plain(k)), ("types", whole.types(k)))]))
    event, seen = _nano(F.col("o.timeUnixNano")), _nano(F.col("o.observedTimeUnixNano"))
    contract = first_problem((~_fits(event), "timestamp_overflow", "time_unix_nano"), (~_fits(seen), "timestamp_overflow", "observed_time_unix_nano"))
    severity = _enum("o.severityNumber", SEVERITIES)
    unread = _malformed(["o.flags", "o.droppedAttributesCount", "res.droppedAttributesCount", "sc.droppedAttributesCount"], [severity])
    rows = _judged(rows, F.coalesce(unread, contract, e.problem()))
    received = F.timestamp_micros(F.call_function("div", F.lit(receive_nano).cast("bigint"), F.lit(1000).cast("bigint"))) if receive_nano is not None else F.current_timestamp()
    named = lambda keys: _string_attribute(whole.plain(_OWN_BAG), whole.types(_OWN_BAG), keys)
    service = F.get_json_object(whole.plain(_RESOURCE_BAG), "$['service.name']")
    columns = {
        "timestamp": F.when(event > 0, _time(event)).when(seen > 0, _time(seen)).otherwise(received), "timestamp_source": F.when(event > 0, "event").when(seen > 0, "observed").otherwise("receive"),
        "time_unix_nano": _long(event), "observed_time": F.when(seen > 0, _time(seen)), "observed_time_unix_nano": _long(seen),
        "trace_id": F.coalesce(_id(F.col("o.traceId")), F.lit("")), "span_id": F.coalesce(_id(F.col("o.spanId")), F.lit("")), "flags": _zero("o.flags"),
        "event_name": F.coalesce(F.nullif("o.eventName", F.lit("")), named(["event.name"]), F.lit("")), "severity_number": severity, "severity_text": F.col("o.severityText"),
        "body": F.coalesce(e.plain(_BODY_BAG), F.lit("null")), "body_schema": F.coalesce(e.types(_BODY_BAG), F.lit('"empty"')),
        **_bag_columns(e, _OWN_BAG), "dropped_attributes_count": _zero("o.droppedAttributesCount"),
        "resource_schema_url": F.col("resource_schema_url"), "scope_schema_url": F.col("scope_schema_url"),
        "log_name": F.coalesce(named(LOG_NAMES), F.nullif(service, F.lit("")), F.lit("default")), "insert_id": named(INSERT_IDS),
    } | _origin(e) | {"service_name": service}
    columns |= {"payload_refs": payload_refs(F.col("payloads"))} if store else {}
    return _finished(rows, columns, "otel_logs", receive_nano)


def metrics(lines: DataFrame, limits: Limits = Limits(), redaction: Redaction | None = None, receive_nano: int | None = None) -> DataFrame:
    """Every data point as a row of ``otel_metrics``; fingerprints are set by ``operators.fingerprint``."""
    rows = _opened(records(lines, "metrics"), _METRIC)
    kinds = F.array(*[F.struct(F.lit(v).alias("type"), F.lit(k).alias("key"), F.col(f"o.{k}").alias("data")) for k, v in KINDS.items()])
    rows = rows.select("*", F.explode(kinds).alias("kind")).where("kind.data IS NOT NULL")
    rows = rows.select("*", F.posexplode("kind.data.dataPoints").alias("m", "point")).withColumns({"place": F.struct("place.i", "place.j", "place.k", "m"), "p": F.from_json("point", f"{_POINT}, {_BROKEN} string", _STRICT)})
    bags = [(F.col("res.attributes"), "resource.attributes"), (F.col("sc.attributes"), "instrumentation_scope.attributes"), (F.col("o.metadata"), "metric_metadata"), (F.col("p.attributes"), "attributes")]
    lists = [(F.col("p.exemplars.filteredAttributes"), "exemplars.filtered_attributes")]
    rows = rows.withColumn("encoded", encoded(bags, lists, limits, redaction))
    e = Encoded(F.col("encoded"), len(bags), [c for c, _ in lists])
    time, start = _nano(F.col("p.timeUnixNano")), _nano(F.col("p.startTimeUnixNano"))
    contract = first_problem(
        (F.coalesce("o.name", F.lit("")) == "", "invalid_id", "metric_name"), (time == 0, "missing_timestamp", "timestamp"),
        (~_fits(time), "timestamp_overflow", "time_unix_nano"), (~_fits(start), "timestamp_overflow", "start_time_unix_nano"),
    )
    count = first_problem((F.size("p.exemplars") > limits.events, "event_count", "exemplars"))
    temporality = _enum("kind.data.aggregationTemporality", [f"AGGREGATION_TEMPORALITY_{n}" for n in _TEMPORALITIES])
    wholes = ["p.flags", "p.count", "p.scale", "p.zeroCount", "p.asInt", "p.positive.offset", "p.negative.offset", "res.droppedAttributesCount", "sc.droppedAttributesCount"]
    reals = [(F.col(f"p.{c}").isNotNull() & F.col(f"p.{c}").try_cast("double").isNull(), "malformed", _snake(c)) for c in ("asDouble", "sum", "min", "max")]
    buckets = [(F.exists(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: _whole(x).isNull()), "malformed", "bucket_counts") for c in ("p.bucketCounts", "p.positive.bucketCounts", "p.negative.bucketCounts")]
    unread = F.coalesce(_malformed(wholes, [temporality], ("o", "res", "sc", "p")), first_problem(*reals, *buckets))
    rows = _judged(rows, F.coalesce(unread, contract, e.problem(), count, e.problem(lists=True)))
    recorded = _zero("p.flags").bitwiseAND(1) == 0
    kept = lambda c: F.when(recorded, c)
    exemplars = F.transform("p.exemplars", lambda x, i: F.struct(
        F.when(_nano(x["timeUnixNano"]) > 0, _time(_nano(x["timeUnixNano"]))).alias("time"), _long(_nano(x["timeUnixNano"])).alias("time_unix_nano"), x["asDouble"].try_cast("double").alias("value_double"),
        _whole(x["asInt"]).alias("value_int64"), _id(x["traceId"]).alias("trace_id"), _id(x["spanId"]).alias("span_id"), e.member(0, i)[0].alias("filtered_attributes"), e.member(0, i)[1].alias("filtered_attributes_schema")))
    longs = lambda c: F.transform(c, _whole)
    buckets = lambda c: kept(F.when(F.size(f"{c}.bucketCounts") > 0, F.struct(_zero(f"{c}.offset").alias("offset"), longs(f"{c}.bucketCounts").alias("bucket_counts"))))
    shape = F.col("kind.type").isin("HISTOGRAM", "EXPONENTIAL_HISTOGRAM", "SUMMARY")
    columns = {
        "timestamp": _time(time), "time_unix_nano": _long(time), "start_time": F.when(start > 0, _time(start)), "start_time_unix_nano": _long(start),
        "metric_name": F.col("o.name"), "metric_description": F.col("o.description"), "metric_unit": F.col("o.unit"), "metric_type": F.col("kind.type"),
        "aggregation_temporality": _name(_TEMPORALITIES, F.when(F.col("kind.data.aggregationTemporality").isNotNull(), temporality)), "is_monotonic": F.when(F.col("kind.type") == "SUM", F.coalesce("kind.data.isMonotonic", F.lit(False))),
        "flags": _zero("p.flags"), "value_type": kept(F.when(F.col("p.asInt").isNotNull(), "INT64").when(F.col("p.asDouble").isNotNull(), "DOUBLE")),
        "value_double": kept(F.col("p.asDouble").try_cast("double")), "value_int64": kept(F.col("p.asInt").try_cast("bigint")),
        "count": kept(F.when(shape, _zero("p.count"))), **{c: kept(F.col(f"p.{c}").try_cast("double")) for c in ("sum", "min", "max")},
        "explicit_bounds": kept(F.col("p.explicitBounds")), "bucket_counts": kept(longs("p.bucketCounts")), "exp_scale": kept(_whole("p.scale")), "exp_zero_count": kept(F.col("p.zeroCount").try_cast("bigint")),
        "exp_zero_threshold": kept(F.col("p.zeroThreshold")), "exp_positive": buckets("p.positive"), "exp_negative": buckets("p.negative"), "summary_quantiles": kept(F.col("p.quantileValues")), "exemplars": exemplars,
        **_bag_columns(e, 3), "metadata": e.plain(2), "metadata_schema": e.types(2),
        "resource_schema_url": F.col("resource_schema_url"), "scope_schema_url": F.col("scope_schema_url"),
    } | _origin(e)
    return _finished(rows.withColumn("record", _metric_of_one_point()), columns, "otel_metrics", receive_nano)


def _metric_of_one_point() -> Column:
    """The metric as it came, with this point only."""
    about = members(F.col("o.name").alias("name"), F.col("o.description").alias("description"), F.col("o.unit").alias("unit"))
    metadata = F.concat(F.lit('"metadata":'), F.col("o.metadata"))
    how = members(F.col("kind.data.aggregationTemporality").alias("aggregationTemporality"), F.col("kind.data.isMonotonic").alias("isMonotonic"))
    data = F.concat(F.lit('"'), "kind.key", F.lit('":{'), F.concat_ws(",", how, F.concat(F.lit('"dataPoints":['), "point", F.lit("]"))), F.lit("}"))
    return F.concat(F.lit("{"), F.concat_ws(",", about, metadata, data), F.lit("}"))


READERS = {"traces": spans, "logs": logs, "metrics": metrics}


def malformed(lines: DataFrame) -> DataFrame:
    lines = lines if "signal" in lines.columns else with_signal(lines)
    return lines.where(F.col("signal") == "malformed")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
