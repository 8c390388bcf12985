"""Large payloads in a table of their own, once for each content.

A payload of ``min_bytes`` to ``max_bytes`` bytes is replaced by ``<offloaded:uri>``; the address is
that of its content, so the same payload is stored once however often it comes. ``offloaded`` does so
for a text column, ``records_without_large`` for all values of export records, however deep.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from ..functions.anyvalue import BrokenLimit, Redaction, bytes_of, keyed, listed, pieces, text_of

MIN_BYTES, MAX_BYTES = 256 << 10, 64 << 20


def address(prefix: str, signal: str, day: Column, digest: Column) -> Column:
    return F.concat_ws("/", F.lit(prefix.rstrip("/")), F.lit(signal), F.date_format(day, "yyyy-MM-dd"), digest)


def offloaded(rows: DataFrame, column: str, day: Column, prefix: str, signal: str, min_bytes: int = MIN_BYTES, max_bytes: int = MAX_BYTES, mime: str = "text/plain") -> tuple[DataFrame, DataFrame]:
    """(rows with references, objects). Rows get ``payload_refs`` with an element for each payload put away;
    objects have ``uri, sha256, byte_size, content``, one row for each address."""
    size = F.octet_length(column)
    large = size.between(min_bytes, max_bytes)
    marked = rows.withColumns({"__sha": F.when(large, F.sha2(F.col(column).cast("binary"), 256)), "__size": size.cast("bigint")})
    marked = marked.withColumn("__uri", F.when(F.col("__sha").isNotNull(), address(prefix, signal, day, F.col("__sha"))))
    objects = marked.where("__uri IS NOT NULL").select(F.col("__uri").alias("uri"), F.col("__sha").alias("sha256"), F.col("__size").alias("byte_size"), F.col(column).alias("content")).dropDuplicates(["uri"])
    ref = F.struct(
        F.lit(column).alias("attribute_path"), F.lit(0).cast("bigint").alias("part_index"), F.lit(mime).alias("mime_type"), F.lit("object").alias("storage_mode"), F.col("__size").alias("byte_size"), F.col("__sha").alias("sha256"),
        F.struct(F.col("__uri").alias("uri"), F.lit(None).cast("string").alias("version"), F.lit(None).cast("string").alias("authorizer"), F.lit(None).cast("string").alias("details")).alias("object_ref"),
    )
    refs = F.when(F.col("__uri").isNotNull(), F.array(ref)).otherwise(F.filter(F.array(ref), lambda r: F.lit(False)))
    text = F.when(F.col("__uri").isNotNull(), F.concat(F.lit("<offloaded:"), "__uri", F.lit(">"))).otherwise(F.col(column))
    return marked.withColumns({column: text, "payload_refs": refs}).drop("__sha", "__size", "__uri"), objects


class Store(NamedTuple):
    """Where payloads go, and from which size to which."""

    prefix: str
    min_bytes: int = MIN_BYTES
    max_bytes: int = MAX_BYTES


TEXT_TYPE, BYTES_TYPE = "text/plain; charset=utf-8", "application/octet-stream"
PAYLOAD = "struct<path:string, mime:string, uri:string, sha256:string, byte_size:bigint, content:binary>"
_PARTS = ["resource_text", "scope_text", "record"]


class _Walk:
    """Takes large values out of one record, in the order of their paths."""

    def __init__(self, store: Store, folder: str):
        self.store, self.folder, self.found = store, folder, []

    def value(self, v: object, path: str) -> None:
        if not isinstance(v, dict):
            return
        if "stringValue" in v:
            self.take(v, path, text_of(v["stringValue"]).encode("utf-8", "replace"), TEXT_TYPE)
        elif "bytesValue" in v:
            self.take(v, path, bytes_of(v["bytesValue"]), BYTES_TYPE)
        elif "kvlistValue" in v:
            self.bag((v["kvlistValue"] or {}).get("values"), path)
        elif "arrayValue" in v:
            for i, x in enumerate(listed(v["arrayValue"])):
                self.value(x, f"{path}[{i}]")

    def bag(self, pairs: object, path: str) -> None:
        """By the bytes of the keys; of a repeated key the first counts."""
        first: dict[str, object] = {}
        for key, value in keyed(pairs):
            first.setdefault(key, value)
        for key in sorted(first, key=lambda k: k.encode("utf-8", "surrogatepass")):
            self.value(first[key], f"{path}.{key}")

    def take(self, v: dict, path: str, content: bytes, mime: str) -> None:
        if self.store.min_bytes <= len(content) <= self.store.max_bytes:
            sha = hashlib.sha256(content).hexdigest()
            uri = f"{self.folder}/{sha}"
            self.found.append({"path": path, "mime": mime, "uri": uri, "sha256": sha, "byte_size": len(content), "content": content})
            v.clear()
            v["stringValue"] = f"<offloaded:{uri}>"


def _masked(part: dict | None, redaction: Redaction | None) -> None:
    """Masks a part's bags in place: what is put away must not hold what would be masked."""
    for holder in [part or {}, *((part or {}).get("events") or []), *((part or {}).get("links") or [])]:
        if redaction and holder.get("attributes"):
            holder["attributes"] = redaction.bag(holder["attributes"])
    if redaction and redaction.log_body and (part or {}).get("body"):
        part["body"] = redaction.value(part["body"])


def without_large(texts: list[str | None], store: Store, folder: str, redaction: Redaction | None = None) -> tuple[list[str | None], list[dict]]:
    """The JSON of resource, scope and record with references in place of large values, and these values. A record that
    can't be read stays as it is: what is wrong with it is told where it is encoded."""
    if redaction is None and all(4 * len(t or "") < store.min_bytes for t in texts):
        return texts, []
    walk = _Walk(store, folder)
    try:
        parts = [json.loads(t) if t else None for t in texts]
        for p in parts:
            _masked(p, redaction)
        resource, scope, record = (p or {} for p in parts)
        walk.value(record.get("body"), "body")
        walk.bag(resource.get("attributes"), "resource.attributes")
        walk.bag(scope.get("attributes"), "instrumentation_scope.attributes")
        walk.bag(record.get("attributes"), "attributes")
        for name in ("events", "links"):
            for i, e in enumerate(record.get(name) or []):
                walk.bag(e.get("attributes"), f"{name}[{i}].attributes")
    except (BrokenLimit, ValueError, AttributeError, TypeError, RecursionError):
        return texts, []
    return ([json.dumps(p) if p is not None else None for p in parts] if walk.found or redaction else texts), walk.found


def records_without_large(rows: DataFrame, signal: str, store: Store, day: Column, redaction: Redaction | None = None) -> DataFrame:
    """Records (``sources.otlp.records``) with ``light_`` forms of their texts, and ``payloads``: what was taken out."""
    folder = F.concat_ws("/", F.lit(store.prefix.rstrip("/")), F.lit(signal), F.date_format(day, "yyyy-MM-dd"))

    @arrow_udf(f"struct<{', '.join(f'{c}:string' for c in _PARTS)}, payloads:array<{PAYLOAD}>>")
    def walk(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        payload = pa.struct([("path", pa.string()), ("mime", pa.string()), ("uri", pa.string()), ("sha256", pa.string()), ("byte_size", pa.int64()), ("content", pa.binary())])
        for column in pieces(columns):
            out = []
            for row in column.to_pylist():
                texts, found = without_large([row[c] for c in _PARTS], store, row["folder"], redaction)
                out.append(dict(zip(_PARTS, texts)) | {"payloads": found})
            yield pa.array(out, pa.struct([*((c, pa.string()) for c in _PARTS), ("payloads", pa.list_(payload))]))

    rows = rows.withColumn("__light", walk(F.struct(*_PARTS, folder.alias("folder"))))
    return rows.select(*rows.columns[:-1], *[F.col(f"__light.{c}").alias(f"light_{c}") for c in _PARTS], F.col("__light.payloads").alias("payloads"))


def payload_refs(payloads: Column) -> Column:
    """What a row keeps of its payloads."""
    return F.transform(payloads, lambda p: F.struct(
        p["path"].alias("attribute_path"), F.lit(0).cast("bigint").alias("part_index"), p["mime"].alias("mime_type"), F.lit("object").alias("storage_mode"), p["byte_size"].alias("byte_size"), p["sha256"].alias("sha256"),
        F.struct(p["uri"].alias("uri"), F.lit(None).cast("string").alias("version"), F.lit(None).cast("string").alias("authorizer"), F.lit(None).cast("string").alias("details")).alias("object_ref"),
    ))


def objects(rows: DataFrame) -> DataFrame:
    """One row for each address among the rows' payloads: ``uri, sha256, byte_size, mime_type, content``."""
    p = rows.select(F.explode("payloads").alias("p"))
    return p.select("p.uri", "p.sha256", "p.byte_size", F.col("p.mime").alias("mime_type"), "p.content").dropDuplicates(["uri"])
