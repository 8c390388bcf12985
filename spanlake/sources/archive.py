"""Archives of export requests as a data source: ``spark.read.format("telemetry_archive").load(path)``.

Each file is a partition and is read as a stream, so a file's size doesn't matter. Gzip is told by a
file's first two bytes, whatever its name. Every line that isn't blank gives a row: ``file``, ``line``
(from 1), ``value``, and ``problem`` where the line can't be used: ``line_too_long`` (more than ``maxLineBytes``
bytes; the value isn't kept), ``not_utf8``, or ``broken_file`` (the compressed stream ends early or is damaged, at this line).
File and line name a request for good: they don't depend on how a job is split.

The path is a file, a folder (read with all below it, but for names that begin with ``.`` or ``_``) or a pattern with ``*``, ``?`` and ``[...]`` in its last
parts; a local path or a URI of a file system that Arrow knows.
"""

from __future__ import annotations

import gzip
import io
import zlib
from collections.abc import Iterator
from fnmatch import fnmatchcase
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

NAME = "telemetry_archive"
SCHEMA = "file string, line bigint, value string, problem string"
MAX_LINE_BYTES = 64 << 20
CHUNK_BYTES, BATCH_BYTES = 1 << 20, 8 << 20

_ARROW = pa.schema([("file", pa.string()), ("line", pa.int64()), ("value", pa.string()), ("problem", pa.string())])
_BROKEN = (EOFError, gzip.BadGzipFile, zlib.error)


def located(path: str) -> tuple[fs.FileSystem, str, str]:
    """File system, path in it, and what stands before that path in a URI."""
    parts = urlsplit(path)
    if len(parts.scheme) < 2:
        return fs.LocalFileSystem(), path, ""
    if parts.scheme == "file":
        return fs.LocalFileSystem(), parts.path, "file://"
    system, base = fs.FileSystem.from_uri(f"{parts.scheme}://{parts.netloc}")
    return system, f"{base.rstrip('/')}{parts.path}" if base else parts.path, f"{parts.scheme}://{parts.netloc}"


def _is_pattern(part: str) -> bool:
    return any(c in part for c in "*?[")


def files(path: str) -> list[str]:
    """The names of all files of an archive, sorted."""
    system, at, before = located(path)
    parts = at.rstrip("/").split("/")
    fixed = next((i for i, p in enumerate(parts) if _is_pattern(p)), len(parts))
    heads = ["/".join(parts[:fixed]) or "/"]
    for k in range(fixed, len(parts)):
        found = [i for h in heads for i in system.get_file_info(fs.FileSelector(h, allow_not_found=True))]
        named = [i for i in found if fnmatchcase(i.base_name, parts[k]) and (i.base_name[:1] not in "._" or parts[k][:1] in "._")]
        heads = [i.path for i in named if k == len(parts) - 1 or i.type == fs.FileType.Directory]
    out = []
    for info in system.get_file_info(heads):
        if info.type == fs.FileType.File:
            out.append(info.path)
        elif info.type == fs.FileType.Directory:
            inner = system.get_file_info(fs.FileSelector(info.path, recursive=True))
            out += [i.path for i in inner if i.type == fs.FileType.File and not any(p[:1] in "._" for p in i.path[len(info.path) :].strip("/").split("/"))]
    if not out and fixed == len(parts) and system.get_file_info(at).type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    return sorted(f"{before}{p}" for p in out)


def opened(name: str) -> io.BufferedIOBase:
    """The file's bytes, decompressed if they begin like gzip."""
    system, at, _ = located(name)
    raw = io.BufferedReader(system.open_input_stream(at, compression=None, buffer_size=CHUNK_BYTES), CHUNK_BYTES)
    return gzip.GzipFile(fileobj=raw) if raw.peek(2)[:2] == b"\x1f\x8b" else raw


def lines_of(file: io.BufferedIOBase, limit: int) -> Iterator[tuple[int, bytes | None, str | None]]:
    """Number, bytes and problem of each line that isn't blank; no more than a line of the limit is held."""
    number, held, too_long = 0, b"", False
    while True:
        try:
            piece = file.readline(CHUNK_BYTES)
        except _BROKEN:
            yield number + 1, None, "broken_file"
            return
        if not piece:
            if too_long or held.strip():
                yield number + 1, None if too_long else held, "line_too_long" if too_long else None
            return
        if not too_long:
            too_long = len(held) + len(piece.removesuffix(b"\n")) > limit
            held = b"" if too_long else held + piece
        if piece.endswith(b"\n"):
            number += 1
            if too_long:
                yield number, None, "line_too_long"
            elif held.strip():
                yield number, held, None
            held, too_long = b"", False


class _File(InputPartition):
    def __init__(self, name: str):
        self.name = name


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        given = {k.lower(): v for k, v in options.items()}
        self.path, self.limit = given["path"], int(given.get("maxlinebytes", MAX_LINE_BYTES))

    def partitions(self) -> list[InputPartition]:
        return [_File(f) for f in files(self.path)]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)

        if partition is None or not hasattr(partition, "name"):
            return  # an archive without files
        with opened(partition.name) as file:
            for number, raw, problem in lines_of(file, self.limit):
                text = None
                if raw is not None:
                    try:
                        text = raw.strip().decode()
                    except UnicodeDecodeError:
                        problem = "not_utf8"
                rows.append((partition.name, number, text, problem))
                size += len(raw or b"") + 64
                if size >= BATCH_BYTES:
                    yield batch()
                    rows, size = [], 0
        if rows:
            yield batch()


class ArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(dict(self.options))


def lines(spark: SparkSession, path: str, max_line_bytes: int = MAX_LINE_BYTES) -> DataFrame:
    """The rows of an archive."""
    spark.dataSource.register(ArchiveSource)
    return spark.read.format(NAME).option("maxLineBytes", str(max_line_bytes)).load(path)
