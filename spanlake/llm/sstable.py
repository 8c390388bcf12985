"""Sorted-string-table shards of token ids.

A shard holds documents in ascending key order:

``block* | index block | Bloom filter | footer``

* A block holds entries ``shared, unshared, value length`` (varints), the key's suffix and
  the value; every 16th key is stored whole and its place listed behind the entries, so a
  block can be searched by bisection. Blocks are zstd-compressed.
* The index block has the last key, place and size of every block (a sparse index).
* The footer has the places of index and filter, the counts and a magic number.

A value is the document's ids, little-endian, two bytes each where the vocabulary allows it.
Tasks write shards under a temporary name and then rename them, so a lost or repeated task
leaves whole files only; a manifest table lists the shards that count.

Defined cases: a null text has no ids but the end id; a null identifier sorts first;
repeated identifiers stay as entries of their own (ties by text); an empty table gives no
shards and an empty result; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import row_batches, shared_dir, staged, text_bytes
from .tokens import encoder, tokenizer_path

MAGIC = b"SPLSST01"
FOOTER = struct.Struct("<QQQQQQIII8s")
BLOCK_BYTES = 64 << 10
RESTART_EVERY = 16
SHARD_BYTES = 16 << 20
#: Bytes of ids in one batch that is read, and tasks that read at most.
READ_BYTES, MAX_READ_TASKS = 2 << 20, 20_000
BLOOM_BITS_PER_KEY, BLOOM_HASHES = 10, 7
MANIFEST = "shard string, part int, seq int, docs long, tokens long, bytes long, first_key binary, last_key binary"


def encode_key(key: int | str | None) -> bytes:
    """Bytes that sort as the keys do: null, then integers, then strings."""
    if key is None:
        return b"\x00"
    if isinstance(key, str):
        return b"\x02" + key.encode("utf-8", "surrogatepass")
    return b"\x01" + (int(key) + (1 << 63)).to_bytes(8, "big")


def decode_key(raw: bytes) -> int | str | None:
    if raw[:1] == b"\x00":
        return None
    return raw[1:].decode("utf-8", "surrogatepass") if raw[:1] == b"\x02" else int.from_bytes(raw[1:], "big") - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n >= 128:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(buf: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = buf[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _bloom_places(key: bytes, n_bits: int) -> list[int]:
    import xxhash

    a, b = xxhash.xxh64_intdigest(key, 1), xxhash.xxh64_intdigest(key, 2) | 1
    return [(a + i * b) % n_bits for i in range(BLOOM_HASHES)]


class ShardWriter:
    """Builds the bytes of one shard from entries in ascending key order."""

    def __init__(self, width: int):
        self.width, self.out, self.index, self.keys = width, bytearray(), [], []
        self.docs = self.tokens = 0
        self._zstd = zstandard.ZstdCompressor(level=1)
        self._start_block()

    def _start_block(self) -> None:
        self.block, self.restarts, self.last, self.in_block = bytearray(), [], b"", 0

    def add(self, key: bytes, ids: np.ndarray) -> None:
        value = ids.astype("<u2" if self.width == 2 else "<u4").tobytes()
        shared = 0
        if self.in_block % RESTART_EVERY:
            most = min(len(key), len(self.last))
            while shared < most and key[shared] == self.last[shared]:
                shared += 1
        else:
            self.restarts.append(len(self.block))
        self.block += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        self.last, self.in_block = key, self.in_block + 1
        self.keys.append(key)
        self.docs += 1
        self.tokens += len(ids)
        if len(self.block) >= BLOCK_BYTES:
            self._end_block()

    def _end_block(self) -> None:
        if not self.in_block:
            return
        raw = bytes(self.block) + struct.pack(f"<{len(self.restarts) + 1}I", *self.restarts, len(self.restarts))
        packed = self._zstd.compress(raw)
        self.index.append((self.last, len(self.out), len(packed)))
        self.out += packed
        self._start_block()

    def size(self) -> int:
        return len(self.out) + len(self.block)

    def finish(self) -> bytes:
        self._end_block()
        index_at = len(self.out)
        for key, at, size in self.index:
            self.out += struct.pack("<IQI", len(key), at, size) + key
        n_bits = max(64, len(self.keys) * BLOOM_BITS_PER_KEY)
        bits = np.zeros(n_bits, dtype=bool)
        for key in set(self.keys):
            bits[_bloom_places(key, n_bits)] = True
        bloom_at = len(self.out)
        self.out += np.packbits(bits).tobytes()
        self.out += FOOTER.pack(
            index_at, bloom_at - index_at, bloom_at, len(self.out) - bloom_at, self.docs, self.tokens,
            len(self.index), n_bits, self.width, MAGIC,
        )
        return bytes(self.out)


class ShardReader:
    """Reads a shard block by block: whole, or one key by filter, index and bisection."""

    def __init__(self, file: pa.NativeFile):
        self.file = file
        end = file.size()
        f = FOOTER.unpack(file.read_at(FOOTER.size, end - FOOTER.size))
        if f[-1] != MAGIC:
            raise ValueError("not a shard of this format")
        index_at, index_size, bloom_at, bloom_size, self.docs, self.tokens, n_blocks, self.n_bits, self.width = f[:-1]
        self.bloom = np.unpackbits(np.frombuffer(file.read_at(bloom_size, bloom_at), np.uint8))
        self.index, at, raw = [], 0, file.read_at(index_size, index_at)
        for _ in range(n_blocks):
            n, place, size = struct.unpack_from("<IQI", raw, at)
            self.index.append((raw[at + 16 : at + 16 + n], place, size))
            at += 16 + n
        self._zstd = zstandard.ZstdDecompressor()

    def _block(self, i: int) -> tuple[bytes, list[int]]:
        _, at, size = self.index[i]
        raw = self._zstd.decompress(self.file.read_at(size, at))
        n = struct.unpack_from("<I", raw, len(raw) - 4)[0]
        end = len(raw) - 4 * (n + 1)
        return raw[:end], list(struct.unpack_from(f"<{n}I", raw, end))

    def _entries(self, raw: bytes, at: int) -> Iterator[tuple[bytes, np.ndarray]]:
        last = b""
        while at < len(raw):
            shared, at = _read_varint(raw, at)
            unshared, at = _read_varint(raw, at)
            size, at = _read_varint(raw, at)
            last = last[:shared] + raw[at : at + unshared]
            at += unshared
            yield last, np.frombuffer(raw, "<u2" if self.width == 2 else "<u4", size // self.width, at)
            at += size

    def __iter__(self) -> Iterator[tuple[bytes, np.ndarray]]:
        for i in range(len(self.index)):
            yield from self._entries(self._block(i)[0], 0)

    def get(self, key: int | str | None) -> list[np.ndarray]:
        """The ids of every entry with this key, in stored order."""
        k = encode_key(key)
        if not self.index or not all(self.bloom[p] for p in _bloom_places(k, self.n_bits)):
            return []
        found: list[np.ndarray] = []
        for i in range(bisect_left([x[0] for x in self.index], k), len(self.index)):
            raw, restarts = self._block(i)
            heads = [next(self._entries(raw, r))[0] for r in restarts]
            for entry, ids in self._entries(raw, restarts[max(0, bisect_left(heads, k) - 1)]):
                if entry == k:
                    found.append(ids)
                elif entry > k:
                    return found
        return found


def open_shard(uri: str, name: str) -> pa.NativeFile:
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(f"{path}/{name}")


def _store(uri: str, name: str, raw: bytes) -> None:
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    context = TaskContext.get()
    temporary = f"{path}/_{name}.{context.taskAttemptId() if context else 0}"
    with system.open_output_stream(temporary) as f:
        f.write(raw)
    system.move(temporary, f"{path}/{name}")


def write_shards(
    docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 2, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """Encodes all texts, writes shards below ``path`` (a URI that all executors share) and returns the manifest."""
    spark, tok = docs.sparkSession, tokenizer or tokenizer_path()
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(at)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, writer, first = TaskContext.get().partitionId(), 0, None, b""
        enc = encoder(tok)
        width = 2 if max(len(enc.ends_word) - 1, end_id) < 1 << 16 else 4

        def close() -> pa.RecordBatch:
            name, last = f"shard-{part:06d}-{seq:05d}.sst", writer.keys[-1]
            raw = writer.finish()
            _store(path, name, raw)
            row = {"shard": name, "part": part, "seq": seq, "docs": writer.docs, "tokens": writer.tokens, "bytes": len(raw), "first_key": first, "last_key": last}
            return pa.RecordBatch.from_pylist([row], schema=_MANIFEST_ARROW)

        for b in row_batches(batches, 1_500_000):
            keys, texts = b.column(0).to_pylist(), [text_bytes(t) for t in b.column(1).to_pylist()]
            for key, ids in zip(keys, enc.encode(texts)):
                if writer is None:
                    writer, first = ShardWriter(width), encode_key(key)
                writer.add(encode_key(key), np.append(ids, np.uint32(end_id)))
                if writer.size() >= shard_bytes:
                    yield close()
                    writer, seq = None, seq + 1
        if writer is not None:
            yield close()

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return staged(ordered.mapInArrow(write, MANIFEST), "manifest")


_MANIFEST_ARROW = pa.schema(
    [("shard", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("docs", pa.int64()), ("tokens", pa.int64()), ("bytes", pa.int64()), ("first_key", pa.binary()), ("last_key", pa.binary())]
)


def read_shards(spark: SparkSession, path: str, manifest: DataFrame, key_type: str = "long") -> DataFrame:
    """One row for each stored document, from the files: key, place in the whole sequence, count and ids.

    Places are sums over the manifest, which has a row for each shard of many megabytes. Tasks get
    shards by name and read them block by block.
    """
    w = Window.orderBy("part", "seq")
    starts = manifest.select("shard", (F.sum("tokens").over(w) - F.col("tokens")).alias("shard_start"))
    names = ["doc_id", "start", "n_tokens", "ids", "ids_crc32"]
    types = (_key_type(key_type), pa.int64(), pa.int64(), pa.binary(), pa.int64())

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, at in zip(*(c.to_pylist() for c in b.columns)):
                out, size = [], 0
                with open_shard(path, name) as file:
                    for key, ids in ShardReader(file):
                        packed = ids.astype("<u4").tobytes()
                        out.append((decode_key(key), at, len(ids), packed, zlib.crc32(packed)))
                        at, size = at + len(ids), size + len(packed)
                        if size >= READ_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                            out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    tasks = min(max(1, manifest.count()), MAX_READ_TASKS)
    return starts.repartition(tasks).mapInArrow(decode, f"doc_id {key_type}, start long, n_tokens long, ids binary, ids_crc32 long")


def _key_type(key_type: str) -> pa.DataType:
    return pa.string() if key_type == "string" else pa.int64()


def lookup(spark: SparkSession, path: str, manifest: DataFrame, keys: DataFrame, key_type: str = "long") -> DataFrame:
    """Entries of the given keys (column ``doc_id``), found by filter, index and bisection in each shard that may hold them.

    The driver holds the key range of each write task; within a task's shards keys are joined.
    """
    ranges = manifest.groupBy("part").agg(F.min("first_key").alias("low"), F.max("last_key").alias("high")).orderBy("part").collect()  # a row for each write task
    lows, highs, parts = ([bytes(r["low"]) for r in ranges], [bytes(r["high"]) for r in ranges], [r["part"] for r in ranges])

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ks = [encode_key(k) for k in b.column(0).to_pylist()]
            within = [parts[bisect_left(highs, k) : bisect_right(lows, k)] for k in ks]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ks, pa.binary()), pa.array(within, pa.list_(pa.int32()))], names=["doc_id", "key", "parts"])

    wanted = keys.select(F.col("doc_id").cast(key_type)).distinct().mapInArrow(locate, f"doc_id {key_type}, key binary, parts array<int>")
    wanted = wanted.select("doc_id", "key", F.explode("parts").alias("part"))
    held = wanted.join(manifest.select("shard", "part", "first_key", "last_key"), "part").where("key >= first_key AND key <= last_key")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", _key_type(key_type)), ("n_tokens", pa.int64()), ("ids", pa.binary())])
        opened, shard = None, None
        for b in batches:
            for name, k in zip(*(c.to_pylist() for c in b.columns)):
                if name != opened:
                    opened, shard = name, ShardReader(open_shard(path, name))
                rows = [{"doc_id": k, "n_tokens": len(ids), "ids": ids.astype("<u4").tobytes()} for ids in shard.get(k)]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return held.select("shard", "doc_id").repartition("shard").sortWithinPartitions("shard", "doc_id").mapInArrow(find, f"doc_id {key_type}, n_tokens long, ids binary")


def write_and_read(docs: DataFrame, end_id: int = 2, tokenizer: str | None = None) -> DataFrame:
    """Writes all documents as shards in the shared folder and reads them back."""
    spark = docs.sparkSession
    path = shared_dir(spark, "shards")
    manifest = write_shards(docs, path, tokenizer, end_id)
    return read_shards(spark, path, manifest)
