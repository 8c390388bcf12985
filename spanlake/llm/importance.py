"""Importance resampling towards a target distribution, on hashed n-gram features.

Texts are read as whole Arrow buffers. A lookup table classifies each UTF-8 byte, differences of
the classes give the words' bounds, and the CRC-32 of all features that begin in a batch is
advanced by one byte a step, for all starts at once. A feature's bucket is its CRC modulo
``buckets``; documents and target are compared by their bucket counts.

A bucket's gain is ``floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets))))``, a
document's weight the floored mean of its features' gains. The Gumbel noise of a document comes
from a hash of its identifier, so that the highest scores are a sample without replacement,
proportional to the weights, and the same in every run.

Counts are summed in each task and then by bucket, so the driver gets ``buckets`` rows. Ranks come
from a range sort and the row counts of its partitions; no task holds more than its part.

Defined cases: a null or empty text has no features, and weight 0; a null identifier is hashed as
``<seed>:`` and stands before all others among equal scores; rows that share an identifier have
the same noise, and among equal ones the order is any, but each has a rank of its own; an empty
target leaves gains that only follow the documents; empty tables give an empty result; columns
whose names clash with results keep theirs, results get longer names.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM_WORDS, row_batches, staged, unstage, unused

BUCKETS = 10_000
MIN_WORDS, PERCENT, SEED = 20, 10, 2024

_FOLD = np.frombuffer(ALNUM_WORDS, np.uint8)
_IN_WORD = _FOLD != 32


def _crc_table() -> np.ndarray:
    """The byte table of the reflected CRC-32 polynomial."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, t >> 1 ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()
#: From so few words on that are still read, the rest of each is left to zlib: the words are very long ones.
_FEW = 12


def advance(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC states after the bytes from ``starts`` to ``ends``, one byte of every feature a step."""
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    state, at, size = state[order], starts[order], size[order]
    longer = np.searchsorted(-size, -np.arange(size[0] if len(size) else 0), side="left")  # how many have more than j bytes
    for j, n in enumerate(longer.tolist()):
        if n <= _FEW:
            for i in range(n):
                rest = data[at[i] + j : at[i] + size[i]].tobytes()
                state[i] = zlib.crc32(rest, int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
            break
        s = state[:n]
        state[:n] = _CRC[(s ^ data[at[:n] + j]) & 255] ^ s >> 8
    out = np.empty_like(state)
    out[order] = state
    return out


def features(texts: pa.Array, buckets: int = BUCKETS, n: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of an array of texts: bucket and row of each feature (runs of 1 to ``n`` words), and the words of each row."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, raw = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    begin, end = int(bounds[0]), int(bounds[-1])
    data = _FOLD[np.frombuffer(raw, np.uint8)[begin:end]] if raw is not None and end > begin else np.empty(0, np.uint8)
    bounds = bounds - begin
    inside = _IN_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.concatenate([[False], inside])[:-1] & ~edge[:-1]
    after = np.concatenate([inside, [False]])[1:] & ~edge[1:]
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    row = np.searchsorted(bounds, starts, side="right") - 1
    state = advance(np.full(len(starts), 0xFFFFFFFF, np.uint32), data, starts, ends)
    crc, rows = [state], [row]
    live = np.arange(len(starts))
    for k in range(1, n):  # the runs go on by a space and a word, as far as that is in the same text
        goes_on = live + k < len(starts)
        goes_on[goes_on] = row[live[goes_on] + k] == row[live[goes_on]]
        live, state = live[goes_on], state[goes_on]
        state = advance(_CRC[(state ^ np.uint32(32)) & 255] ^ state >> 8, data, starts[live + k], ends[live + k])
        crc.append(state)
        rows.append(row[live])
    found = np.concatenate(crc) ^ np.uint32(0xFFFFFFFF)
    return (found % np.uint32(buckets)).astype(np.int64), np.concatenate(rows), np.bincount(row, minlength=len(texts))


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, n: int = 1) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in row_batches(batches):
            total += np.bincount(features(b.column(0), buckets, n)[0], minlength=buckets)
        has = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(has.astype(np.int32)), pa.array(total[has])], names=["bucket", "n"])

    total = np.zeros(buckets, np.int64)
    for r in docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most `buckets` rows
        total[r["bucket"]] = r["n"]
    return total


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored gains of the buckets, in thousandths."""
    k, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    ratio = [(t + 1) * (s_all + k) / ((s + 1) * (t_all + k)) for s, t in zip(source.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def noise(doc_id: object, seed: int = SEED) -> int:
    """Floored Gumbel noise of an identifier, in thousandths."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, keep: list[str], n: int = 1, seed: int = SEED) -> tuple[DataFrame, list[str]]:
    """The columns ``keep`` with ``n_features, n_words, weight, score`` (or longer names, which come with them)."""
    kept = docs.select(*keep)
    names = [unused(c, kept) for c in ("n_features", "n_words", "weight", "score")]
    text = unused("text_read", kept)
    own = unused("id_read", kept)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in row_batches(batches):
            bucket, row, n_words = features(b.column(text), len(gain), n)
            n_features = np.bincount(row, minlength=b.num_rows)
            total = np.zeros(b.num_rows, np.int64)
            np.add.at(total, row, gain[bucket])
            weight = total // np.maximum(n_features, 1)
            found = weight + np.array([noise(d, seed) for d in b.column(own).to_pylist()], np.int64).reshape(-1)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *(pa.array(c.astype(np.int64)) for c in (n_features, n_words, weight, found))], names=[*keep, *names])

    schema = T.StructType([*kept.schema.fields, *(T.StructField(c, T.LongType()) for c in names)])
    return docs.select(*keep, F.col("text").alias(text), F.col("doc_id").alias(own)).mapInArrow(score, schema), names


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, buckets: int = BUCKETS, n: int = 1, min_words: int = MIN_WORDS, seed: int = SEED, keep: list[str] | None = None
) -> DataFrame:
    """All documents with ``n_features, weight, score`` and ``rank``: 1, 2, ... for the drawn ones, null for the others.

    Of the N documents with at least ``min_words`` words, ``floor(percent * N / 100)`` with the highest
    scores are drawn. ``keep`` names the columns that are carried along (all).
    """
    keep = docs.columns if keep is None else keep
    gain = gains(bucket_counts(docs, buckets, n), bucket_counts(target, buckets, n))
    found, (n_features, n_words, weight, score) = scored(docs, gain, keep, n, seed)
    rank, line, part = (unused(c, found) for c in ("rank", "line", "part"))
    # written once, so that line numbers stay: they part rows that are equal in all else
    found = staged(found.withColumn(line, F.monotonically_increasing_id()), "scores")
    enough = found.where(F.col(n_words) >= min_words)
    drawn = percent * enough.count() // 100
    order = [F.col(score).desc(), *([F.col("doc_id")] if "doc_id" in keep else []), F.col(line)]
    placed = staged(enough.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(part, F.monotonically_increasing_id()), "ranks")
    # an identifier holds its partition in the upper and the place there in the lower 33 bits
    task, place = F.shiftright(part, 33), F.col(part).bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(task.alias("task")).agg(F.count("*").alias("size"))  # a row for each partition
    sizes = sizes.select("task", (F.sum("size").over(Window.orderBy("task")) - F.col("size")).alias("before"))
    ranked = placed.join(F.broadcast(sizes), task == F.col("task")).withColumn(rank, F.col("before") + place + 1)
    out = [*(found[c] for c in keep), found[n_features], found[weight], found[score]]
    top = ranked.select(*(F.col(c) for c in [*keep, n_features, weight, score]), F.when(F.col(rank) <= drawn, F.col(rank)).alias(rank))
    rest = found.where(F.col(n_words) < min_words).select(*out, F.lit(None).cast("long").alias(rank))
    return top.unionByName(rest)
