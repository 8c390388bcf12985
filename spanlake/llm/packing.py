"""Packing of token sequences by non-negative least squares over length patterns.

1. Spark tokenizes the documents, cuts long ones and stages one small row for each piece.
2. The histogram of lengths (at most ``capacity`` rows) goes to the driver.
3. Patterns of up to three binned lengths that fill a sequence are fitted to the histogram
   by non-negative least squares; the repeat counts are rounded down, each pattern is drawn
   with exact lengths, and gaps and residual lengths are filled by best fit.
4. The plan is a list of rank intervals for each length; its size depends on the capacity,
   not on the number of pieces. Spark ranks the pieces of each length and looks them up.

Pieces of a very common length are ranked in several groups, so no task gets all of them.

Defined cases: a null or empty text is one piece (the end id alone); a null identifier is
kept; repeated rows are packed each; an empty table gives an empty result; other columns
are ignored. Ties between pieces of one length go by identifier, piece and checksum.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import row_batches, staged, text_bytes
from .tokens import encoder, tokenizer_path

CAPACITY = 4096
BINS = 128
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = 1, tokenizer: str | None = None) -> DataFrame:
    """One row for each piece: its place in the document, length and checksum of ids."""
    tok = tokenizer or tokenizer_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in row_batches(batches, 1_500_000):
            keys, texts = b.column(0).to_pylist(), [text_bytes(t) for t in b.column(1).to_pylist()]
            out: list[list] = [[], [], [], [], []]
            for key, ids in zip(keys, encoder(tok).encode(texts)):
                raw = ids.tobytes() + int(end_id).to_bytes(4, "little")
                for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at : at + 4 * capacity]
                    for column, v in zip(out, (key, piece, at // 4, len(part) // 4, zlib.crc32(part))):
                        column.append(v)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2_000) -> np.ndarray:
    """The non-negative x with the least |ax - b|, by active sets (Lawson and Hanson)."""
    n = a.shape[1]
    x, free = np.zeros(n), np.zeros(n, dtype=bool)
    near = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(rounds):
        slope = a.T @ (b - a @ x)
        slope[free] = -np.inf
        best = int(np.argmax(slope)) if n else 0
        if not n or slope[best] <= near:
            break
        free[best] = True
        while True:
            trial = np.zeros(n)
            trial[free] = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            low = free & (trial <= 0)
            if not low.any():
                x = trial
                break
            gap = x[low] - trial[low]
            step = np.min(np.where(gap > 0, x[low] / np.where(gap > 0, gap, 1), 0))
            x = x + step * (trial - x)
            free &= x > 1e-12
            x[~free] = 0
            if not free.any():
                break
    return x


def length_patterns(present: list[int], total: int) -> list[tuple[int, ...]]:
    """Patterns of one to three of the bins in ``present`` that sum to ``total`` bins, largest first."""
    have = set(present)
    found: list[tuple[int, ...]] = [(total,)] if total in have else []
    for a in present:
        if total - a in have and a >= total - a:
            found.append((a, total - a))
        for b in present:
            c = total - a - b
            if a >= b >= c > 0 and c in have:
                found.append((a, b, c))
    return found


def packing_plan(histogram: dict[int, int], capacity: int = CAPACITY, bins: int = BINS) -> list[tuple[tuple[int, ...], int]]:
    """Lengths that share a sequence, and how many such sequences: every piece of the histogram once."""
    left = {n: c for n, c in histogram.items() if c > 0}
    order = sorted(left)
    plan: list[tuple[tuple[int, ...], int]] = []
    bins = min(bins, capacity)
    width = -(-capacity // bins)
    of_bin: dict[int, list[int]] = {}
    for n in order:
        of_bin.setdefault(-(-n // width), []).append(n)

    def drawn(chosen: list[int], most: int) -> int:
        """Fills the gap behind the chosen lengths by best fit and books as many such sequences as there are pieces."""
        gap = capacity - sum(chosen)
        took = {n: chosen.count(n) for n in chosen}
        while (i := bisect_right(order, gap)) > 0:
            while i and left[order[i - 1]] <= took.get(order[i - 1], 0):
                i -= 1
            if not i:
                break
            n = order[i - 1]
            chosen.append(n)
            took[n] = took.get(n, 0) + 1
            gap -= n
        times = min([most, *(left[n] // c for n, c in took.items())])
        for n, c in took.items():
            left[n] -= c * times
            if not left[n]:
                order.remove(n)
                of_bin[-(-n // width)].remove(n)
        plan.append((tuple(sorted(chosen, reverse=True)), times))
        return times

    present = sorted(of_bin)
    patterns = length_patterns(present, -(-capacity // width))
    if patterns:
        row = {b: i for i, b in enumerate(present)}
        a = np.zeros((len(present), len(patterns)))
        for j, p in enumerate(patterns):
            for b in p:
                a[row[b], j] += 1
        goal = np.array([sum(left[n] for n in of_bin[b]) for b in present], dtype=float)
        counts = np.floor(nnls(a, goal)).astype(int)
        for j in np.argsort(-counts, kind="stable"):
            want = int(counts[j])
            while want > 0:
                chosen: list[int] = []
                for b in patterns[j][: max(1, len(patterns[j]) - 1)]:
                    # the last place is left to best fit, which finds the exact length
                    n = next((n for n in reversed(of_bin[b]) if left[n] > chosen.count(n)), None)
                    if n is not None:
                        chosen.append(n)
                if not chosen:
                    break
                want -= drawn(chosen, want)
    while order:
        drawn([order[-1]], left[order[-1]])
    return plan


def plan_intervals(plan: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first rank, ranks, first sequence, offset), by length and first rank."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for lengths, times in plan:
        at = 0
        for n in lengths:
            rows.append((n, used.get(n, 0), times, base, at))
            used[n] = used.get(n, 0) + times
            at += n
        base += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a staged table of pieces (columns of ``token_pieces``)."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    if not counts:
        return pieces.withColumns({"sequence_id": F.lit(0).cast("long"), "offset": F.lit(0).cast("long")})
    rows = plan_intervals(packing_plan(counts, capacity))
    lengths, firsts, _, bases, offsets = (np.ascontiguousarray(c) for c in rows.T)
    begins = {int(n): (int(i), int(j)) for n in np.unique(lengths) for i, j in [np.searchsorted(lengths, [n, n + 1])]}
    group_rows = max(1_000, -(-sum(counts.values()) // 100_000))
    groups = spark.createDataFrame([(n, -(-c // group_rows)) for n, c in counts.items()], "length long, groups long")
    salted = pieces.join(F.broadcast(groups), "length").withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.col("groups"))
    )
    sizes = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt")
    sizes = sizes.select("length", "salt", (F.sum("n").over(before) - F.col("n")).alias("before"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (
        salted.withColumn("nth", F.row_number().over(within))
        .join(sizes, ["length", "salt"])
        .select(*pieces.columns, (F.col("nth") - 1 + F.col("before")).alias("rank"))
    )

    names = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            row = np.empty(len(rank), dtype=np.int64)
            for n in np.unique(length):
                i, j = begins[int(n)]
                row[length == n] = i + np.searchsorted(firsts[i:j], rank[length == n], side="right") - 1
            found = {"sequence_id": bases[row] + rank - firsts[row], "offset": offsets[row]}
            kept = [b.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*kept, *map(pa.array, found.values())], names=[*names, *found])

    return ranked.mapInArrow(place, f"{PIECES}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = 1, tokenizer: str | None = None
) -> DataFrame:
    """Packs all documents: one row for each piece with its sequence and place there."""
    return pack(staged(token_pieces(docs, capacity, end_id, tokenizer), "pieces"), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """One row for each sequence: its pieces in order and its length."""
    part = F.struct("offset", "doc_id", "piece", "start", "length")
    return packed.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(part)).alias("pieces"), F.sum("length").alias("length")
    )
