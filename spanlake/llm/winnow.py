"""Document fingerprints by winnowing.

Rolling hashes of all k-grams of code points; in every window of ``WINDOW`` hashes the smallest is
selected, the rightmost of ties; hashes and positions are kept. The window is the same for every
text; one with fewer k-grams is a single window. Two texts that share a passage of
``k + WINDOW - 1`` code points share a fingerprint. A text shorter than ``k`` is one k-gram.

Defined cases: a null text counts as empty, an empty text has no fingerprints (alike 1 to
another empty text, else 0); equal texts have equal fingerprints; a null identifier sorts
first; rows with equal identifiers are ordered by text; a table of one document has itself as
the next; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_batches
from .shingles import mix

K, WINDOW = 8, 32
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_STEP = 1 << 20


def _gram_hashes(c: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-grams: a polynomial over the code points, each plus one, from the power k - 1
    down to 0, whose bits are then spread. Built by joining runs of powers of two."""
    x = c.astype(np.uint64) + np.uint64(1)
    m = len(x) - k + 1
    total, done, n, run, factor = np.zeros(m, np.uint64), 0, 1, x, int(_FACTOR)
    while True:
        if k & n:  # the binary digits of k tell which runs make up a k-gram
            total = total * np.uint64(factor) + run[done : done + m]
            done += n
            if done == k:
                break
        run = run[:-n] * np.uint64(factor) + run[n:]
        factor, n = factor * factor % (1 << 64), 2 * n
    return mix(total)


def _keys(hashes: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Keys in the order of the hashes, and rightmost first among equal ones."""
    return hashes.astype(np.uint64) << np.uint64(32) | (np.uint64(0xFFFFFFFF) - positions.astype(np.uint64))


def _minima(keys: np.ndarray, w: int) -> np.ndarray:
    """The places that windows of ``w`` keys select."""
    low, size = keys, 1
    while size < w:
        step = min(size, w - size)
        low = np.minimum(low[:-step], low[step:])
        size += step
    return np.unique((np.uint64(0xFFFFFFFF) - (low & np.uint64(0xFFFFFFFF))).astype(np.int64))


def winnow(text: str, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of the selected k-grams; 32-bit hashes, positions in code points."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if not len(c):
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    k = min(k, len(c))
    n = len(c) - k + 1
    w = min(window, n)
    kept = []
    for at in range(0, n - w + 1, _STEP):  # blocks of windows; those of a block need w - 1 more hashes
        h = _gram_hashes(c[at : at + _STEP + w + k - 2], k) >> np.uint64(32)
        at_block = _minima(_keys(h, np.arange(len(h))), w)
        kept.append((h[at_block].astype(np.uint32), at_block + at))
    hashes, positions = (np.concatenate(x) for x in zip(*kept))
    positions, first = np.unique(positions, return_index=True)
    return hashes[first], positions


def fingerprint_text(hashes: np.ndarray) -> str:
    return base64.b64encode(hashes.astype("<u4").tobytes()).decode()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Distinct fingerprints that both texts have, of those that either has; 1 if neither has any."""
    a, b = np.unique(a), np.unique(b)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 1.0


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """One row for each document: ``doc_id, n_chars, hashes, positions``."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in row_batches(batches):
            texts = [t or "" for t in b.column(1).to_pylist()]
            found = [winnow(t, k) for t in texts]
            columns = [pa.array([len(t) for t in texts], pa.int64()), pa.array([h.tolist() for h, _ in found], pa.list_(pa.int64())), pa.array([p.tolist() for _, p in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["doc_id", "n_chars", "hashes", "positions"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(find, "doc_id long, n_chars long, hashes array<long>, positions array<long>")


def with_next(docs: DataFrame, rows_per_group: int = 1_024, max_groups: int = 50_000) -> DataFrame:
    """Rows (group, follows, doc_id, text) so that each row's next document, in ascending
    identifiers, is in its group: groups are ranges of identifiers, and a group also holds the
    first row of the range behind it (``follows``). The last range is followed by the first.

    Texts are shuffled once. The driver holds, and broadcasts, one identifier for each group, of
    which there are at most ``max_groups``; groups grow beyond that, and tasks stream them.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    total, nulls = ids.agg(F.count("*"), F.count("*") - F.count("doc_id")).first()
    groups = max(1, min(max_groups, -(-(total - nulls) // rows_per_group)))
    cuts = sorted(set(ids.approxQuantile("doc_id", [i / groups for i in range(1, groups)], 0.1 / groups))) if groups > 1 else []
    cuts = [int(c) for c in cuts]

    @F.pandas_udf("int")
    def group_of(doc: pd.Series) -> pd.Series:
        # nulls come before all others, in the first group
        known = doc.notna().to_numpy()
        out = np.zeros(len(doc), np.int32)
        out[known] = np.searchsorted(np.array(cuts, np.int64), doc[known].to_numpy(np.int64), side="right")
        return pd.Series(out)

    heads = {r["g"]: (r["nulls"] > 0, r["head"]) for r in ids.groupBy(group_of("doc_id").alias("g")).agg(F.min("doc_id").alias("head"), (F.count("*") - F.count("doc_id")).alias("nulls")).collect()}
    order = sorted(heads)
    # the first row of each group, copied to the group before it
    before = {g: order[i - 1] for i, g in enumerate(order)}
    copies = docs.sparkSession.createDataFrame([(None if n else h, before[g]) for g, (n, h) in heads.items()], "h_id long, h_group int")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("own", group_of("doc_id"))
    both = own.join(F.broadcast(copies), F.col("doc_id").eqNullSafe(F.col("h_id")), "left")
    to = F.array(F.struct(F.col("own").alias("g"), F.lit(0).alias("follows")))
    also = F.when(F.col("h_group").isNotNull(), F.array(F.struct(F.col("h_group").alias("g"), F.lit(1).alias("follows")))).otherwise(F.array().cast("array<struct<g:int,follows:int>>"))
    rows = both.select("doc_id", "text", F.explode(F.concat(to, also)).alias("x")).select("x.g", "x.follows", "doc_id", "text")
    return rows.repartition("g").sortWithinPartitions("g", "follows", "doc_id", "text")


COMPARED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_with_edited(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of each text and of its edited text, whose last quarter is the beginning of
    the next document, and how alike they and the next document's are."""
    rows = with_next(docs)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # group, identifier, text and hashes of the row before
        out: list[tuple] = []

        def close(text: str, hashes: np.ndarray) -> None:
            _, doc, own, mine = last
            n = len(own) // 4
            edited = own[: len(own) - n] + text[:n]
            other = winnow(edited, k)[0]
            digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
            out.append((doc, len(own), digest, fingerprint_text(mine), fingerprint_text(other), likeness(mine, other), likeness(mine, hashes)))

        for b in row_batches(batches, 8_000_000):
            for group, follows, doc, text in zip(*(c.to_pylist() for c in b.columns)):
                text = text or ""
                if last and last[0] != group:
                    last = None
                hashes = winnow(text, k)[0]
                if last:
                    close(text, hashes)
                last = None if follows else (group, doc, text, hashes)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], names=_NAMES)
                out.clear()

    return rows.mapInArrow(compare, COMPARED)


_NAMES = [c.split()[0] for c in COMPARED.split(", ")]
_TYPES = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
