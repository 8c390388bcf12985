"""Ranked lexical search by sort-based accumulation: the best documents for each of many items.

Each task reads whole texts and finds the terms that items have. For a batch of documents the matched
terms are expanded to parallel arrays of item, document and impact; item and document are packed into
one key, keys are radix sorted, and the impacts of equal keys are added by ``reduceat``. An item's sums
go through a heap of its best documents, which the task keeps over all its batches. The heaps of all
tasks are then range-partitioned by item and a salt, and again reduced by heaps, and last by item.

Weights need counts over all documents (documents, terms, documents of each term), which a first pass
sums up; only the counts of terms that items have reach the driver. Items are taken in blocks of at most
``BLOCK`` (item, term) pairs, so what is sent to tasks has a size bound whatever the number of items.

Scores are integers: a term of weight ``w = floor(1000 * ln((2 N + 2) / (2 df + 1)))`` adds
``w * (10**9 * tf // (1000 * tf + 8 * m))``, where ``m = 100 - B + B * n * N // L``.

Defined cases: null and empty texts have no terms and match nothing; a document is ranked once for each of its rows;
a null identifier comes before all others among equal scores; rows of items that repeat are items of their own; items without
terms or matches have no rows; empty tables give an empty result; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ALNUM_WORDS, row_batches, staged, text_bytes

BEST, B = 10, 90
BLOCK = 2_000_000
SALTS = 16
#: Matches that are sorted at once.
SORT_ROWS = 4_000_000

_NO_ID = -(1 << 63)


def terms(text: str | None) -> list[bytes]:
    """Digits, letters (A-Z in lower case) and all that isn't ASCII, in runs."""
    return text_bytes(text).translate(ALNUM_WORDS).split()


def radix_order(keys: np.ndarray) -> np.ndarray:
    """The stable order of non-negative keys, by 16 bits a pass from the lowest on (numpy sorts 16-bit numbers by radix)."""
    order = np.argsort(keys.astype(np.uint16), kind="stable")
    for shift in range(16, int(keys.max(initial=0)).bit_length(), 16):
        order = order[np.argsort((keys[order] >> shift).astype(np.uint16), kind="stable")]
    return order


def accumulate(item: np.ndarray, doc: np.ndarray, impact: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The summed impacts of each (item, document), sorted by both."""
    if not len(item):
        return item, doc, impact
    keys = item * docs + doc
    order = radix_order(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    total = np.add.reduceat(impact[order], first)
    return keys[first] // docs, keys[first] % docs, total


class Heaps:
    """The best documents of each item: highest score, then least identifier."""

    def __init__(self, items: int, best: int):
        self.best, self.heaps = best, [[] for _ in range(items)]
        self.least = np.zeros(items, np.int64)  # what a score has to reach

    def add(self, item: np.ndarray, doc: list[int], score: np.ndarray) -> None:
        able = np.flatnonzero(score >= np.maximum(self.least[item], 1))
        for k, s, i in zip(item[able].tolist(), score[able].tolist(), able.tolist()):
            heap, entry = self.heaps[k], (s, -doc[i])
            if len(heap) < self.best:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.best:
                self.least[k] = heap[0][0]

    def rows(self) -> Iterator[tuple[int, int, int]]:
        for k, heap in enumerate(self.heaps):
            yield from ((k, -d, s) for s, d in heap)


class Index:
    """The terms of a block of items: which items have each, in one array."""

    def __init__(self, pairs: list[tuple[int, bytes]], items: int):
        self.number: dict[bytes, int] = {}
        of: list[list[int]] = []
        for item, term in pairs:
            t = self.number.setdefault(term, len(of))
            if t == len(of):
                of.append([])
            of[t].append(item)
        self.n_items = items
        self.begin = np.concatenate([[0], np.cumsum([len(o) for o in of])]).astype(np.int64)
        self.items = np.array([i for o in of for i in o], np.int64)

    def matched(self, text: str | None) -> tuple[list[int], list[int], int]:
        """Numbers and counts of the terms that items have, and the text's number of terms."""
        found = terms(text)
        counts = Counter(found)
        hits = counts.keys() & self.number.keys()
        return [self.number[t] for t in hits], [counts[t] for t in hits], len(found)


def collection_counts(docs: DataFrame, index: Index) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all their terms, and the documents of each term of the index."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(index.begin) + 1, np.int64)  # behind the terms: documents, and all terms
        for b in row_batches(batches):
            for text in b.column(0).to_pylist():
                found, _, n = index.matched(text)
                df[found] += 1
                df[-2] += n > 0
                df[-1] += n
        has = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(has.astype(np.int32)), pa.array(df[has])], names=["term", "n"])

    df = np.zeros(len(index.begin) + 1, np.int64)
    for r in docs.select("text").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():  # a row for each term of the block
        df[r["term"]] = r["n"]
    return int(df[-2]), int(df[-1]), df[:-2]


def _search_block(docs: DataFrame, index: Index, best: int, b: int) -> DataFrame:
    """``item, doc, score`` (item: its number in the block) of the best documents in each task, reduced by range."""
    n_docs, n_terms, df = collection_counts(docs, index)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    schema = pa.schema([("item", pa.int32()), ("doc", pa.int64()), ("score", pa.int64())])

    def batch_of(heaps: Heaps) -> pa.RecordBatch:
        rows = list(zip(*heaps.rows())) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, schema.types)], schema=schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(index.n_items, best)
        ids: list[int] = []
        parts: list[tuple[np.ndarray, ...]] = []
        held = 0

        def flush() -> None:
            nonlocal ids, parts, held
            if parts:
                item, doc, score = accumulate(*(np.concatenate(c) for c in zip(*parts)), len(ids))
                heaps.add(item, [ids[d] for d in doc.tolist()], score)
            ids, parts, held = [], [], 0

        for batch in row_batches(batches):
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                found, counts, n = index.matched(text)
                if not found:
                    continue
                t, tf = np.array(found), np.array(counts, np.int64)
                m = 100 - b + b * n * n_docs // n_terms
                impact = weight[t] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
                sizes = index.begin[t + 1] - index.begin[t]
                at = np.repeat(index.begin[t] - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
                parts.append((index.items[at], np.full(len(at), len(ids)), np.repeat(impact, sizes)))
                ids.append(doc_id)
                held += len(at)
                if held >= SORT_ROWS:
                    flush()
        flush()
        yield batch_of(heaps)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(index.n_items, best)
        for batch in batches:
            heaps.add(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), batch.column(1).to_pylist(), batch.column(2).to_numpy(zero_copy_only=False))
        yield batch_of(heaps)

    rows = "item int, doc long, score long"
    found = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)), "text").mapInArrow(search, rows)
    # written once: ranges are drawn from a first read, which would search all documents again
    found = staged(found, "best")
    salt = F.pmod(F.xxhash64("doc"), F.lit(SALTS))
    return found.repartitionByRange(F.col("item"), salt).mapInArrow(select, rows)


def item_terms(items: DataFrame) -> DataFrame:
    """The distinct terms of each row of items: ``item`` (its number), ``item_id``, ``terms``."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in row_batches(batches):
            found = [sorted(set(terms(t))) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("item"), b.column("item_id"), pa.array(found, pa.list_(pa.binary()))], names=["item", "item_id", "terms"])

    kind = items.schema["item_id"].dataType.simpleString()
    numbered = items.select(F.monotonically_increasing_id().alias("item"), "item_id", "text")
    return numbered.mapInArrow(split, f"item long, item_id {kind}, terms array<binary>")


def search(docs: DataFrame, items: DataFrame, best: int = BEST, b: int = B, block: int = BLOCK) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``best`` documents of each row of items with a score above 0,
    equal scores by ascending identifier."""
    held = staged(item_terms(items), "items")
    pairs = held.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = pairs // block + 1
    out = []
    for k in range(blocks):
        rows = held.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == k).orderBy("item").collect()  # about `block` pairs
        index = Index([(i, bytes(t)) for i, r in enumerate(rows) for t in r["terms"]], len(rows))
        numbers = docs.sparkSession.createDataFrame([(i, r["item"]) for i, r in enumerate(rows)], "item int, number long")
        found = _search_block(docs, index, best, b)
        out.append(found.join(F.broadcast(numbers), "item").select("number", "doc", "score"))
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    rank = F.row_number().over(Window.partitionBy("number").orderBy(F.col("score").desc(), "doc"))
    top = found.withColumn("rank", rank).where(F.col("rank") <= best)  # at most `best` rows of each salt and partition
    named = top.join(held.select(F.col("item").alias("number"), "item_id").hint("shuffle_hash"), "number")
    doc_id: Column = F.when(F.col("doc") != _NO_ID, F.col("doc"))
    return named.select("item_id", F.col("rank").cast("int").alias("rank"), doc_id.alias("doc_id"), "score")
