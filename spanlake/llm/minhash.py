"""Near-duplicates by min-max hashing.

Every permutation gives two signature values, the smallest and the largest, so half as many
hash evaluations are needed. Bands of four values (two permutations) are the buckets.

1. Documents with equal shingle sets collapse into one vertex (grouped by a 128-bit digest).
2. In each bucket the vertex that shares most bucket places becomes the hub; in a group of
   copies that is one near its middle. Every member is compared with its hubs.
3. Members that are then in another component than their hub are compared with all others of
   that hub's buckets. The join itself compares, and gives out links only.
4. Components by contraction: each vertex points to its smallest neighbour, pointers are
   followed, edges are rewritten and the rest repeats.

A hub's members are dealt over seats of about ``SEAT`` each, as many as its buckets need, and the
hub's row goes to each seat; so no hub, however many share it, is one task's work.

So a large group of copies costs a row for each member, and every two vertices of a bucket are
linked, joined by others, or compared. A comparison looks at sizes, then at the lowest bits of the
128 signature values (links fail with probability below 1e-8), then at full sets as 32-bit hashes
with room for as many as collide in either set; what passes is confirmed on the texts' full sets.
With 32 bands of four values a pair at 0.8 shares no bucket with probability below 1e-7.

Defined cases: texts without words (or null) are linked with nothing; rows that share an
identifier are one vertex; a row without identifier keeps a null component and stays; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_batches, staged, text_bytes, unstage, unused
from .shingles import shingle_set

SHINGLE, THRESHOLD = 5, 0.8
PERMUTATIONS, BAND = 64, 2
#: Members of a hub that sit together in joins; of those compared with all others, ``BLOCK`` times as many.
SEAT, BLOCK = 256, 16
_SEEDS = np.random.default_rng(20240229).integers(0, 1 << 32, size=(2, PERMUTATIONS), dtype=np.uint64).astype(np.uint32)
_A, _B = _SEEDS[0] | np.uint32(1), _SEEDS[1]


def min_max(shingles: np.ndarray, a: np.ndarray = _A, b: np.ndarray = _B) -> np.ndarray:
    """(2, permutations): the smallest and the largest value under each permutation."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low, high = np.full(len(a), 0xFFFFFFFF, np.uint32), np.zeros(len(a), np.uint32)
    for i in range(0, len(x), 2_048):
        y = np.multiply.outer(a, x[i : i + 2_048])
        y += b[:, None]
        y ^= y >> np.uint32(15)
        y *= np.uint32(0x85EBCA6B)
        np.minimum(low, y.min(axis=1), out=low)
        np.maximum(high, y.max(axis=1), out=high)
    return np.stack([low, high])


def _bands(signature: np.ndarray) -> list[int]:
    """A 64-bit key of each band: ``BAND`` permutations, two values each."""
    from .shingles import mix

    v = signature.T.reshape(-1, 2 * BAND).astype(np.uint64)
    key = np.arange(1, len(v) + 1, dtype=np.uint64)
    for j in range(v.shape[1]):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + v[:, j])
    return key.view(np.int64).tolist()


_SIGNED = "doc_id long, n_shingles long, digest binary, bands array<long>"


def signed(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Each row's set size, digest of the set and band keys."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in row_batches(batches):
            out: list[list] = [[], [], []]
            for text in b.column(1).to_pylist():
                s = shingle_set(text_bytes(text), shingle)
                out[0].append(len(s))
                out[1].append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                out[2].append(_bands(min_max(s)) if len(s) else [])
            types = (pa.int64(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(out, types))], names=["doc_id", "n_shingles", "digest", "bands"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sign, _SIGNED)


_SETS = "rep long, n long, bits0 long, bits1 long, shingles array<int>"


def set_row(s: np.ndarray) -> tuple[int, int, int, np.ndarray]:
    """Size, lowest signature bits and distinct 32-bit hashes of a set of shingles."""
    bits = np.packbits(min_max(s).reshape(-1) & 1).view(np.int64) if len(s) else (0, 0)
    return len(s), int(bits[0]), int(bits[1]), np.unique(s.astype(np.uint32)).view(np.int32)


def shingle_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """The ``set_row`` of each text (doc_id, text)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in row_batches(batches, 4_000_000):
            out: list[list] = [[], [], [], []]
            for text in b.column(1).to_pylist():
                for column, v in zip(out, set_row(shingle_set(text_bytes(text), shingle))):
                    column.append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(out, types))], names=["rep", "n", "bits0", "bits1", "shingles"])

    return texts.mapInArrow(make, _SETS)


#: Of 128 signature bits so many may differ: the mean at 0.8 is 12.8, and this is six deviations more.
BITS_APART = 33


def _near(x: str, y: str, threshold: float) -> Column:
    """A join condition that all links of the aliases meet, evaluated from cheap to dear."""
    c = lambda t, name: F.col(f"{t}.{name}")
    t = round(100 * threshold)
    sizes = 100 * F.least(c(x, "n"), c(y, "n")) >= t * F.greatest(c(x, "n"), c(y, "n"))
    apart = sum(F.bit_count(c(x, b).bitwiseXOR(c(y, b))) for b in ("bits0", "bits1"))
    # shingles that both have and that share a 32-bit hash are lost in either set
    lost = F.least(*(c(a, "n") - F.size(c(a, "shingles")) for a in (x, y)))
    both = F.size(F.array_intersect(c(x, "shingles"), c(y, "shingles"))) + lost
    return sizes & (apart <= BITS_APART) & (100 * both >= t * (c(x, "n") + c(y, "n") - both))


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, threshold: float) -> DataFrame:
    """Those of the staged, distinct pairs (a, b, seat) whose full sets are at least ``threshold`` alike; ``seat`` deals
    out the pairs of one ``a``."""

    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        sets: dict[str, np.ndarray] = {}
        found = []
        for x, y in zip(a, b):
            s, t = (sets.get(v) if v in sets else sets.setdefault(v, shingle_set(text_bytes(v), shingle)) for v in (x, y))
            both = len(np.intersect1d(s, t, assume_unique=True))
            found.append(100 * both >= round(100 * threshold) * (len(s) + len(t) - both))
        return pd.Series(found, dtype=bool)

    first = pairs.select("a", "seat").distinct().join(texts.toDF("a", "ta"), "a")
    full = pairs.join(first, ["a", "seat"]).join(texts.toDF("b", "tb"), "b")
    return full.where(F.pandas_udf(alike, "boolean")("ta", "tb")).select("a", "b")


def components(links: DataFrame, tag: str) -> DataFrame:
    """(vertex, label): the smallest vertex reachable over the links (a, b); only linked vertices."""
    edges = staged(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"edges-{tag}")
    labels = None
    while edges.head(1):
        both = edges.union(edges.select("b", "a"))
        to = both.groupBy("a").agg(F.min("b").alias("least")).select(F.col("a").alias("v"), F.least("a", "least").alias("p"))
        pointers = to = staged(to, f"pointers-{tag}")
        for _ in range(2):  # pointers of pointers
            up = to.select(F.col("v").alias("p"), F.col("p").alias("q"))
            to = to.join(up, "p", "left").select("v", F.coalesce("q", "p").alias("p"))
        to = staged(to, f"roots-{tag}")
        if labels is None:
            fresh = to.select("v", F.col("p").alias("label"))
        else:
            moved = to.select(F.col("v").alias("label"), "p")
            fresh = labels.join(moved, "label", "left").select("v", F.coalesce("p", "label").alias("label"))
        fresh = staged(fresh, f"labels-{tag}")
        rest = edges.join(to.toDF("a", "pa"), "a").join(to.toDF("b", "pb"), "b").where("pa <> pb")
        rest = staged(rest.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), f"edges-{tag}")
        unstage(edges, pointers, to, labels)
        edges, labels = rest, fresh
    if labels is None:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("label"))
    unstage(edges)
    return labels


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document: ``doc_id, n_shingles, component_id, kept``."""
    rows = staged(signed(docs, shingle), "signed")
    grouped = rows.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    vertices = staged(grouped, "vertices")
    buckets = vertices.select("rep", F.explode("bands").alias("key"))
    filled = buckets.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    shared = staged(buckets.join(filled, "key"), "buckets")
    weights = shared.groupBy("rep").agg(F.sum("members").alias("weight"))
    hubs = shared.join(weights, "rep").groupBy("key").agg(F.max(F.struct("weight", (-F.col("rep")).alias("rep"))).alias("best"))
    places = shared.join(hubs.select("key", (-F.col("best.rep")).alias("hub")), "key").groupBy("hub", "rep").agg(F.max("members").alias("members"))
    dealt = lambda n: F.pmod(F.xxhash64("rep"), F.ceil(F.col("members") / n))
    places = staged(places.select("hub", "rep", dealt(SEAT).alias("seat"), dealt(SEAT * BLOCK).alias("block")), "places")
    seats = staged(places.select("hub", "seat").distinct(), "seats")

    wanted = shared.select(F.col("rep").alias("doc_id")).distinct()
    # always by shuffle, so that a run's cost follows its input
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").hint("merge").join(wanted.hint("merge"), "doc_id", "left_semi")
    texts = staged(texts, "texts")
    sets = staged(shingle_sets(texts, shingle), "sets")
    members = staged(places.join(sets, "rep").select(*places.columns, *sets.columns[1:]), "members")

    # rows that share an identifier are one vertex: the representatives of their texts are linked
    of_row = rows.select("doc_id", "n_shingles", "digest").join(vertices.select("digest", "rep"), "digest", "left")
    twice = of_row.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("rep").alias("a"), F.collect_set("rep").alias("reps"))
    twice = twice.where(F.size("reps") > 1).select("a", F.explode("reps").alias("b")).where("a <> b")
    at_seats = seats.join(sets.withColumnRenamed("rep", "hub"), "hub")
    same_seat = (F.col("x.hub") == F.col("y.hub")) & (F.col("x.seat") == F.col("y.seat"))
    to_hub = members.where("rep <> hub").alias("x").join(at_seats.alias("y"), same_seat & _near("x", "y", threshold))
    to_hub = staged(to_hub.select(F.col("x.hub").alias("a"), F.col("x.rep").alias("b"), "x.seat"), "pairs")
    links = staged(confirmed(to_hub, texts, shingle, threshold).union(twice), "links")
    label = components(links, "hub")

    part = lambda c: label.select(F.col("v").alias(c), F.col("label").alias(f"{c}_label"))
    parts = members.join(part("rep"), "rep", "left").join(seats.join(part("hub"), "hub", "left"), ["hub", "seat"])
    parts = parts.select(*members.columns, F.coalesce("rep_label", "rep").alias("part"), F.coalesce("hub_label", "hub").alias("hub_part"))
    # blocks of loose members meet seats of all members
    loose = staged(parts.where("part <> hub_part"), "loose")
    cells = staged(loose.select("hub", "block").distinct().join(seats, "hub"), "cells")
    others = parts.drop("block").join(cells, ["hub", "seat"]).where("rep <> hub")
    tried = loose.drop("seat").join(cells, ["hub", "block"])
    apart = (F.col("x.part") != F.col("y.part")) & ((F.col("y.part") == F.col("y.hub_part")) | (F.col("x.rep") < F.col("y.rep")))
    same_cell = same_seat & (F.col("x.block") == F.col("y.block"))
    cross = tried.alias("x").join(others.alias("y"), same_cell & apart & _near("x", "y", threshold))
    cross = staged(cross.groupBy(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).agg(F.min("x.seat").alias("seat")), "cross")
    if cross.head(1):
        more = staged(links.union(confirmed(cross, texts, shingle, threshold)), "links")
        label, first = components(more, "all"), label
        unstage(more, first)
    unstage(shared, places, seats, texts, sets, members, to_hub, links, loose, cells, cross)

    of = label.select(F.col("v").alias("rep"), "label")
    out = of_row.join(of, "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "rep", "doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each group, the one with the smallest identifier."""
    found = near_duplicates(docs, shingle, threshold)
    name = unused("gone_id", docs)
    gone = found.where("NOT kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == F.col(name), "left_anti")
