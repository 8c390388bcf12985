"""Exact repeats by enhanced suffix arrays: maximal repeat groups with all occurrences.

A suffix array of all texts can't be built in one task, and needn't: only suffixes with a common
beginning of ``min_bytes`` meet. Each string of that length has an anchor, the ``GRAM`` bytes in it
whose first eight have the least hash (leftmost of ties), so equal strings have equal anchors. A text is
cut into stretches: the runs of its strings with the same anchor. Texts are held in blocks of some megabytes, and what blocks tell each
other are arrays, one for each bucket of anchors:

1. each block sends the hashes of its anchors; buckets send back which of them stand in several documents;
2. each block sends the stretches of those, equal ones once with their first and last document, so that a passage
   of many documents costs an entry for each block;
3. a bucket sorts the suffixes of its different stretches, takes the common prefixes of neighbours, and
   scans them with a stack: each node of the interval tree of at least ``min_bytes`` whose
   suffixes follow different bytes (or begin their stretch) is a maximal repeat within the stretches;
4. groups go back to the blocks, which know all occurrences of their stretches. Repeats that are longer than a
   stretch come as overlapping groups, whose union is the repeat.

Buckets are so many that each holds about as many anchors or bytes as ``Sizes`` says. Every block has something for nearly
every bucket, so with blocks and buckets of fixed sizes what is sent would be a number of arrays that grows with the square of the input; blocks and buckets
of stretches therefore grow with its root, and a bucket is sorted part by part. An anchor of more than ``common`` blocks would make one too large: its stretches are sent as single strings of
``min_bytes``, each its own anchor, and so spread over the buckets.

Defined cases: a null text is empty; texts below ``min_bytes`` have no repeats; a null identifier comes before all
others, so a text without one keeps its bytes and others lose them; rows that share an identifier never cost each other bytes; rows
equal in identifier and text are edited alike; empty tables give an empty result; other columns are passed through.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import row_batches, staged, text_bytes, unused

MIN_BYTES = 50
GRAM = 28
#: Texts are read in pieces of so many bytes, as the place of an anchor has 20 bits in its key.
PIECE = 1 << 16



class Sizes(NamedTuple):
    """Bytes of texts in a block (one text at least), anchors in a bucket, bytes of stretches that are sorted at once, and blocks of a common anchor;
    bytes of all texts up to which this holds, how much blocks grow beyond at most, and parts of a bucket of stretches."""

    block: int = 1_000_000
    anchors: int = 2_000_000
    bytes: int = 3_000_000
    common: int = 20_000
    whole: int = 400_000_000
    most: int = 8
    parts: int = 1

    def of(self, total: int) -> Sizes:
        """For ``total`` bytes of texts: with blocks and parts both times the root of the growth, the arrays that are sent grow with the input."""
        times = min(max(total / self.whole, 1.0) ** 0.5, self.most)
        return self._replace(block=int(self.block * times), parts=self.parts * math.ceil(times))


SIZES = Sizes()

_NO_ID = -(1 << 63)
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: What is sent of an anchor's hash: 39 bits, and one that tells if several documents of the block have it.
_SENT = np.uint64((1 << 39) - 1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as numbers."""
    return np.ndarray((max(len(data) - 7, 0),), "<u8", data, strides=(1,))


def string_hashes(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` (8 or more) bytes from the given places on."""
    words, h = _words(data), np.zeros(len(at), np.uint64)
    for k in [*range(0, size - 8, 8), size - 8]:
        h = _mixed((h + words[at + k]) * _ODD)
    return h


def _minima(keys: np.ndarray, width: int) -> np.ndarray:
    """The least key of each ``width`` neighbours."""
    have = 1
    while have < width:
        step = min(have, width - have)
        keys = np.minimum(keys[: len(keys) - step], keys[step:])
        have += step
    return keys


def stretches(data: np.ndarray, bounds: np.ndarray, min_bytes: int = MIN_BYTES, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts that stand one behind the other (between ``bounds``): the hash of each stretch's anchor, and where it begins and ends."""
    n = len(data) - min_bytes + 1
    none = np.empty(0, np.int64)
    if n <= 0:
        return none.view(np.uint64), none, none
    anchor = np.empty(n, np.int32)
    width = min_bytes - gram + 1
    for at in range(0, n, PIECE):
        words = _words(data[at : min(at + PIECE, n) + width + 6])  # the grams that begin within these strings
        keys = words * _ODD
        keys = (keys ^ keys >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
        keys = (keys & np.uint64(0xFFFFFFFFFFF00000)) | np.arange(len(keys), dtype=np.uint64)
        anchor[at : at + PIECE] = (_minima(keys, width) & np.uint64(0xFFFFF)).astype(np.int32) + at
    within = np.ones(n + 1, bool)  # strings that don't reach into the next text
    within[n] = False
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        within[max(begin, end - min_bytes + 1) : end] = False
    same = within[:-2] & within[1:-1] & (anchor[1:] == anchor[:-1])
    first = np.flatnonzero(within[:-1] & ~np.concatenate([[False], same]))
    last = np.flatnonzero(within[:-1] & ~np.concatenate([same, [False]]))
    return string_hashes(data, anchor[first], gram), first, last + min_bytes


def interval_groups(prefixes: list[int], before: list[int], low: list[int], high: list[int], least: int) -> list[tuple[int, int, int, int, int]]:
    """The nodes of the interval tree over sorted suffixes that are maximal repeats.

    ``prefixes``: common prefix of each suffix with the one before it; ``before``: the byte that each
    follows, or a negative number of its own where its stretch begins; ``low, high``: its first and
    last document. Gives (length, first suffix, last suffix, first document, last document); a node
    counts if its suffixes follow different bytes.
    """
    found = []
    stack: list[list[int]] = []  # length, first suffix, byte before (-1: diverse), first document, last document
    n = len(before)
    for i in range(1, n + 1):
        length = prefixes[i] if i < n else 0
        start = i - 1
        left, lo, hi = before[start], low[start], high[start]
        while stack and stack[-1][0] > length:
            size, first, other, lo2, hi2 = stack.pop()
            left, lo, hi, start = left if left == other else -1, lo if lo < lo2 else lo2, hi if hi > hi2 else hi2, first
            if left < 0:
                found.append((size, first, i - 1, lo, hi))
        if length >= least:
            if stack and stack[-1][0] == length:
                top = stack[-1]
                top[2], top[3], top[4] = top[2] if top[2] == left else -1, min(top[3], lo), max(top[4], hi)
            else:
                stack.append([length, start, left, lo, hi])
    return found


def repeats_of(held: list[bytes], low: list[int], high: list[int], min_bytes: int = MIN_BYTES) -> tuple[np.ndarray, ...]:
    """The maximal repeats of some stretches: number of the group, stretch, place in it, length, first and last document."""
    sizes = np.array([len(s) for s in held], np.int64)
    data = np.frombuffer(b"".join(held), np.uint8)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    own = np.repeat(np.arange(len(held)), sizes - min_bytes + 1)
    place = np.concatenate([np.arange(n) for n in sizes - min_bytes + 1])
    at = begin[own] + place
    # suffixes that share their first bytes with no other take no part
    _, kind, times = np.unique(string_hashes(data, at, min_bytes), return_inverse=True, return_counts=True)
    often = times[kind] > 1
    own, place, at = own[often], place[often], at[often]
    none = np.empty(0, np.int64)
    if not len(at):
        return (none,) * 6
    longest = int(sizes.max())
    length = sizes[own] - place
    suffix = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(longest, np.uint8)]), longest)[at]
    suffix[np.arange(longest, dtype=np.int32) >= length[:, None].astype(np.int32)] = 0
    order = np.lexsort((length, suffix.view(f"S{longest}").ravel()))
    suffix, own, place, length, at = suffix[order], own[order], place[order], length[order], at[order]
    differ = suffix[1:] != suffix[:-1]
    prefix = np.where(differ.any(axis=1), differ.argmax(axis=1), longest)
    prefix = np.concatenate([[0], np.minimum(prefix, np.minimum(length[1:], length[:-1]))])
    before = np.where(place > 0, data[np.maximum(at - 1, 0)].astype(np.int64), -2 - np.arange(len(at)))
    low_of, high_of = np.array(low, np.int64)[own].tolist(), np.array(high, np.int64)[own].tolist()
    groups = interval_groups(prefix.tolist(), before.tolist(), low_of, high_of, min_bytes)
    if not groups:
        return (none,) * 6
    size, first, last, lo, hi = np.array(groups, np.int64).T
    members = last - first + 1
    group = np.repeat(np.arange(len(groups)), members)
    suffixes = np.arange(len(group)) - np.repeat(np.cumsum(members) - members, members) + first[group]
    return group, own[suffixes], place[suffixes], size[group], lo[group], hi[group]


class Block(NamedTuple):
    """Texts of one block, and its stretches: anchor's hash, place, end, and number of the text."""

    docs: np.ndarray
    bounds: np.ndarray
    data: np.ndarray
    anchor: np.ndarray
    first: np.ndarray
    end: np.ndarray
    own: np.ndarray


@lru_cache
def _compressor(level: int) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=level)


@lru_cache
def _decompressor() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def _packed(raw: bytes, level: int = 3) -> bytes:
    return _compressor(level).compress(raw)


def _unpacked(packed: bytes | pa.Buffer) -> bytes:
    return _decompressor().decompress(packed)


def _read_block(docs: bytes, sizes: bytes, text: bytes, min_bytes: int) -> Block:
    bounds = np.concatenate([[0], np.cumsum(np.frombuffer(sizes, np.int64))])
    data = np.frombuffer(_unpacked(text), np.uint8)
    anchor, first, end = stretches(data, bounds, min_bytes)
    return Block(np.frombuffer(docs, np.int64), bounds, data, anchor, first, end, np.searchsorted(bounds, first, side="right") - 1)


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of batches, each with its large values only while it is worked on; binary ones as views."""
    for b in batches:
        for i in range(b.num_rows):
            yield tuple(c[i].as_buffer() if pa.types.is_binary(c.type) else c[i].as_py() for c in b.columns)


def blocks(docs: DataFrame, block_bytes: int = SIZES.block) -> DataFrame:
    """Texts in blocks, numbered and written once: identifiers (least for null), two hashes and sizes of the texts, and their bytes (compressed, as they go through shuffles)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held: list[tuple[int, int, int, bytes]] = []
        size = 0

        def block() -> pa.RecordBatch:
            columns = [[number], *[[np.array([h[k] for h in held], np.int64).tobytes()] for k in range(3)], [np.array([len(h[3]) for h in held], np.int64).tobytes()], [_packed(b"".join(h[3] for h in held), 6)], [sum(len(h[3]) for h in held)]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), *[pa.binary()] * 5, pa.int64()))], names=["block", "docs", "k1", "k2", "sizes", "text", "n_bytes"])

        for b in row_batches(batches, block_bytes):
            for doc, k1, k2, text in zip(*(c.to_pylist() for c in b.columns)):
                raw = text_bytes(text)
                if held and size + len(raw) > block_bytes:
                    yield block()
                    number, held, size = number + 1, [], 0
                held.append((doc, k1, k2, raw))
                size += len(raw) + 32
        if held:
            yield block()

    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)), *text_keys(F.col("text")), "text")
    return staged(keyed.mapInArrow(pack, "block long, docs binary, k1 binary, k2 binary, sizes binary, text binary, n_bytes long"), "blocks")


def text_keys(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(7), text).alias("k2")


def _dealt(anchor: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different anchors of a block in the order in which they are sent, which of them each stretch has, and where
    each bucket begins."""
    different, which = np.unique(anchor, return_inverse=True)
    bucket = ((different >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    return different[order], place[which], np.searchsorted(bucket[order], np.arange(buckets + 1))


def _parts(begin: np.ndarray) -> list[tuple[int, int, int]]:
    """Bucket, begin and end of the buckets that aren't empty."""
    has = np.flatnonzero(begin[1:] > begin[:-1])
    return list(zip(has.tolist(), begin[has].tolist(), begin[has + 1].tolist()))


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of one bucket after the other; rows are sorted by it."""
    held: list[dict] = []
    for b in batches:
        for row in b.to_pylist():  # arrays of one block and bucket
            if held and row["bucket"] != held[-1]["bucket"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _answers(held: DataFrame, buckets: int, min_bytes: int, across: bool, common_from: int) -> DataFrame:
    """Of each block and bucket: which of the anchors that the block sent stand in several documents, and which of them are common."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, docs, sizes, text in _one_by_one(batches):
            x = _read_block(docs, sizes, text, min_bytes)
            different, which, begin = _dealt(x.anchor, buckets)
            doc = x.docs[x.own]
            low, high = np.full(len(different), (1 << 63) - 1), np.full(len(different), _NO_ID)
            np.minimum.at(low, which, doc)
            np.maximum.at(high, which, doc)
            several = low < high if across else np.bincount(which, minlength=len(different)) > 1
            sent = (different & _SENT) << np.uint64(1) | several.astype(np.uint64)
            sent = sent.view(np.uint8).reshape(-1, 8)[:, :5]
            parts = _parts(begin)
            columns = [pa.array([k for k, _, _ in parts], pa.int32()), pa.array([number] * len(parts), pa.int64()), pa.array([sent[i:j].tobytes() for _, i, j in parts], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "block", "sent"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_bucket(batches):
            raw = np.frombuffer(b"".join(r["sent"] for r in rows), np.uint8).reshape(-1, 5)
            sent = np.zeros((len(raw), 8), np.uint8)
            sent[:, :5] = raw
            sent = sent.view(np.uint64).ravel()
            _, which, times = np.unique(sent >> np.uint64(1), return_inverse=True, return_counts=True)
            several = np.zeros(len(times), bool)
            several[which[(sent & np.uint64(1)) > 0]] = True
            wanted, common = (several | (times > 1))[which], (times > common_from)[which]
            at = np.cumsum([0, *(len(r["sent"]) // 5 for r in rows)])
            columns = [
                pa.array([r["bucket"] for r in rows], pa.int32()), pa.array([r["block"] for r in rows], pa.int64()), pa.array([int(wanted[i:j].sum()) for i, j in zip(at, at[1:])], pa.int64()),
                pa.array([np.packbits(wanted[i:j]).tobytes() for i, j in zip(at, at[1:])], pa.binary()), pa.array([np.packbits(common[i:j]).tobytes() if common[i:j].any() else None for i, j in zip(at, at[1:])], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "block", "n", "wanted", "common"])

    sent = held.select("block", "docs", "sizes", "text").mapInArrow(send, "bucket int, block long, sent binary")
    dealt = sent.repartition("bucket").sortWithinPartitions("bucket")
    return staged(dealt.mapInArrow(answer, "bucket int, block long, n long, wanted binary, common binary"), "answers")


class Sent(NamedTuple):
    """The different stretches that a block sends, by bucket: anchor, bytes, first and last document, times; and of each
    stretch of the block its place among them and in the block."""

    anchor: np.ndarray
    texts: list[bytes]
    low: np.ndarray
    high: np.ndarray
    times: np.ndarray
    begin: np.ndarray
    which: np.ndarray
    first: np.ndarray
    own: np.ndarray


def _wanted(x: Block, answers: list[dict], buckets: int, sort_buckets: int, min_bytes: int) -> Sent:
    different, which, begin = _dealt(x.anchor, buckets)
    flags = np.zeros((2, len(different)), bool)
    for a in answers:
        i, j = int(begin[a["bucket"]]), int(begin[a["bucket"] + 1])
        for k, name in enumerate(("wanted", "common")):
            if a[name] is not None:
                flags[k, i:j] = np.unpackbits(np.frombuffer(a[name], np.uint8), count=j - i)
    wanted, common = flags[0][which], flags[1][which]
    plain = np.flatnonzero(wanted & ~common)
    anchor, first, end, own = x.anchor[plain], x.first[plain], x.end[plain], x.own[plain]
    cut = np.flatnonzero(wanted & common)
    if len(cut):  # single strings, each its own anchor
        n = x.end[cut] - x.first[cut] - min_bytes + 1
        at = np.repeat(x.first[cut] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        anchor, first, end, own = (np.concatenate(c) for c in ((anchor, string_hashes(x.data, at, min_bytes)), (first, at), (end, at + min_bytes), (own, np.repeat(x.own[cut], n))))
    raw = x.data.tobytes()
    numbers: dict[bytes, int] = {}
    place = np.array([numbers.setdefault(raw[i:j], len(numbers)) for i, j in zip(first.tolist(), end.tolist())], np.int64)
    texts = list(numbers)
    anchors = np.zeros(len(texts), np.uint64)
    anchors[place] = anchor
    low, high = np.full(len(texts), (1 << 63) - 1), np.full(len(texts), _NO_ID)
    np.minimum.at(low, place, x.docs[own])
    np.maximum.at(high, place, x.docs[own])
    bucket = ((anchors >> np.uint64(20)) % np.uint64(sort_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    moved = np.empty_like(order)
    moved[order] = np.arange(len(order))
    times = np.bincount(place, minlength=len(texts))
    return Sent(anchors[order], [texts[k] for k in order.tolist()], low[order], high[order], times[order], np.searchsorted(bucket[order], np.arange(sort_buckets + 1)), moved[place] if len(place) else place, first, own)


#: What a block learns of the members of groups: places, starts, sizes and first documents, one array of 64-bit numbers
#: behind the other, and the digests of what repeats (16 bytes each).
_GROUPED = "block long, bucket int, members binary, digest binary"


def _outermost(own: np.ndarray, start: np.ndarray, size: np.ndarray, first_doc: np.ndarray) -> np.ndarray:
    """Members, by their stretch, without those that lie within another one of the same stretch and first document: these remove nothing more."""
    order = np.lexsort((-size, start, first_doc, own))
    own, first_doc, start, end = own[order], first_doc[order], start[order], (start + size)[order]
    new = np.concatenate([[True], (own[1:] != own[:-1]) | (first_doc[1:] != first_doc[:-1])]) if len(own) else np.empty(0, bool)
    run = np.cumsum(new) * (int(end.max(initial=0)) + 1)
    reach = np.maximum.accumulate(end + run) - run
    return order[new | (end > np.concatenate([[0], reach[:-1]]))] if len(own) else order


def _grouped(held: DataFrame, buckets: int, sort_buckets: int, parts: int, min_bytes: int, across: bool, digests: bool) -> DataFrame:
    """Of each block and bucket: the maximal repeats that its stretches hold, by the place of the stretch in what was sent. ``held``: blocks with their answers.
    Without ``digests`` only those that remove something: whose first document is before one of the block's that has the stretch, and the outermost of these.
    A bucket comes in ``parts``, by anchors, which are sorted one after the other."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, docs, sizes, text, answers in _one_by_one(batches):
            s = _wanted(_read_block(docs, sizes, text, min_bytes), answers or [], buckets, sort_buckets * parts, min_bytes)
            begins = s.begin[::parts]
            lengths = np.array([len(t) for t in s.texts], np.int64)
            ends = np.concatenate([[0], np.cumsum(lengths)]).tolist()
            numbers, raw, split = np.stack([lengths, s.low, s.high, s.times]), b"".join(s.texts), np.diff(s.begin)
            has = _parts(begins)
            payloads = [_packed(b"".join((numbers[:, i:j].tobytes(), raw[ends[i] : ends[j]]))) for _, i, j in has]
            of_parts = [split[k * parts : (k + 1) * parts].tobytes() for k, _, _ in has]
            columns = [pa.array(c, t) for c, t in zip(([k for k, _, _ in has], [number] * len(has), of_parts, payloads), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "block", "n", "sent"])

    def repeats(texts: list[bytes], which: np.ndarray, low: np.ndarray, high: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, ...]:
        """The repeats of one part of a bucket, by their stretch: stretch, start, size, first document."""
        least, most, total = np.full(len(texts), (1 << 63) - 1), np.full(len(texts), _NO_ID), np.zeros(len(texts), np.int64)
        np.minimum.at(least, which, low)
        np.maximum.at(most, which, high)
        np.add.at(total, which, times)
        _, own, start, size, lo, hi = repeats_of(texts, least.tolist(), most.tolist(), min_bytes)
        # a stretch that stands in several places is a repeat itself
        leaf = np.flatnonzero(least < most if across else total > 1)
        own, start, size = np.concatenate([own, leaf]), np.concatenate([start, 0 * leaf]), np.concatenate([size, np.array([len(texts[k]) for k in leaf.tolist()], np.int64)])
        lo, hi = np.concatenate([lo, least[leaf]]), np.concatenate([hi, most[leaf]])
        keep = np.flatnonzero(lo < hi) if across else np.arange(len(lo))
        found = own[keep], start[keep], size[keep], lo[keep]
        order = np.argsort(found[0], kind="stable") if digests else _outermost(*found)
        return tuple(c[order] for c in found)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_bucket(batches):
            split = np.array([np.frombuffer(r["n"], np.int64) for r in rows])
            bounds = np.concatenate([[0], np.cumsum(split.sum(axis=1))])
            numbers: list[dict[bytes, int]] = [{} for _ in range(parts)]
            which, sent = [], []
            for r, ns in zip(rows, split.tolist()):
                raw, n = _unpacked(r.pop("sent")), sum(ns)
                sent.append(np.frombuffer(raw, np.int64, 4 * n).reshape(4, -1).copy())
                ends = (np.cumsum(sent[-1][0]) + 32 * n).tolist()
                spans = zip([32 * n, *ends], ends)
                for known, m in zip(numbers, ns):
                    which += [known.setdefault(raw[i:j], len(known)) for i, j in islice(spans, m)]
            which, sent = np.array(which, np.int64), np.concatenate(sent, axis=1)
            part = np.repeat(np.tile(np.arange(parts), len(rows)), split.ravel())
            first, members = np.zeros(len(which), np.int64), np.zeros(len(which), np.int64)  # of each stretch's members in all that was found
            found, digest, total = [], [], 0
            for k in range(parts):
                mine = np.flatnonzero(part == k)
                texts, numbers[k] = list(numbers[k]), {}
                if not len(mine):
                    continue
                own, start, size, lo = repeats(texts, which[mine], *sent[1:, mine])
                if digests:
                    digest += [hashlib.blake2b(texts[i][at : at + n], digest_size=16).digest() for i, at, n in zip(own.tolist(), start.tolist(), size.tolist())]
                first[mine] = np.searchsorted(own, which[mine]) + total
                members[mine] = np.bincount(own, minlength=len(texts))[which[mine]]
                found.append((start, size, lo))
                total += len(own)
            if not total:
                continue
            start, size, lo = (np.concatenate(c) for c in zip(*found))
            digest = np.array(digest, object)
            done = []
            for r, i, j in zip(rows, bounds.tolist(), bounds[1:].tolist()):
                mine = members[i:j]
                n = int(mine.sum())
                if not n:
                    continue
                place = np.repeat(np.arange(j - i), mine)
                k = np.repeat(first[i:j] - np.cumsum(mine) + mine, mine) + np.arange(n)
                if not digests:
                    later = lo[k] < sent[2, i:j][place]
                    place, k = place[later], k[later]
                if len(k):
                    done.append((r["block"], r["bucket"], _packed(np.concatenate([place, start[k], size[k], lo[k]]).tobytes()), b"".join(digest[k].tolist()) if digests else b""))
            for at in range(0, len(done), 1000):
                columns = [pa.array(c, t) for c, t in zip(zip(*done[at : at + 1000]), (pa.int64(), pa.int32(), pa.binary(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, names=["block", "bucket", "members", "digest"])

    sent = held.select("block", "docs", "sizes", "text", "answers").mapInArrow(send, "bucket int, block long, n binary, sent binary")
    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(scan, _GROUPED)


class Buckets(NamedTuple):
    """How many there are of anchors and of stretches, and parts of the latter."""

    anchors: int
    stretches: int
    parts: int


def _found(docs: DataFrame, min_bytes: int, across: bool, sizes: Sizes, digests: bool) -> tuple[DataFrame, Buckets]:
    """Blocks with their answers and groups, and how many buckets there were."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    sizes = sizes.of(total)
    held = blocks(docs, sizes.block)
    buckets = int(total * 2 / (min_bytes - GRAM + 2)) // sizes.anchors + 1  # of the strings about so many are the first of a stretch
    answers = _answers(held, buckets, min_bytes, across, sizes.common)
    wanted = answers.agg(F.sum("n"), F.sum(F.when(F.col("common").isNotNull(), F.col("n")))).first()
    sort_buckets = int((wanted[0] or 0) * (min_bytes + min_bytes // 4) + (wanted[1] or 0) * min_bytes * min_bytes // 2) // (sizes.bytes * sizes.parts) + 1
    own = answers.groupBy("block").agg(F.collect_list(F.struct("bucket", "wanted", "common")).alias("answers"))  # of one block
    with_answers = held.hint("merge").join(own.hint("merge"), "block", "left")
    groups = _grouped(with_answers, buckets, sort_buckets, sizes.parts, min_bytes, across, digests)
    groups = staged(groups if digests else groups.drop("digest"), "groups")
    mine = groups.groupBy("block").agg(F.collect_list(F.struct("bucket", "members", *(["digest"] if digests else []))).alias("groups"))
    return with_answers.hint("merge").join(mine.hint("merge"), "block", "left"), Buckets(buckets, sort_buckets, sizes.parts)


#: Members that a block works on at once.
_AT_ONCE = 100_000


def _occurrences(x: Block, answers: list[dict] | None, groups: list[dict] | None, buckets: Buckets, min_bytes: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Number of the text, place in the block, length, first document, and which member it is of those of all groups, some buckets at a time."""
    if not groups:
        return
    s = _wanted(x, answers or [], buckets.anchors, buckets.stretches * buckets.parts, min_bytes)
    order = np.argsort(s.which, kind="stable")
    begin = np.concatenate([[0], np.cumsum(np.bincount(s.which, minlength=len(s.texts)))])
    before, held, n_held = 0, [], 0
    for number, g in enumerate(groups, 1):
        mine = np.frombuffer(_unpacked(g["members"]), np.int64).reshape(4, -1).copy()
        mine[0] += s.begin[g["bucket"] * buckets.parts]
        held.append(mine)
        n_held += mine.shape[1]
        if n_held < _AT_ONCE and number < len(groups):
            continue
        sent, start, size, doc = np.concatenate(held, axis=1)
        n = begin[sent + 1] - begin[sent]
        at = order[np.repeat(begin[sent] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))]
        member = np.repeat(np.arange(len(sent)), n)
        yield s.own[at], s.first[at] + start[member], size[member], doc[member], member + before
        before, held, n_held = before + n_held, [], 0


def repeat_groups(docs: DataFrame, min_bytes: int = MIN_BYTES, across: bool = True, sizes: Sizes = SIZES) -> DataFrame:
    """All occurrences of all maximal repeats: ``digest`` of the repeated bytes, ``size``, ``doc_id``, ``k1, k2``
    (hashes of the text), ``start`` (byte) and ``first_doc``. ``across``: only repeats that stand in several documents."""
    found, buckets = _found(docs, min_bytes, across, sizes, True)

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, h1, h2, lengths, text, answers, groups in _one_by_one(batches):
            x = _read_block(ids, lengths, text, min_bytes)
            keys = [np.frombuffer(h, np.int64) for h in (h1, h2)]
            digests = b"".join(g["digest"] for g in groups or ())
            for own, at, size, doc, member in _occurrences(x, answers, groups, buckets, min_bytes):
                digest = [digests[16 * k : 16 * k + 16] for k in member.tolist()]
                columns = [pa.array(digest, pa.binary()), *(pa.array(c) for c in (size, x.docs[own], keys[0][own], keys[1][own], at - x.bounds[own], doc))]
                yield pa.RecordBatch.from_arrays(columns, names=["digest", "size", "doc_id", "k1", "k2", "start", "first_doc"])

    rows = found.select("docs", "k1", "k2", "sizes", "text", "answers", "groups").mapInArrow(give, "digest binary, size long, doc_id long, k1 long, k2 long, start long, first_doc long")
    known = lambda c: F.when(F.col(c) > _NO_ID, F.col(c)).alias(c)
    return rows.select("digest", "size", known("doc_id"), "k1", "k2", "start", known("first_doc"))


def without(raw: bytes, start: np.ndarray, end: np.ndarray) -> tuple[bytes, int, int]:
    """The bytes outside the runs, how many went, and in how many pieces."""
    if not len(start):
        return raw, 0, 0
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    opens = np.concatenate([[True], start[1:] > reach[:-1]])
    begins, ends = start[opens].tolist(), reach[np.concatenate([opens[1:], [True]])].tolist()
    kept = b"".join(raw[i:j] for i, j in zip([0, *ends], [*begins, len(raw)]))
    return kept, sum(ends) - sum(begins), len(begins)


def edited(docs: DataFrame, min_bytes: int = MIN_BYTES, sizes: Sizes = SIZES) -> DataFrame:
    """A row for each row: ``doc_id, k1, k2`` (hashes of the text), ``n_bytes, n_removed, n_spans`` and ``kept``."""
    found, buckets = _found(docs, min_bytes, True, sizes, False)
    names = ["doc_id", "k1", "k2", "n_bytes", "n_removed", "n_spans", "kept"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, h1, h2, lengths, text, answers, groups in _one_by_one(batches):
            x = _read_block(ids, lengths, text, min_bytes)
            runs = [[np.empty(0, np.int64)] * 3]
            for own, at, size, doc, _ in _occurrences(x, answers, groups, buckets, min_bytes):
                later = x.docs[own] > doc
                runs.append([own[later], at[later], at[later] + size[later]])
            own, start, end = (np.concatenate(c) for c in zip(*runs))
            order = np.argsort(own, kind="stable")
            own, start, end = own[order], start[order], end[order]
            begin = np.searchsorted(own, np.arange(len(x.docs) + 1))
            raw = x.data.tobytes()
            done = [without(raw[i:j], start[k:m] - i, end[k:m] - i) for i, j, k, m in zip(x.bounds.tolist(), x.bounds[1:].tolist(), begin.tolist(), begin[1:].tolist())]
            columns = [pa.array(x.docs), pa.array(np.frombuffer(h1, np.int64)), pa.array(np.frombuffer(h2, np.int64)), pa.array(np.diff(x.bounds)), pa.array([d[1] for d in done], pa.int64()), pa.array([d[2] for d in done], pa.int64()), pa.array([d[0] for d in done], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = found.select("docs", "k1", "k2", "sizes", "text", "answers", "groups").mapInArrow(cut, "doc_id long, k1 long, k2 long, n_bytes long, n_removed long, n_spans long, kept binary")
    return rows.withColumn("doc_id", F.when(F.col("doc_id") > _NO_ID, F.col("doc_id")))


def drop_repeats(docs: DataFrame, min_bytes: int = MIN_BYTES, sizes: Sizes = SIZES) -> DataFrame:
    """The documents with all their columns and behind them, by longer names where these are taken: ``n_bytes``,
    ``n_removed``, ``n_spans`` and ``kept``, the bytes that stay. A cut can part a character, so what stays is binary."""
    names = [unused(c, docs) for c in ("n_bytes", "n_removed", "n_spans", "kept")]
    own, k1, k2 = (unused(c, docs) for c in ("edited_id", "edited_k1", "edited_k2"))
    # rows equal in identifier and text are edited alike
    found = edited(docs, min_bytes, sizes).dropDuplicates(["doc_id", "k1", "k2"]).withColumnsRenamed({"doc_id": own, "k1": k1, "k2": k2} | dict(zip(("n_bytes", "n_removed", "n_spans", "kept"), names)))
    keys = text_keys(docs["text"])
    same = docs["doc_id"].cast("long").eqNullSafe(F.col(own)) & (keys[0] == F.col(k1)) & (keys[1] == F.col(k2))
    return docs.hint("merge").join(found.hint("merge"), same).select(*docs.columns, *names)
