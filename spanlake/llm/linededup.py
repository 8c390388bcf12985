"""Line dedup by winnowing over line hashes.

A run of lines repeats if it has at least ``min_words`` words and stood before, in document
order or earlier in the same document. Windows are the shortest runs of lines with that many
words; in each, the smallest line hash (the rightmost of ties) is selected as fingerprint. Two
documents that share such a run share a window and so a fingerprint: nothing is missed.

1. Each document gives its fingerprints with the lines around them, one row each.
2. Fingerprints that occur once go; the positions of the others are joined.
3. Around each position the match is extended both ways: every window that selected it is
   looked up by its whole content, and the first place of that content is kept.
4. The union of the later windows is the repeated run; its lines are deleted.

Each step groups by content and compares with the first place only, so a passage in a third of
all documents costs a row for each, not for each pair.

Lines are compared without white space at their ends and without repeated spaces; lines that
are empty then count as no line and stay. Defined cases: a null text stays null; an empty text
stays; a null identifier sorts first; rows equal in identifier and text are one document and
edited alike; a line that repeats over and over keeps its first window; empty tables give empty
results; other columns are passed through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import row_batches, row_key, staged, unstage, unused

MIN_WORDS = 50
_SPACES = re.compile(r"\s+")


#: A line's digest: 128 bits, of which the first 64 are the hash that windows select by.
_DIGEST = np.dtype([("hash", "<i8"), ("rest", "<i8")])


def line_digest(line: str) -> bytes:
    """A 128-bit digest of the line as it is compared."""
    raw = _SPACES.sub(" ", line.strip()).encode("utf-8", "surrogatepass")
    return hashlib.blake2b(raw, digest_size=_DIGEST.itemsize).digest()


def document_lines(text: str) -> tuple[list[int], list[bytes], list[int]]:
    """Of the lines that aren't blank: place in the text, digest, words."""
    places, hashes, words = [], [], []
    for i, line in enumerate(text.split("\n")):
        n = len(line.split())
        if n:
            places.append(i)
            hashes.append(line_digest(line))
            words.append(n)
    return places, hashes, words


def windows(words: list[int], min_words: int) -> list[tuple[int, int]]:
    """The shortest runs (first, last) with ``min_words`` from each first and up to each last line, no run twice."""
    total = np.concatenate([[0], np.cumsum(words)])
    first = np.arange(len(words))
    last = np.searchsorted(total, total[:-1] + min_words)  # lines before the end of the run
    forward = {(int(i), int(j) - 1) for i, j in zip(first, last) if j <= len(words)}
    begin = np.searchsorted(total, total[1:] - min_words, side="right") - 1
    backward = {(int(i), int(j)) for i, j in zip(begin, first) if i >= 0}
    return sorted(forward | backward)


def selected(hashes: np.ndarray, first: int, last: int) -> int:
    """The place of the smallest hash of a window, the rightmost of ties."""
    w = hashes[first : last + 1]
    return last - int(np.argmin(w[::-1]))


_FOUND = "fingerprint long, doc_id long, doc_key long, at int, lines binary, words binary, first int, places binary"


def fingerprints(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """A row for each fingerprint: the line's hash and place, and digests, words and places of the
    lines of all windows that selected it (from line ``first``)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in row_batches(batches):
            out: list[list] = [[] for _ in range(8)]
            for doc, key, text in zip(*(c.to_pylist() for c in b.columns)):
                places, hashes, words = document_lines(text or "")
                if sum(words) < min_words:
                    continue
                lines, w, pl = np.frombuffer(b"".join(hashes), _DIGEST), np.array(words, np.int32), np.array(places, np.int32)
                h = lines["hash"]
                around: dict[int, list[int]] = {}
                for i, j in windows(words, min_words):
                    p = selected(h, i, j)
                    span = around.setdefault(p, [i, j])
                    span[0], span[1] = min(span[0], i), max(span[1], j)
                for p, (i, j) in around.items():
                    row = (int(h[p]), doc, key, p, lines[i : j + 1].tobytes(), w[i : j + 1].tobytes(), i, pl[i : j + 1].tobytes())
                    for column, v in zip(out, row):
                        column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, _FOUND_TYPES)], names=_FOUND_NAMES)

    return docs.select(F.col("doc_id").cast("long"), row_key("doc_id", "text"), "text").mapInArrow(find, _FOUND)


_FOUND_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary())
_FOUND_NAMES = [c.split()[0] for c in _FOUND.split(", ")]
_WINDOWS = "content long, content2 long, doc_id long, doc_key long, first int, last int"


def extended(repeated: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Every window that selected a fingerprint: two hashes of its content and its places in the text."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[] for _ in range(6)]
            for _, doc, key, at, lines, words, first, places in zip(*(c.to_pylist() for c in b.columns)):
                full, pl = np.frombuffer(lines, _DIGEST), np.frombuffer(places, np.int32)
                h = full["hash"]
                for i, j in windows(np.frombuffer(words, np.int32).tolist(), min_words):
                    if selected(h, i, j) + first != at:
                        continue
                    digest = hashlib.blake2b(full[i : j + 1].tobytes(), digest_size=16).digest()
                    row = (int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True), doc, key, int(pl[i]), int(pl[j]))
                    for column, v in zip(out, row):
                        column.append(v)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=[c.split()[0] for c in _WINDOWS.split(", ")])

    return repeated.mapInArrow(extend, _WINDOWS)


#: Rows of one key are dealt over so many seats by their document.
SEATS = 1024


def seat() -> Column:
    return F.pmod(F.col("doc_key"), F.lit(SEATS)).alias("seat")


def seated(rows: DataFrame, keys: list[str], place: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(``keys``, ``seat`` and ``origin``, the least ``place``, of keys that stand in several rows; the staged table it
    reads). Rows are joined with these by key and seat, so that a very common key is split over tasks."""
    least = [] if place is None else [F.min(place).alias("origin")]
    parts = staged(rows.groupBy(*keys, seat()).agg(F.count("*").alias("n"), *least), "parts")
    whole = parts.groupBy(*keys).agg(F.sum("n").alias("total"), *([] if place is None else [F.min("origin").alias("origin")])).where("total > 1")
    return parts.select(*keys, "seat").hint("merge").join(whole.drop("total").hint("merge"), keys), parts


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """A row for each document with repeated runs: ``doc_id, doc_key`` and ``runs`` (first and last line)."""
    found = staged(fingerprints(docs, min_words), "fingerprints")
    often, held = seated(found, ["fingerprint"])
    places = staged(extended(found.withColumn("seat", seat()).hint("merge").join(often.hint("merge"), ["fingerprint", "seat"]).select(*found.columns), min_words), "windows")
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "doc_key", "first", "last")
    firsts, held_firsts = seated(places, ["content", "content2"], place)
    later = places.withColumn("seat", seat()).hint("merge").join(firsts.hint("merge"), ["content", "content2", "seat"]).where(place != F.col("origin"))
    inside = F.col("doc_id").eqNullSafe(F.col("origin.doc_id")) & (F.col("doc_key") == F.col("origin.doc_key"))
    begin = F.when(inside, F.greatest("first", F.col("origin.last") + 1)).otherwise(F.col("first"))
    later = later.select("doc_id", "doc_key", F.struct(begin.alias("first"), "last").alias("run"))
    runs = staged(later.groupBy("doc_id", "doc_key").agg(F.sort_array(F.collect_set("run")).alias("runs")), "runs")
    unstage(found, held, places, held_firsts)
    return runs


def drop_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without later repeated runs, all other columns as they are, and behind them how many lines
    went: ``lines_removed``, or a longer name if there is a column of that name."""
    names, counted = docs.columns, unused("lines_removed", docs)
    own, key, runs = unused("run_id", docs), unused("run_key", docs), unused("runs", docs)
    found = repeated_runs(docs, min_words).select(F.col("doc_id").alias(own), F.col("doc_key").alias(key), F.col("runs").alias(runs))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in row_batches(batches):
            texts, counts = [], []
            for text, spans in zip(b.column("text").to_pylist(), b.column(runs).to_pylist()):
                gone = {k for s in spans or () for k in range(s["first"], s["last"] + 1)}
                if gone:
                    text = "\n".join(line for k, line in enumerate(text.split("\n")) if k not in gone)
                texts.append(text)
                counts.append(len(gone))
            columns = [pa.array(texts, pa.string()) if c == "text" else b.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int32())], names=[*names, counted])

    same = docs["doc_id"].cast("long").eqNullSafe(F.col(own)) & (row_key(docs["doc_id"], docs["text"]) == F.col(key))
    schema = T.StructType([*docs.schema.fields, T.StructField(counted, T.IntegerType())])
    # by shuffle at every size, so that a run's cost follows its input
    return docs.hint("merge").join(found.hint("merge"), same, "left").drop(own, key).mapInArrow(cut, schema)
