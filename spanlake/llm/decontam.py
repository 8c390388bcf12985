"""Benchmark decontamination with DataFrame functions only.

The benchmark's distinct windows of ``n`` words form a hash set. Every window of a
document's words is hashed, looked up, and verified word by word; words inside hits are
counted, and documents or spans removed.

The set is broadcast while it has at most ``max_broadcast`` windows and ``MAX_BROADCAST_BYTES`` of
words and item identifiers; beyond that, hashes of document windows are joined by shuffle and the
hits verified after. Rows without a window take no part in that shuffle.

Defined cases: a null text has no words; a null identifier or repeated rows are kept, each
with its result; items without words have no windows; items of fewer than ``n`` words are one
window; empty tables give an empty result or no hits; other columns are passed through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import unused

N = 10
MAX_BROADCAST, MAX_BROADCAST_BYTES = 1_000_000, 192 << 20
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str | Column) -> Column:
    """Words of a text: digits, letters and all that isn't ASCII; A-Z in lower case."""
    lowered = F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, NOT_WORD), "")


def item_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """Distinct windows: hash ``w_hash``, words ``w_words``, length ``w_len``, ``w_items`` that have it."""
    w = benchmark.select("item_id", words("text").alias("ws")).where(F.size("ws") > 0)
    w = w.select("item_id", "ws", F.least(F.lit(n), F.size("ws")).alias("k"))
    w = w.select("item_id", "ws", "k", F.explode(F.expr("sequence(1, size(ws) - k + 1)")).alias("at"))
    w = w.select("item_id", F.expr("slice(ws, at, k)").alias("w_words"))
    w = w.groupBy("w_words").agg(F.collect_set("item_id").alias("w_items"))
    return w.select(F.xxhash64("w_words").alias("w_hash"), "w_words", F.size("w_words").alias("w_len"), "w_items")


def contamination(
    docs: DataFrame, benchmark: DataFrame, n: int = N, max_broadcast: int = MAX_BROADCAST
) -> DataFrame:
    """One row for each document: ``doc_id, text_hash, n_words, n_hit, items, hits, contaminated``.

    ``hits`` are (first word, words) of every occurrence. ``text_hash`` tells repeated
    identifiers apart; rows that share both are counted and given back as often.
    """
    windows = item_windows(benchmark, n)
    size_of = F.octet_length(F.array_join("w_words", " ")) + 16 * F.size("w_items") + 64
    found = windows.agg(F.collect_set("w_len").alias("lengths"), F.count("*").alias("n"), F.sum(size_of).alias("bytes")).first()  # at most n lengths
    lengths = sorted(found["lengths"]) or [n]
    small = found["n"] <= max_broadcast and (found["bytes"] or 0) <= MAX_BROADCAST_BYTES
    base = docs.select(F.col("doc_id").alias("d_id"), F.xxhash64("text").alias("d_text"), words("text").alias("d_words"))
    # place 0 stands for the document itself, so that it is kept without hits
    each = len(lengths)
    last = F.greatest(F.lit(0), F.size("d_words") - lengths[0] + 1) * each
    place = base.select("d_id", "d_text", "d_words", F.explode(F.sequence(F.lit(0), last)).alias("d_place"))
    at = ((F.col("d_place") - 1) / each).cast("int") + 1
    size = F.element_at(F.array(*map(F.lit, lengths)), (F.pmod(F.col("d_place") - 1, F.lit(each)) + 1).cast("int")) if each > 1 else F.lit(lengths[0])
    fits = (F.col("d_place") > 0) & (at + size - 1 <= F.size("d_words"))
    place = place.select(
        "d_id", "d_text", "d_words", "d_place", at.alias("d_at"),
        F.when(fits, F.xxhash64(F.slice("d_words", at, size))).alias("d_hash"),
    )
    if small:
        same = (F.col("d_hash") == F.col("w_hash")) & (F.slice("d_words", F.col("d_at"), F.col("w_len")) == F.col("w_words"))
        found = place.join(F.broadcast(windows), same, "left")
    else:
        keyed = place.where("d_hash IS NOT NULL").select("d_id", "d_text", "d_place", "d_at", "d_hash")
        hits = keyed.join(windows, F.col("d_hash") == F.col("w_hash"))
        texts = base.dropDuplicates(["d_id", "d_text"]).select(F.col("d_id").alias("t_id"), F.col("d_text").alias("t_text"), "d_words")
        hits = hits.join(texts, F.col("d_id").eqNullSafe(F.col("t_id")) & (F.col("d_text").eqNullSafe(F.col("t_text"))))
        hits = hits.where(F.slice("d_words", F.col("d_at"), F.col("w_len")) == F.col("w_words")).drop("t_id", "t_text")
        # a row of each document, as it is at place 0 in the other way
        found = base.withColumn("d_place", F.lit(0)).unionByName(hits, allowMissingColumns=True)
    found = found.where((F.col("d_place") == 0) | F.col("w_hash").isNotNull()).select(
        "d_id", "d_text", "w_items",
        F.when(F.col("d_place") == 0, F.size("d_words")).alias("own"),
        F.when(F.col("w_hash").isNotNull(), F.struct(F.col("d_at").alias("at"), F.col("w_len").alias("size"))).alias("hit"),
    )
    per = found.groupBy("d_id", "d_text").agg(
        F.max("own").alias("n_words"), F.count("own").alias("times"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("w_items")))).alias("items"),
        F.array_sort(F.collect_set("hit")).alias("hits"),
    )
    covered = F.expr("size(array_distinct(flatten(transform(hits, h -> sequence(h.at, h.at + h.size - 1)))))")
    per = per.select("*", covered.cast("long").alias("n_hit"))
    per = per.withColumn("time", F.explode(F.expr("sequence(1, int(times))")))
    return per.select(
        F.col("d_id").alias("doc_id"), F.col("d_text").alias("text_hash"), F.col("n_words").cast("long").alias("n_words"),
        "n_hit", "items", "hits", (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, n: int = N, remove: str = "documents", max_broadcast: int = MAX_BROADCAST
) -> DataFrame:
    """Documents without benchmark text: contaminated ones are left out (``documents``) or
    lose the words of hits and what stands between them (``spans``)."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    found = contamination(docs, benchmark, n, max_broadcast).where("contaminated").groupBy("doc_id", "text_hash").agg(F.first("hits").alias("hits"))
    own, text_hash, hits = (unused(c, docs) for c in ("bad_id", "bad_text", "hit_spans"))
    bad = found.select(F.col("doc_id").alias(own), F.col("text_hash").alias(text_hash), F.col("hits").alias(hits))
    same = docs["doc_id"].eqNullSafe(F.col(own)) & (F.xxhash64(docs["text"]) == F.col(text_hash))
    if remove == "documents":
        return docs.join(bad, same, "left_anti")
    text = F.when(F.col(hits).isNull(), F.col("text")).otherwise(_without(F.col("text"), F.col(hits)))
    return docs.join(bad, same, "left").select(*[text.alias("text") if c == "text" else docs[c] for c in docs.columns])


def _without(text: Column, hits: Column) -> Column:
    """The text without the words of the hits and what stands between two words of one hit."""
    word, gap = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)", r"([\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"
    # behind a space put before the text, gaps stand at even places and word n at place 2n - 1
    pieces = F.regexp_extract_all(F.concat(F.lit(" "), text), F.lit(f"{word}|{gap}"), 0)

    def stays(_: Column, i: Column) -> Column:
        return ~F.exists(hits, lambda h: (F.shiftright(i + 1, 1) >= h["at"]) & (F.shiftright(i, 1) + 1 <= h["at"] + h["size"] - 1))

    return F.substr(F.array_join(F.filter(pieces, stays), ""), F.lit(2))
