"""Toxicity by a weighted lexicon.

Text is folded (homoglyphs, A-Z), reduced to words, and searched by Aho-Corasick for lexicon
entries: words, and beginnings of words. Digits and signs that stand for letters are read
as letters (``tr@sh``), as what ends a word (``idiot!``), and as either by their place (``tr@sh!``);
an entry that several readings have at one place counts once. Exception phrases cancel the entries inside them. The weights of
what remains are summed, normalised by length, and mapped to a probability.

Weights are learned as log odds of an entry in toxic and other labelled documents; the mapping
is a logistic regression on the weight sum and the weight per word. Both are fitted on a sample
of at most ``SAMPLE`` labelled documents of each class, chosen by a hash of the identifier, of which near copies count once; all
other steps see every document. Without labels, the built-in entries and a fixed mapping apply.
At most ``ENTRIES`` entries are learned, the best ones. What an entry needs follows the number of labels: that so many of
its documents are toxic by chance has to be unlikely, also for the luckiest of all candidates (``CHANCE``).
Whole words come first. A beginning of a word (from ``SHORTEST`` letters on) has to have several continuations that are toxic
themselves, none of which makes most of it: the first letters of one toxic word are no entry, as harmless words share them. Of
beginnings that stand in nearly the same documents the longest is taken.

Defined cases: null and empty texts have no entries and so the lowest score; repeated rows are
scored each; a null identifier is scored and not held out; a document with several labels counts
as toxic if one says so; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import row_batches, staged, text_bytes, unstage
from .shingles import shingle_set

#: Labelled documents of each class that are fitted on, entries that are learned at most, toxic documents that an entry needs, and how likely
#: a candidate may be by chance, all candidates taken together. From ``CLEAR`` log odds on an entry counts as one that clean documents don't have.
SAMPLE, ENTRIES, SUPPORT, CHANCE, CLEAR = 3_000, 1_000, 3, 0.01, 4.0
#: Of a beginning: continuations that are toxic, their share, and the most that one of them may make of its toxic documents.
FORMS, FORM_SHARE, ONE_FORM = 5, 0.6, 0.5
THRESHOLD = 0.3
SHORTEST, LONGEST = 4, 11

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = dict(zip("аеорсухіјѕԁһӏкмтвнАЕОРСУХІЈЅКМТВНαορνικτυ", "aeopcyxijsdhlkmtbhaeopcyxijskmtbhaopviktu"))
#: Digits and signs that stand for letters.
SUBSTITUTES = dict(zip("0134579@$!|", "oieastgasil"))
#: Entries before any learning.
BUILT_IN = {"idiot": 2.0, "moron": 2.0, "stupid": 1.0, "pathetic": 1.0, "worthless": 1.0, "scum": 2.0, "disgusting": 1.0, "loser": 1.5, "trash": 1.0, "clown": 1.0}
#: Phrases in which an entry means no offence.
EXCEPTIONS = ("trash can", "trash bin", "trash collection", "clown fish", "pathetic fallacy", "not stupid", "not worthless", "sore loser rule", "class clown award")

_FULL_WIDTH = {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
_FOLD = str.maketrans(HOMOGLYPHS | _FULL_WIDTH)
_ODD = re.compile("[Ͱ-ӿԀ-ԯ！-～]")
_LETTERS = {ord(k): ord(v) for k, v in SUBSTITUTES.items()}
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_READ = bytes(_LETTERS.get(b, _WORDS[b]) for b in range(256))
_STANDS_FOR = re.compile(f"[{re.escape(''.join(SUBSTITUTES))}]")
_AT_END = re.compile(rb"[0134579@$!|]+(?![0134579@$!|a-z\x80-\xff])")


def readings(text: str | None) -> list[str]:
    """The words with single spaces between and around them. A text with digits or signs that may
    stand for letters has readings of equal length: all of them as letters, as spaces (which then
    may follow each other), and as spaces at the ends of words only."""
    text = text or ""
    if _ODD.search(text):
        text = text.translate(_FOLD)
    raw = text.lower().encode("utf-8", "replace")
    if not _STANDS_FOR.search(text):
        return [(b" " + b" ".join(raw.translate(_WORDS).split()) + b" ").decode("utf-8", "replace")]
    forms = [raw.translate(_READ), raw.translate(_WORDS)]
    inner = _AT_END.sub(lambda m: b" " * len(m[0]), raw)
    if inner != raw:
        forms.append(inner.translate(_READ))
    forms = [np.frombuffer(b" " + f + b" ", np.uint8) for f in forms]
    space = forms[0] == 32
    stays = ~space
    stays[0] = True
    stays[1:] |= ~space[:-1]
    return [f[stays].tobytes().decode("utf-8", "replace") for f in forms]


def folded(text: str | None) -> str:
    """The reading in which digits and signs are letters."""
    return readings(text)[0]


class Model(NamedTuple):
    """Entries (`` word `` or `` beginning``) with weights, and the mapping to a probability."""

    entries: dict[str, float]
    mapping: tuple[float, float, float]


class Matcher:
    def __init__(self, model: Model):
        import ahocorasick

        self.model, self.automaton = model, ahocorasick.Automaton()
        for e, w in model.entries.items():
            self.automaton.add_word(e, (len(e), w))
        for e in EXCEPTIONS:
            self.automaton.add_word(f" {e} ", (len(e) + 2, None))
        self.automaton.make_automaton()

    def features(self, text: str | None) -> tuple[float, float]:
        """The weight sum, damped, and the weight per hundred words."""
        forms = readings(text)
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for norm in forms:
            for end, (size, weight) in self.automaton.iter(norm):
                at = end - size + 1
                if weight is None:
                    spared.append((at, end))
                elif weight > best.get(at, 0.0):
                    best[at] = weight  # of entries at one word the heaviest
        total, reach, k = 0.0, -1, 0
        spared.sort()
        for at in sorted(best):  # one sweep over entries and exceptions
            while k < len(spared) and spared[k][0] <= at:
                reach = max(reach, spared[k][1])
                k += 1
            total += best[at] if at >= reach else 0.0
        n = forms[0].count(" ") - 1
        return math.log1p(total), 100 * total / max(n, 20)

    def score(self, text: str | None) -> float:
        a, b, c = self.model.mapping
        x, y = self.features(text)
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, a + b * x + c * math.log1p(y)))))


def fold_of(doc_id: str | Column, of: int = 4) -> Column:
    """The documented fold of an identifier: crc32 of its decimal text, modulo ``of``."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(of))


def _labelled(labels: DataFrame, held_out: int) -> DataFrame:
    """(doc_id, toxic 0 or 1) outside the held-out fold."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(fold_of("doc_id") != held_out)
    return known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))


def sample(docs: DataFrame, labels: DataFrame, held_out: int = 2, per_class: int = SAMPLE) -> DataFrame:
    """(text, toxic) of at most ``per_class`` labelled documents of each class outside the held-out fold."""
    known = _labelled(labels, held_out)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = known.where("toxic = 1").orderBy(*order).limit(per_class).union(known.where("toxic = 0").orderBy(*order).limit(per_class))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = texts.join(F.broadcast(picked), "doc_id").select("text", "toxic")  # at most 2 * per_class rows are broadcast

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in row_batches(batches):
            sets = [shingle_set(text_bytes(t), 5) for t in b.column(0).to_pylist()]
            ends = [pa.array([int(s[i]) >> 1 if len(s) else None for s in sets], pa.int64()) for i in (0, -1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *ends], names=["text", "toxic", "low", "high"])

    # near copies mostly share the least or the greatest hash of their shingles: they count once as evidence
    once = rows.mapInArrow(sketch, "text string, toxic int, low long, high long")
    for end, rest in (("low", ["high"]), ("high", [])):
        # of copies the one with the least hash stays, so that every run learns from the same texts
        first = F.min(F.struct(F.xxhash64("text").alias("order"), "text", *rest)).alias("first")
        once = once.groupBy("toxic", end).agg(first).select("toxic", "first.text", *[f"first.{c}" for c in rest])
    return staged(once.select("text", "toxic"), "labelled")


def _candidates(text: str | None) -> set[str]:
    """The words of a text and their beginnings, as entries."""
    ws = {w for norm in readings(text) for w in norm.split()}
    return {f" {w} " for w in ws} | {f" {w[:k]}" for w in ws for k in range(SHORTEST, min(len(w), LONGEST + 1))}


def _counted(labelled: DataFrame) -> DataFrame:
    """(entry, toxic, other): in how many documents of each class an entry stands."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in row_batches(batches, 1_000_000):
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(*(c.to_pylist() for c in b.columns)):
                seen[1 - toxic].update(_candidates(text))
            keys = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([seen[0][k] for k in keys], pa.int64()), pa.array([seen[1][k] for k in keys], pa.int64())], names=["entry", "toxic", "other"])

    rows = labelled.mapInArrow(count, "entry string, toxic long, other long")
    return rows.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, rounds: int = 60, ridge: float = 1e-2) -> np.ndarray:
    """Weighted logistic regression by Newton's method; the first column of x is constant and not shrunk."""
    b = np.zeros(x.shape[1])
    shrink = np.diag([0.0] + [ridge] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (w * (y - p)) - shrink @ b
        curve = (x * (w * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + shrink + 1e-6 * np.eye(len(b))
        step = np.linalg.solve(curve, slope)
        b += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return b


FALLBACK = (-3.0, 1.0, 1.5)


def _evidence(pos: int, neg: int) -> Column:
    """By how much, in natural logarithms, it is unlikely that so many of an entry's documents are toxic by chance (a bound)."""
    rate = pos / (pos + neg)
    t, o = F.col("toxic"), F.col("other")
    part = lambda k, r: F.when(k > 0, k * F.log(k / ((t + o) * r))).otherwise(0.0)
    return F.when(t > (t + o) * rate, part(t, rate) + part(o, 1 - rate)).otherwise(0.0)


def _with_forms(counted: DataFrame, pos: int, neg: int) -> DataFrame:
    """Beginnings that have several continuations which are toxic themselves."""
    words = counted.where(F.col("entry").endswith(" ")).select(F.expr("substring(entry, 1, length(entry) - 1)").alias("word"), "toxic", (F.col("toxic") * neg > 2 * F.col("other") * pos).alias("bad"))
    starts = words.select(F.explode(F.expr(f"transform(sequence({SHORTEST} + 1, least(length(word), {LONGEST} + 1)), n -> substring(word, 1, n))")).alias("entry"), "word", "toxic", "bad").where(F.length("word") > SHORTEST)
    forms = starts.groupBy("entry").agg(F.count_if("bad").alias("bad"), F.count("*").alias("forms"), F.max("toxic").alias("top"), F.sum("toxic").alias("total"))
    enough = (F.col("bad") >= FORMS) & (F.col("bad") >= FORM_SHARE * F.col("forms")) & (F.col("top") <= ONE_FORM * F.col("total"))
    return counted.where(~F.col("entry").endswith(" ")).join(forms.where(enough).select("entry"), "entry")


def _chosen(words: list[tuple[str, float, float]], beginnings: list[tuple[str, float, float]], labelled: DataFrame, needed: float) -> dict[str, float]:
    """Of candidates (entry, weight, toxic documents), best first: beginnings, the longest of those with nearly the same documents,
    and words. A word that clean documents have as well must also bring its evidence from toxic documents that no better entry is in."""
    entries: dict[str, float] = {}
    for e, _, n in beginnings:
        if any(e.startswith(k) or k.startswith(e) for k in entries):
            continue
        longest = max((b for b in beginnings if b[0].startswith(e) and b[2] >= 0.95 * n), key=lambda b: len(b[0]))
        entries[longest[0]] = longest[1]
    known = {e for e, _, _ in words}

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in row_batches(batches, 4_000_000):
            yield pa.RecordBatch.from_arrays([pa.array([sorted(_candidates(t) & known) for t in b.column(0).to_pylist()], pa.list_(pa.string()))], names=["entries"])

    within: dict[str, set[int]] = {}
    for i, r in enumerate(labelled.where("toxic = 1").select("text").mapInArrow(reach, "entries array<string>").collect()):  # at most per_class rows
        for e in r["entries"]:
            within.setdefault(e, set()).add(i)
    reached: set[int] = set()
    for e, w, _ in words:
        fresh = within.get(e, set()) - reached
        if any(e.startswith(k) for k in entries) or (w < CLEAR and len(fresh) * w < needed):
            continue
        entries[e] = w
        reached |= fresh
    return entries


def fit(docs: DataFrame, labels: DataFrame, held_out: int = 2, per_class: int = SAMPLE) -> Model:
    """Learns entries and mapping from labelled documents outside the held-out fold."""
    built_in = {f" {w} ": v for w, v in BUILT_IN.items()}
    labelled = sample(docs, labels, held_out, per_class)
    sizes = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    if not pos or not neg:
        unstage(labelled)
        return Model(built_in, FALLBACK)
    # the sample holds equally many of each class; each counts for as many labelled documents as it stands for
    whole = {r["toxic"]: r["count"] for r in _labelled(labels, held_out).groupBy("toxic").count().collect()}
    share = {0: whole[0] / neg, 1: whole[1] / pos}
    odds = F.log((F.col("toxic") + 0.5) / (pos + 1)) - F.log((F.col("other") + 0.5) / (neg + 1))
    counted = staged(_counted(labelled).where(F.col("toxic") > 0).withColumns({"weight": odds, "evidence": _evidence(pos, neg)}), "entries")
    common = F.col("toxic") >= SUPPORT

    def best(candidates: DataFrame) -> tuple[list[tuple[str, float, float]], float]:
        """The best candidates, and the evidence that they need: more, the more there are."""
        needed = math.log(max(candidates.where(common).count(), 1) / CHANCE)
        good = candidates.where(common & (F.col("weight") > 1.5) & (F.col("evidence") >= needed))
        rows = good.orderBy(F.desc("evidence"), F.desc(F.length("entry")), "entry").limit(ENTRIES).select("entry", "weight", "toxic").collect()  # at most ENTRIES rows
        return [(r["entry"], r["weight"], r["toxic"]) for r in rows], needed

    words, needed = best(counted.where(F.col("entry").endswith(" ")))
    entries = _chosen(words, best(_with_forms(counted, pos, neg))[0], labelled, needed)
    unstage(counted)
    entries = {e: w for e, w in built_in.items() if e not in entries and not any(e.startswith(k) for k in entries)} | entries
    model = Model(entries, FALLBACK)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(model)
        for b in row_batches(batches):
            found = [m.features(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.float64()), b.column(1)], names=["x", "y", "toxic"])

    rows = labelled.mapInArrow(measure, "x double, y double, toxic int").collect()  # at most 2 * per_class rows of three numbers
    unstage(labelled)
    x = np.array([[1.0, r["x"], math.log1p(r["y"])] for r in rows])
    y = np.array([r["toxic"] for r in rows], dtype=float)
    b = _logistic(x, y, np.where(y > 0, share[1], share[0]))
    return Model(entries, tuple(float(v) for v in b))


SCORED = "doc_id long, held_out boolean, score double, predicted int"


def score(docs: DataFrame, model: Model, held_out: int = 2, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document: ``doc_id, held_out, score, predicted``."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(model)
        for b in row_batches(batches):
            s = [m.score(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s, pa.float64()), pa.array([int(v >= threshold) for v in s], pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    held = F.coalesce(fold_of("doc_id") == held_out, F.lit(False))
    return docs.select(F.col("doc_id").cast("long"), held.alias("held_out"), "text").mapInArrow(rate, SCORED)


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score is below the threshold, with their columns as they are."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(model)
        for b in row_batches(batches):
            clean = pa.array([m.score(t) < threshold for t in b.column("text").to_pylist()], pa.bool_())
            yield b.filter(clean)

    return docs.mapInArrow(keep, docs.schema)
