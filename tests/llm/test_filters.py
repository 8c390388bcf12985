import hashlib
import random
import re
import zlib

import pytest

from spanlake.llm import decontam, toxicity


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def slow(rows, items, n=10):
    out = []
    for d, text in rows:
        ws, hit, found = words(text), set(), set()
        for i, item in items:
            iw = words(item)
            k = min(n, len(iw))
            wins = {tuple(iw[j : j + k]) for j in range(len(iw) - k + 1)} if iw else set()
            for j in range(len(ws) - k + 1):
                if k and tuple(ws[j : j + k]) in wins:
                    hit.update(range(j, j + k))
                    found.add(i)
        out.append((d, len(ws), len(hit), sorted(found)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def benchmark_table(spark, texts):
    ws = texts[-1].split()
    rows = [(1, " ".join(ws[100:125])), (2, " ".join(ws[110:118])), (3, None), (4, ""), (5, "tie tie TIE"), (6, "same line same line"), (1, " ".join(ws[5000:5030])), (7, "never in any document at all, to be sure of it here")]
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "1 AS d_id", "2 AS doc_id")


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_contamination(spark, docs, no_docs, benchmark_table, most):
    want = slow([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in benchmark_table.collect()])
    found = decontam.contamination(docs, benchmark_table, max_broadcast=most)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in found.collect()), key=str) == want
    assert decontam.contamination(no_docs, benchmark_table, max_broadcast=most).count() == 0
    none = decontam.contamination(docs, benchmark_table.limit(0), max_broadcast=most).collect()
    assert len(none) == docs.count() and not any(r.contaminated for r in none)


def test_clean_documents_stay_as_they_are(docs, benchmark_table):
    bad = {r.doc_id for r in decontam.contamination(docs, benchmark_table).collect() if r.contaminated}
    kept = decontam.decontaminate(docs, benchmark_table)
    assert kept.columns == docs.columns
    assert sorted(str(r) for r in kept.collect()) == sorted(str(r) for r in docs.collect() if r.doc_id not in bad)
    cut = decontam.decontaminate(docs, benchmark_table, remove="spans")
    before = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.text == before[r.doc_id] for r in cut.collect() if r.doc_id not in bad)


def test_spans_are_cut(spark):
    item = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    d = spark.createDataFrame([(1, "A, b! One two-three four five six seven eight nine TEN. c"), (2, None)], "doc_id long, text string")
    assert {r.doc_id: r.text for r in decontam.decontaminate(d, item, remove="spans").collect()} == {1: "A, b! . c", 2: None}


def test_folding_and_exceptions():
    assert toxicity.folded("1d10t tr@sh") == " idiot trash "
    assert toxicity.folded(None) == "  " and toxicity.folded("mоrоn") == " moron "
    m = toxicity.Matcher(toxicity.Model({f" {w} ": v for w, v in toxicity.BUILT_IN.items()}, toxicity.FALLBACK))
    assert m.features("the trash can is full")[0] == 0 < m.features("you are trash")[0]
    assert m.score("") == m.score(None) == m.score("a b") < toxicity.THRESHOLD
    assert m.score("idiot " + "word " * 1000) < m.score("idiot word")


def test_learned_words_and_held_out_rows(spark):
    rows, labels = [], []
    for i in range(1200):
        bad = i % 5 == 0
        rows.append((i, f"plain words number {i} here " + ("zorgax blimfen " if bad else "sunny meadow ") + f"and the rest {i % 97}"))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame([*rows, (5000, None), (5001, ""), (None, "zorgax")], "doc_id long, text string").selectExpr("*", "1 AS score", "0 AS toxic")
    known = spark.createDataFrame([*labels, (0, 1), (None, 1), (7777, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, known)
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert len(found) == 1203
    assert all(found[i].predicted == int(i % 5 == 0) for i in range(1200))
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(1200))
    assert found[5000].predicted == found[5001].predicted == 0 and not found[None].held_out
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == 1203 - 241
    assert toxicity.fit(docs, known.limit(0)).mapping == toxicity.FALLBACK
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_signs_are_read_both_ways():
    m = toxicity.Matcher(toxicity.Model({f" {w} ": v for w, v in toxicity.BUILT_IN.items()} | {" zorga": 2.0}, toxicity.FALLBACK))
    for plain, marked in (("You idiot", "You idiot!"), ("You moron idiot", "You moron! Idiot!"), ("scum", "$cum"), ("idiot you", "idiot!you"), ("moron", "moron1"), ("zorgax", "zorgax|"), ("you trash", "you tr@sh!")):
        assert m.score(marked) >= m.score(plain) - 1e-9 > m.score("") + 0.1, marked
    for harmless in ("trash can!", "the trash can! is", "class clown award|"):
        assert m.features(harmless)[0] == 0


def slow_features(text, model):
    """Words and beginnings at every place, one by one; the heaviest at a place, none within an exception."""
    best, spared = {}, []
    forms = toxicity.readings(text)
    for norm in forms:
        for at in range(len(norm)):
            for e, w in model.entries.items():
                if norm.startswith(e, at):
                    best[at] = max(best.get(at, 0.0), w)
            spared += [(at, at + len(e) + 1) for e in toxicity.EXCEPTIONS if norm.startswith(f" {e} ", at)]
    total = sum(w for at, w in best.items() if not any(i <= at < j for i, j in spared))
    return total, forms[0].count(" ") - 1


def test_features_by_definition():
    import math
    import random

    rng = random.Random(6)
    model = toxicity.Model({f" {w} ": v for w, v in toxicity.BUILT_IN.items()} | {" trash c": 0.5, " idio": 1.0, " stup": 3.0}, toxicity.FALLBACK)
    m = toxicity.Matcher(model)
    pieces = ["trash", "can", "idiot", "idiotic", "not", "stupid", "!", " ", " ", ", ", "@", "1", "word", "clown fish", "іdіоt", "ＩＤＩＯＴ", "\n", "7r45h", "$tup1d", "é"]
    for _ in range(400):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(25)))
        total, n = slow_features(text, model)
        x, y = m.features(text)
        assert math.isclose(x, math.log1p(total), abs_tol=1e-9) and math.isclose(y, 100 * total / max(n, 20), abs_tol=1e-9), text


def test_long_and_repeated_texts(spark):
    import time

    m = toxicity.Matcher(toxicity.Model({f" {w} ": v for w, v in toxicity.BUILT_IN.items()}, toxicity.FALLBACK))
    start = time.perf_counter()
    assert m.features("trash can " * 300_000)[0] == 0 < m.features("idiot! " * 400_000)[0]
    assert time.perf_counter() - start < 20
    rows = spark.createDataFrame([(1, "idiot " * 300_000), (2, "same idiot"), (2, "same idiot"), (2, "other")], "doc_id long, text string")
    found = toxicity.score(rows, m.model).collect()
    assert len(found) == 4 and len({r.score for r in found if r.doc_id == 2}) == 2


#: Harmless words that begin like a toxic one, and harmless sentences.
HARMLESS = ["Follow the path.", "It is worth the trip", "He is from Morocco.", "a disguise", "clowning around", "losers weep", "the stupa", "trasher", "a reasonable achievement of the team", "scumble the paint"]


@pytest.mark.parametrize(("sf", "recall"), [("sf0.01", 0.6), ("sf0.1", 0.9)])
def test_held_out_fold(spark, sf, recall):
    """Of the fold that nothing was learned from: most toxic documents are found (of 0.01, whose 51 toxic ones are too few to learn other
    languages from, those in English), few others rejected, and plain words that share letters with an entry stay clean."""
    from pyspark.sql import functions as F

    from spanlake.llm.common import read_table

    d = f"/root/testdata/{sf}"
    docs, labels = read_table(spark, d, "documents"), read_table(spark, d, "labels")
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs, model).where("held_out").join(labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id").collect()
    hits = sum(r.predicted and r.toxic for r in scored)
    assert hits >= recall * sum(r.toxic for r in scored) and hits >= 0.9 * sum(r.predicted for r in scored)
    m = toxicity.Matcher(model)
    assert all(m.score(t) < toxicity.THRESHOLD for t in HARMLESS) and m.score("You are a pathetic loser") > 0.9
    # an entry has to stand in several toxic documents that aren't copies of each other
    toxic = [set(toxicity.readings(r.text)[0].split()) for r in docs.join(labels.where("toxic = 1"), "doc_id").select("text").distinct().collect()]
    for e in set(model.entries) - {f" {w} " for w in toxicity.BUILT_IN}:
        assert sum(any(f" {w} ".startswith(e) for w in ws) for ws in toxic) >= 8, e


def test_a_beginning_needs_several_toxic_continuations(spark):
    """``zorg`` with many endings is learned as a beginning; ``brak``, in one toxic word only, isn't, and its harmless neighbours stay clean."""
    rows, labels, rng = [], [], random.Random(6)
    for i in range(600):
        bad = i % 4 == 0
        text = " ".join(f"word{rng.randrange(900)}" for _ in range(30)) + (f" zorg{'abcdefgh'[i // 4 % 8]}x brakul" if bad else " brakel")
        rows.append((i, text))
        labels.append((i, 0, int(bad)))
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert any(e.startswith(" zorg") and not e.endswith(" ") for e in model.entries) and " brakul " in model.entries
    assert not any(" brakel".startswith(e) for e in model.entries)
    m = toxicity.Matcher(model)
    assert m.score("a zorgax b") > toxicity.THRESHOLD > m.score("a brakel b")
