import base64
import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from spanlake.llm import winnow as w


FACTOR, MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


def slow_hash(gram):
    """A polynomial over the code points, its bits spread, in plain integers."""
    x = sum((ord(c) + 1) * FACTOR ** (len(gram) - 1 - j) for j, c in enumerate(gram)) & MASK
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return (x ^ x >> 31) >> 32


def slow(text, k=8, window=32):
    if not text:
        return [], []
    k = min(k, len(text))
    n = len(text) - k + 1
    size = min(window, n)
    h = [slow_hash(text[i : i + k]) for i in range(n)]
    picked = set()
    for i in range(n - size + 1):
        low = min(h[i : i + size])
        picked.add(max(j for j in range(i, i + size) if h[j] == low))
    return sorted(picked), [h[p] for p in sorted(picked)]


def slow_likeness(a, b):
    a, b = set(slow(a)[1]), set(slow(b)[1])
    return len(a & b) / len(a | b) if a | b else 1.0


def slow_text(text):
    return base64.b64encode(b"".join(h.to_bytes(4, "little") for h in slow(text)[1])).decode()


@settings(max_examples=60, deadline=None)
@given(st.one_of(st.text(alphabet="ab", max_size=400), st.text(max_size=200)))
def test_selection_by_definition(text):
    hashes, positions = w.winnow(text)
    places, values = slow(text)
    assert positions.tolist() == places and hashes.tolist() == values


def test_shared_passage_shares_a_fingerprint():
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    for _ in range(30):
        a, b, shared = letters(3000), letters(5000), letters(w.K + w.WINDOW - 1)
        x, y = w.winnow(a + shared + b)[0], w.winnow(b[:1000] + shared + a)[0]
        assert len(np.intersect1d(x, y))


def test_blocks_of_long_texts_join():
    text = "".join(random.Random(5).choice("abcdefg") for _ in range(5000))
    whole, step = w.winnow(text), w._STEP
    try:
        w._STEP = 700
        parts = w.winnow(text)
    finally:
        w._STEP = step
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_edited_and_next(spark, docs, no_docs):
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for i, (d, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        n = len(t) // 4
        edited = t[: len(t) - n] + after[:n]
        want.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), slow_text(t), slow_text(edited), slow_likeness(t, edited), slow_likeness(t, after)))
    key = lambda r: (r[0] is not None, r[0] or 0, *map(str, r[1:]))
    assert sorted((tuple(r) for r in w.compare_with_edited(docs).collect()), key=key) == sorted(want, key=key)
    assert w.compare_with_edited(no_docs).count() == 0 and w.fingerprints(no_docs).count() == 0


def test_groups_of_few_rows_join(spark):
    df = spark.createDataFrame([(i, f"text number {i} " * 5) for i in range(200)], "doc_id long, text string")
    rows = w.with_next(df, rows_per_group=7).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r.g, []).append((r.follows, r.doc_id))
    follows = sorted(d for g in groups.values() for f, d in g if f)
    heads = sorted(min(d for f, d in g if not f) for g in groups.values())
    assert len(groups) > 10 and follows == heads


def test_likeness_does_not_depend_on_length():
    """Of two texts the one a few characters longer is alike at every length."""
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefghij ") for _ in range(9_000))
    for n in (*range(700, 1_100, 9), *range(2_000, 2_150, 11), *range(4_000, 4_200, 7), 8_900):
        # nine code points change a few fingerprints, of which a text has about two in 33 code points
        assert w.likeness(w.winnow(text[: n + 9])[0], w.winnow(text[:n])[0]) > (0.95 if n >= 2_000 else 0.85), n
