"""Ranked search, exact repeats and importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from spanlake.llm import importance, search, suffixes
from spanlake.llm.common import staged

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())


def slow_search(docs, items, best=10):
    """Rows (item, rank, doc_id, score) by the formula."""
    found = [(d, Counter(TERM.findall(lowered(t)))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in found]
    n_docs, n_terms = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(w for _, c in found for w in c)
    out = []
    for item, text in items:
        rows = []
        for (d, c), n in zip(found, sizes):
            score = 0
            for w in set(TERM.findall(lowered(text))) & c.keys():
                m = 10 + 90 * n * n_docs // n_terms
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (1_000_000_000 * c[w] // (1000 * c[w] + 8 * m))
            if score > 0:
                rows.append((-score, d is not None, d or 0, d))
        out += [(item, k, r[3], -r[0]) for k, r in enumerate(sorted(rows)[:best], 1)]
    return sorted(out, key=str)


def test_search(spark, docs, no_docs):
    items = [(1, "w1 w2 W3, w17"), (2, None), (3, "nowhere"), (3, "w1"), (None, "token 字 changed2"), (4, "same line"), (5, "w5 " * 9)]
    table = spark.createDataFrame(items, "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = slow_search(rows, items)
    for block in (search.BLOCK, 3):  # in one block, and in several
        found = search.search(docs, table, block=block).collect()
        assert sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in found), key=str) == want
    assert search.search(no_docs, table).count() == 0 and search.search(docs, table.limit(0)).count() == 0
    assert search.search(docs.withColumnRenamed("lang", "item_id"), table, best=2).columns == ["item_id", "rank", "doc_id", "score"]


@settings(deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 2**20), st.integers(0, 2**40)), max_size=60))
def test_accumulation(rows):
    item, doc, impact = (np.array([r[k] for r in rows], np.int64) for k in range(3))
    want = Counter()
    for i, d, x in rows:
        want[i, d] += x
    found = search.accumulate(item, doc, impact, 2**20 + 1)
    assert list(zip(*(c.tolist() for c in found))) == [(i, d, want[i, d]) for i, d in sorted(want)]


def slow_kept(rows, least):
    """(doc_id, bytes that stay, removed, spans) of each row."""
    first = {}
    for d, t in rows:
        for q in range(len(t) - least + 1):
            s = t[q : q + least]
            first[s] = min(first.get(s, d), d)
    out = []
    for d, t in rows:
        gone = [False] * (len(t) + 1)
        for q in range(len(t) - least + 1):
            if first[t[q : q + least]] < d:
                gone[q : q + least] = [True] * least
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((d, kept, sum(gone), sum(b and not a for a, b in zip([False, *gone], gone))))
    return out


def test_repeats(spark, docs, no_docs):
    rows = [(r.doc_id if r.doc_id is not None else -1, (r.text or "").encode()) for r in docs.collect()]
    want = sorted(slow_kept(rows, 50))
    for sizes in (suffixes.SIZES, suffixes.Sizes(3_000, 100, 1_000, 1)):  # in one bucket, and in many, with strings on their own as for very common anchors
        found = suffixes.drop_repeats(docs, sizes=sizes)
        assert found.columns == [*docs.columns, "n_bytes", "n_removed", "n_spans", "kept"]
        got = sorted((r.doc_id if r.doc_id is not None else -1, bytes(r.kept), r.n_removed, r.n_spans) for r in found.collect())
        assert got == want and sum(w[2] for w in want) > 5_000
    assert suffixes.drop_repeats(no_docs).count() == 0


def test_repeats_of_odd_texts(spark):
    """NUL bytes, runs of one byte, cut characters, clashing columns, equal identifiers."""
    rng = random.Random(5)
    pool = ["\x00" * 70, "ab" * 40, "é字" * 30, "a" * 200] + ["".join(rng.choice("ab\x00") for _ in range(60)) for _ in range(3)]
    rows = [(k // 2, "".join(rng.choice(pool)[rng.randrange(9) :] for _ in range(rng.randrange(5))), "x") for k in range(40)]
    table = spark.createDataFrame(rows, "doc_id long, text string, kept string").repartition(4)
    found = suffixes.drop_repeats(table)
    assert found.columns == ["doc_id", "text", "kept", "n_bytes", "n_removed", "n_spans", "_kept"]
    want = sorted(slow_kept([(d, t.encode()) for d, t, _ in rows], 50))
    assert sorted((r.doc_id, bytes(r._kept), r.n_removed, r.n_spans) for r in found.collect()) == want


def test_what_blocks_and_buckets_send_grows_with_the_input(spark, monkeypatch):
    """Not with the number of blocks times that of buckets, however sizes stand to the texts; results stay."""
    sent = []
    monkeypatch.setattr(suffixes, "staged", lambda df, tag: sent.append((tag, out := staged(df, tag))) or out)
    sizes, rng = suffixes.Sizes(4_000, 10_000, 6_000, 20_000, 80_000), random.Random(7)
    arrays = []
    for n in (40, 360):
        texts = ["".join(rng.choice("abcdefgh") for _ in range(1_000)) for _ in range(n)]
        rows = [(k, texts[(k * 7 + k // n) % n] + str(k)) for k in range(2 * n)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
        got = sorted((r.doc_id, bytes(r.kept), r.n_removed, r.n_spans) for r in suffixes.edited(docs, sizes=sizes).collect())
        assert got == sorted(slow_kept([(d, t.encode()) for d, t in rows], 50)) and sum(g[2] for g in got) > 900 * n
        arrays.append(sent[-1][1].count())
    assert sent[-1][0] == "groups" and arrays[0] > 20 and arrays[1] < 13 * arrays[0]
    for tag, df in sent:
        if tag == "groups":
            assert not df.where("members IS NULL").count()


def test_repeats_by_parts_of_buckets(spark, docs):
    rows = [(r.doc_id if r.doc_id is not None else -1, (r.text or "").encode()) for r in docs.collect()]
    for common in (1, 20_000):
        sizes = suffixes.Sizes(3_000, 100, 1_000, common, 9_000)
        assert sizes.of(sum(len(t) for _, t in rows)).parts > 1
        got = sorted((r.doc_id if r.doc_id is not None else -1, bytes(r.kept), r.n_removed, r.n_spans) for r in suffixes.edited(docs, sizes=sizes).collect())
        assert got == sorted(slow_kept(rows, 50))


def test_members_within_others_are_left_out():
    """Of the members of a stretch and first document those that lie in none of the others."""
    rng = np.random.default_rng(3)
    own, start, size, first_doc = (rng.integers(low, high, 400) for low, high in ((0, 8), (0, 20), (1, 12), (0, 4)))
    rows = list(zip(own.tolist(), first_doc.tolist(), start.tolist(), (start + size).tolist()))
    kept = [rows[k] for k in suffixes._outermost(own, start, size, first_doc).tolist()]
    inner = {r for r in rows if any(r[:2] == q[:2] and q[2] <= r[2] and r[3] <= q[3] and q != r for q in rows)}
    assert sorted(kept) == sorted(set(rows) - inner) and [r[0] for r in kept] == sorted(r[0] for r in kept)
    assert not len(suffixes._outermost(*[own[:0]] * 4))


def test_texts_are_read_in_pieces(monkeypatch):
    """Every string of 50 bytes that lies in one text is in one stretch, whose anchor follows from the string alone."""
    rng = random.Random(1)
    texts = [bytes(rng.choice(b"abc") for _ in range(n)) for n in (3_000, 20, 50, 0, 51, 400)]
    data, bounds = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    seen = {}
    for piece in (1 << 16, 512, 64):
        monkeypatch.setattr(suffixes, "PIECE", piece)
        strings = set()
        for anchor, start, end in zip(*(c.tolist() for c in suffixes.stretches(data, bounds))):
            for q in range(start, end - 49):
                assert seen.setdefault(data[q : q + 50].tobytes(), anchor) == anchor and q not in strings
                strings.add(q)
        assert strings == {q for i, j in zip(bounds, bounds[1:]) for q in range(i, j - 49)}


def test_maximal_repeats():
    """Groups hold all occurrences; what always stands behind the same byte is no group of its own."""
    held = [b"xABCDEFGHIJy", b"zABCDEFGHIJw", b"zABCDEFGHIq"]
    group, own, place, size, low, high = suffixes.repeats_of(held, [3, 1, 2], [3, 1, 2], 8)
    found = {}
    for g, o, p, n in zip(group.tolist(), own.tolist(), place.tolist(), size.tolist()):
        found.setdefault((g, held[o][p : p + n]), set()).add((o, p))
    assert {s: m for (_, s), m in found.items()} == {b"ABCDEFGHIJ": {(0, 1), (1, 1)}, b"ABCDEFGHI": {(0, 1), (1, 1), (2, 1)}, b"zABCDEFGHI": {(1, 0), (2, 0)}}
    assert set(low.tolist()) == {1} and set(high.tolist()) == {2, 3}


def test_repeat_groups(spark):
    passage = "a passage of more than fifty bytes that stands in several documents."
    rows = [(1, f"one {passage} end"), (2, f"two {passage} stop"), (3, f"{passage}"), (4, "nothing of it here, but as long as others are in this test")]
    found = suffixes.repeat_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    at = {1: 4, 2: 4, 3: 0}
    assert {r.doc_id for r in found} == {1, 2, 3} and {r.first_doc for r in found} == {1}
    for d, t in rows[:3]:
        covered = set()
        for r in found:
            if r.doc_id == d:
                covered |= set(range(r.start, r.start + r.size))
        assert set(range(at[d], at[d] + len(passage))) <= covered
    groups = {}
    for r in found:
        groups.setdefault(bytes(r.digest), set()).add(r.doc_id)
    assert {1, 2, 3} in groups.values()


def test_features():
    texts = ["Hello World abc", "", None, "ünï X" * 3, "a" * 100_000 + " b c", " the end", "x y"]
    for n in (1, 2, 3):
        bucket, row, words = importance.features(pa.array(texts).slice(1), 10_000, n)
        want = Counter()
        for i, t in enumerate(texts[1:]):
            ws = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))
            assert words[i] == len(ws)
            want.update((i, zlib.crc32(b" ".join(ws[j : j + k])) % 10_000) for k in range(1, n + 1) for j in range(len(ws) - k + 1))
        assert Counter(zip(row.tolist(), bucket.tolist())) == want


def slow_resample(rows, target, percent=10, buckets=10_000, least=20, seed=2024):
    split = lambda t: [zlib.crc32(w) % buckets for w in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))]
    held = [(d, split(t)) for d, t in rows]
    s, t = Counter(b for _, bs in held for b in bs), Counter(b for x in target for b in split(x))
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in s}
    out = []
    for d, bs in held:
        weight = sum(gain[b] for b in bs) // len(bs) if bs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for k, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = k
    return [tuple(r) for r in out]


def test_resampling(spark, docs, no_docs):
    target = ["w1 w2 w3 w4", None, "changed1 zero"]
    table = spark.createDataFrame([(t,) for t in target], "text string")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for percent in (10, 50, 100):
        found = importance.resample(docs, table, percent=percent)
        assert found.columns == [*docs.columns[:9], *docs.columns[9:], "n_features", "weight", "_score", "rank"]
        got = sorted(((r.doc_id, r.n_features, r.weight, r._score, r.rank) for r in found.collect()), key=str)
        assert got == sorted(slow_resample(rows, target, percent), key=str)
    assert importance.resample(no_docs, table).count() == 0
    assert importance.resample(docs, table.limit(0), keep=["doc_id"]).count() == len(rows)
