import random

from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np

from spanlake.llm import linededup, minhash

SPACE = " \t\n\x0b\x0c\r"


def word_list(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [x for x in "".join(" " if c in SPACE else c for c in low).split(" ") if x]


def shingles(text, n):
    ws = word_list(text)
    return {tuple(ws[i : i + n]) for i in range(max(1, len(ws) - n + 1))} if ws else set()


def slow_components(rows, n, percent):
    sets = [(d, shingles(t, n)) for d, t in rows]
    root = {d: d for d, _ in sets if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[i + 1 :]:
            if a is not None and b is not None and s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {(d, len(s), None if d is None else find(d)) for d, s in sets}


def check(docs, n):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = minhash.near_duplicates(docs, n, 0.8).collect()
    assert len(found) == len(rows)
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in found} == slow_components(rows, n, 80)
    assert all(r.kept == (r.doc_id == r.component_id or r.doc_id is None) for r in found)


def test_components_of_mixed_documents(spark, docs, no_docs):
    check(docs, 2)
    check(docs, 5)
    assert minhash.near_duplicates(no_docs).count() == 0


def test_chains_and_stars(spark):
    """Documents that change word by word: neighbours are alike, ends aren't; no document is near all others."""
    rng = random.Random(11)
    rows, w = [], [f"v{rng.randrange(10_000)}" for _ in range(80)]
    for i in range(120):
        w = list(w)
        w[rng.randrange(80)] = f"n{i}"
        rows.append((1000 - i, " ".join(w)))
    check(spark.createDataFrame(rows, "doc_id long, text string"), 2)


def test_many_copies(spark):
    rng = random.Random(2)
    base = [f"b{rng.randrange(5_000)}" for _ in range(150)]
    rows = []
    for i in range(400):
        w = list(base)
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(150)] = f"e{rng.randrange(10_000)}"
        rows.append((i, " ".join(w)))
    check(spark.createDataFrame(rows, "doc_id long, text string"), 2)


def test_hubs_of_many_seats(spark, monkeypatch):
    """Chains and copies whose hubs are dealt over many seats and blocks give the same components."""
    monkeypatch.setattr(minhash, "SEAT", 4)
    monkeypatch.setattr(minhash, "BLOCK", 3)
    rng = random.Random(5)
    rows, w = [], [f"v{rng.randrange(10_000)}" for _ in range(60)]
    for i in range(150):
        w = list(w)
        w[rng.randrange(60)] = f"n{i}"
        rows.append((i * 7 % 151, " ".join(w)))
    for i in range(60):
        rows.append((1000 + i, " ".join([*(f"c{k}" for k in range(80)), f"end{i}"])))
    check(spark.createDataFrame(rows, "doc_id long, text string"), 2)


def test_kept_documents_keep_their_columns(docs):
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    gone = {r.doc_id for r in minhash.near_duplicates(docs).collect() if not r.kept}
    assert sorted(str(r) for r in kept.collect()) == sorted(str(r) for r in docs.collect() if r.doc_id not in gone)


def test_estimate_is_unbiased():
    rng = np.random.default_rng(4)
    both = rng.integers(0, 1 << 63, 800).astype(np.uint64)
    one, other = (np.concatenate([both, rng.integers(0, 1 << 63, 100).astype(np.uint64)]) for _ in range(2))
    a, b = minhash.min_max(one), minhash.min_max(other)
    assert a.shape == (2, minhash.PERMUTATIONS)
    assert abs((a == b).mean() - 0.8) < 0.12


def test_links_of_sets_with_colliding_hashes(spark):
    """Sets just 0.8 alike meet the join condition however many of their 32-bit hashes collide."""
    rng = np.random.default_rng(6)
    draw = lambda n: rng.integers(0, 1 << 63, n).astype(np.uint64)
    both = draw(800)
    low = np.uint64(0xFFFFFFFF)
    both[:300] = both[:300] & ~low | both[300:600] & low
    for own, near in ((100, True), (130, False)):
        sets = [np.unique(np.concatenate([both, draw(own)])) for _ in range(2)]
        assert all(len(s) - len(minhash.set_row(s)[3]) >= 300 for s in sets)
        rows = [(i, *minhash.set_row(s)[:3], minhash.set_row(s)[3].tolist()) for i, s in enumerate(sets)]
        df = spark.createDataFrame(rows, minhash._SETS)
        links = df.alias("x").join(df.alias("y"), minhash._near("x", "y", 0.8)).where("x.rep < y.rep").count()
        assert links == int(near)


def slow_windows(words, least):
    n, found = len(words), set()
    for i in range(n):
        j = next((j for j in range(i, n) if sum(words[i : j + 1]) >= least), None)
        if j is not None:
            found.add((i, j))
    for j in range(n):
        i = next((i for i in range(j, -1, -1) if sum(words[i : j + 1]) >= least), None)
        if i is not None:
            found.add((i, j))
    return sorted(found)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 12), max_size=25), st.integers(1, 30))
def test_windows_by_definition(words, least):
    assert linededup.windows(words, least) == slow_windows(words, least)


def slow_dedup(rows, least):
    """Each window's first place stays, later ones go, without the lines of the first inside the same document."""
    rows = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0))
    seen, gone = {}, {}
    for r, (d, text) in enumerate(rows):
        places, hashes, words = linededup.document_lines(text or "")
        for i, j in slow_windows(words, least):
            content = tuple(hashes[i : j + 1])
            at = (r, places[i], places[j])
            if content not in seen:
                seen[content] = at
                continue
            first = seen[content]
            begin = max(places[i], first[2] + 1) if first[0] == r else places[i]
            gone.setdefault((d, text), set()).update(range(begin, places[j] + 1))
    return {(d, t): None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get((d, t), ())) for d, t in rows}


def test_repeated_lines(spark, docs, no_docs):
    for least in (50, 8):
        found = linededup.drop_repeated_lines(docs, least)
        assert found.columns == [*docs.columns, "lines_removed"]
        want = slow_dedup([(r.doc_id, r.text) for r in docs.collect()], least)
        before = {r.doc_id: r.text for r in docs.collect()}
        rows = found.collect()
        assert len(rows) == docs.count()
        for r in rows:
            assert r.text == want[r.doc_id, before[r.doc_id]], r.doc_id
    assert any(r.lines_removed for r in rows)
    assert linededup.drop_repeated_lines(no_docs).count() == 0


def test_columns_of_the_same_name_stay(spark):
    text = "\n".join(f"line {i} of a passage that has more than fifty words in all" for i in range(6))
    rows = spark.createDataFrame([(1, text, 7), (2, text, 8)], "doc_id long, text string, lines_removed int")
    found = {r.doc_id: r for r in linededup.drop_repeated_lines(rows).collect()}
    assert [(found[i].lines_removed, found[i]["_lines_removed"]) for i in (1, 2)] == [(7, 0), (8, 6)]


def test_lines_of_equal_hash_differ(spark):
    """Windows are told apart by 128 bits of each line, also where the 64 that select them collide."""
    digests = [b"\x01" * 8 + bytes([i]) * 8 for i in range(3)]
    words = np.array([60], np.int32).tobytes()
    rows = [(1, i, i, 0, digests[i % 3], words, 0, np.array([0], np.int32).tobytes()) for i in range(6)]
    found = linededup.extended(spark.createDataFrame(rows, linededup._FOUND), 50).collect()
    assert len({(r.content, r.content2) for r in found}) == 3 and len(found) == 6


def test_passage_across_lines_goes(spark):
    rng = random.Random(9)
    lines = [" ".join(f"p{rng.randrange(9999)}" for _ in range(9)) for _ in range(8)]
    rows = [(i, "\n".join([f"intro {i} of its own", *lines, f"outro {i}"])) for i in range(30)]
    found = {r.doc_id: r for r in linededup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[0].lines_removed == 0 and all(found[i].text == f"intro {i} of its own\noutro {i}" for i in range(1, 30))
