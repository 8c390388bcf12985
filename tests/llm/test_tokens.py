import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from spanlake.llm import packing, sstable, tokens
from spanlake.llm.common import shared_dir

PLAIN = Tokenizer.from_file(tokens.tokenizer_path())
MEMO = tokens.ChunkEncoder(tokens.tokenizer_path(), memo=50)


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="aAéÜß.,'!?<|endoftext>  \n\t1字ſİ-_ ", max_size=60)))
def test_memo_gives_the_tokenizers_ids(text):
    raw = text.encode("utf-8", "surrogatepass")
    assert MEMO.encode([raw])[0].tolist() == ids_of(raw.decode("utf-8", "replace"))


def test_shards_hold_all_documents(spark, docs, texts, no_docs):
    path = shared_dir(spark, "shards")
    manifest = sstable.write_shards(docs, path, shard_bytes=1_500)
    assert manifest.count() > 3
    rows = sstable.read_shards(spark, path, manifest).orderBy("start").collect()
    want = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    assert [r.doc_id for r in rows] == [d for d, _ in want]
    for r, (_, text) in zip(rows, want):
        packed = np.array([*ids_of(text), 2], dtype="<u4").tobytes()
        assert (r.start, r.n_tokens, bytes(r.ids), r.ids_crc32) == (at, len(packed) // 4, packed, zlib.crc32(packed))
        at += r.n_tokens
    keys = spark.range(0, 200).select(F.col("id").alias("doc_id"))
    found = {}
    for r in sstable.lookup(spark, path, manifest, keys).collect():
        found.setdefault(r.doc_id, []).append(bytes(r.ids))
    have = {}
    for d, text in want:
        if d is not None and d < 200:
            have.setdefault(d, []).append(np.array([*ids_of(text), 2], dtype="<u4").tobytes())
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in have.items()}
    assert sstable.write_and_read(no_docs).count() == 0


def test_string_keys(spark):
    df = spark.createDataFrame([("b", "two"), ("a", "one"), ("ab", "three"), (None, None)], "doc_id string, text string")
    path = shared_dir(spark, "shards")
    manifest = sstable.write_shards(df, path)
    rows = sstable.read_shards(spark, path, manifest, "string").orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, "a", "ab", "b"]


def test_packing_is_gapless_and_whole(spark, docs, no_docs):
    rows = packing.pack_documents(docs, capacity=256).collect()
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.ids_crc32))
    for d, text in {(r.doc_id, r.text) for r in docs.collect()}:
        ids = np.array([*ids_of(text), 1], dtype="<u4")
        want = {(i, len(ids[i : i + 256]), zlib.crc32(ids[i : i + 256].tobytes())) for i in range(0, len(ids), 256)}
        assert want <= set(pieces[d])
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(sequences) <= 1.05 * sum(r.length for r in rows) / 256 + 2
    assert packing.pack_documents(no_docs).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30))
def test_plan_uses_every_piece_once(histogram):
    plan = packing.packing_plan(histogram, capacity=64, bins=16)
    used = {}
    for lengths, times in plan:
        assert sum(lengths) <= 64
        for n in lengths:
            used[n] = used.get(n, 0) + times
    assert used == histogram


def test_nnls_against_known_solution():
    rng = np.random.default_rng(1)
    a, x = rng.random((20, 6)), np.array([0, 2.0, 0, 1.0, 3.0, 0])
    assert np.allclose(packing.nnls(a, a @ x), x, atol=1e-6)
    assert (packing.nnls(a, -np.ones(20)) == 0).all()
