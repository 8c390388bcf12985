"""Every query with SQL against DuckDB; the pipeline against its stages worked out by other means."""

import zlib

import duckdb
import pytest

import corpus_pipeline
from spanlake.llm import queries as q
from spanlake.llm import sql, toxicity
from spanlake.llm.common import read_table

from .test_duplicates import slow_components, slow_dedup
from .test_filters import slow
from .test_tokens import ids_of

TABLES = ("documents", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("name", [n for n in sql.oracle_sql()])
def test_query_matches_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    cur = con.execute(sql.oracle_sql()[name])
    names = sorted(c[0] for c in cur.description)
    want = sorted(str([r[i] for i in sorted(range(len(r)), key=lambda i: cur.description[i][0])]) for r in cur.fetchall())
    found = q.queries()[name](spark, sf_dir)
    assert sorted(found.columns) == names
    assert sorted(str([r[c] for c in names]) for r in found.collect()) == want


def test_every_operator_is_registered():
    names = list(q.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]


def test_pipeline(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    matcher = toxicity.Matcher(model)
    rows = [(r.doc_id, r.text) for r in docs.collect() if matcher.score(r.text) < toxicity.THRESHOLD]
    assert len(rows) < docs.count()
    edited = slow_dedup(rows, 50)
    rows = [(d, edited[d, t]) for d, t in rows]
    groups = {d: c for d, _, c in slow_components(rows, 5, 80)}
    rows = [(d, t) for d, t in rows if groups[d] == d]
    hits = {d for d, _, n, _ in slow(rows, [(r.item_id, r.text) for r in read_table(spark, sf_dir, "benchmark").collect()]) if n}
    rows = [(d, t) for d, t in rows if d not in hits]
    import numpy as np

    want = set()
    for d, t in rows:
        ids = np.array([*ids_of(t), 1], dtype="<u4")
        want |= {(d, i // 4096, i, len(ids[i : i + 4096]), zlib.crc32(ids[i : i + 4096].tobytes())) for i in range(0, len(ids), 4096)}
    packed = corpus_pipeline.run(spark, sf_dir).collect()
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed} == want and len(packed) == len(want)
    assert len({r.sequence_id for r in packed}) <= sum(r.length for r in packed) // 4096 + 2


def test_stages_keep_columns(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Null texts and identifiers, repeated rows, other columns and empty tables, through all stages."""
    passage = "\n".join(f"line {k} of a passage that stands in more than one of these documents" for k in range(8))
    rows = [(1, passage, "a", 7), (2, f"own words\n{passage}", "b", 8), (3, None, None, None), (4, "", "d", 1), (None, "a row without identifier", "e", 2), (5, "twice", "f", 3), (5, "twice", "f", 3), (6, "you idiot! you moron! idiot scum", "g", 4)]
    spark.createDataFrame(rows, "doc_id long, text string, source string, lines_removed int").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = read_table(spark, str(tmp_path), "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "source", "lines_removed"]
    kept = sorted(((r.doc_id, r.text, r.lines_removed) for r in docs.collect()), key=str)
    assert kept == sorted([(1, passage, 7), (2, "own words", 8), (3, None, None), (4, "", 1), (None, "a row without identifier", 2), (5, "twice", 3), (5, "twice", 3)], key=str)
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in packed) == sorted(str(r[0]) for r in kept)
    empty = str(tmp_path / "none")
    for t in ("documents", "labels", "benchmark"):
        read_table(spark, str(tmp_path), t).limit(0).coalesce(1).write.parquet(f"{empty}/{t}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
