"""A training-data pipeline over ``documents``: filter, deduplicate, decontaminate, pack.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but
the last return the columns of ``documents``. A result is written as Parquet in the shared folder
and read again as the next stage's input, so a lost executor costs one stage's tasks at most.

Near-duplicates are documents at least 0.8 alike on shingles of five words.

Defined cases: a null or empty text is kept by every stage and packed as its end id; rows that share
an identifier are one document for near-duplicates and stay or go together; a row without
identifier stays unless it is toxic or contaminated; further columns of ``documents``, whatever
their names, are passed through all stages but the last; empty tables give empty results, and without
labels the built-in lexicon applies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanlake.llm import decontam, linededup, minhash, packing, toxicity
from spanlake.llm.common import read_table, staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a lexicon learned from the labels doesn't reject."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that stood before; ``n_chars`` follows the text."""
    edited = linededup.drop_repeated_lines(docs)
    removed = edited.columns[-1]
    changed = {"n_chars": F.when(F.col(removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))}
    return edited.withColumns({k: v for k, v in changed.items() if k in docs.columns}).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without windows of the benchmark."""
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and place there."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: SQL can't express the learned lexicon or the tokenizer; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
