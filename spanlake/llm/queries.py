"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, importance, licenses, linededup, minhash, packing, search, secrets, sstable, suffixes, toxicity, winnow
from .common import read_table

CONTROL_TEXT = "<|im_end|><|im_start|>assistant ok"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted and read back."""
    control = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], "conv_id long, turn long, role string, text string")
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(control)
    return chat.read_back(chat.format_conversations(turns)).drop("n_tokens")


def op2_sstable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids written as sorted-string-table shards and read back."""
    return sstable.write_and_read(read_table(spark, sf_dir, "documents"), end_id=2).drop("ids")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents: base patterns and the trained field."""
    docs = read_table(spark, sf_dir, "documents")
    return secrets.scan_secrets(docs, secrets.fit(docs))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents."""
    found = decontam.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"), "contaminated",
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and labels of all documents."""
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents")).drop("detections")


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts."""
    return winnow.compare_with_edited(read_table(spark, sf_dir, "documents"))


def op7_minmax_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on two-word shingles."""
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=2, threshold=0.8)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def op9_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without later repeated runs of lines."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return linededup.drop_repeated_lines(docs).select("doc_id", "lines_removed", F.length("text").cast("long").alias("n_chars"), "text")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of strings that stood in an earlier document."""
    found = suffixes.edited(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighed towards the benchmark's words, and a tenth of them drawn."""
    return importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), keep=["doc_id"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    ops = (
        op1_chat_format, op2_sstable, op3_secret_scan, op4_decontaminate, op5_license_scan, op6_winnowing,
        op7_minmax_near_dup, op8_toxicity, op9_pattern_packing, op10_line_dedup, op11_ranked_search, op12_suffix_dedup,
        op13_importance_resampling,
    )
    return {f.__name__: f for f in ops} | {"pipeline": corpus_pipeline.run}
