"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words for decontamination and licences: ASCII other than 0-9, A-Z, a-z.
_ALNUM = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
ALNUM_WORDS = bytes(
    (b + 32 if 65 <= b <= 90 else b) if b >= 128 or b in _ALNUM else 32 for b in range(256)
)
LOWER_ASCII = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def shared_dir(spark: SparkSession, tag: str) -> str:
    """A new path below ``spark.checkpoint.dir``, which a cluster has to name. Where it is unset in a
    local session (tests), a temporary folder is set for the session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spanlake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


_STAGED: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def staged(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back: computed once, safe from lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, tag)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _STAGED[out] = path
    return out


def unstage(*frames: DataFrame | None) -> None:
    """Deletes staged tables that nothing reads any more."""
    for df in frames:
        path = _STAGED.pop(df, None) if df is not None else None
        if path:
            p = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(name: str, df: DataFrame) -> str:
    """``name``, or a longer one if ``df`` has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def row_batches(batches: Iterator[pa.RecordBatch], max_chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Splits record batches so that their string columns stay below ``max_chars`` bytes (one row at least)."""
    for b in batches:
        sizes = np.zeros(b.num_rows, dtype=np.int64)
        for c in b.columns:
            if pa.types.is_string(c.type) or pa.types.is_large_string(c.type):
                sizes += pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False)
        if sizes.sum() <= max_chars:
            yield b
            continue
        at, total = 0, 0
        for i, s in enumerate(sizes.tolist()):
            if total and total + s > max_chars:
                yield b.slice(at, i - at)
                at, total = i, 0
            total += s
        yield b.slice(at)


def row_key(*cols: str | Column) -> Column:
    """A 64-bit key of a row; nulls count as values of their own."""
    cs = [F.col(c) if isinstance(c, str) else c for c in cols]
    return F.xxhash64(*[x for c in cs for x in (c, c.isNull())])
