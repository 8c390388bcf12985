"""Tables between steps, written to the shared folder that the session names."""

from __future__ import annotations

import re
import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, tag: str) -> str:
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
    """Written as Parquet and read back: lineage ends here, and lost executors cost no rerun of what led here."""
    path = shared_path(df.sparkSession, tag)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _STAGED[out] = path
    return out


def spread(df: DataFrame) -> DataFrame:
    """As a side of a join that grows with the input: both sides are shuffled and merged. Spark would broadcast by the size of
    compressed files, which says little of what the driver has to hold."""
    return df.hint("merge")


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Dealt by keys over as many tasks as shuffles have: where a row costs far more than to read it, a file of a few megabytes would be one task's work."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def unstage(*frames: DataFrame) -> None:
    """Deletes staged tables that nothing reads any more."""
    for df in frames:
        path = _STAGED.pop(df, None)
        if path:
            delete(df.sparkSession, path)


def hadoop_path(spark: SparkSession, path: str) -> tuple[object, object]:
    """A path and its file system, as Spark's own readers see them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, system = hadoop_path(spark, path)
    return system.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p, system = hadoop_path(spark, path)
    system.delete(p, True)
