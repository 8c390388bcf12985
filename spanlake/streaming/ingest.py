"""Streaming ingest: export requests into rows, dead letters and payloads, batch by batch.

Structured Streaming gives a batch the same lines when it is run again, but not the same time. So a batch's
receive time is booked before anything is written, and a second run takes it from there: it makes the same rows, in the
same partitions, and takes the place of what the first one wrote. Counts of each batch are kept in ``_ingest_batches``.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.stage import exists
from ..tools import backfill

BOOKED = "_ingest_times"
COUNTS = "_ingest_batches"


def received(lines: DataFrame, root: str, batch: str) -> int:
    """The receive time of a batch in nanoseconds, booked by its first run."""
    spark, path = lines.sparkSession, f"{root}/{BOOKED}/batch={batch}"
    if not exists(spark, f"{path}/_SUCCESS"):
        spark.createDataFrame([(time.time_ns(),)], "nano long").coalesce(1).write.mode("overwrite").parquet(path)
    return spark.read.schema("nano long").parquet(path).first()["nano"]


def sink(root: str, stream: str = "stream", **options: object) -> Callable[[DataFrame, int], None]:
    """What ``foreachBatch`` calls. ``stream`` tells the batches of several streams into the same tables apart."""

    def write(lines: DataFrame, number: int) -> None:
        batch = f"{stream}-{number}"
        nano = received(lines, root, batch)
        report = backfill.ingest(lines, root, batch, receive_nano=nano, **options)
        counts = lines.sparkSession.createDataFrame(report, backfill.REPORT)
        counts = counts.withColumns({"receive_nano": F.lit(nano), "seconds": F.lit((time.time_ns() - nano) / 1e9), "batch": F.lit(batch)})
        counts.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{root}/{COUNTS}")

    return write


def start(lines: DataFrame, root: str, checkpoint: str, stream: str = "stream", trigger: dict | None = None, **options: object) -> StreamingQuery:
    """Starts the stream (lines as of ``otlp.export_lines(..., stream=True)``). ``trigger``: arguments of Spark's trigger."""
    writer = lines.writeStream.foreachBatch(sink(root, stream, **options)).option("checkpointLocation", checkpoint).queryName(stream)
    return writer.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
