"""Upload notifications -> queue table, incrementally.

A file-source stream of notification JSON (one per line) is decoded, filtered
to record uploads and put into the queue in ``foreachBatch``.  A put reads and
writes only the queue's slots that the micro-batch's files fall into, and a
repeated upload is queued once.  The checkpoint makes reruns idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eavflow.session import scratch_path
from eavflow.sources import notifications
from eavflow.sources.tables import Queue


def enqueue_batch(batch: DataFrame, queue_path: str) -> None:
    Queue(batch.sparkSession, queue_path).put(notifications.record_uploads(batch, "value").select(F.col("url").alias("src"), "bucket"))


def run_intake(spark: SparkSession, source_dir: str, queue_path: str,
               checkpoint: str | None = None, available_now: bool = True):
    """Start (and, with ``available_now``, finish) the intake stream."""
    checkpoint = checkpoint or scratch_path(spark, "intake-ckpt")
    stream = spark.readStream.format("text").load(source_dir)
    w = (stream.writeStream.foreachBatch(lambda df, _id: enqueue_batch(df, queue_path))
               .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 hour")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
