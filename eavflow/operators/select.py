"""Work selection: which files to convert.

All of it is semi/anti joins and one aggregation keyed by the file URL
(``src``); nothing is looked up per file from the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gate_semi(files: DataFrame, properties: DataFrame, names: Sequence[str]) -> DataFrame:
    """J6 + P3 + A4: keep files whose sidecar has a row with one of ``names``.

    ``properties`` is (src, propertyname) keyed by the *record* file URL
    (``plans.run.sidecar_rows``); a missing sidecar has no rows and so fails the
    gate.
    """
    ok = properties.where(F.col("propertyname").isin(list(names))).select("src")
    return files.join(ok, "src", "left_semi")


def gate_status(files: DataFrame, properties: DataFrame, names: Sequence[str]) -> DataFrame:
    """Every file with ``passed`` (sidecar exists and holds a gate name)."""
    ok = (properties.where(F.col("propertyname").isin(list(names)))
                    .select("src").distinct().withColumn("passed", F.lit(True)))
    return (files.join(ok, "src", "left")
                 .withColumn("passed", F.coalesce(F.col("passed"), F.lit(False))))


def pending_anti(listed: DataFrame, ledger: DataFrame) -> DataFrame:
    """Listed files not yet in the ledger."""
    return listed.join(ledger.select("src"), "src", "left_anti")


def output_status(listed: DataFrame, outputs: DataFrame) -> DataFrame:
    """Mark files whose output already exists; keep them with that status."""
    done = outputs.select("src").distinct().withColumn("_done", F.lit(True))
    return (listed.join(done, "src", "left")
                  .withColumn("status", F.when(F.col("_done"), F.lit("already_converted"))
                                         .otherwise(F.lit("pending")))
                  .drop("_done"))


def queue_dedupe(puts: DataFrame) -> DataFrame:
    """K5: puts by key collapse to one item per file URL."""
    return puts.groupBy("src").agg(F.min("bucket").alias("bucket"))


def queue_drain(queue: DataFrame, processed: DataFrame) -> DataFrame:
    """K6: remaining queue after removing processed files."""
    return queue.join(processed.select("src"), "src", "left_anti")


def has_pending(queue: DataFrame) -> DataFrame:
    """One row, true when the queue holds at least one item."""
    return queue.limit(1).agg((F.count(F.lit(1)) > 0).alias("has_pending"))


def newest(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, then by the other columns."""
    rest = [c for c in rows.columns if c != key and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_e_r")
    return rows.groupBy(key).agg(best).select(*[key if c == key else F.col(f"_e_r.{c}").alias(c) for c in rows.columns])


def ledger_upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """K4: put-by-key; the newest entry by ``ts`` wins, in the same second the later write (``seq``, else new over old)."""
    cols, made = new.columns, "seq" in new.columns
    if not made:
        old, new = old.withColumn("seq", F.lit(0)), new.withColumn("seq", F.lit(1))
    return newest(old.select(*new.columns).unionByName(new), "src", ["ts", "seq"]).select(*cols)
