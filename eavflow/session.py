"""Session defaults and the shared scratch location.

Scratch data (lineage cuts, staging copies of tables, stream checkpoints)
lives under the folder the cluster names in ``spark.checkpoint.dir``.  Only
when the session has none (tests, local runs) do we create one.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only on measured sizes: no static, estimate-based broadcast; AQE
    # converts a join after the small side's shuffle output has been measured.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8,
                app: str = "eavflow", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")   # local mode: the driver is the executor
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shuffles_freed(spark: SparkSession):
    """What runs inside runs once: its shuffle files go when it ends, not when the driver's collector gets to them."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


FINE_PARTITIONS = 1024


@contextmanager
def finely_shuffled(spark: SparkSession):
    """What runs inside is shuffled into many small partitions, joined again by their measured sizes.

    A fixed number of them would grow with the input until tasks spill what they sort.
    """
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(max(FINE_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")), int(before or 0))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared scratch root: ``spark.checkpoint.dir``, which every cluster must name.

    Only a local master (tests, one machine) gets a folder of its own if unset:
    on a cluster each executor would write to its own disk.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on master {sc.master}")
        root = tempfile.mkdtemp(prefix="eavflow-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared scratch root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path) of a path in any store that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as a listing spells it (``file:///x``)."""
    fs, p = file_system(spark, path)
    return re.sub("^file:/+", "file:///", fs.makeQualified(p).toString())


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = file_system(spark, path)
    return fs.exists(p)


def drop_path(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)
