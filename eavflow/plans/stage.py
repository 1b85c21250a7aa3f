"""Lineage cuts: write an intermediate once to the shared scratch folder.

A DataFrame consumed by several branches of one plan is written as a parquet
table under ``spark.checkpoint.dir`` and read back.  Each branch then scans
only its partition (``partitionBy``) and columns, the upstream work runs once,
and a lost executor costs a re-read, not a recomputation of the lineage.

A run that consumes its intermediates itself opens a ``Stage``, which deletes
them at its end.  A lazy result (a query) keeps them as long as its session.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from eavflow.session import drop_path, file_system, finely_shuffled, scratch_path, shuffles_freed


class Stage:
    """Staged tables of one run: ``with Stage(spark) as stage: ... stage.table(df, name)``."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def path(self, name: str) -> str:
        """A fresh folder that goes with the run."""
        self.paths.append(scratch_path(self.spark, name))
        return self.paths[-1]

    def table(self, df: DataFrame, name: str, partition_by: Sequence[str] = (), within: str = "") -> DataFrame:
        """``within`` (column=value): all rows are written as that one partition, which needs no sort by it."""
        path = self.path(name)
        with finely_shuffled(self.spark), shuffles_freed(df.sparkSession):
            df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(f"{path}/{within}".rstrip("/"))
        schema = _schema(df, partition_by)
        out = self.spark.read.schema(schema.add(within.split("=")[0], "string") if within else schema).parquet(path)
        out.stage_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        """Delete staged tables that no plan reads any more."""
        for t in tables:
            drop_path(self.spark, t.stage_path)

    def __enter__(self) -> Stage:
        return self

    def __exit__(self, *_) -> None:
        for p in self.paths:
            drop_path(self.spark, p)


def _schema(df: DataFrame, partition_by: Sequence[str]):
    """As written, partition columns last, so that an empty table can be read too."""
    s = df.schema
    return type(s)([s[n] for n in s.names if n not in partition_by] + [s[n] for n in partition_by])


def stage_table(df: DataFrame, name: str, partition_by: Sequence[str] = (), stage: Stage | None = None, within: str = "") -> DataFrame:
    return (stage or Stage(df.sparkSession)).table(df, name, partition_by, within)


def stored_bytes(staged: DataFrame, part: str = "") -> int:
    """The size on disk of a staged table, or of one of its partitions."""
    fs, path = file_system(staged.sparkSession, f"{staged.stage_path}/{part}".rstrip("/"))
    return fs.getContentSummary(path).getLength() if fs.exists(path) else 0
