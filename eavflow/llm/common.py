"""Helpers the operators share: staged tables, skew-proof lookups, components, shipping.

Internal columns start with ``_e_``, so callers' columns cannot clash with
them.  Operators that return their input's columns drop those whose name
(ignoring case) equals one of their own results: the operator's value wins.
"""

from __future__ import annotations

import ctypes
import io
import os
import zipfile
from collections.abc import Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from eavflow.session import drop_path, file_system, scratch_path, setting, shuffles_freed

#: A key with more than 1 / HOT_SHARE of the rows is hot, so at most HOT_SHARE keys are.
HOT_SHARE = 256


_OPEN: list[list[Scratch]] = []


class Scratch:
    """Tables written once under the shared folder.

    ``drop`` deletes a table that no plan reads any more, ``close`` all of
    them.  What a lazy result still reads stays as long as its session, or
    until the enclosing ``cleared`` block ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, scratch_path(spark, name), 0
        for block in _OPEN:
            block.append(self)

    def close(self) -> None:
        drop_path(self.spark, self.root)

    def write(self, df: DataFrame, partition_by: Sequence[str] = (), compression: str = "snappy", writers: int = 0,
              options: dict[str, str] | None = None) -> DataFrame:
        """Stage ``df``; with ``writers``, a task keeps that many partitions' files open instead of sorting its rows."""
        self.n += 1
        path = f"{self.root}/t{self.n}"
        with shuffles_freed(self.spark), setting(self.spark, "spark.sql.maxConcurrentOutputFileWriters", str(writers)):
            df.write.partitionBy(*partition_by).option("compression", compression).options(**options or {}).parquet(path)
        out = self.spark.read.schema(_schema(df, partition_by)).parquet(path)
        out._eav_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            drop_path(self.spark, t._eav_path)


@contextmanager
def cleared():
    """Deletes at its end what operators staged inside; what is to be kept must be written by then."""
    _OPEN.append([])
    try:
        yield
    finally:
        for s in _OPEN.pop():
            s.close()


def _schema(df: DataFrame, partition_by: Sequence[str]):
    """The schema as written, partition columns last, so that an empty table can be read too."""
    s = df.schema
    names = [f.name for f in s.fields if f.name not in partition_by] + list(partition_by)
    return type(s)([s[n] for n in names])


def nullable(t: T.DataType) -> T.DataType:
    """The type with everything inside it nullable, as a table that was written and read has it."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, nullable(f.dataType)) for f in t])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(nullable(t.elementType))
    if isinstance(t, T.MapType):
        return T.MapType(nullable(t.keyType), nullable(t.valueType))
    return t


def arrow_cast(a, t: T.DataType):
    """Arrow data as a column of that type."""
    want = to_arrow_type(t)
    return a if a.type == want else a.cast(want)


def without(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The columns of ``df`` that do not clash with the operator's own ``names``."""
    own = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in own]


def col(name: str) -> Column:
    """A column by its exact name, dots and back quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def lookup_join(left: DataFrame, right: DataFrame, on: Sequence[str], weight: str) -> DataFrame:
    """Inner join of ``left`` with ``right`` (staged; unique by ``on``; ``weight`` = its rows in ``left``).

    Keys holding more than 1 / HOT_SHARE of the rows are at most HOT_SHARE, so
    their right rows are broadcast and the left rows never move; the rest is
    shuffled by key, where no key can fill a partition.  The rest is a merge
    join whatever its size, so the plan is the same for small and large inputs.
    """
    total, most = right.agg(F.sum(weight), F.max(weight)).first()
    if total is None or most * HOT_SHARE <= total:
        return left.join(right.hint("merge"), list(on))
    is_hot = F.col(weight) * HOT_SHARE > F.lit(total)
    hot = right.where(is_hot)
    cold = (left.join(F.broadcast(hot.select(*on)), list(on), "left_anti")
            .join(right.where(~is_hot).hint("merge"), list(on)))
    return left.join(F.broadcast(hot), list(on)).unionByName(cold)


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of edges (a, b), longs: one row (node, comp) for every node in an edge.

    ``comp`` is the smallest node that can be reached.  Alternating large-star
    and small-star rounds: every round hangs the neighbours of a node on the
    smallest of them, so chains shrink by a power; what a round holds is one
    row per edge.  Minima are combined before the shuffle and hot nodes are
    looked up by broadcast (``lookup_join``).
    """
    e = scratch.write(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .where("u <> v").distinct())
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.write(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"),
                                                    F.count(F.lit(1)).alias("n")))
        if least.where("m < u AND n > 1").isEmpty():
            scratch.drop(least)
            break       # every node that hangs on one has no other neighbour: stars
        large = scratch.write(lookup_join(both, least, ["u"], "n").where("v > u")
                              .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = scratch.write(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")))
        small = (lookup_join(large, low, ["u"], "n").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        old, e = e, scratch.write(small)
        scratch.drop(old, least, large, low)
    return (e.select(F.col("u").alias("node"), F.col("v").alias("comp"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()))


def release() -> None:
    """Give a Python worker's freed memory back to the system: workers live on and would hold their peak through later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc has it
    if trim:
        trim(0)


def freeing(function):
    """``function`` from batches to batches, with its memory released at its end."""
    def run(batches):
        try:
            yield from function(batches)
        finally:
            release()
    return run


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for the functions that run there.

    The archive lies in the shared folder for as long as executors may ask for it.
    """
    sc = spark.sparkContext
    if getattr(sc, "_eav_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    made = io.BytesIO()
    with zipfile.ZipFile(made, "w") as z:
        for base, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(base, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    path = f"{scratch_path(spark, 'package')}/eavflow_pkg.zip"
    fs, p = file_system(spark, path)
    out = fs.create(p)
    out.write(bytearray(made.getvalue()))
    out.close()
    sc.addPyFile(path)
    sc._eav_shipped = True
