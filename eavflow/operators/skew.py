"""Joins with a dictionary (unique by key) that hold whatever its size and however hot a key is.

A staged dictionary's size is known.  Up to ``BROADCAST_BYTES`` it is
broadcast; beyond that the rows of hot keys (more than 1 / HOT_SHARE of all
rows, so at most HOT_SHARE keys) stay where they are and meet a broadcast of
just those keys' dictionary rows, and the rest is a merge join in which no
key can fill a partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 4 << 20       # of parquet in zstd (8 of snappy), so some twenty times that in memory
HOT_SHARE = 256


def lookup(left: DataFrame, dictionary: DataFrame, on: Sequence[str], how: str, size: int) -> DataFrame:
    """``left`` joined N:1 with ``dictionary`` of ``size`` staged bytes; ``how`` is inner or left."""
    on = list(on)[::-1]     # the file comes last: a sort tells rows apart by the first bytes of its first column
    if size <= BROADCAST_BYTES:
        return left.join(F.broadcast(dictionary), on, how)
    hot = hot_keys(left, on)
    if hot is None:
        return left.join(dictionary.hint("merge"), on, how)
    near = left.join(hot, on, "left_semi").join(F.broadcast(dictionary.join(hot, on, "left_semi")), on, how)
    far = left.join(hot, on, "left_anti").join(dictionary.hint("merge"), on, how)
    return near.unionByName(far)


def hot_keys(left: DataFrame, on: Sequence[str]) -> DataFrame | None:
    """The keys of more than 1 / HOT_SHARE of all rows (at most HOT_SHARE), in hand; None if there are none.

    Found in one narrow pass by a sketch of frequent items, which a task combines
    before anything is shuffled.  A key that it estimates too high is only held apart as well.
    """
    key = F.xxhash64(*on).alias("_h")
    top = left.select(key).agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(_h, {HOT_SHARE}, {16 * HOT_SHARE})").alias("top")).first()
    codes = [r["item"] for r in top["top"] or [] if r["count"] * HOT_SHARE > top["n"]]
    if not codes:
        return None
    hot = left.select(*on).where(F.xxhash64(*on).isin(codes)).distinct().collect()      # some hundred keys
    return F.broadcast(left.sparkSession.createDataFrame(hot, left.select(*on).schema))
