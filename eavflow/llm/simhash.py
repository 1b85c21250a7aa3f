"""SimHash near-dedup: fingerprints of word shingles, compared exactly tile by tile.

Equal fingerprints are one node, so a group of copies is compared once.  The
distinct fingerprints are sorted by the population counts of their four
16-bit quarters and cut into blocks; a block and its counts' ranges are one
row.  Two fingerprints differ in at least as many bits as their quarters'
counts do in sum, so block pairs, and inside them tile pairs, whose ranges
are further apart than the radius are skipped; all others are compared with
numpy exclusive-or and bit counts.  A task returns a spanning forest of the
links it found, never the pairs of a group, and components are joined by Spark.

Defined cases: A-Z are lower-cased; a text with fewer words than a shingle is
one shingle, a text without words (or null) has fingerprint zero, linked like
any other; repeated rows and ids are ordinary, null ids are never a
component's smallest id unless all are null; an empty table gives an empty
result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eavflow.llm.common import col, components, lookup_join, release, Scratch, ship, without
from eavflow.llm.forest import Forest

WORDS, RADIUS, SEED = 4, 4, 42
BLOCK, TILE = (1024, 1 << 16), 512
RESULT = ("fingerprint", "component_id", "kept")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: str | None, n: int = WORDS) -> np.ndarray:
    """XXH64 (seed 42) of every shingle of ``n`` words, repeats included."""
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= n:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-n] + 1]).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends[n - 1:].tolist())), np.uint64, len(starts))


def fingerprint(text: str | None, n: int = WORDS) -> int:
    """A bit is 1 if it is set in over half of the hashes; 0 without words."""
    h = shingle_hashes(text, n)
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(h), 1 << 14):
        part = h[lo:lo + (1 << 14)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    bits = np.packbits(ones * 2 > len(h), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(text: Column, n: int = WORDS) -> Column:
    """The fingerprint of each whole text, as a signed 64-bit number."""
    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        out = pa.array(np.array([fingerprint(t.as_py(), n) for t in texts], np.uint64).view(np.int64))
        release()
        return out
    return of(text)


def _quarters(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.ascontiguousarray(x).view(np.uint16).reshape(-1, 4)).astype(np.int16)


def _ranges(x: np.ndarray, tile: int) -> tuple[np.ndarray, np.ndarray]:
    q, at = _quarters(x), np.arange(0, len(x), tile)
    return np.minimum.reduceat(q, at), np.maximum.reduceat(q, at)


def _apart(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """At least so many bits differ between any fingerprints of tile i of a and tile j of b."""
    gap = np.maximum(a[0][:, None] - b[1][None], b[0][None] - a[1][:, None])
    return np.maximum(gap, 0).sum(axis=2)


def close(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> Forest:
    """Links between the fingerprints of two blocks; rows of ``b`` count on from those of ``a`` unless ``same``."""
    forest, shift = Forest(len(a) if same else len(a) + len(b)), 0 if same else len(a)
    small = max(1, TILE // 8)
    apart = _apart(_ranges(a, small), _ranges(b, TILE))
    for i, j in zip(*np.nonzero(apart <= radius)):
        lo, left = j * TILE, i * small
        if same and lo + TILE <= left:
            continue
        d = np.bitwise_count(a[left:left + small, None] ^ b[None, lo:lo + TILE])
        x, y = np.nonzero(d <= radius)
        if len(x):
            forest.link(x + left, y + lo + shift)
    return forest


def _blocks(batches):
    """One row for the partition: its sorted fingerprints and the ranges of their quarters' counts."""
    parts = [b.column("fp").to_numpy() for b in batches]
    x = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    if len(x):
        q = _quarters(x)
        yield pa.RecordBatch.from_pydict({"data": pa.array([x.tobytes()], pa.binary()),
                                          "low": pa.array([q.min(axis=0).tolist()], pa.list_(pa.int32())),
                                          "high": pa.array([q.max(axis=0).tolist()], pa.list_(pa.int32()))})


def links(prints: DataFrame, radius: int, scratch: Scratch) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints ``fp`` linked at ``radius`` bits or fewer."""
    n = prints.count()
    size = min(BLOCK[1], max(BLOCK[0], n // 16))
    quarter = [F.bit_count(F.shiftrightunsigned("fp", 16 * k).bitwiseAND(F.lit(0xFFFF))).alias(f"q{k}") for k in range(4)]
    order = ["q0", "q1", "q2", "q3", "fp"]
    blocks = scratch.write(
        prints.select("fp", *quarter).repartitionByRange(max(1, math.ceil(n / size)), *order)
        .sortWithinPartitions(*order).select("fp")
        .mapInArrow(_blocks, "data binary, low array<int>, high array<int>")
        .withColumn("block", F.monotonically_increasing_id()))
    # numbered 0, 1, ...; one row per block, so this window holds no fingerprints
    number = blocks.select("block", (F.row_number().over(Window.orderBy("block")) - 1).alias("i"))
    blocks = scratch.write(blocks.join(number, "block").select("i", "low", "high", "data"))
    count = blocks.count()
    gap = F.aggregate(F.arrays_zip(F.col("low"), F.col("high"), F.col("low2"), F.col("high2")), F.lit(0),
                      lambda s, z: s + F.greatest(z["low"] - z["high2"], z["low2"] - z["high"], F.lit(0)))
    box = blocks.select("i", "low", "high")
    pairs = (box.select("*", F.explode(F.sequence(F.lit(0), F.col("i"))).alias("j"))
             .join(box.select(F.col("i").alias("j"), F.col("low").alias("low2"), F.col("high").alias("high2")), "j")
             .where(gap <= radius).select("i", "j"))
    work = (pairs.join(blocks.select("i", "data"), "i")
            .join(blocks.select(F.col("i").alias("j"), F.col("data").alias("other")), "j"))

    def compare(batches):
        for b in batches:
            for i, j, x, y in zip(*(b.column(c).to_pylist() for c in ("i", "j", "data", "other"))):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                forest = close(x, y, radius, i == j)
                both = x if i == j else np.concatenate([x, y])
                e = both.view(np.int64)[np.array(forest.edges, np.int64).reshape(-1, 2)]
                yield pa.RecordBatch.from_pydict({"a": e[:, 0], "b": e[:, 1]})

    # block pairs differ in work, so they are dealt out evenly by number
    return work.repartition(max(1, min(count * (count + 1) // 2, 4096))).mapInArrow(compare, "a long, b long")


def near_dedup(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", words: int = WORDS,
               radius: int = RADIUS, keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``df``: the columns in ``keep`` (all), fingerprint, component_id and kept.

    ``component_id`` is the smallest id that can be reached by links,
    ``kept`` marks one row of each component.  Columns named like a result are
    replaced.
    """
    ship(df.sparkSession)
    scratch = Scratch(df.sparkSession, "simhash")
    own = [c for c in without(df, RESULT) if keep is None or c in keep]
    rows = scratch.write(df.select(F.struct(*[col(c) for c in own]).alias("_e_df"), col(id_col).alias("_e_id"),
                                   F.monotonically_increasing_id().alias("_e_row"),
                                   fingerprints(col(text_col), words).alias("fp")))
    first = F.struct(F.col("_e_id").isNull().alias("z"), F.col("_e_id").alias("id"), F.col("_e_row").alias("row"))
    inner = Scratch(df.sparkSession, "simhash-links")
    prints = inner.write(rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("first")))
    comps = inner.write(components(links(prints.select("fp"), radius, inner), inner))
    of = inner.write(prints.join(comps.withColumnRenamed("node", "fp"), "fp", "left")
                     .withColumn("comp", F.coalesce("comp", "fp")))
    best = inner.write(of.groupBy("comp").agg(F.min("first").alias("best"), F.count(F.lit(1)).alias("k")))
    found = scratch.write(lookup_join(of.select("fp", "n", "comp"), best, ["comp"], "k").select("fp", "n", "best"))
    inner.close()
    out = lookup_join(rows, found, ["fp"], "n")
    return out.select(*[F.col("_e_df").getField(c).alias(c) for c in own],
                      F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("best.id").alias("component_id"), (F.col("best.row") == F.col("_e_row")).alias("kept"))
