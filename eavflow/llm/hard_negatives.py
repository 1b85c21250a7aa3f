"""Hard-negative mining: Hilbert-ordered blocks with zone maps, read where interval bounds allow an answer.

Components x become floor(SCALE * x); a score is the integer inner product.  An
anchor's positives are its ``POSITIVES`` best rows of the same label; for each of
them, of positive score p, the ``NEGATIVES`` best rows of other labels with
``LOW``% of p <= score <= p are its hard negatives.  Higher scores come first,
ties by smaller id (null ids last).

1. Rows are sorted by label and their place on a Hilbert curve through all
   dimensions and written as Parquet blocks of ``ROWS`` rows, one row per block
   beside its zone map: the least and the greatest value in each dimension.
2. Anchors are dealt into tiles.  Interval arithmetic over the zone maps (which
   are read without the vectors) bounds the scores that an anchor can have in a
   block from both sides.  A block must be read if its interval meets one of the
   anchor's windows, unless other blocks are sure to hold enough better rows.
3. Tiles meet the blocks they must read in units of ``PART`` blocks at most.  A
   unit returns each anchor's best rows, and these are ranked over all units.
   The first reading finds the positives, whose scores set the windows of the
   second.

All arithmetic is exact: on doubles below 2**53, on 64-bit integers above.

Defined cases: rows with a null label or vector or any null or non-finite
component take no part, nor do those with components so large that scores
could pass 2**55; vectors of different lengths have no score; repeated rows are
separate rows; a positive with a score below zero has an empty window; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eavflow.llm.common import Scratch, col, ship

SCALE, POSITIVES, NEGATIVES, LOW = 256, 5, 5, 80
ROWS, TILE, ZONES, PART, BITS = 512, 512, 4096, 64, 2
LAST = np.iinfo(np.int64).max       # a null id
NONE = np.iinfo(np.int64).min       # no such positive
_TILE = "dim int, tile long, ids binary, rows binary, labels binary, q binary"
_BLOCK = "block long, dim int, label long, n long, ids binary, rows binary, q binary, lo binary, hi binary"


# -- 1 blocks ----------------------------------------------------------------------------

def hilbert(x: np.ndarray, bits: int) -> list[bytes]:
    """The place of each row of small integers (below 2**bits) on the Hilbert curve, as bytes that sort alike.

    Skilling's transform: undo the excess work from the highest bit down, then Gray-code.
    """
    n, dim = x.shape
    t = x.T.astype(np.uint32).copy()
    top = np.uint32(1 << (bits - 1))
    q = top
    while q > 1:
        low = q - np.uint32(1)
        for i in range(dim):
            flip = (t[i] & q) != 0
            swap = np.where(flip, np.uint32(0), (t[0] ^ t[i]) & low)
            t[0] = np.where(flip, t[0] ^ low, t[0] ^ swap)
            t[i] ^= swap
        q >>= np.uint32(1)
    for i in range(1, dim):
        t[i] ^= t[i - 1]
    turn = np.zeros(n, np.uint32)
    q = top
    while q > 1:
        turn = np.where((t[dim - 1] & q) != 0, turn ^ (q - np.uint32(1)), turn) if dim else turn
        q >>= np.uint32(1)
    t ^= turn
    planes = [(t >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1)]
    packed = np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)
    return [r.tobytes() for r in packed]


def _matrix(lists: pa.Array, dim: int) -> np.ndarray:
    return lists.flatten().to_numpy().reshape(len(lists), dim)


def _curve(batches):
    """Rows with their place on the curve; ``low`` and ``high`` bound all components of vectors of this length."""
    for b in batches:
        dims = b.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            part = b.filter(pa.array(dims == dim))
            q = _matrix(part.column("q"), dim)
            low, high = part.column("low")[0].as_py() or 0, part.column("high")[0].as_py() or 0
            cells = ((q - low) * (1 << BITS)) // (high - low + 1)
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("dim", "label", "row", "id")), pa.array(hilbert(cells, BITS), pa.binary()), part.column("q")],
                ["dim", "label", "row", "id", "key", "q"])


def _cut(batches):
    """Blocks of neighbouring rows of one label."""
    base, made = TaskContext.get().partitionId() << 32, 0
    held, at = [], None

    def flush():
        ids, rows, q = (np.concatenate(v) for v in zip(*held))
        return pa.RecordBatch.from_arrays(
            [pa.array([base + made]), pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int64()), pa.array([len(ids)]),
             *(pa.array([v.astype(np.int64).tobytes()], pa.binary()) for v in (ids, rows, q, q.min(axis=0), q.max(axis=0)))],
            ["block", "dim", "label", "n", "ids", "rows", "q", "lo", "hi"])

    for b in batches:
        dims, labels, rows = (b.column(c).to_numpy() for c in ("dim", "label", "row"))
        ids = b.column("id").fill_null(LAST).to_numpy()
        change = np.flatnonzero((np.diff(dims) != 0) | (np.diff(labels) != 0)) + 1
        for lo, hi in zip([0, *change.tolist()], [*change.tolist(), b.num_rows]):
            if hi == lo:
                continue
            q = _matrix(b.column("q").slice(lo, hi - lo), int(dims[lo]))
            now = (int(dims[lo]), int(labels[lo]))
            while lo < hi:
                size = sum(len(x[0]) for x in held)
                if held and (now != at or size == ROWS):
                    yield flush()
                    held, made, size = [], made + 1, 0
                at, take = now, min(hi - lo, ROWS - size)
                held.append((ids[lo:lo + take], rows[lo:lo + take], q[:take]))
                q, lo = q[take:], lo + take
    if held:
        yield flush()


def _pack_tile(table: pa.Table) -> pa.Table:
    dim = table.column("dim")[0].as_py()
    q = _matrix(table.column("q").combine_chunks(), dim)
    one = lambda v: pa.array([np.ascontiguousarray(v, np.int64).tobytes()], pa.binary())
    return pa.table({"dim": pa.array([dim], pa.int32()), "tile": table.column("tile").slice(0, 1),
                     "ids": one(table.column("id").fill_null(LAST).to_numpy()), "rows": one(table.column("row").to_numpy()),
                     "labels": one(table.column("label").to_numpy()), "q": one(q)})


# -- 2 bounds ----------------------------------------------------------------------------

def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of integers, exactly."""
    most = lambda x: float(np.abs(x).max()) if x.size else 0.0
    if most(a) * most(b) * max(1, a.shape[1]) < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def bounds(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that each row of ``a`` can have with a row between ``lo`` and ``hi``."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return product(up, lo) + product(down, hi), product(up, hi) + product(down, lo)


def must_read(least: np.ndarray, most: np.ndarray, n: np.ndarray, may: np.ndarray, sure: np.ndarray, want: int) -> np.ndarray:
    """Which blocks (columns) may hold one of the ``want`` best rows of each anchor.

    ``may``: the block can hold rows of the window; ``sure``: it holds no others.
    The blocks that are sure to hold ``want`` rows at or above some score make
    those below it needless.
    """
    out = may.copy()
    for i in range(len(least)):
        some = np.flatnonzero(sure[i])
        some = some[np.argsort(-least[i, some], kind="stable")]
        enough = np.flatnonzero(np.cumsum(n[some]) >= want)
        if len(enough):
            out[i] &= most[i] >= least[i, some[enough[0]]]
    return out


def _ints(b: bytes, width: int | None = None) -> np.ndarray:
    a = np.frombuffer(b, np.int64)
    return a if width is None else a.reshape(-1, width)


def _windows(p: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of each positive's window, as integers; an empty one where there is no positive."""
    first = np.where(p == NONE, 1, -((-low * np.where(p == NONE, 0, p)) // 100))
    return first, np.where(p == NONE, 0, p)


def _choose(batches, want: int, low: int, positives: int):
    """(tile, block, mask): the blocks that anchors of a tile must read; ``mask`` has a bit for each anchor."""
    for b in batches:
        for i in range(b.num_rows):
            r = {c: b.column(c)[i].as_py() for c in b.schema.names}
            dim = r["dim"]
            labels, zone = _ints(r["labels"]), r["zones"]
            k = len(labels)
            a = np.frombuffer(r["q"], np.int64).reshape(k, dim)
            lo, hi = (np.frombuffer(b"".join(z[c] for z in zone), np.int64).reshape(len(zone), dim) for c in ("lo", "hi"))
            block, label, n = (np.array([z[c] for z in zone], np.int64) for c in ("block", "label", "n"))
            least, most = bounds(a, lo, hi)
            same = labels[:, None] == label[None]
            if r["scores"] is None:         # the anchor itself is one of them
                read = must_read(least, most, n, same, same, want + 1)
            else:
                read = np.zeros(same.shape, bool)
                first, last = _windows(_ints(r["scores"], positives), low)
                for j in range(positives):
                    lo_j, hi_j = first[:, j, None], last[:, j, None]
                    may = ~same & (most >= lo_j) & (least <= hi_j) & (lo_j <= hi_j)
                    read |= must_read(least, most, n, may, may & (least >= lo_j) & (most <= hi_j), want)
            some = np.flatnonzero(read.any(axis=0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), r["tile"])), pa.array(block[some]),
                 pa.array([np.packbits(read[:, j]).tobytes() for j in some.tolist()], pa.binary())], ["tile", "block", "mask"])


# -- 3 reading ---------------------------------------------------------------------------

class _Best:
    """The ``want`` best (score, id, row) seen so far."""

    def __init__(self, want: int):
        self.want, self.kept, self.floor = want, [], NONE

    def offer(self, s: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        some = np.flatnonzero(s >= self.floor)
        if not len(some):
            return
        first = some[np.lexsort((rows[some], ids[some], -s[some]))[:self.want]]
        self.kept += zip((-s[first]).tolist(), ids[first].tolist(), rows[first].tolist())
        self.kept.sort()
        del self.kept[self.want:]
        if len(self.kept) == self.want:
            self.floor = -self.kept[-1][0]


def _read(tile: pa.Table, blocks: pa.Table, want: int, low: int, positives: int) -> pa.Table:
    """Each anchor's best rows of these blocks; ``slot`` numbers its positives (0 where these are looked for)."""
    out = []
    if tile.num_rows and blocks.num_rows:
        r = {c: tile.column(c)[0].as_py() for c in tile.column_names}
        labels, own = _ints(r["labels"]), _ints(r["rows"])
        k, dim = len(labels), r["dim"]
        a = np.frombuffer(r["q"], np.int64).reshape(k, dim)
        second = r["scores"] is not None
        if second:
            first, last = _windows(_ints(r["scores"], positives), low)
        best: dict[tuple[int, int], _Best] = {}
        for i in range(blocks.num_rows):
            b = {c: blocks.column(c)[i].as_py() for c in ("label", "ids", "rows", "q", "mask")}
            asked = np.flatnonzero(np.unpackbits(np.frombuffer(b["mask"], np.uint8), count=k))
            ids, rows = _ints(b["ids"]), _ints(b["rows"])
            s = product(a[asked], np.frombuffer(b["q"], np.int64).reshape(len(ids), dim))
            for at, line in zip(asked.tolist(), s):
                if (labels[at] == b["label"]) == second:
                    continue
                if not second:
                    other = rows != own[at]
                    best.setdefault((at, 0), _Best(want)).offer(line[other], ids[other], rows[other])
                    continue
                for j in range(positives):
                    inside = (line >= first[at, j]) & (line <= last[at, j])
                    if inside.any():
                        best.setdefault((at, j), _Best(want)).offer(line[inside], ids[inside], rows[inside])
        for (at, j), found in best.items():
            out += [(int(own[at]), j, i, row, -s) for s, i, row in found.kept]
    names = ("anchor_row", "slot", "id", "row", "score")
    return pa.table({n: pa.array([x[i] for x in out], pa.int64()) for i, n in enumerate(names)})


def _with_scores(tile: pa.Table, found: pa.Table, positives: int) -> pa.Table:
    """The tile with its anchors' positive scores."""
    if not tile.num_rows:
        return tile.append_column("scores", pa.nulls(0, pa.binary()))
    own = _ints(tile.column("rows")[0].as_py())
    scores = np.full((len(own), positives), NONE)
    order = np.argsort(own)
    at = order[np.searchsorted(own[order], found.column("anchor_row").to_numpy())] if found.num_rows else []
    scores[at, found.column("slot").to_numpy()] = found.column("score").to_numpy()
    return tile.append_column("scores", pa.array([scores.tobytes()], pa.binary()))


def _search(tiles: DataFrame, zones: DataFrame, blocks: DataFrame, scratch: Scratch, want: int, low: int, positives: int) -> DataFrame:
    """The best rows of every anchor and slot, over all blocks its bounds ask for."""
    last = zones.agg(F.max("part")).first()[0]
    units = (tiles.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last or 0).cast("long"))))
             .join(zones, ["dim", "part"]).repartition(F.col("tile"), F.col("part")))
    chosen = scratch.write(units.mapInArrow(lambda x: _choose(x, want, low, positives), "tile long, block long, mask binary"))
    parts = blocks.count() // PART + 1
    part = F.pmod(F.xxhash64("block"), F.lit(parts)).alias("part")
    mine = chosen.join(blocks.drop("lo", "hi", "n", "dim"), "block").withColumn("part", part).withColumnRenamed("tile", "of")
    asked = chosen.select("tile", part).distinct().join(tiles, "tile")
    found = asked.groupBy("tile", "part").cogroup(mine.groupBy("of", "part")).applyInArrow(
        lambda x, y: _read(x, y, want, low, positives), "anchor_row long, slot long, id long, row long, score long")
    w = Window.partitionBy("anchor_row", "slot").orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= want)


def hard_negatives(df: DataFrame, is_anchor: Column, vec_col: str = "embedding", id_col: str = "vec_id", label_col: str = "label",
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): the hard negatives of all anchors.

    ``is_anchor`` is a condition over ``df``; ``low`` is the least score of a
    negative in percent of the positive's.  Ids are integers.
    """
    spark = df.sparkSession
    ship(spark)
    scratch = Scratch(spark, "negatives")
    x = F.transform(col(vec_col), lambda c: F.coalesce(c.cast("double"), F.lit(float("nan"))) * SCALE)
    rows = df.select(col(id_col).cast("long").alias("id"), col(label_col).cast("long").alias("label"), x.alias("x"),
                     F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    # dim * q * q stays below 2**55, so scores and their hundredfold fit
    most = F.sqrt(F.lit(float(1 << 55)) / F.greatest(F.size("x"), F.lit(1))) - 1
    rows = rows.where(F.col("label").isNotNull() & F.col("x").isNotNull() & F.forall("x", lambda c: ~F.isnan(c) & (F.abs(c) < most)))
    rows = scratch.write(rows.select(F.monotonically_increasing_id().alias("row"), "id", "label", "anchor", F.size("x").alias("dim"),
                                     F.transform("x", lambda c: F.floor(c)).alias("q")))
    # one row per length of vector
    spread = rows.groupBy("dim").agg(F.min(F.array_min("q")).alias("low"), F.max(F.array_max("q")).alias("high"), F.count(F.lit(1)).alias("n"))
    spread = scratch.write(spread)
    placed = scratch.write(rows.join(spread.drop("n"), "dim").mapInArrow(
        _curve, "dim int, label long, row long, id long, key binary, q array<long>"))
    order = ["dim", "label", "key", "row"]
    blocks = scratch.write(placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_cut, _BLOCK))
    part = F.pmod(F.xxhash64("block"), F.lit(blocks.count() // ZONES + 1)).alias("part")
    zone = F.struct("block", "label", "n", "lo", "hi")
    zones = scratch.write(blocks.select("dim", part, zone.alias("z")).groupBy("dim", "part").agg(F.collect_list("z").alias("zones")))
    anchors = rows.where("anchor")
    many = anchors.count() // TILE + 1
    tile = (F.col("dim") * many + F.pmod(F.xxhash64("row"), F.lit(many))).alias("tile")
    tiles = scratch.write(anchors.select("dim", tile, "id", "row", "label", "q").groupBy("tile").applyInArrow(_pack_tile, _TILE))
    plain = tiles.withColumn("scores", F.lit(None).cast("binary"))
    found = scratch.write(_search(plain, zones, blocks, scratch, positives, low, positives).select(
        "anchor_row", (F.col("rank") - 1).cast("long").alias("slot"), "id", "score"))
    of = anchors.select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id"), tile.alias("of"))
    best = found.join(of, "anchor_row")
    ready = scratch.write(tiles.groupBy("tile").cogroup(best.select("of", "anchor_row", "slot", "score").groupBy("of")).applyInArrow(
        lambda t, f: _with_scores(t, f, positives), _TILE + ", scores binary"))
    hard = scratch.write(_search(ready, zones, blocks, scratch, negatives, low, positives).select(
        "anchor_row", "slot", "rank", F.col("id").alias("negative"), F.col("score").alias("negative_score")))
    known = lambda c: F.when(F.col(c) != LAST, F.col(c))
    return hard.join(best.select("anchor_row", "slot", "anchor_id", "id", F.col("score").alias("positive_score")), ["anchor_row", "slot"]).select(
        "anchor_id", known("id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), known("negative").alias("negative_id"),
        "positive_score", "negative_score")
