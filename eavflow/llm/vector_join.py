"""Embedding near-dedup: exact metric range join.

Unit vectors at cosine c are at distance sqrt(2 - 2c), so a cosine threshold
is a radius.  Pivots (a farthest-first choice from a bounded sample) cut the
vectors into cells: a vector lives in the cell of its nearest pivot.  If x
lives in cell i and y in cell j and they are within the radius, then by the
triangle inequality d(y, p_i) - d(y, p_j) <= 2 radius, and y is no further than
the radius from the plane between the two pivots,
(d(y, p_i)^2 - d(y, p_j)^2) / 2 d(p_i, p_j) <= radius.  A vector that meets both
for a cell before its own is replicated there, so each pair meets in exactly
one cell, that of the smaller number.  Cells are put into blocks of bounded size,
a crowded one into many, and a task compares two blocks, in tiles.  A vector is sent
once to each block it is compared in, so what is shuffled is the vectors times the number of
blocks and no pair of tiles is ever staged.  The number of pivots grows with the
square root of the number of vectors and there are always two where two vectors differ.

Copies of a vector are one node with a count.  A tile pair returns each node's
number of links and a spanning forest of them, never the pairs of a group.

Defined cases: vectors that are null, zero, or hold null or non-finite
components link with nothing and are their own component; vectors of different
lengths never link; repeated rows link with each other; null ids are never a
component's smallest id unless all are null; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eavflow.llm.common import Scratch, col, components, lookup_join, ship, without
from eavflow.llm.forest import Forest

COSINE, SAMPLE_BYTES, TILE, SLACK = 0.9, 16 << 20, 2048, 1e-7
#: sqrt(n) / ROOT_SHARE pivots (SAMPLE_BYTES of them at most), four sampled vectors to choose each from.
ROOT_SHARE, CHOICE = 16, 4
#: Bytes of a block's vectors in double precision at most, and how many blocks there are at least where they fill a tile;
#: beyond one candidate in CROWDED pairs of a tile all of them are computed in double precision.
BLOCK_BYTES, BLOCKS, CROWDED = 32 << 20, 8, 16
RETURNED = ["node", "links", "a", "b"]
RESULT = ("n_links", "component_id", "kept")


def pivot_count(n: int) -> int:
    return max(2, math.ceil(math.sqrt(n) / ROOT_SHARE))


def choose_pivots(sample: np.ndarray, most: int) -> np.ndarray:
    """Farthest-first traversal from the sample's first vector."""
    chosen = [0]
    near = np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < min(most, len(sample)):
        k = int(near.argmax())
        if near[k] <= 0:
            break
        chosen.append(k)
        near = np.minimum(near, np.linalg.norm(sample - sample[k], axis=1))
    return sample[chosen]


def cells(x: np.ndarray, pivots: np.ndarray, radius: float, home: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Each unit vector's own cell (``home``, if it is known), and whether it must also be seen in each cell (those before its own)."""
    d2 = np.maximum((x ** 2).sum(1)[:, None] - 2 * x @ pivots.T + (pivots ** 2).sum(1)[None], 0)
    home = d2.argmin(axis=1) if home is None else home      # found once: sums of another batch may round a tie otherwise
    own = d2[np.arange(len(x)), home][:, None]
    between = np.maximum((pivots ** 2).sum(1)[:, None] - 2 * pivots @ pivots.T + (pivots ** 2).sum(1)[None], 0)
    triangle = np.sqrt(d2) - np.sqrt(own) <= 2 * radius + SLACK
    plane = (d2 - own) <= 2 * radius * np.sqrt(between[home]) + SLACK
    return home, triangle & plane & (np.arange(len(pivots))[None] < home[:, None])


def _unit(values) -> np.ndarray:
    x = np.array(values, dtype=np.float64)
    # scaled first: squares of very large or small components must not overflow
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def pack(x: np.ndarray) -> list[bytes]:
    """Vectors as bytes, of half the size where single precision holds all components exactly."""
    with np.errstate(over="ignore"):
        single = x.astype(np.float32)
    exact = (single == x).all(axis=1)
    return [(s if e else d).tobytes() for s, d, e in zip(single, x, exact)]


def unpack(packed: pa.ChunkedArray, dim: int) -> np.ndarray:
    x = np.empty((len(packed), dim))
    at = 0
    for part in packed.chunks:
        part = part.cast(pa.large_binary())
        ends = np.frombuffer(part.buffers()[1], np.int64)[part.offset:part.offset + len(part) + 1]
        data, wide = part.buffers()[2], np.diff(ends) > 4 * dim
        if wide.any():
            for k, (a, z, w) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), wide.tolist())):
                x[at + k] = np.frombuffer(data[a:z], np.float64 if w else np.float32)
        elif len(part):
            x[at:at + len(part)] = np.frombuffer(data[int(ends[0]):int(ends[-1])], np.float32).reshape(-1, dim)
        at += len(part)
    return x


class Blocks:
    """Cells as blocks of at most ``most`` vectors of their own: neighbouring small cells share one, larger cells have several.

    Blocks are numbered in the order of cells.  ``meet[a, b]`` (a <= b) says that a vector of block b is seen in block a.
    """

    def __init__(self, sizes: np.ndarray, seen: np.ndarray, most: int):
        self.first, self.pieces, at, room = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64), -1, 0
        for c, n in enumerate(sizes.tolist()):
            if n > room:
                at, self.pieces[c] = at + 1, max(1, -(-n // most))
                self.first[c], room = at, most - n
                at += self.pieces[c] - 1
            else:
                self.first[c], room = max(at, 0), room - n
        self.n = max(at, 0) + 1
        # which cells a block holds vectors of
        self.holds = np.zeros((len(sizes), self.n), bool)
        for c in np.flatnonzero(sizes):
            self.holds[c, self.first[c]:self.first[c] + self.pieces[c]] = True
        of = self.holds.astype(np.int64)
        self.meet = np.triu(of.T @ (seen | np.eye(len(sizes), dtype=bool)).astype(np.int64) @ of > 0)

    def of(self, node: np.ndarray, cell: np.ndarray) -> np.ndarray:
        dealt = (node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        return self.first[cell] + (dealt % self.pieces[cell].astype(np.uint64)).astype(np.int64)

    def visits(self, block: np.ndarray, cell: np.ndarray, also: np.ndarray) -> np.ndarray:
        """The blocks that each vector is compared in: as a guest those before its own, as a host those that have guests for it."""
        number = np.arange(self.n)[None]
        cells_seen = also.copy()
        cells_seen[np.arange(len(cell)), cell] = True
        guest = (cells_seen.astype(np.float32) @ self.holds.astype(np.float32) > 0) & (number < block[:, None])
        return guest | (self.meet[block] & (number >= block[:, None]))


def linked(x: np.ndarray, y: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (in x, in y) of the pairs of unit vectors at ``cosine`` or more.

    Single precision finds what can be one, with room for its rounding; double precision decides.
    """
    slack = (x.shape[1] + 16) * 2.0 ** -23
    i, j = np.nonzero(x.astype(np.float32) @ y.astype(np.float32).T >= np.float32(cosine - slack))
    if len(i) * CROWDED > len(x) * len(y):
        return np.nonzero(x @ y.T >= cosine)
    sure = np.einsum("ij,ij->i", x[i], y[j]) >= cosine
    return i[sure], j[sure]


def _join(nodes: DataFrame, dim: int, cosine: float, scratch: Scratch) -> DataFrame:
    """(node, links, a, b): link counts by node (a null) and forest edges (node null) among ``nodes`` of one length."""
    radius, n, tile = math.sqrt(2 - 2 * cosine), nodes.count(), TILE
    most = pivot_count(n)
    limit = max(2, min(max(64, CHOICE * most), SAMPLE_BYTES // (8 * dim)))
    # at most SAMPLE_BYTES of vectors, chosen by a hash: pivots only steer the work, any choice gives the same result
    sample = _unit([r[0] for r in nodes.select("v").orderBy(F.xxhash64("v"), "node").limit(limit).collect()])
    pivots = choose_pivots(sample, most)

    def read(b):
        return b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, dim)

    def count(batches):
        seen = np.zeros((len(pivots), len(pivots)), np.int64)       # [cell, own cell]
        for b in batches:
            if b.num_rows:
                home, also = cells(_unit(read(b)), pivots, radius)
                np.add.at(seen, (home, home), 1)
                row, cell = np.nonzero(also)
                np.add.at(seen, (cell, home[row]), 1)
        cell, home = np.nonzero(seen)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(cell, pa.int32()), "home": pa.array(home, pa.int32()), "n": pa.array(seen[cell, home], pa.int64())})

    # one row per pair of cells that meet
    met = nodes.select("v").mapInArrow(count, "cell int, home int, n long").groupBy("cell", "home").agg(F.sum("n")).collect()
    seen = np.zeros((len(pivots), len(pivots)), np.int64)
    for cell, home, k in met:
        seen[cell, home] = k
    blocks = Blocks(seen.diagonal(), seen > 0, max(tile, min(BLOCK_BYTES // (8 * dim), -(-n // BLOCKS))))

    def assign(batches):
        for b in batches:
            if b.num_rows:
                v, node = read(b), b.column("node").to_numpy()
                home, also = cells(_unit(v), pivots, radius)
                own = blocks.of(node, home)
                row, other = np.nonzero(blocks.visits(own, home, also))
                guest = other < own[row]
                packed = pa.array(pack(v), pa.binary())
                yield pa.RecordBatch.from_pydict({
                    "unit": np.where(guest, other * blocks.n + own[row], own[row] * blocks.n + other), "guest": guest,
                    "cell": pa.array(home[row], pa.int32()), "node": node[row], "m": b.column("m").to_numpy()[row], "v": packed.take(pa.array(row))})

    def compare(rows):
        """One pair of blocks, or one block: cell by cell, a tile at a time."""
        rows = rows.combine_chunks()
        if not rows.num_rows:
            return none()
        first, second = divmod(rows.column("unit")[0].as_py(), blocks.n)
        node, m = rows.column("node").to_numpy(), rows.column("m").to_numpy().astype(np.float64)
        guest = rows.column("guest").to_numpy(zero_copy_only=False)
        x = _unit(unpack(rows.column("v"), dim))
        home, also = cells(x, pivots, radius, rows.column("cell").to_numpy())
        links, forest = np.zeros(len(x)), Forest(len(x))
        for cell in np.unique(home[~guest]):
            host = np.flatnonzero(~guest & (home == cell))
            # in a block of its own a pair of one cell is met once, above the diagonal
            come = np.flatnonzero((guest & (home == cell)) | (guest if first != second else ~guest) & also[:, cell])
            for s in range(0, len(host), tile):
                left = host[s:s + tile]
                if first == second:
                    for t in range(s, len(host), tile):
                        right = host[t:t + tile]
                        i, j = linked(x[left], x[right], cosine)
                        _note(links, forest, m, left[i], right[j], left[i] < right[j] if s == t else None)
                for t in range(0, len(come), tile):
                    right = come[t:t + tile]
                    i, j = linked(x[left], x[right], cosine)
                    _note(links, forest, m, left[i], right[j])
        some = np.flatnonzero(links)
        e = node[np.array(forest.edges, np.int64).reshape(-1, 2)]
        gap = lambda k: pa.nulls(k, pa.int64())
        return pa.concat_tables([none(), *[pa.Table.from_arrays(a, names=RETURNED) for a in (
            [pa.array(node[some]), pa.array(links[some].astype(np.int64)), gap(len(some)), gap(len(some))],
            [gap(len(e)), gap(len(e)), pa.array(e[:, 0]), pa.array(e[:, 1])])]])

    def none():
        return pa.schema([(c, pa.int64()) for c in RETURNED]).empty_table()

    # a vector is sent to each block it is compared in, of which there are n / their size: the size of a block decides what is shuffled
    dealt = nodes.select("node", "m", "v").mapInArrow(assign, "unit long, guest boolean, cell int, node long, m long, v binary")
    return dealt.repartition(max(8, 2 * int(blocks.meet.sum())), "unit").groupBy("unit").applyInArrow(compare, ", ".join(f"{c} long" for c in RETURNED))


def _note(links: np.ndarray, forest: Forest, m: np.ndarray, i: np.ndarray, j: np.ndarray, where: np.ndarray | None = None) -> None:
    if where is not None:
        i, j = i[where], j[where]
    if len(i):
        np.add.at(links, i, m[j])
        np.add.at(links, j, m[i])
        forest.link(i, j)


def near_dedup(df: DataFrame, vec_col: str = "embedding", id_col: str = "vec_id", cosine: float = COSINE) -> DataFrame:
    """One row per row of ``df``: its columns, n_links, component_id and kept (id = component_id).

    ``n_links`` counts the other vectors at ``cosine`` or more, ``component_id``
    is the smallest id reachable by links.  Columns named like a result are replaced.
    """
    ship(df.sparkSession)
    scratch = Scratch(df.sparkSession, "vectors")
    own = without(df, RESULT)
    # null components become NaN, which is not finite
    v = F.transform(col(vec_col), lambda c: F.coalesce(c.cast("double"), F.lit(float("nan"))))
    finite = F.forall("v", lambda c: ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))) & F.exists("v", lambda c: c != 0)
    rows = scratch.write(df.select(F.struct(*[col(c) for c in own]).alias("_e_df"), col(id_col).alias("_e_id"),
                                   F.monotonically_increasing_id().alias("row"), v.alias("v")))
    good = rows.where(F.col("v").isNotNull() & finite)
    first = F.struct(F.col("_e_id").isNull().alias("z"), F.col("_e_id").alias("id"))
    inner = Scratch(df.sparkSession, "vector-links")
    nodes = inner.write(good.groupBy("v").agg(F.min("row").alias("node"), F.count(F.lit(1)).alias("m"),
                                              F.min(first).alias("first"), F.size("v").alias("dim")))
    found = None
    for dim in sorted(r[0] for r in nodes.select("dim").distinct().collect()):
        part = _join(nodes.where(F.col("dim") == dim).select("node", "m", "v"), dim, cosine, inner)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return df.select(*[col(c) for c in own], F.lit(0).cast("long").alias("n_links"),
                         col(id_col).alias("component_id"), F.lit(True).alias("kept"))
    found = inner.write(found)
    links = found.where("node IS NOT NULL").groupBy("node").agg(F.sum("links").alias("links"))
    comps = components(found.where("a IS NOT NULL").select("a", "b"), inner)
    # vectors are brought to the answers once, at the end
    of = inner.write(nodes.select("node", "m", "first").join(links, "node", "left").join(comps, "node", "left").select(
        "node", "first", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).cast("long").alias("links"),
        F.coalesce("comp", "node").alias("comp")))
    best = inner.write(of.groupBy("comp").agg(F.min("first").alias("best"), F.count(F.lit(1)).alias("k")))
    small = inner.write(lookup_join(of.drop("first"), best, ["comp"], "k").select("node", "links", "best"))
    answer = scratch.write(nodes.select("node", "v", "m").join(small, "node").select("v", "m", "links", "best"))
    inner.close()
    alone = rows.where(F.col("v").isNull() | ~finite)
    shown = [F.col("_e_df").getField(c).alias(c) for c in own]
    same = F.col("_e_id").eqNullSafe(F.col("component_id"))
    linked = lookup_join(good, answer, ["v"], "m").select("_e_df", "_e_id", F.col("links").alias("n_links"),
                                                          F.col("best.id").alias("component_id"))
    alone = alone.select("_e_df", "_e_id", F.lit(0).cast("long").alias("n_links"), F.col("_e_id").alias("component_id"))
    return linked.unionByName(alone).select(*shown, "n_links", "component_id", same.alias("kept"))
