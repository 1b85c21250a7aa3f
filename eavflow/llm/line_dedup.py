"""Line dedup: fuzzy lines by MinHash, exact Jaccard and distributed components.

A line is what stands between line feeds, without white space at its ends;
blank lines are never duplicates.  Lower-cased lines are sets of
``SHINGLE``-character shingles (a shorter line is one shingle).  ``BANDS``
bands of ``ROWS`` minima find the candidates: a pair of Jaccard similarity 0.8
shares a band with probability 0.9992.  Lines linked at ``SIMILAR`` or more,
directly or through others, are one component, and the whole corpus keeps
its first line of it: the one of the smallest (id, line number).

1. Lines are cut and hashed once; their places and band keys are staged, not
   their words.  Band keys are dealt to buckets, many a row, and grouped there
   to a smallest and a largest line hash; keys where these differ hold different
   lines.  A bit map of those keys tells which keys to deal again, now with
   whole hashes, which makes the groups (a false hit only adds a key that is
   found to be alone).  Bands of the same lines are one group.  Equal lines are
   one node; the words of the nodes in groups are read again from the texts.
2. The lines of a group of up to ``TILE`` come together and are compared, first
   with one of them, then those still in different components.  In larger
   groups all lines are compared with one (a star); what this leaves in several
   components is compared in full, in tiles of bounded size, skipping pairs
   within a tile's most frequent component.  So no pair of a group is emitted
   and no link is lost.
3. Components give each line class its first line; lines that are not it are
   taken out of their documents.

Defined cases: null text stays null and empty text empty (no lines); null ids
come after all others; repeated rows are separate documents, of which one
keeps its lines; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from eavflow.llm import words as WD
from eavflow.llm.common import Scratch, col, components, freeing, lookup_join, ship, without
from eavflow.llm.forest import Forest
from eavflow.session import drop_path

SHINGLE, BANDS, ROWS, SIMILAR, TILE, BITS = 8, 10, 3, 0.8, 256, 26
BAND_BITS = 40      # of a band key, where it only finds candidates
HEADS = 1 << 20     # band keys dealt out at once, and in a bucket
BLOCK, SLOTS = 1 << 17, 512         # characters hashed at once; slots of a set's sketch (9 bits)
# texts, keys and hashes are mostly distinct: no dictionaries, light compression
FAST = {"parquet.enable.dictionary": "false", "parquet.compression.codec.zstd.level": "1"}
BLANK = " \t\n\x0b\x0c\r"
RESULT = ("n_lines", "removed")
_RNG = np.random.Generator(np.random.PCG64(11))
_A = _RNG.integers(1, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def lines_of(text: str | None) -> list[tuple[int, str]]:
    """(line number, line without white space at its ends) of the lines that are not blank."""
    return [(i, s) for i, s in enumerate(x.strip(BLANK) for x in (text or "").split("\n")) if s]


def _rolling(text: str) -> np.ndarray:
    """A 64-bit hash of the SHINGLE characters from each place on (the last places reach beyond the text)."""
    c = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    h, power, width = c * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1), int(_STEP), 1
    while width < SHINGLE:
        later = np.zeros_like(h)
        later[:max(0, len(h) - width)] = h[width:]
        h, power, width = h * np.uint64(power) + later, power * power % (1 << 64), 2 * width
    return h


def _rolling32(text: str) -> np.ndarray:
    """A 32-bit hash of the SHINGLE characters from each place on: enough for minima, which only find candidates."""
    h = np.frombuffer(text.encode("utf-32-le"), np.uint32) * np.uint32(0x85EBCA6B) + np.uint32(1)
    power, width = 0x9E3779B1, 1
    while width < SHINGLE:
        later = h
        h = h * np.uint32(power)
        if len(h) > width:
            h[:-width] += later[width:]
        power, width = power * power % (1 << 32), 2 * width
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        h ^= h >> np.uint32(shift)
        h *= np.uint32(factor)
    return h ^ (h >> np.uint32(16))


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (n[0] of them), start[1], ..."""
    return np.arange(int(n.sum())) + np.repeat(start - (np.cumsum(n) - n), n)


def _hashes(low: list[str], rolling, digest) -> tuple[np.ndarray, np.ndarray]:
    """The lines' shingle hashes one after another, and how many each line has."""
    size = np.fromiter(map(len, low), np.int64, len(low))
    n = np.maximum(size - SHINGLE + 1, 1)
    h = rolling("".join(low))[_ranges(np.cumsum(size) - size, n)]
    short = np.flatnonzero(size < SHINGLE)
    h[(np.cumsum(n) - n)[short]] = [digest(low[i].encode()) for i in short]
    return h, n


def _slices(size: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``most`` in all."""
    lo = held = 0
    for i, k in enumerate(size):
        if held and held + k > most:
            yield lo, i
            lo, held = i, 0
        held += k
    if lo < len(size):
        yield lo, len(size)


def bands(lines: list[str]) -> np.ndarray:
    """The band keys of each line: (lines, BANDS)."""
    low = [x.lower() for x in lines]
    least = np.empty((BANDS * ROWS, len(low)), np.uint32)
    for lo, hi in _slices([len(x) for x in low], BLOCK):
        x, n = _hashes(low[lo:hi], _rolling32, xxhash.xxh32_intdigest)
        first, y = np.cumsum(n) - n, np.empty_like(x)
        for r in range(BANDS * ROWS):
            np.multiply(x, _A[r], out=y)
            y += _B[r]
            least[r, lo:hi] = np.minimum.reduceat(y, first)
    out = np.empty((len(low), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(low), b + 1, np.uint64)
        for r in range(b * ROWS, (b + 1) * ROWS):
            key = WD.mix64(key * _STEP + least[r])
        out[:, b] = key
    return out


def _starts(sorted_keys: np.ndarray) -> np.ndarray:
    """Which keys differ from the one before."""
    new = np.ones(len(sorted_keys), bool)
    np.not_equal(sorted_keys[1:], sorted_keys[:-1], out=new[1:])
    return new


class Sets:
    """The shingle sets of lines, as sorted 64-bit hashes, ``ids[start[i]:start[i] + size[i]]``."""

    def __init__(self, lines: list[str]):
        h, n = _hashes([x.lower() for x in lines], _rolling, xxhash.xxh3_64_intdigest)
        ends = np.cumsum(n)
        for lo, hi in zip((ends - n).tolist(), ends.tolist()):
            h[lo:hi].sort()
        new = _starts(h)
        new[ends - n] = True
        line = np.repeat(np.arange(len(n)), n)[new]
        self.ids = h[new]
        self.size = np.bincount(line, minlength=len(n))
        self.start = np.cumsum(self.size) - self.size
        # how many shingles of a line fall into each of SLOTS: the sum of two lines' minima bounds what they share
        slot = (self.ids >> np.uint64(55)).view(np.int64)
        slot += line * SLOTS
        self.slots = np.bincount(slot, minlength=len(n) * SLOTS).astype(np.int16 if self.size.max(initial=0) < 1 << 15 else np.int32).reshape(-1, SLOTS)

    def shared(self, a: int, b: int) -> int:
        x, y = (self.ids[self.start[i]:self.start[i] + self.size[i]] for i in (a, b))
        both = np.sort(np.concatenate([x, y]))
        return int(np.count_nonzero(both[1:] == both[:-1]))

    def pairs(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of lines a[i], b[i] are similar; exact sets are compared where the bound leaves it open."""
        all_ = self.size[a] + self.size[b]
        least = SIMILAR / (1 + SIMILAR) * all_ - 1e-6      # shingles that similar lines share
        at = np.flatnonzero(np.minimum(self.size[a], self.size[b]) >= least)
        ok = np.zeros(len(a), bool)
        for lo in range(0, len(at), 512):
            some = at[lo:lo + 512]
            bound = np.minimum(self.slots[a[some]], self.slots[b[some]]).sum(axis=1, dtype=np.int32)
            for i in some[bound >= least[some]].tolist():
                both = self.shared(a[i], b[i])
                ok[i] = both / (all_[i] - both) >= SIMILAR
        return ok


def _runs(texts: list[str | None], most: int = 1 << 19):
    """Texts of about ``most`` characters at a time: each line's text, number and words, with its 128-bit key."""
    doc, number, line, held = [], [], [], 0
    for i, t in enumerate(texts):
        for k, s in lines_of(t):
            doc.append(i)
            number.append(k)
            line.append(s)
            held += len(s)
        if held > most:
            yield doc, number, line
            doc, number, line, held = [], [], [], 0
    if line:
        yield doc, number, line


def _keys(lines: list[str]) -> list[bytes]:
    return [xxhash.xxh3_128_digest(x.encode()) for x in lines]


def _short(keys: list[bytes]) -> np.ndarray:
    """The first 64 bits of the keys: a line's node.  Of different lines with the same ones only one is compared with others."""
    return np.frombuffer(b"".join(keys), np.int64)[::2]


def _cut(base: DataFrame) -> DataFrame:
    """Kind 0: every line's place and key.  Kind 1: the band keys of the lines of a run of texts, each line once."""
    def of(batches):
        for b in batches:
            row, id_ = b.column("_e_row").to_numpy(), b.column("_e_id")
            for doc, number, line in _runs(b.column("text").to_pylist()):
                key, n = _keys(line), len(line)
                yield rows(0, n, row=pa.array(row[doc]), id_=id_.take(pa.array(doc)), number=pa.array(number, pa.int32()),
                           key=pa.array(key, pa.binary()))
                at = list(dict(zip(reversed(key), range(n - 1, -1, -1))).values())
                own, line = [key[i] for i in at], [line[i] for i in at]
                band = pa.array(bands(line).reshape(-1).view(np.int64))
                yield rows(1, len(at), k=pa.array(_short(own)), bands=pa.ListArray.from_arrays(np.arange(0, len(band) + 1, BANDS, dtype=np.int32), band))

    id_type = base.schema["_e_id"].dataType
    types = {"row": pa.int64(), "id_": to_arrow_type(id_type), "number": pa.int32(), "key": pa.binary(), "k": pa.int64(),
             "bands": pa.list_(pa.int64())}

    def rows(kind: int, n: int, **known) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32))] + [
            known[c].cast(t) if c in known else pa.nulls(n, t) for c, t in types.items()], schema.names)

    schema = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("_e_row", T.LongType()),
                           T.StructField("_e_id", id_type), T.StructField("number", T.IntegerType()),
                           T.StructField("key", T.BinaryType()), T.StructField("k", T.LongType()),
                           T.StructField("bands", T.ArrayType(T.LongType()))])
    return base.select("_e_row", "_e_id", "text").mapInArrow(freeing(of), schema)


def _ends(key: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys in order, with the smallest and the largest k of each."""
    at = np.argsort(key)
    key, k = key[at], k[at]
    first = np.flatnonzero(_starts(key))
    return (key[first], np.minimum.reduceat(k, first), np.maximum.reduceat(k, first)) if len(key) else (key, k, k)


def _packed(of: np.ndarray, data: dict[str, np.ndarray]) -> pa.RecordBatch:
    """A row for each bucket in ``of`` (in order), with the bytes of its part of each array."""
    cut = np.append(np.flatnonzero(_starts(of)), len(of)).astype(np.int32)
    return pa.RecordBatch.from_pydict({"bucket": pa.array(of[cut[:-1]].astype(np.int32))} | {
        c: pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer(cut * v.itemsize), pa.py_buffer(v)]) for c, v in data.items()})


def _heads(lines: DataFrame) -> DataFrame:
    """The band keys, cut to BAND_BITS, that lines of different hashes ``k`` have.

    Keys are dealt to buckets by their first bits.  A row holds what some lines
    have for a bucket, as bytes: a key's low 32 and high bits and half a hash,
    for the smallest and the largest hash alone, so that no key fills a bucket.
    """
    buckets = max(256, -(-lines.count() * BANDS // HEADS))

    def offer(batches):
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n * BANDS >= HEADS:
                yield deal(held)
                held, n = [], 0
        if n:
            yield deal(held)

    def deal(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        key = t.column("bands").combine_chunks().flatten().to_numpy() & ((1 << BAND_BITS) - 1)
        key, lo, hi = _ends(key, np.repeat((t.column("k").to_numpy() >> 32).astype(np.int32), BANDS))
        two = lo != hi
        at = np.repeat(np.arange(len(key)), 1 + two)
        second = np.zeros(len(at), bool)
        second[1:] = at[1:] == at[:-1]
        key, k = key[at], np.where(second, hi[at], lo[at])
        of = key * buckets >> BAND_BITS
        return _packed(of, {"low": key.astype(np.uint32), "high": (key >> 32).astype(np.uint8), "k": k})

    def meet(table: pa.Table) -> pa.Table:
        low, high, k = (np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in (("low", np.uint32), ("high", np.uint8), ("k", np.int32)))
        key, lo, hi = _ends(high.astype(np.int64) << 32 | low, k)
        return pa.table({"b": key[lo != hi]})

    return (lines.mapInArrow(freeing(offer), "bucket int, low binary, high binary, k binary")
            .groupBy("bucket").applyInArrow(meet, "b long"))


def _bit_map(spark, table: DataFrame, of: str, bits: int) -> Broadcast:
    """Which of 2**bits slots hold a value of the column: a numpy array."""
    slot = F.col(of).bitwiseAND(F.lit((1 << bits) - 1))
    words = (table.select(F.shiftright(slot, 6).alias("at"), F.expr(f"shiftleft(1L, int({of} & 63))").alias("bit"))
             .groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow())       # at most 2**(bits - 6) rows
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words.column("at").to_numpy()] = words.column("bits").to_numpy()
    return spark.sparkContext.broadcast(out.view(np.uint64))


def _wide(n: int) -> int:
    """Bits of a bit map in which ``n`` values take less than a sixteenth of the slots, up to 32 MB."""
    return min(28, max(16, (16 * n).bit_length()))


def _met(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values' slots are set."""
    slot = values.view(np.uint64) & np.uint64(64 * len(bits) - 1)
    return (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def _banded(batch: pa.RecordBatch, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The band keys in the bit map, cut to BAND_BITS, and their lines' nodes."""
    key = batch.column("bands").flatten().to_numpy() & ((1 << BAND_BITS) - 1)
    met = np.flatnonzero(_met(bits, key))
    return key[met], batch.column("k").to_numpy()[met // BANDS]


def _sorted(key: np.ndarray, k: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and nodes in order, each pair once, and where the keys start."""
    at = np.lexsort((k, key))
    key, k = key[at], k[at]
    new = _starts(key)
    one = new | _starts(k)
    return key[one], k[one], np.flatnonzero(new[one])


def _groups(lines: DataFrame, hits: Broadcast, n: int) -> DataFrame:
    """The nodes of each of ``n`` band keys (about) that has several; null where these are more than TILE.

    Of a key that has more in a row's lines, TILE + 1 are dealt: enough to tell.
    """
    most, buckets = TILE, max(64, -(-4 * n // HEADS))

    def offer(batches):
        held, rows = [], 0
        for b in batches:
            held.append(_banded(b, hits.value))
            rows += len(held[-1][0])
            if rows >= HEADS:
                yield deal(held)
                held, rows = [], 0
        if rows:
            yield deal(held)

    def deal(held):
        key, k, first = _sorted(*(np.concatenate(x) for x in zip(*held)))
        size = np.diff(np.append(first, len(key)))
        few = np.arange(len(key)) - np.repeat(first, size) <= most
        key, k = key[few], k[few]
        return _packed(key * buckets >> BAND_BITS, {"key": key, "k": k})

    def meet(table: pa.Table) -> pa.Table:
        key, k, first = _sorted(*(np.frombuffer(b"".join(table.column(c).to_pylist()), np.int64) for c in ("key", "k")))
        size = np.diff(np.append(first, len(key)))
        x, y = (np.bitwise_xor.reduceat(WD.mix64(k.view(np.uint64) ^ np.uint64(seed)), first).view(np.int64) for seed in (1, 2))
        some = np.flatnonzero(size > 1)
        large = size[some] > most
        light = some[~large]
        nodes, ends = pa.array(k[_ranges(first[light], size[light])]), np.append(0, np.cumsum(np.where(large, 0, size[some]))).astype(np.int32)
        return pa.table({"b": key[first[some]], "x": x[some], "y": np.where(large, key[first[some]], y[some]),
                         "nodes": pa.ListArray.from_arrays(ends, nodes),
                         "large": large})

    return (lines.mapInArrow(freeing(offer), "bucket int, key binary, k binary")
            .groupBy("bucket").applyInArrow(meet, "b long, x long, y long, nodes array<long>, large boolean"))


def _members(lines: DataFrame, large: Broadcast) -> DataFrame:
    """(b, node) of the band keys in the bit map."""
    def of(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _banded(b, large.value)], ["b", "node"])
    return lines.mapInArrow(freeing(of), "b long, node long").distinct()


def _words(base: DataFrame, nodes: Broadcast) -> DataFrame:
    """The lines whose nodes are in the bit map, each once of a run of texts."""
    def of(batches):
        for b in batches:
            for _, _, line in _runs(b.column("text").to_pylist()):
                own = dict(zip(_keys(line), line))
                key = list(own)
                node = _short(key)
                some = np.flatnonzero(_met(nodes.value, node)).tolist()
                yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array([key[i] for i in some], pa.binary()),
                                                  pa.array([own[key[i]] for i in some], pa.string())], ["node", "key", "line"])
    return base.select("text").mapInArrow(freeing(of), "node long, key binary, line string")


def _candidates(base: DataFrame, lines: DataFrame, heads: DataFrame, scratch: Scratch) -> DataFrame:
    """The different lines that share bands with others, staged: node, key, line and their groups, ``bands`` of up to TILE lines and ``large``."""
    spark, n = base.sparkSession, heads.count()
    groups = scratch.write(_groups(lines, _bit_map(spark, heads, "b", BITS), n).dropDuplicates(["x", "y"]))
    own = groups.where("NOT large").select("b", F.explode("nodes").alias("node"), F.lit(False).alias("large"))
    large = groups.where("large").select("b")
    if not large.isEmpty():
        # a false hit of the bit map makes no group: it has TILE lines at most
        found = scratch.write(_members(lines, _bit_map(spark, large, "b", BITS)))
        sizes = scratch.write(found.groupBy("b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > TILE))
        own = own.unionByName(lookup_join(found, sizes, ["b"], "n").select("b", "node", F.lit(True).alias("large")))
    own = scratch.write(own.groupBy("node").agg(F.collect_list(F.when(~F.col("large"), F.col("b"))).alias("bands"),
                                                F.collect_list(F.when(F.col("large"), F.col("b"))).alias("large")))
    words = _words(base, _bit_map(spark, own, "node", _wide(own.count())))
    return scratch.write(words.groupBy("node").agg(F.first("key").alias("key"), F.first("line").alias("line")).join(own.hint("merge"), "node"))


def _sets(node: np.ndarray, line: pa.Array) -> tuple[Sets, np.ndarray]:
    """The sets of the lines, equal nodes once, and each row's place among them."""
    _, first, at = np.unique(node, return_index=True, return_inverse=True)
    return Sets(line.take(pa.array(first)).to_pylist()), at


def _star(pairs: DataFrame) -> DataFrame:
    def verify(batches):
        for b in batches:
            b = pa.RecordBatch.from_arrays([b.column(c) for c in ("node", "head", "line", "other")], ["node", "head", "line", "other"])
            size = np.add(*(pc.utf8_length(b.column(c)).to_numpy() + SLOTS for c in ("line", "other")))
            for lo, hi in _slices(size.tolist(), 8 * BLOCK):
                run = b.slice(lo, hi - lo)
                node, head = run.column("node").to_numpy(), run.column("head").to_numpy()
                sets, at = _sets(np.concatenate([node, head]), pa.concat_arrays([run.column("line"), run.column("other")]))
                ok = sets.pairs(at[:hi - lo], at[hi - lo:])
                yield pa.RecordBatch.from_pydict({"a": pa.array(node[ok]), "b": pa.array(head[ok])})
    return pairs.mapInArrow(freeing(verify), "a long, b long")


def _full(tiles: DataFrame, sizes: DataFrame) -> DataFrame:
    """Links between lines of different components in the same band group, as a forest for each pair of tiles."""
    def open_pairs(comp: np.ndarray, left: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows to compare: of different components, of both tiles (the first ``left`` rows and the others) or of the only one."""
        two = left < len(comp)
        _, of, n = np.unique(comp, return_inverse=True, return_counts=True)
        rest, place = of != n.argmax(), np.arange(len(comp))    # most rows may be of one component: not compared with each other
        one, other = place[:left], place[left:] if two else place
        found = []
        for p, q in ((one[rest[one]], other), (one[~rest[one]], other[rest[other]] if two else other[:0])):
            i, j = np.repeat(p, len(q)), np.tile(q, len(p))
            # in one tile a pair of two rows outside the most frequent component is met twice
            open_ = (of[i] != of[j]) & (two | (i < j) | ~rest[j])
            found.append((i[open_], j[open_]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def forest(node: np.ndarray, comp: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Of the similar rows i, j those pairs of nodes that connect components."""
        _, first, of = np.unique(comp, return_index=True, return_inverse=True)
        links = Forest(len(first))
        links.link(of[i], of[j])
        return node[first[np.array(links.edges, np.int64).reshape(-1, 2)]]

    def verify(batches):
        for b in batches:
            sides = [b.column("left"), b.column("right")]
            n = [pc.fill_null(pc.list_value_length(x), 0).to_numpy().astype(np.int64) for x in sides]
            ends = [np.concatenate([[0], np.cumsum(x)]) for x in n]
            flat = [x.flatten() for x in sides]
            cost = [np.concatenate([[0], np.cumsum(pc.utf8_length(x.field("line")).to_numpy() + SLOTS)]) for x in flat]
            size = sum(c[e[1:]] - c[e[:-1]] for c, e in zip(cost, ends))
            for lo, hi in _slices(size.tolist(), 8 * BLOCK):
                part = [x.slice(e[lo], e[hi] - e[lo]) for x, e in zip(flat, ends)]
                node, comp = (np.concatenate([x.field(c).to_numpy() for x in part]) for c in ("node", "comp"))
                sets, at = _sets(node, pa.concat_arrays([x.field("line") for x in part]))
                for k in range(lo, hi):
                    mine = np.concatenate([np.arange(ends[0][k], ends[0][k + 1]) - ends[0][lo],
                                           np.arange(ends[1][k], ends[1][k + 1]) - ends[1][lo] + len(part[0])])
                    i, j = open_pairs(comp[mine], int(n[0][k]))
                    ok = sets.pairs(at[mine[i]], at[mine[j]])
                    e = forest(node[mine], comp[mine], i[ok], j[ok])
                    yield pa.RecordBatch.from_pydict({"a": pa.array(e[:, 0]), "b": pa.array(e[:, 1])})

    last = F.col("tiles") - 1
    pairs = (sizes.select("b", "tiles", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("tile"))
             .select("b", "tile", F.explode(F.sequence(F.col("tile"), last)).alias("with")))
    work = (pairs.join(tiles.select("b", "tile", F.col("rows").alias("left")), ["b", "tile"])
            .join(tiles.select("b", F.col("tile").alias("with"), F.col("rows").alias("right")), ["b", "with"])
            .select("left", F.when(F.col("tile") != F.col("with"), F.col("right")).alias("right")))
    return work.mapInArrow(freeing(verify), "a long, b long")


def _together(rows: DataFrame) -> DataFrame:
    """Links between the lines of each group ``b`` (a few lines), as a forest for some groups at a time."""
    def whole(batches):
        """The rows as they come, but cut between groups."""
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            of = t.column("b").to_numpy()
            last = int(np.searchsorted(of, of[-1])) if len(of) else 0
            held = t.slice(last)
            if last:
                yield t.slice(0, last).combine_chunks()
        if held is not None and held.num_rows:
            yield held.combine_chunks()

    def verify(batches):
        for t in whole(batches):
            first = np.flatnonzero(_starts(t.column("b").to_numpy()))
            ends = np.append(first, t.num_rows)
            cost = np.add.reduceat(pc.utf8_length(t.column("line")).to_numpy() + SLOTS, first)
            for lo, hi in _slices(cost.tolist(), 8 * BLOCK):
                run = t.slice(ends[lo], ends[hi] - ends[lo])
                node, size = run.column("node").to_numpy(), np.diff(ends[lo:hi + 1])
                sets, at = _sets(node, run.column("line").combine_chunks())
                links, rows = Forest(len(sets.size)), np.arange(len(node))
                head = np.repeat(ends[lo:hi] - ends[lo], size)
                i, j = rows[rows != head], head[rows != head]
                for _ in range(2):
                    i, j = at[i], at[j]
                    ok = sets.pairs(i, j)
                    links.link(i[ok], j[ok])
                    # then all pairs of a group that are still in different components: each row with those after it
                    more = np.repeat(ends[lo + 1:hi + 1] - ends[lo], size) - rows - 1
                    i, j = np.repeat(rows, more), _ranges(rows + 1, more)
                    open_ = (head[i] != i) & (links.label[at[i]] != links.label[at[j]])
                    i, j = i[open_], j[open_]
                own = np.empty(len(sets.size), np.int64)
                own[at] = node
                e = own[np.array(links.edges, np.int64).reshape(-1, 2)]
                yield pa.RecordBatch.from_pydict({"a": pa.array(e[:, 0]), "b": pa.array(e[:, 1])})
    return rows.repartition("b").sortWithinPartitions("b").mapInArrow(freeing(verify), "a long, b long")


def _apart(lines: DataFrame, scratch: Scratch) -> DataFrame:
    """Links between the lines of the ``large`` groups."""
    met = lines.select("node", F.explode("large").alias("b"))
    groups = scratch.write(met.groupBy("b").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("head")).where("n > 1"))
    members = scratch.write(lookup_join(met, groups, ["b"], "n"))
    pairs = members.where("node <> head").select("node", "head").distinct()
    stars = scratch.write(pairs.groupBy("head").agg(F.count(F.lit(1)).alias("n"))
                          .join(lines.select(F.col("node").alias("head"), F.col("line").alias("other")), "head"))
    # a head's rows come one after another, so that its set is made once for them
    star = scratch.write(_star(lookup_join(pairs.join(lines.select("node", "line"), "node"), stars, ["head"], "n")
                               .select("node", "head", "line", "other")))
    # what the star has linked with a group's head is one component there
    linked = star.select(F.col("a").alias("node"), F.col("b").alias("head"), F.col("b").alias("comp"))
    members = scratch.write(members.join(linked, ["node", "head"], "left").select(
        "b", "node", "n", F.coalesce("comp", "node").alias("comp")))
    # bands of the same lines (by two hashes of their set) are one group
    split = scratch.write(members.groupBy("b").agg(
        F.count(F.lit(1)).alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("node").alias("least"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
        .where("lo <> hi").groupBy("n", "least", "x", "y").agg(F.min("b").alias("b"))
        .select("b", "n", F.ceil(F.col("n") / TILE).alias("tiles")))
    tiles = scratch.write(lookup_join(members.select("b", "node", "comp"), split, ["b"], "n")
                          .join(lines.select("node", "line"), "node")
                          .groupBy("b", F.pmod(F.xxhash64("node"), F.col("tiles")).alias("tile"))
                          .agg(F.collect_list(F.struct("node", "comp", "line")).alias("rows")))   # about TILE lines each
    return star.unionByName(scratch.write(_full(tiles, split.select("b", "tiles"))))


def _components(lines: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, comp) of those of the staged distinct lines that are linked with a different line."""
    links = scratch.write(_together(lines.select("node", "line", F.explode("bands").alias("b"))))
    if not lines.where("size(large) > 0").isEmpty():
        links = links.unionByName(_apart(lines.where("size(large) > 0"), scratch))
    comps = components(links, scratch)
    return lines.select("node", "key").join(comps, "node").select("key", "comp")


def line_dedup(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``df``: the columns in ``keep`` (all), with the text without its duplicate lines, n_lines and removed.

    ``removed`` lists the numbers (from 0) of the lines taken out, ``n_lines``
    counts the lines that are not blank.  Columns named like a result are replaced.
    """
    spark = df.sparkSession
    ship(spark)
    scratch = Scratch(spark, "lines")
    own = [c for c in without(df, RESULT) if c != text_col and (keep is None or c in keep)]
    order = [c for c in without(df, RESULT) if c == text_col or c in own]
    base = scratch.write(df.select(F.monotonically_increasing_id().alias("_e_row"), col(id_col).alias("_e_id"),
                                   F.struct(F.lit(0).alias("_e_0"), *[col(c) for c in own]).alias("_e_df"),
                                   col(text_col).alias("text")), compression="zstd", options=FAST)
    cut = scratch.write(_cut(base), ["kind"], compression="zstd", writers=3, options=FAST)
    # the heads only find candidates: parts of the hashes tell lines and bands apart, and are what is shuffled
    heads = scratch.write(_heads(cut.where("kind = 1").select("k", "bands")))
    inner = Scratch(spark, "line-candidates")
    some = _candidates(base, cut.where("kind = 1").select("k", "bands"), heads, inner)
    scratch.drop(heads)
    drop_path(spark, f"{cut._eav_path}/kind=1")     # all that is read of these lines from here on
    comps = scratch.write(_components(some, inner))
    inner.close()
    # only lines that occur again or are linked can go
    found = scratch.write(cut.where("kind = 0").groupBy("key").agg(F.count(F.lit(1)).alias("n")).join(comps, "key", "left")
                          .where("n > 1 OR comp IS NOT NULL"))
    place = F.struct(F.col("_e_id").isNull().alias("z"), "_e_id", "_e_row", "number")
    lines = scratch.write(lookup_join(cut.where("kind = 0").select("_e_row", "_e_id", "number", "key"), found, ["key"], "n"))
    drop_path(spark, f"{cut._eav_path}/kind=0")
    classes = scratch.write(lines.groupBy("key").agg(F.first("n").alias("n"), F.first("comp").alias("comp"), F.min(place).alias("first")))
    linked = classes.where("comp IS NOT NULL")
    best = scratch.write(linked.groupBy("comp").agg(F.min("first").alias("best"), F.count(F.lit(1)).alias("k")))
    answer = scratch.write(
        lookup_join(linked.select("key", "n", "comp"), best, ["comp"], "k").select("key", "n", "best")
        .unionByName(classes.where("comp IS NULL").select("key", "n", F.col("first").alias("best"))))
    scratch.drop(found, classes, best)
    gone = scratch.write(
        lookup_join(lines.select("_e_row", "number", "key"), answer, ["key"], "n")
        .where((F.col("best._e_row") != F.col("_e_row")) | (F.col("best.number") != F.col("number")))
        .groupBy("_e_row").agg(F.sort_array(F.collect_list("number")).alias("removed")))
    scratch.drop(lines, answer)
    # texts that lose no line stay where they are; a false hit of the bit map only moves a text
    lossy = _bit_map(spark, gone.select(F.xxhash64("_e_row").alias("h")), "h", _wide(gone.count()))

    @F.arrow_udf("boolean")
    def loses(h: pa.Array) -> pa.Array:
        return pa.array(_met(lossy.value, h.to_numpy()))

    @F.arrow_udf("string")
    def rest(texts: pa.Array, removed: pa.Array) -> pa.Array:
        made = []
        for t, r in zip(texts.to_pylist(), removed.to_pylist()):
            drop = set(r or ())
            made.append(None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in drop))
        return pa.array(made, pa.string())

    has = F.size("removed") > 0
    text = F.when(has, rest(F.when(has, F.col("text")), F.col("removed"))).otherwise(F.col("text"))
    filled = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(BLANK)) != "")
    count = F.coalesce(F.when(F.col("text").isNotNull(), F.size(filled)), F.lit(0)).alias("n_lines")
    none = F.array().cast("array<int>")
    moved = loses(F.xxhash64("_e_row"))

    def result(rows: DataFrame, made) -> DataFrame:
        return rows.select(*[made.alias(c) if c == text_col else F.col("_e_df").getField(c).alias(c) for c in order], count, "removed")

    return result(base.where(moved).join(gone.hint("merge"), "_e_row", "left").withColumn("removed", F.coalesce("removed", none)), text).unionByName(
        result(base.where(~moved).withColumn("removed", none), F.col("text")))
