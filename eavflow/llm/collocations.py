"""Phrase collocation mining: SETM, by sorted occurrence relations.

Texts are lower-cased, cut into pieces at punctuation and line ends, and pieces
into words.  A place numbers the words of a block of texts in order and skips
one number between pieces, so neighbours within a piece are neighbours in number.

1. The relation R1 (block, place, word) and each block's dictionary, with the
   block's own counts, are written.  Dictionaries are dealt out by hash and add
   up to the words of a language; those with ``least`` occurrences get a number,
   blocks learn the numbers of their words, and other words leave the relation.
2. A phrase of k + 1 words is a pair of phrases of k words at neighbouring
   places, so R(k) is merge-joined with itself.  Blocks count their distinct
   pairs, pairs are dealt out by hash with these counts and added up
   (group-count); frequent ones get a number and blocks learn it: R(k + 1).
   Numbers stand for whole phrases of a language, so counts are exact.
3. A phrase keeps the counts of all its beginnings and ends.  Of its cuts the
   one with the lowest score counts; arithmetic is on 38-digit decimals.  A
   phrase goes if one longer by a word has all its occurrences: if any longer
   phrase has, then one longer by a word has too.

Relations are one row per block: places and numbers, sorted by place, packed.
A word or pair is one entry per block wherever it goes, however frequent.

Defined cases: null text has no words; null language is ``UNKNOWN``; a piece is
never split, a long text is, between pieces; repeated rows count each time; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eavflow.llm import words as WD
from eavflow.llm.common import Scratch, col, lookup_join, ship
from eavflow.llm.katz import deal, pack, pack_sorted, unpack, unpack_sorted
from eavflow.session import drop_path

LEAST, LONGEST, TOP, BLOCK, BUCKET, UNKNOWN = 100, 5, 2000, 1 << 22, 1 << 20, "und"
#: What ends a piece, and what lies between words (ends of pieces too).
END = np.zeros(256, bool)
END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BETWEEN = END.copy()
BETWEEN[[0x20, 0x09]] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)
_RELATION = "block long, at binary, id binary"


# -- 1 words ------------------------------------------------------------------------------

def parts(buf: np.ndarray, offs: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts longer than ``most`` bytes in parts that end with a piece: the offsets of all parts, and the text of each."""
    cuts = [offs]
    for i in np.flatnonzero(np.diff(offs) > most).tolist():
        after = np.flatnonzero(END[buf[offs[i]:offs[i + 1]]]) + offs[i] + 1
        _, last = np.unique((after - offs[i]) // most, return_index=True)
        cuts.append(after[last][1:])
    if len(cuts) == 1:
        return offs, np.arange(len(offs) - 1)
    out = np.unique(np.concatenate(cuts))       # empty texts are left out
    return out, np.searchsorted(offs, out[:-1], "right") - 1


def relation(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Places, numbers and texts of the words of some texts, and the distinct words."""
    starts, ends, n = WD.spans(buf, offs, BETWEEN)
    code, found = WD.coded(buf, starts, ends)
    doc = np.repeat(np.arange(len(n)), n)
    breaks = np.concatenate([[0], np.cumsum(END[buf])])
    apart = np.zeros(len(starts), np.int64)
    apart[1:] = (breaks[starts[1:]] > breaks[ends[:-1]]) | (doc[1:] != doc[:-1])
    return np.arange(len(starts)) + np.cumsum(apart), code, doc, found


_BASE = "kind int, block long, at binary, code binary, lang string, number array<int>, word array<string>, ns array<long>, n long"


def _relate(batches):
    """Kind 0: a block's relation, by the block's own numbers.  Kind 1: its dictionary, a row per language."""
    block = TaskContext.get().partitionId() << 32
    names = ["kind", "block", "at", "code", "lang", "number", "word", "ns", "n"]
    lists = [pa.list_(t) for t in (pa.int32(), pa.string(), pa.int64())]
    for b in batches:
        buf, whole = WD.as_bytes(b.column("text"))
        langs = b.column("lang").dictionary_encode()
        lang_of, names_of = langs.indices.to_numpy().astype(np.int64), langs.dictionary
        offs, text = parts(buf, whole, BLOCK)
        for lo, hi, part, o in WD.pieces(buf, offs, BLOCK):
            at, code, doc, found = relation(part, o)
            if not len(at):
                continue
            both, code = np.unique(lang_of[text[lo:hi]][doc] * len(found) + code, return_inverse=True)
            k, n, lang = len(both), np.bincount(code), both // len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([0], pa.int32()), pa.array([block]), pa.array([pack_sorted(at.astype(np.uint64))], pa.binary()),
                 pa.array([pack(code.astype(np.int64))], pa.binary()), pa.nulls(1, pa.string()), *[pa.nulls(1, t) for t in lists],
                 pa.array([len(at)])], names)
            first = np.flatnonzero(np.diff(lang, prepend=-1))
            m = len(first)
            word = found.take(pa.array(both % len(found))).cast(pa.large_string()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(m, np.int32)), pa.array(np.full(m, block)), pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary()),
                 names_of.take(pa.array(lang[first])).cast(pa.string()),
                 *[_lists(x, [*first, k]) for x in (pa.array(np.arange(k, dtype=np.int32)), word, pa.array(n))],
                 pa.array(np.add.reduceat(n, first))], names)
            block += 1


def _lists(values: pa.Array, cuts) -> pa.Array:
    """Lists of the values from each cut to the next."""
    return pa.ListArray.from_arrays(pa.array(np.asarray(cuts, np.int32)), values)


def _offer(batches, buckets: int):
    """The dictionaries, dealt out by the words' hash."""
    for b in batches:
        for i in range(b.num_rows):
            own = {c: b.column(c).slice(i, 1).flatten() for c in ("number", "word", "ns")}
            buf, offs = WD.as_bytes(own["word"])
            dealt = list(deal(WD.keys(buf, offs[:-1], offs[1:], lower=False), buckets))
            of = pa.array(np.concatenate([x for _, x in dealt]))
            cuts = np.cumsum([0, *[len(x) for _, x in dealt]])
            same = pa.array(np.zeros(len(dealt), np.int64))
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array([x for x, _ in dealt], pa.int64()), "block": b.column("block").slice(i, 1).take(same),
                "lang": b.column("lang").slice(i, 1).take(same), **{c: _lists(x.take(of), cuts) for c, x in own.items()}})


def _count_words(table: pa.Table, least: int) -> pa.Table:
    """Kind 0: a bucket's frequent words, numbered.  Kind 1: to each block, the numbers of those it holds."""
    lists = {c: table.column(c).combine_chunks() for c in ("number", "word", "ns")}
    row = np.repeat(np.arange(table.num_rows), lists["number"].value_lengths().to_numpy())
    langs, words = table.column("lang").combine_chunks().dictionary_encode(), lists["word"].flatten().dictionary_encode()
    lang, word = langs.indices.to_numpy().astype(np.int64)[row], words.indices.to_numpy()
    _, first, at = np.unique(lang * len(words.dictionary) + word, return_index=True, return_inverse=True)
    total = np.zeros(len(first), np.int64)
    np.add.at(total, at, lists["ns"].flatten().to_numpy())
    often = total >= least
    id_ = np.full(len(first), -1)
    id_[often] = (table.column("bucket")[0].as_py() << 32) + np.arange(int(often.sum()))
    first = first[often]
    k = len(first)
    mine = np.flatnonzero(id_[at] >= 0)
    rows, lo = np.unique(row[mine], return_index=True)
    m, cuts = len(rows), [*lo, len(mine)]
    return pa.concat_tables([
        pa.table({"kind": np.zeros(k, np.int32), "lang": langs.dictionary.take(pa.array(lang[first])),
                  "word": words.dictionary.take(pa.array(word[first])), "a": total[often], "id": id_[often],
                  "block": pa.nulls(k, pa.int64()), "number": pa.nulls(k, pa.list_(pa.int32())), "ids": pa.nulls(k, pa.list_(pa.int64()))}),
        pa.table({"kind": np.ones(m, np.int32), "lang": pa.nulls(m, pa.string()), "word": pa.nulls(m, pa.string()),
                  "a": pa.nulls(m, pa.int64()), "id": pa.nulls(m, pa.int64()), "block": table.column("block").combine_chunks().take(pa.array(rows)),
                  "number": _lists(lists["number"].flatten().take(pa.array(mine)), cuts), "ids": _lists(pa.array(id_[at[mine]]), cuts)})])


def _word_counter(least: int):
    return lambda table: _count_words(table, least)


def _numbered(block: pa.Table, known: pa.Table) -> pa.Table:
    """The block's relation by the corpus's numbers, without the words that have none."""
    if not block.num_rows or not known.num_rows:
        return _rows([])
    at = unpack_sorted(block.column("at")[0].as_py())
    code = unpack(block.column("code")[0].as_py(), np.int64)
    to = np.full(int(code.max()) + 1, -1)
    number, ids = (known.column(c).combine_chunks().flatten().to_numpy() for c in ("number", "ids"))
    to[number] = ids
    id_ = to[code]
    some = id_ >= 0
    return _rows([(block.column("block")[0].as_py(), at[some], id_[some])])


def _rows(rows) -> pa.Table:
    return pa.table({"block": pa.array([x for x, *_ in rows], pa.int64()),
                     "at": pa.array([pack_sorted(x.astype(np.uint64)) for _, x, _ in rows], pa.binary()),
                     "id": pa.array([pack(x) for *_, x in rows], pa.binary())})


# -- 2 longer phrases -------------------------------------------------------------------------

def _neighbours(at: bytes, id_: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The merge-join of a block's relation with itself: place, beginning and end of each longer phrase."""
    place, number = unpack_sorted(at), unpack(id_, np.int64)
    i = np.flatnonzero(place[1:] == place[:-1] + np.uint64(1))
    return place[i], number[i], number[i + 1]


def _ask(batches, buckets: int):
    for b in batches:
        for i in range(b.num_rows):
            _, x, y = _neighbours(b.column("at")[i].as_py(), b.column("id")[i].as_py())
            if not len(x):
                continue
            own = np.unique(np.concatenate([x, y]))
            pair, n = np.unique(np.searchsorted(own, x) * len(own) + np.searchsorted(own, y), return_counts=True)
            x, y = own[pair // len(own)], own[pair % len(own)]
            by = WD.mix64(WD.mix64(x.astype(np.uint64)) * _STEP + y.astype(np.uint64))
            for bucket, of in deal(by, buckets):
                of = np.sort(of)            # by beginning, then end
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([bucket], pa.int64()), "block": b.column("block").slice(i, 1),
                    "x": pa.array([pack_sorted(x[of].astype(np.uint64))], pa.binary()), "y": pa.array([pack(y[of])], pa.binary()),
                    "n": pa.array([pack(n[of].astype(np.int64))], pa.binary())})


def _count(table: pa.Table, least: int, answer: bool) -> pa.Table:
    """Kind 0: a bucket's frequent pairs, numbered.  Kind 1: to each block, the numbers of those it holds."""
    blocks = table.column("block").to_pylist()
    xs = [unpack_sorted(v.as_py()).astype(np.int64) for v in table.column("x")]
    x, y, n = (np.concatenate(v) for v in (xs, *([unpack(v.as_py(), np.int64) for v in table.column(c)] for c in ("y", "n"))))
    order = np.lexsort((y, x))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(x[order]) != 0) | (np.diff(y[order]) != 0)
    lo = np.flatnonzero(new)
    total = np.add.reduceat(n[order], lo)
    often = total >= least
    number = np.full(len(lo), -1)
    number[often] = (table.column("bucket")[0].as_py() << 32) + np.arange(int(often.sum()))
    first = order[lo[often]]
    k = len(first)
    out = [pa.table({"kind": np.zeros(k, np.int32), "block": pa.nulls(k, pa.int64()), "x": x[first], "y": y[first], "a": total[often],
                     "id": number[often], "xs": pa.nulls(k, pa.binary()), "ys": pa.nulls(k, pa.binary()), "ids": pa.nulls(k, pa.binary())})]
    if answer and k:
        of = np.empty(len(order), np.int64)
        of[order] = number[np.cumsum(new) - 1]
        at, rows = 0, []
        for block, v in zip(blocks, xs):
            mine = np.flatnonzero(of[at:at + len(v)] >= 0) + at
            at += len(v)
            if len(mine):
                rows.append((block, pack_sorted(x[mine].astype(np.uint64)), pack(y[mine]), pack(of[mine])))
        m = len(rows)
        none = pa.nulls(m, pa.int64())
        out.append(pa.table({"kind": np.ones(m, np.int32), "block": pa.array([r[0] for r in rows], pa.int64()), "x": none, "y": none, "a": none,
                             "id": none, **{c: pa.array([r[i] for r in rows], pa.binary()) for i, c in enumerate(("xs", "ys", "ids"), 1)}}))
    return pa.concat_tables(out)


def _counter(least: int, answer: bool):
    return lambda table: _count(table, least, answer)


def _extended(block: pa.Table, known: pa.Table) -> pa.Table:
    """The block's relation of longer phrases, the frequent ones alone."""
    if not block.num_rows or not known.num_rows:
        return _rows([])
    place, x, y = _neighbours(block.column("at")[0].as_py(), block.column("id")[0].as_py())
    kx = np.concatenate([unpack_sorted(v.as_py()).astype(np.int64) for v in known.column("xs")])
    ky, id_ = (np.concatenate([unpack(v.as_py(), np.int64) for v in known.column(c)]) for c in ("ys", "ids"))
    own = np.unique(np.concatenate([x, y]))
    key = np.searchsorted(own, kx) * len(own) + np.searchsorted(own, ky)
    order = np.argsort(key)
    key = key[order]
    pair = np.searchsorted(own, x) * len(own) + np.searchsorted(own, y)
    near = np.minimum(np.searchsorted(key, pair), len(key) - 1)
    some = key[near] == pair
    return _rows([(block.column("block")[0].as_py(), place[some], id_[order[near[some]]])])


def _described(pairs: DataFrame, shorter: DataFrame, scratch: Scratch) -> DataFrame:
    """Pairs with their language, words and the counts of all their beginnings and ends."""
    def side(name: str, *cols: str) -> DataFrame:
        n = pairs.groupBy(name).agg(F.count(F.lit(1)).alias(f"n_{name}")).withColumnRenamed(name, "id")
        return scratch.write(shorter.join(n, "id").select(F.col("id").alias(name), f"n_{name}", *cols))

    begun = lookup_join(pairs, side("x", "lang", "phrase", "heads"), ["x"], "n_x")
    return lookup_join(begun, side("y", "last", "tails"), ["y"], "n_y").select(
        "id", "lang", F.concat_ws(" ", "phrase", "last").alias("phrase"), "last", "a", "x", "y",
        F.concat("heads", F.array("a")).alias("heads"), F.concat("tails", F.array("a")).alias("tails"))


# -- 3 scores -----------------------------------------------------------------------------------

def score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (left right)), exactly."""
    big = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", big(a * 1000) * big(n), big(left) * big(right))


def mine(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST,
         top: int | None = TOP) -> DataFrame:
    """Each language's best phrases: lang, rank (from 1), phrase, a, l, r, n and score; ``top`` None means all.

    Phrases have 2 to ``longest`` words and ``least`` occurrences (a); l and r
    count the parts of the cut that scores lowest, n the language's words.
    """
    spark = df.sparkSession
    ship(spark)
    scratch = Scratch(spark, "phrases")
    base = scratch.write(df.select(F.coalesce(col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), col(text_col).alias("text")).mapInArrow(
        _relate, _BASE), ["kind"], compression="zstd")
    blocks, held = base.where("kind = 0").select("block", "at", "code"), base.where("kind = 1")
    buckets = (base.where("kind = 0").agg(F.sum("n")).first()[0] or 0) // BUCKET + 1
    total = scratch.write(held.groupBy("lang").agg(F.sum("n").alias("n")))
    shares = (held.agg(F.sum(F.size("number"))).first()[0] or 0) // BUCKET + 1
    offered = held.select("block", "lang", "number", "word", "ns").mapInArrow(
        lambda x: _offer(x, shares), "bucket long, block long, lang string, number array<int>, word array<string>, ns array<long>")
    words = scratch.write(offered.groupBy("bucket").applyInArrow(
        _word_counter(least), "kind int, lang string, word string, a long, id long, block long, number array<int>, ids array<long>"),
        ["kind"], compression="zstd")
    known, numbers = words.where("kind = 0"), words.where("kind = 1").select(F.col("block").alias("of"), "number", "ids")
    drop_path(spark, f"{base._eav_path}/kind=1")
    now = scratch.write(blocks.groupBy("block").cogroup(numbers.groupBy("of")).applyInArrow(_numbered, _RELATION))
    scratch.drop(base)
    drop_path(spark, f"{words._eav_path}/kind=1")
    phrases = known.select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "a",
                           F.array("a").alias("heads"), F.array("a").alias("tails"))
    found = []
    for k in range(2, longest + 1):
        answer = k < longest
        asked = now.mapInArrow(lambda x: _ask(x, buckets), "bucket long, block long, x binary, y binary, n binary")
        counted = scratch.write(asked.groupBy("bucket").applyInArrow(
            _counter(least, answer),
            "kind int, block long, x long, y long, a long, id long, xs binary, ys binary, ids binary"), ["kind"])
        pairs = counted.where("kind = 0").select("x", "y", "a", "id")
        longer = scratch.write(_described(pairs, phrases, scratch))
        if found:       # phrases with a longer one at all their places
            within = pairs.select(F.col("x").alias("id"), "a").union(pairs.select(F.col("y").alias("id"), "a")).distinct()
            found[-1] = found[-1].join(within, ["id", "a"], "left_anti")
        found.append(longer)
        phrases = longer
        if answer:
            old, known = now, counted.where("kind = 1").select(F.col("block").alias("of"), "xs", "ys", "ids")
            now = scratch.write(now.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(_extended, _RELATION))
            scratch.drop(old)
    every = found[0]
    for x in found[1:]:
        every = every.unionByName(x)
    every = scratch.write(every.select("lang", "phrase", "a", "heads", "tails"))
    weights = every.groupBy("lang").agg(F.count(F.lit(1)).alias("k"))
    total = scratch.write(total.join(weights, "lang"))
    cuts = F.transform(F.sequence(F.lit(1), F.size("heads") - 1), lambda i: F.struct(
        score(F.col("a"), F.col("n"), F.get("heads", i - 1), F.get("tails", F.size("heads") - i - 1)).alias("score"),
        i.alias("cut"), F.get("heads", i - 1).alias("l"), F.get("tails", F.size("heads") - i - 1).alias("r")))
    scored = scratch.write(lookup_join(every, total, ["lang"], "k").select(
        "lang", "phrase", "a", F.array_min(cuts).alias("c"), "n").select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of ever larger shares, so that no language is ranked in one task as a whole
    shares = scored.count() // (64 * (top or 1 << 62)) + 1
    while shares > 1:
        w = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(shares))).orderBy(*order)
        scored = scored.withColumn("_e_rank", F.row_number().over(w)).where(F.col("_e_rank") <= top).drop("_e_rank")
        shares //= 16
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    out = scored.withColumn("rank", rank)
    return (out if top is None else out.where(F.col("rank") <= top)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
