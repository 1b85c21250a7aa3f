"""Substring dedup: repeated-phrase automata.

A window is ``WINDOW`` consecutive words of one document.  A word goes if a
window that covers it also starts in a document with a smaller id; what stays
is joined by single spaces.

1. *Candidates.*  Texts become blocks of at most ``BLOCK`` bytes.  A window's
   anchor is the smallest hash of its ``GRAM``-word runs, so equal windows have
   equal anchors and neighbours mostly share one.  Blocks ask whether another
   document has their distinct anchors; windows of other anchors occur once.
2. *Confirmation.*  Candidate windows meet by hash: of each the smallest id and
   its place are found.  Requests are dealt out by hash, summed up per block,
   so a window that a third of all documents hold is one entry per block.
   Windows side by side in a block whose first occurrences lie side by side
   too make one passage, cut where the first place is a multiple of ``CELL``, so
   near copies of a text mostly ask for the same passages.  Their words are read
   from the document they first stand in, once however many blocks ask.
3. *Location.*  Each block's passages are its shard of the phrase automaton
   (Aho-Corasick, of at most ``SHARD`` characters at a time), and all of its
   documents run through it.  An occurrence counts where the passage comes from
   a smaller id.  So words decide what goes, hashes only what is looked for: two
   windows whose 64-bit hashes meet by chance (2**-64 a pair) could only
   hide a repetition.

Defined cases: null text has no words and becomes empty text, as one shorter
than a window stays as it is but for its white space; null ids come after all
others and are never smaller than one another; rows with the same id take
nothing from each other; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from eavflow.llm import words as WD
from eavflow.llm.common import Scratch, arrow_cast, col, lookup_join, nullable, ship, without
from eavflow.llm.katz import deal, pack, pack_sorted, unpack, unpack_sorted

WINDOW, GRAM, BLOCK, BUCKET, SHARD, CELL = 13, 6, 1 << 21, 1 << 20, 1 << 20, 64
LAST = np.iinfo(np.int64).max       # a null id
RUNS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
RESULT = ("n_words", "n_removed", "removed")
_STEP = np.uint64(0x9E3779B97F4A7C15)


# -- blocks ----------------------------------------------------------------------------

def normalised(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts with one space between words: (bytes, size of each text, number of words of each text)."""
    starts, ends, n = WD.spans(buf, offs)
    keep = ~WD.SPACE[buf]
    last = np.cumsum(n) - 1
    inner = np.ones(len(ends), bool)
    inner[last[n > 0]] = False
    keep[ends[inner]] = True
    out = np.where(WD.SPACE[buf], np.uint8(32), buf)[keep]
    return out, np.diff(np.concatenate([[0], np.cumsum(keep)])[offs]), n


def _make_blocks(batches, payload):
    base, made = TaskContext.get().partitionId() << 32, 0
    ids, texts, sizes, rows, words, held = [], [], [], [], 0, 0

    def flush():
        df = pa.concat_arrays(rows)
        text = b"".join(texts)
        return pa.RecordBatch.from_arrays(
            [pa.array([base + made]), pa.ListArray.from_arrays(pa.array([0, len(df)], pa.int32()), df),
             pa.array([pack(np.concatenate(ids))], pa.binary()), pa.array([pack(np.concatenate(sizes))], pa.binary()),
             pa.array([len(text).to_bytes(8, "little") + pa.compress(text, "zstd", asbytes=True)], pa.binary()),
             pa.array([words])], ["block", "rows", "ids", "sizes", "text", "n_words"])

    for b in batches:
        buf, offs = WD.as_bytes(b.column("text"))
        id_ = b.column("_e_id").fill_null(LAST).to_numpy()
        for lo, hi, part, o in WD.pieces(buf, offs, BLOCK // 4):
            if held and held + len(part) > BLOCK:
                yield flush()
                ids, texts, sizes, rows, words, held, made = [], [], [], [], 0, 0, made + 1
            text, size, n = normalised(part, o)
            ids.append(id_[lo:hi].astype(np.int64))
            texts.append(text.tobytes())
            sizes.append(size.astype(np.int64))
            rows.append(arrow_cast(b.column("_e_df").slice(lo, hi - lo), payload))
            words, held = words + int(n.sum()), held + len(part)
    if rows:
        yield flush()


class Block:
    """A block's documents: ids, normalised bytes, and its words numbered from 0."""

    def __init__(self, ids: bytes, sizes: bytes, text: bytes):
        self.ids = unpack(ids, np.int64)
        self.offs = np.concatenate([[0], np.cumsum(unpack(sizes, np.int64))]).astype(np.int64)
        self.raw = pa.decompress(text[8:], int.from_bytes(text[:8], "little"), "zstd", asbytes=True)
        self.buf = np.frombuffer(self.raw, np.uint8)
        self.starts, self.ends, self.n = WD.spans(self.buf, self.offs)
        self.doc = np.repeat(np.arange(len(self.n)), self.n)

    def windows(self, size: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First words of all windows, their anchors and their hashes."""
        runs, n = {1: WD.keys(self.buf, self.starts, self.ends, lower=False)}, len(self.starts)

        def run(k: int) -> np.ndarray:
            """Hashes of the runs of ``k`` words from each word on, put together from halves."""
            if k not in runs:
                a, b = run(k - k // 2), run(k // 2)
                to = max(0, n - k + 1)
                runs[k] = WD.mix64(a[:to] * _STEP + b[k - k // 2:k - k // 2 + to])
            return runs[k]

        to = max(0, n - size + 1)
        first = np.flatnonzero(self.doc[:to] == self.doc[size - 1:size - 1 + to])
        least, width, reach = run(gram), 1, size - gram + 1
        while width < reach:                # the smallest of ``reach`` neighbours, by doubling
            step = min(width, reach - width)
            least = np.minimum(least[:len(least) - step], least[step:])
            width += step
        return first, least[first], run(size)[first]


def _each(batches, names):
    for b in batches:
        for i in range(b.num_rows):
            yield {n: b.column(n)[i].as_py() for n in names}


_TEXT = ("ids", "sizes", "text")


def _first(table: pa.Table) -> Block | None:
    return Block(*(table.column(c)[0].as_py() for c in _TEXT)) if table.num_rows else None


def _row(**columns) -> pa.RecordBatch:
    """One row; ints as longs, the rest as binary."""
    return pa.RecordBatch.from_pydict({k: pa.array([v], pa.int64() if isinstance(v, int) else pa.binary()) for k, v in columns.items()})


# -- 1 candidates -------------------------------------------------------------------------

def _ask_anchors(batches, size: int, gram: int, buckets: int):
    for row in _each(batches, ("block", *_TEXT)):
        b = Block(*(row[c] for c in _TEXT))
        first, anchor, _ = b.windows(size, gram)
        order = np.lexsort((first, anchor))
        doc, a = b.doc[first[order]], anchor[order]
        at = np.flatnonzero(np.diff(a, prepend=~a[:1]) != 0)
        if not len(at):
            continue
        many = np.minimum.reduceat(doc, at) < np.maximum.reduceat(doc, at)
        a = a[at]
        for bucket, of in deal(a, buckets):
            yield _row(bucket=bucket, block=row["block"], keys=pack_sorted(a[of]), many=np.packbits(many[of]).tobytes())


def _shared_anchors(table: pa.Table) -> pa.Table:
    parts = [unpack_sorted(x.as_py()) for x in table.column("keys")]
    many = [np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=len(p)).astype(bool) for x, p in zip(table.column("many"), parts)]
    keys, of, n = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    shared = n > 1
    shared[of[np.concatenate(many)]] = True
    out, lo = [], 0
    for block, p in zip(table.column("block").to_pylist(), parts):
        some = p[shared[of[lo:lo + len(p)]]]
        lo += len(p)
        if len(some):
            out.append((block, pack_sorted(some)))
    return pa.table({"block": pa.array([x for x, _ in out], pa.int64()), "keys": pa.array([x for _, x in out], pa.binary())})


# -- 2 confirmation -------------------------------------------------------------------------

def _ask_windows(base: pa.Table, answers: pa.Table, size: int, gram: int, buckets: int) -> pa.Table:
    names = {"bucket": pa.int64(), "block": pa.int64(), "keys": pa.binary(), "ids": pa.binary(), "more": pa.binary(),
             "at": pa.binary()}
    b, out = _first(base), []
    if b is not None and answers.num_rows:
        block = base.column("block")[0].as_py()
        shared = np.sort(np.concatenate([unpack_sorted(x.as_py()) for x in answers.column("keys")]))
        first, anchor, key = b.windows(size, gram)
        near = np.minimum(np.searchsorted(shared, anchor), len(shared) - 1)
        some = shared[near] == anchor
        first, key = first[some], key[some]
        id_ = b.ids[b.doc[first]]
        order = np.lexsort((first, id_, key))
        first, key, id_ = first[order], key[order], id_[order]
        lo = np.flatnonzero(np.diff(key, prepend=~key[:1]) != 0)
        hi = np.append(lo[1:], len(key)) - 1
        key, least, most, at = key[lo], id_[lo], id_[hi], first[lo]
        for bucket, of in deal(key, buckets):
            out.append((bucket, block, pack_sorted(key[of]), pack(least[of]), pack(most[of] - least[of]), pack(at[of])))
    return pa.table({n: pa.array([x[i] for x in out], t) for i, (n, t) in enumerate(names.items())})


def _owners(table: pa.Table) -> pa.Table:
    """To each block: those of its windows that a smaller id holds, with the id, block and place of their first occurrence."""
    blocks = table.column("block").to_numpy()
    parts = [unpack_sorted(x.as_py()) for x in table.column("keys")]
    of = np.repeat(np.arange(len(parts)), np.fromiter(map(len, parts), np.int64, len(parts)))
    key = np.concatenate(parts)
    least, more, at = (np.concatenate([unpack(x.as_py(), np.int64) for x in table.column(c)]) for c in ("ids", "more", "at"))
    order = np.lexsort((at, blocks[of], least, key))
    new = np.diff(key[order], prepend=~key[order[:1]]) != 0
    owner = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    later = least[owner] < least[order] + more[order]
    asked, owner = order[later], owner[later]
    by = np.argsort(of[asked], kind="stable")           # by block, then key
    asked, owner = asked[by], owner[by]
    cuts = np.flatnonzero(np.diff(of[asked], prepend=-1))
    out = []
    for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(asked)]):
        o = owner[lo:hi]
        out.append((int(blocks[of[asked[lo]]]), pack_sorted(key[asked[lo:hi]]), pack(least[o]), pack(blocks[of[o]]), pack(at[o])))
    return pa.table({"block": pa.array([x[0] for x in out], pa.int64()), **{
        n: pa.array([x[i] for x in out], pa.binary()) for i, n in enumerate(("keys", "ids", "from_block", "from_at"), 1)}})


def _passages(base: pa.Table, answers: pa.Table, size: int, gram: int) -> pa.Table:
    """Runs of the block's windows whose first occurrences are a run too: (from_block, from_at, words, block), each once."""
    none = np.zeros(0, np.int64)
    block, at, n, own = none, none, none, 0
    b = _first(base)
    if b is not None and answers.num_rows:
        own = base.column("block")[0].as_py()
        known = np.concatenate([unpack_sorted(x.as_py()) for x in answers.column("keys")])
        ids, blocks, places = (np.concatenate([unpack(x.as_py(), np.int64) for x in answers.column(c)]) for c in ("ids", "from_block", "from_at"))
        order = np.argsort(known)
        known = known[order]
        first, _, key = b.windows(size, gram)
        near = np.minimum(np.searchsorted(known, key), len(known) - 1)
        to = order[near]
        some = (known[near] == key) & (ids[to] < b.ids[b.doc[first]])
        first, to = first[some], to[some]
        block, at = blocks[to], places[to]
        new = np.ones(len(first), bool)
        new[1:] = (first[1:] != first[:-1] + 1) | (block[1:] != block[:-1]) | (at[1:] != at[:-1] + 1) | (at[1:] % CELL == 0)
        lo = np.flatnonzero(new)
        n = np.diff(np.append(lo, len(first))) + size - 1
        block, at, n = np.unique(np.stack([block[lo], at[lo], n]), axis=1) if len(lo) else (none, none, none)
    return pa.table({"from_block": block, "from_at": at, "words": n, "block": np.full(len(at), own, np.int64)})


def _read_passages(base: pa.Table, asked: pa.Table) -> pa.Table:
    """The words of passages, and the id of the document they come from."""
    at, words = asked.column("from_at").to_numpy(), asked.column("words").to_numpy()
    ids, texts = np.zeros(0, np.int64), []
    if asked.num_rows:
        b = _first(base)
        ids = b.ids[b.doc[at]]
        texts = [b.raw[x:y] for x, y in zip(b.starts[at].tolist(), b.ends[at + words - 1].tolist())]
    return pa.table({"from_block": asked.column("from_block"), "from_at": asked.column("from_at"), "words": asked.column("words"),
                     "n": asked.column("n"), "id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.binary())})


# -- 3 location -----------------------------------------------------------------------------

def _shards(passages: dict[str, int]):
    """Automata over the passages, of about SHARD characters each: the length and id of a match are its value."""
    import ahocorasick
    held, made = 0, None
    for text, id_ in passages.items():
        made = made or ahocorasick.Automaton()
        made.add_word(text, (len(text), id_))
        held += len(text)
        if held >= SHARD:
            made.make_automaton()
            yield made
            held, made = 0, None
    if made:
        made.make_automaton()
        yield made


def located(texts: list[str], ids: list[int], passages: dict[str, int]) -> list[list[tuple[int, int]]]:
    """For each text the (first, end) characters that a passage of a smaller id covers, in order and apart.

    Texts and passages begin and end with a space, so matches begin and end with words.
    """
    found: list[list[tuple[int, int]]] = [[] for _ in texts]
    for shard in _shards(passages):
        for spans, text, own in zip(found, texts, ids):
            spans.extend((end + 1 - size, end + 1) for end, (size, id_) in shard.iter(text) if id_ < own)
    out = []
    for spans in found:
        spans.sort()
        apart: list[tuple[int, int]] = []
        for lo, hi in spans:
            if apart and lo < apart[-1][1]:         # the space between two words belongs to both
                apart[-1] = (apart[-1][0], max(hi, apart[-1][1]))
            else:
                apart.append((lo, hi))
        out.append(apart)
    return out


def _kept(text: str, spans: list[tuple[int, int]]) -> tuple[str, int, list[dict[str, int]]]:
    """What is left of a text with a space at both ends, the number of words removed, and their numbers as (first, end)."""
    left, removed, at, word, gone = [], [], 0, 0, 0
    for lo, hi in spans:
        # two runs may share the space between them
        before = text[at:lo].strip(" ")
        word += before.count(" ") + 1 if before else 0
        n = text.count(" ", lo, hi) - 1
        if removed and removed[-1]["end"] == word:
            removed[-1]["end"] = word + n
        else:
            removed.append({"first": word, "end": word + n})
        if before:
            left.append(before)
        word, gone, at = word + n, gone + n, hi - 1
    rest = text[at:].strip(" ")
    if rest:
        left.append(rest)
    return " ".join(left), gone, removed


def _locate(base: pa.Table, needed: pa.Table, schema: T.StructType) -> pa.Table:
    if not base.num_rows:
        return to_arrow_schema(schema).empty_table()
    b = _first(base)
    texts = [b.raw[lo:hi].decode() for lo, hi in itertools.pairwise(b.offs.tolist())]
    passages: dict[str, int] = {}
    for raw, id_ in zip(needed.column("text").to_pylist(), needed.column("id").to_pylist()):
        t = f" {raw.decode()} "
        passages[t] = min(id_, passages.get(t, id_))
    kept, gone, spans = texts, [0] * len(texts), [[]] * len(texts)
    if passages:
        wide = [f" {t} " for t in texts]
        kept, gone, spans = zip(*(_kept(t, s) for t, s in zip(wide, located(wide, b.ids.tolist(), passages))))
    rows = base.column("rows").combine_chunks().flatten()
    return pa.Table.from_arrays(
        [arrow_cast(rows, schema["_e_df"].dataType), pa.array(kept, pa.string()), pa.array(b.n, pa.int64()),
         pa.array(gone, pa.int64()), arrow_cast(pa.array(spans, RUNS), schema["removed"].dataType)], schema.names)


def substring_dedup(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", size: int = WINDOW,
                    keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``df``: the columns in ``keep`` (all), with the text that is left, n_words, n_removed and removed.

    ``removed`` lists the numbers (from 0) of the removed words as runs (first,
    end), ``n_words`` counts the words there were.  ``id_col`` holds integers.
    Columns named like a result are replaced.
    """
    if size <= 1:
        raise ValueError("a window has two words at least")
    spark, gram = df.sparkSession, min(GRAM, size - 1)
    ship(spark)
    scratch = Scratch(spark, "passages")
    own = [c for c in without(df, RESULT) if c != text_col and (keep is None or c in keep)]
    order = [c for c in without(df, RESULT) if c == text_col or c in own]
    rows = df.select(F.struct(F.lit(0).alias("_e_0"), *[col(c) for c in own]).alias("_e_df"), col(id_col).cast("long").alias("_e_id"),
                     col(text_col).alias("text"))
    payload = nullable(rows.schema["_e_df"].dataType)
    block = T.StructType([T.StructField("block", T.LongType()), T.StructField("rows", T.ArrayType(payload)),
                          *[T.StructField(c, T.BinaryType()) for c in _TEXT], T.StructField("n_words", T.LongType())])
    base = scratch.write(rows.mapInArrow(lambda batches: _make_blocks(batches, payload), block))
    buckets = (base.agg(F.sum("n_words")).first()[0] or 0) // BUCKET + 1
    texts = base.select("block", *_TEXT)
    asked = texts.mapInArrow(lambda x: _ask_anchors(x, size, gram, buckets), "bucket long, block long, keys binary, many binary")
    shared = scratch.write(asked.groupBy("bucket").applyInArrow(_shared_anchors, "block long, keys binary"))
    asked = texts.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(
        lambda x, y: _ask_windows(x, y, size, gram, buckets),
        "bucket long, block long, keys binary, ids binary, more binary, at binary")
    owned = scratch.write(asked.groupBy("bucket").applyInArrow(
        _owners, "block long, keys binary, ids binary, from_block binary, from_at binary"))
    scratch.drop(shared)
    wanted = scratch.write(texts.groupBy("block").cogroup(owned.groupBy("block")).applyInArrow(
        lambda x, y: _passages(x, y, size, gram), "from_block long, from_at long, words long, block long"))
    scratch.drop(owned)
    place = ["from_block", "from_at", "words"]
    each = wanted.groupBy(*place).agg(F.count(F.lit(1)).alias("n"))
    passages = scratch.write(
        texts.groupBy("block").cogroup(each.groupBy("from_block")).applyInArrow(
            _read_passages, "from_block long, from_at long, words long, n long, id long, text binary"), compression="zstd")
    needed = lookup_join(wanted, passages, place, "n").select("block", "id", "text")
    runs = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))
    out = T.StructType([T.StructField("_e_df", payload), T.StructField("text", T.StringType()), T.StructField("n_words", T.LongType()),
                        T.StructField("n_removed", T.LongType()), T.StructField("removed", runs)])
    done = base.drop("n_words").groupBy("block").cogroup(needed.groupBy("block")).applyInArrow(lambda x, y: _locate(x, y, out), out)
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col("_e_df").getField(c).alias(c) for c in order],
                       "n_words", "n_removed", "removed")
