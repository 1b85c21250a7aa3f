"""LM scoring: a Katz backoff bigram model with Good-Turing discounts, counted and evaluated in parallel.

    p(w | h) = d2(c(h w)) c(h w) / c(h)      if the pair was seen in training
             = alpha(h) p(w)                 otherwise (alpha = 1 for an unknown h)
    p(w)     = d1(c(w)) c(w) / N             if the word was seen
             = what is left                  for the class of all unknown words

Counts up to ``K`` get Katz's Good-Turing discount, larger ones give up
``TAIL`` of a count, so something is always left for unseen words, and
alpha(h) = left over by h / (1 - sum of p(w) over the words seen after h)
makes every history sum to one exactly.

Texts become blocks of at most ``BLOCK`` tokens: one row with the block's
distinct words (64-bit keys, see ``words``) and its tokens as numbers into
them.  A block asks for the counts of its distinct words and pairs; requests
are dealt out by a hash of the word or pair, already summed per block, so a
frequent word or pair is one entry per block wherever it goes.  The number of
buckets follows the data and bounds what one holds.  A bucket adds up, keeps
its share of the model as one row of the table (the key columns packed, sorted
by key) and answers.  Pairs are owned by the first block that asks, which adds
them to the sums of its history; alpha is a table of rows by history, and
the few tokens that back off are joined with it, frequent histories by
broadcast.  Nothing but count-of-counts reaches the driver.

Defined cases: null text is empty and has the end token alone; a null id is an
ordinary row; repeated rows count each time; without training texts every
probability is 1 (score 0); an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eavflow.llm import words as WD
from eavflow.llm.common import Scratch, arrow_cast, col, lookup_join, nullable, ship, without

K, TAIL, BLOCK, BUCKET = 5, 0.01, 1 << 20, 1 << 19
END, START = np.uint64(0x9D3F5C1B7A2E4680), np.uint64(0x5B1E93C7D0A8F246)
RESULT = ("n_tokens", "n_known", "train_tokens", "base_score", "score")


# -- packed columns ------------------------------------------------------------

def pack(a: np.ndarray) -> bytes:
    """64-bit values, byte plane by byte plane, compressed; sorted values go as differences."""
    raw = np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8).T).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack(b: bytes, kind=np.uint64) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    raw = pa.decompress(b[8:], n, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).reshape(-1).view(kind)


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a, prepend=np.uint64(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b), dtype=np.uint64)


# -- blocks --------------------------------------------------------------------

@dataclass
class Block:
    vocab: np.ndarray       # sorted keys of the distinct words
    tokens: np.ndarray      # numbers into vocab, every text's end included
    size: np.ndarray        # tokens of each text
    train: np.ndarray       # by text

    def __post_init__(self):
        n = len(self.vocab)
        self.doc = np.repeat(np.arange(len(self.size)), self.size)
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[np.cumsum(self.size) - self.size] = n        # n stands for the start
        pair, self.pair_of = np.unique(before * np.int64(n + 1) + self.tokens, return_inverse=True)
        self.h, self.w = pair // (n + 1), pair % (n + 1)
        known = np.append(self.vocab, START)
        self.pair_key = WD.mix64(known[self.h] * np.uint64(0x9E3779B97F4A7C15) + self.vocab[self.w])
        self.counted = self.train[self.doc]

    def requests(self, pairs: bool) -> tuple[np.ndarray, np.ndarray]:
        """Keys, and their counts in the block's training texts."""
        if pairs:
            return self.pair_key, np.bincount(self.pair_of[self.counted], minlength=len(self.pair_key))
        return self.vocab, np.bincount(self.tokens[self.counted], minlength=len(self.vocab))


def deal(keys: np.ndarray, buckets: int):
    """For each bucket that has keys: (bucket, places of its keys, by key)."""
    b = keys % np.uint64(buckets)
    order = np.lexsort((keys, b))
    cuts = np.flatnonzero(np.diff(b[order], prepend=np.uint64(buckets)))
    for lo, hi in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
        yield int(b[order[lo]]), order[lo:hi]


def _tokens(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, n = WD.spans(buf, offs)
    out = np.full(len(starts) + len(n), END, np.uint64)
    out[np.arange(len(starts)) + np.repeat(np.arange(len(n)), n)] = WD.keys(buf, starts, ends)
    return out, n + 1


def _make_blocks(batches, payload):
    base, made = TaskContext.get().partitionId() << 33, 0
    keys, size, train, rows, held = [], [], [], [], 0

    def flush():
        vocab, tokens = np.unique(np.concatenate(keys), return_inverse=True)
        df = pa.concat_arrays(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([base + made]), pa.ListArray.from_arrays(pa.array([0, len(df)], pa.int32()), df),
             pa.array([pack_sorted(vocab)], pa.binary()), pa.array([pack(tokens.astype(np.int64))], pa.binary()),
             pa.array([pack(np.concatenate(size))], pa.binary()),
             pa.array([np.concatenate(train).astype(np.uint8).tobytes()], pa.binary()),
             pa.array([len(vocab)]), pa.array([len(tokens)])],
            ["block", "rows", "vocab", "tokens", "size", "train", "n_vocab", "n_tokens"])

    for b in batches:
        buf, offs = WD.as_bytes(b.column("text"))
        flag = b.column("train").to_numpy(zero_copy_only=False).astype(bool)
        for lo, hi, block, o in WD.pieces(buf, offs):
            k, n = _tokens(block, o)
            if held and held + len(k) > BLOCK:
                yield flush()
                keys, size, train, rows, held, made = [], [], [], [], 0, made + 1
            keys.append(k)
            size.append(n)
            train.append(flag[lo:hi])
            rows.append(arrow_cast(b.column("_e_df").slice(lo, hi - lo), payload))
            held += len(k)
    if held:
        yield flush()


def _read_block(row: dict) -> Block:
    return Block(unpack_sorted(row["vocab"]), unpack(row["tokens"], np.int64), unpack(row["size"], np.int64),
                 np.frombuffer(row["train"], np.uint8).astype(bool))


def _each(batches, names):
    for b in batches:
        for i in range(b.num_rows):
            yield {n: b.column(n)[i].as_py() for n in names}


_BLOCK_COLS = ("block", "vocab", "tokens", "size", "train")


def _count(blocks: DataFrame, pairs: bool, buckets: int) -> DataFrame:
    """Rows of kind 0 (a bucket's keys and counts: the model) and 1 (answers to a block)."""
    def ask(batches):
        for row in _each(batches, _BLOCK_COLS):
            keys, n = _read_block(row).requests(pairs)
            for bucket, at in deal(keys, buckets):
                yield pa.RecordBatch.from_pydict({
                    "bucket": pa.array([bucket], pa.int64()), "block": pa.array([row["block"]], pa.int64()),
                    "keys": pa.array([pack_sorted(keys[at])], pa.binary()),
                    "n": pa.array([pack(n[at].astype(np.int64))], pa.binary())})

    def add(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("block").to_numpy(), kind="stable").tolist()
        blocks_, parts, ns = [], [], []
        for i in order:
            blocks_.append(table.column("block")[i].as_py())
            parts.append(unpack_sorted(table.column("keys")[i].as_py()))
            ns.append(unpack(table.column("n")[i].as_py(), np.int64))
        keys, first, at = np.unique(np.concatenate(parts), return_index=True, return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, at, np.concatenate(ns))
        answer = total[at] * 2
        answer[first] += 1                  # the first to ask owns the key
        cuts = np.cumsum([0] + [len(p) for p in parts])
        seen = total > 0
        n = len(parts)
        bucket = [table.column("bucket")[0].as_py()] * (n + 1)
        return pa.Table.from_pydict({
            "kind": pa.array([0] + [1] * n, pa.int32()), "bucket": pa.array(bucket, pa.int64()),
            "block": pa.array([None, *blocks_], pa.int64()),
            "keys": pa.array([pack_sorted(keys[seen])] + [None] * n, pa.binary()),
            "n": pa.array([pack(total[seen])] + [pack(answer[a:b]) for a, b in zip(cuts, cuts[1:])], pa.binary())})

    return (blocks.select(*_BLOCK_COLS).mapInArrow(ask, "bucket long, block long, keys binary, n binary")
            .groupBy("bucket").applyInArrow(add, "kind int, bucket long, block long, keys binary, n binary"))


# -- discounts -----------------------------------------------------------------

@dataclass
class Discount:
    """d(r) r for a count r: what is left of it."""

    small: np.ndarray       # d(r) r for r = 0 .. K

    def __call__(self, r: np.ndarray) -> np.ndarray:
        return np.where(r <= K, self.small[np.minimum(r, K)], r - TAIL)


def good_turing(n: list[int]) -> Discount:
    """From n[r] keys of count r, r = 1 .. K + 1 (n[0] is not used)."""
    out = np.zeros(K + 1)
    share = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
    absolute = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.5
    for r in range(1, K + 1):
        d = 0.0
        if n[r] and share < 1:
            d = ((r + 1) * n[r + 1] / (r * n[r]) - share) / (1 - share)
        if not 0 < d < 1:       # counts too few or uneven for Good-Turing: absolute discounting
            d = (r - min(max(absolute, TAIL), 0.99)) / r
        out[r] = d * r
    return Discount(out)


def _stats(model: DataFrame) -> tuple[list[int], int, int]:
    """Keys of each count 1 .. K + 1, sum of counts, distinct keys."""
    def of(batches):
        n, total, keys = np.zeros(K + 2, np.int64), 0, 0
        for row in _each(batches, ("n",)):
            c = unpack(row["n"], np.int64)
            n += np.bincount(c[c <= K + 1], minlength=K + 2)
            total, keys = total + int(c.sum()), keys + len(c)
        yield pa.RecordBatch.from_pydict({"r": pa.array([*range(K + 2), -1, -2], pa.int32()), "n": pa.array([*n.tolist(), total, keys])})
    got = {r["r"]: r["n"] for r in model.where("kind = 0").select("n").mapInArrow(of, "r int, n long")
           .groupBy("r").agg(F.sum("n").alias("n")).collect()}
    return [got.get(r, 0) for r in range(K + 2)], got.get(-1, 0), got.get(-2, 0)


@dataclass
class Unigram:
    discount: Discount
    total: int
    distinct: int
    left: float             # the probability of all unknown words

    def p(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.discount(c) / max(self.total, 1), self.left)


# -- the model and its scores --------------------------------------------------

def score(df: DataFrame, train: Column, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``df``: the columns in ``keep`` (all but the text), n_tokens, n_known, train_tokens, base_score, score.

    Texts with ``train`` true are learned.  ``score`` is the model's log10
    probability of the text, ``base_score`` that of add-one unigrams.  Columns
    named like a result are replaced.
    """
    ship(df.sparkSession)
    scratch = Scratch(df.sparkSession, "katz")
    own = [c for c in without(df, RESULT) if (keep is None and c != text_col) or (keep is not None and c in keep)]
    rows = df.select(F.struct(*[col(c) for c in own]).alias("_e_df"), col(text_col).alias("text"),
                     F.coalesce(train, F.lit(False)).alias("train"))
    payload = nullable(rows.schema["_e_df"].dataType)
    long, binary = T.LongType(), T.BinaryType()
    schema = T.StructType([T.StructField("block", long), T.StructField("rows", T.ArrayType(payload))]
                          + [T.StructField(n, binary) for n in ("vocab", "tokens", "size", "train")]
                          + [T.StructField("n_vocab", long), T.StructField("n_tokens", long)])
    blocks = scratch.write(rows.mapInArrow(lambda batches: _make_blocks(batches, payload), schema))
    size = blocks.agg(F.sum("n_vocab"), F.sum("n_tokens")).first()
    per = [max(1, -(-(s or 0) // BUCKET)) for s in size]
    words = scratch.write(_count(blocks, False, per[0]), ["kind"])
    pairs = scratch.write(_count(blocks, True, per[1]), ["kind"])
    n1, total, distinct = _stats(words)
    n2, _, _ = _stats(pairs)
    d1, d2 = good_turing(n1), good_turing(n2)
    # what is left of all counts, from the counts of counts
    kept = float(sum(n1[r] * d1.small[r] for r in range(1, K + 1)))
    above = total - sum(r * n1[r] for r in range(1, K + 1)) - TAIL * (distinct - sum(n1[1:K + 1]))
    uni = Unigram(d1, total, distinct, 1 - (kept + above) / total if total else 1.0)

    answers = (words.where("kind = 1").select("block", F.lit(0).alias("what"), "bucket", "n")
               .unionByName(pairs.where("kind = 1").select("block", F.lit(1).alias("what"), "bucket", "n"))
               .groupBy("block").agg(F.collect_list(F.struct("what", "bucket", "n")).alias("answers")))
    asked, alphas = per, per[0]

    def answered(block: Block, got: list, what: int) -> tuple[np.ndarray, np.ndarray]:
        keys = block.requests(bool(what))[0]
        out = np.zeros(len(keys), np.int64)
        by = {g["bucket"]: g["n"] for g in got if g["what"] == what}
        for bucket, at in deal(keys, asked[what]):
            out[at] = unpack(by[bucket], np.int64)
        return out >> 1, (out & 1).astype(bool)

    piece = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("block", long), T.StructField("doc", long),
                          T.StructField("_e_df", payload), T.StructField("n_tokens", long), T.StructField("n_known", long),
                          T.StructField("base", T.DoubleType()), T.StructField("score", T.DoubleType()),
                          T.StructField("h", long), T.StructField("times", long), T.StructField("sums", binary)])
    arrow = {f.name: None for f in piece}

    def emit(kind: int, n: int, have: dict, df_type) -> pa.RecordBatch:
        types = {"kind": pa.int32(), "_e_df": df_type, "base": pa.float64(), "score": pa.float64(), "sums": pa.binary()}
        have = {"kind": pa.array([kind] * n, pa.int32()), **have}
        return pa.RecordBatch.from_arrays([have[c] if c in have else pa.nulls(n, types.get(c, pa.int64())) for c in arrow], list(arrow))

    def evaluate(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = {c: b.column(c)[i].as_py() for c in (*_BLOCK_COLS, "answers")}
                block = _read_block(row)
                rows_ = b.column("rows")[i].values
                c1, _ = answered(block, row["answers"], 0)
                c2, owner = answered(block, row["answers"], 1)
                docs = len(block.size)
                p1 = uni.p(c1)
                end = np.searchsorted(block.vocab, END)
                before = np.append(c1, c1[end])             # a history's count; the start has one per text
                seen = c2 > 0
                lp = np.log10(np.where(seen, d2(c2) / np.maximum(before[block.h], 1), p1[block.w]))
                add = lambda x: np.bincount(block.doc, x, minlength=docs)
                base = add(np.log10(c1 + 1.0)[block.tokens]) - block.size * np.log10(uni.total + uni.distinct + 1)
                yield emit(0, docs, {
                    "block": pa.array([row["block"]] * docs), "doc": pa.array(np.arange(docs)), "_e_df": rows_,
                    "n_tokens": pa.array(block.size), "n_known": pa.array(add((c1 > 0)[block.tokens]).astype(np.int64)),
                    "base": pa.array(base), "score": pa.array(add(lp[block.pair_of]))}, rows_.type)
                names = np.append(block.vocab, START)
                # tokens that back off from a known history
                off = ~seen[block.pair_of] & (before[block.h] > 0)[block.pair_of]
                code, times = np.unique(block.doc[off] * np.int64(len(names)) + block.h[block.pair_of[off]], return_counts=True)
                n = len(code)
                yield emit(1, n, {
                    "block": pa.array([row["block"]] * n, pa.int64()), "doc": pa.array(code // len(names)),
                    "h": pa.array(names[code % len(names)].view(np.int64)), "times": pa.array(times)}, rows_.type)
                mine = owner & seen
                each = [np.bincount(block.h[mine], x, minlength=len(names))
                        for x in (c2[mine], c2[mine] - d2(c2[mine]), p1[block.w[mine]])]
                some = np.flatnonzero(each[0])
                for bucket, at in deal(names[some], alphas):
                    at = some[at]
                    sums = b"".join(len(p).to_bytes(8, "little") + p for p in
                                    (pack_sorted(names[at]), *(pack(x[at].astype(np.float64)) for x in each)))
                    yield emit(2, 1, {"h": pa.array([bucket]), "sums": pa.array([sums], pa.binary())}, rows_.type)

    def backoff(table: pa.Table) -> pa.Table:
        """alpha of every history of the bucket."""
        parts = [[], [], [], []]
        for s in sorted(table.column("sums").to_pylist()):
            for k in range(4):
                size_ = int.from_bytes(s[:8], "little")
                parts[k].append(unpack_sorted(s[8:8 + size_]) if k == 0 else unpack(s[8:8 + size_], np.float64))
                s = s[8 + size_:]
        keys, at = np.unique(np.concatenate(parts[0]), return_inverse=True)
        n, left, below = (np.bincount(at, np.concatenate(p)) for p in parts[1:])
        return pa.Table.from_pydict({"h": keys.view(np.int64), "n": n.astype(np.int64),
                                     "log_alpha": np.log10(left / n) - np.log10(np.maximum(1 - below, uni.left))})

    out = scratch.write(blocks.select("rows", *_BLOCK_COLS).join(answers, "block").mapInArrow(evaluate, piece), ["kind"])
    table = scratch.write(out.where("kind = 2").select(F.col("h").alias("bucket"), "sums").groupBy("bucket")
                          .applyInArrow(backoff, "h long, n long, log_alpha double"))
    more = (lookup_join(out.where("kind = 1").select("block", "doc", "h", "times"), table, ["h"], "n")
            .groupBy("block", "doc").agg(F.sum(F.col("times") * F.col("log_alpha")).alias("more")))
    done = out.where("kind = 0").select("block", "doc", "_e_df", "n_tokens", "n_known", "base", "score").join(more, ["block", "doc"], "left")
    return done.select(*[F.col("_e_df").getField(c).alias(c) for c in own], "n_tokens", "n_known",
                       F.lit(total).cast("long").alias("train_tokens"), F.col("base").alias("base_score"),
                       (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"))
