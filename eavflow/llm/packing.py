"""Best-fit packing of tokenised documents by hierarchical residual packing.

Documents are tokenised and cut into pieces of at most one sequence.  Every
task packs its pieces best-fit decreasing, a bounded chunk at a time, and emits
the bins that are full or nearly so.  What is left open goes up a tree: groups
of ``FAN_IN`` chunks pack their open bins again, as items, best-fit decreasing,
round after round until one group is left.

After a round no two bins of a group fit together, so at most one is half empty
or more; as only such bins can move into others, a group hands on its emptiest
``FAN_IN`` bins besides it, room enough for every bin that can still move, and
a merge holds at most FAN_IN * (FAN_IN + 1) bins whatever the input.

Tokens: white space never lies inside a token, so words are encoded once and
looked up afterwards; a worker keeps about ``KNOWN`` words.  Where the tokenizer
is known to lower words and to cut them between letters and marks, this is done
before, as far fewer parts than words are different.

Defined cases: null text is empty and has the end token alone; repeated rows
are packed one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eavflow.llm import words as WD
from eavflow.llm.common import Scratch, arrow_cast, col, freeing, nullable, ship, without

SEQUENCE, END_ID, FAN_IN, SLACK, CHUNK, KNOWN, BYTES = 2048, 0, 8, 8, 100_000, 400_000, 1 << 22
PIECE = ("piece", "start", "length", "ids")
RESULT = ("sequence_id", "offset")
#: Tokenizers like this see lower case alone, and no token lies over the border of a letter and a mark (``_parts``).
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")     # small letters to U+00FF
KIND = np.array([1 if chr(i).isalpha() else 2 if chr(i) in string.punctuation.replace("'", "") else 0 for i in range(128)] + [0] * 128, np.uint8)
LOWER = bytes(WD.LOWER)
_WORKER: dict = {}      # per worker process: path, tokenizer, its added tokens, whether words are cut, ids by word (young and old)


def tokenizer(path: str):
    from tokenizers import Tokenizer, pre_tokenizers
    if _WORKER.get("path") != path:
        tok = Tokenizer.from_file(path)
        spec = json.loads(tok.to_str())
        plain = Tokenizer.from_file(path)
        plain.normalizer = None
        plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        special = [t["content"].encode().translate(LOWER) for t in spec["added_tokens"]]
        _WORKER.update(path=path, tokenizer=tok, plain=plain, young={}, old={}, special=special,
                       parts=(spec["normalizer"], spec["pre_tokenizer"]) == (NORMALIZER, SPLIT))
    return _WORKER["tokenizer"]


def _encode(part: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The words' ids, and where each word's begin."""
    e = _WORKER["tokenizer"].encode(" ".join(part), add_special_tokens=False)
    starts = np.cumsum([0] + [len(w) + 1 for w in part])[:-1]
    return np.array(e.ids, "<u4"), np.searchsorted(np.fromiter((o[0] for o in e.offsets), np.int64, len(e.ids)), starts)


def _encode_plain(part: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The same for words of small letters, which normalizer and pattern leave whole."""
    e = _WORKER["plain"].encode(" ".join(part), add_special_tokens=False)
    return np.array(e.ids, "<u4"), np.searchsorted(np.array(e.word_ids, np.int64), np.arange(len(part)))


def _learn(words: list[bytes], path: str) -> list[bytes]:
    """Little-endian 32-bit ids of each word, encoding those not known yet as one line each some thousands.

    Known words come in two generations: when the young one is full it becomes
    the old one, whose words are kept if they are met again.
    """
    tokenizer(path)
    if len(_WORKER["young"]) > KNOWN // 2:
        _WORKER.update(young={}, old=_WORKER["young"])
    young, old = _WORKER["young"], _WORKER["old"]
    found = list(map(young.get, words))
    new = []
    for i in [i for i, ids in enumerate(found) if ids is None]:
        ids = old.get(words[i])
        if ids is None:
            new.append(i)
        else:
            found[i] = young[words[i]] = ids
    plain = [_WORKER["parts"] and PLAIN.fullmatch(words[i]) is not None for i in new]
    for encode, some in ((_encode, [i for i, p in zip(new, plain) if not p]), (_encode_plain, [i for i, p in zip(new, plain) if p])):
        for lo in range(0, len(some), 5_000):
            part = some[lo:lo + 5_000]
            ids, cut = encode([words[i].decode() for i in part])
            data, cut = ids.tobytes(), (4 * cut).tolist() + [4 * len(ids)]
            for i, x, y in zip(part, cut, cut[1:]):
                found[i] = young[words[i]] = data[x:y]
    return found


def _parts(buf: np.ndarray, low: np.ndarray, offs: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Words in lower case, cut between letters and marks: bytes, and the parts' starts, ends and number in each text.

    For tokenizers with NORMALIZER and SPLIT, whose tokens stay the same.  A
    pattern's match ends where a letter (A-Z or Latin-1) meets an ASCII mark; an
    apostrophe is no mark here, it may begin a contraction.  A capital is left
    where a combining mark may follow: the tokenizer composes them first.
    """
    kind, after = KIND[buf], np.append(buf[1:], np.uint8(0x20))
    wide = (buf == 0xC3) & (after != 0x97) & (after != 0xB7)        # U+00C0-U+00FF without the signs times and divided by
    begins, stops, mark = (kind == 1) | wide, kind == 1, kind == 2
    stops[1:] |= wide[:-1]
    cut = np.flatnonzero((stops[:-1] & mark[1:]) | (mark[:-1] & begins[1:])) + 1
    at = np.zeros((2, len(buf) + 1), bool)
    at[0, starts] = at[0, cut] = at[1, ends] = at[1, cut] = True
    starts, ends = np.flatnonzero(at[0]), np.flatnonzero(at[1])
    return np.where((after < 0x80) | (after == 0xC3), low, buf), starts, ends, np.diff(np.searchsorted(starts, offs))


def token_ids(buf: np.ndarray, offs: np.ndarray, path: str, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, each followed by the end id, and each text's number of ids."""
    tokenizer(path)
    starts, ends, n = WD.spans(buf, offs)
    if _WORKER["parts"]:
        low = buf.tobytes().translate(LOWER)
        if not any(t in low for t in _WORKER["special"]):       # added tokens are looked for before anything else
            buf, starts, ends, n = _parts(buf, np.frombuffer(low, np.uint8), offs, starts, ends)
    which, words = WD.coded(buf, starts, ends, lower=False)
    ids = _learn(words.to_pylist(), path) + [np.array([end_id], "<u4").tobytes()]
    last = np.cumsum(n + 1)     # a text's words and its end
    all_ = np.full(len(which) + len(n), len(words), np.int64)
    all_[np.arange(len(which)) + np.repeat(np.arange(len(n)), n)] = which
    got = pa.array(ids, pa.large_binary()).take(pa.array(all_))
    cuts = np.frombuffer(got.buffers()[1], np.int64)[:len(got) + 1]
    out = np.frombuffer(got.buffers()[2], "<u4", int(cuts[-1]) // 4) if len(got) else np.zeros(0, "<u4")
    return out, np.diff(cuts[np.concatenate([[0], last])]) // 4


def pieces(df: DataFrame, tokenizer_path: str, text_col: str = "text", length: int = SEQUENCE,
           end_id: int = END_ID, keep: list[str] | None = None) -> DataFrame:
    """One row per piece: the columns of ``df`` in ``keep`` (all but the text), then piece, start, length and ids.

    ``ids`` are the piece's token ids as little-endian 32-bit numbers.  Only
    documents longer than ``length`` are cut.
    """
    ship(df.sparkSession)
    own = [c for c in without(df, PIECE) if (keep is None and c != text_col) or (keep is not None and c in keep)]
    rows = df.select(F.struct(*[col(c) for c in own]).alias("_e_df"), col(text_col).alias("text"))

    def cut(batches):
        for b in batches:
            buf, offs = WD.as_bytes(b.column("text"))
            for lo, hi, block, o in WD.pieces(buf, offs, BYTES):
                ids, n = token_ids(block, o, tokenizer_path, end_id)
                k = -(-n // length)
                row = np.repeat(np.arange(hi - lo), k)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)
                start = piece * length
                size = np.minimum(n[row] - start, length)
                cuts = np.concatenate([[0], np.cumsum(size) * 4]).astype(np.int64)
                data = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(cuts), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [arrow_cast(b.column("_e_df").take(pa.array(row + lo)), payload), pa.array(piece, pa.int32()), pa.array(start),
                     pa.array(size), data.cast(pa.binary())], ["_e_df", *PIECE])

    payload = nullable(rows.schema["_e_df"].dataType)
    schema = T.StructType([T.StructField("_e_df", payload), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())])
    out = rows.mapInArrow(freeing(cut), schema)
    return out.select(*[F.col("_e_df").getField(c).alias(c) for c in own], *PIECE)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Best-fit decreasing: each item's bin and offset, and the bins' fills.

    Bins wait by the room they have; the lowest set bit at or above an item's
    size names the tightest room.
    """
    if len(sizes) and int(sizes.max()) > capacity:
        raise ValueError(f"an item of {int(sizes.max())} is longer than a sequence of {capacity}")
    bin_of, offset, fill = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    waiting: dict[int, list[int]] = {}
    rooms = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            b = waiting[room].pop()
            if not waiting[room]:
                rooms ^= 1 << room
        else:
            room, b = capacity, len(fill)
            fill.append(0)
        bin_of[i], offset[i] = b, capacity - room
        room -= size
        fill[b] = capacity - room
        waiting.setdefault(room, []).append(b)
        rooms |= 1 << room
    return bin_of, offset, fill


def handed_on(fill: list[int], capacity: int) -> np.ndarray:
    """The bins that stay open: those at most half full and the emptiest FAN_IN others; never nearly full ones."""
    f = np.array(fill, np.int64)
    order = np.argsort(f, kind="stable")
    half = int((f * 2 <= capacity).sum())
    stay = np.zeros(len(f), bool)
    stay[order[:half + FAN_IN]] = True
    return stay & (f < capacity - SLACK)


def pack(df: DataFrame, length_col: str = "length", capacity: int = SEQUENCE) -> DataFrame:
    """One row per row of ``df``: its columns, sequence_id and offset.

    Rows with the same sequence_id lie one after another from offset 0, without
    gaps, ``capacity`` at most in sum; a null length counts as 0.  Columns
    named like a result are replaced.
    """
    ship(df.sparkSession)
    scratch = Scratch(df.sparkSession, "pack")
    own = without(df, RESULT)
    rows = df.select(F.struct(*[col(c) for c in own]).alias("_e_df"),
                     F.coalesce(col(length_col).cast("long"), F.lit(0).cast("long")).alias("size"))
    payload = nullable(rows.schema["_e_df"].dataType)
    schema = T.StructType([T.StructField("_e_df", payload), T.StructField("size", T.LongType()), T.StructField("bin", T.LongType()),
                           T.StructField("off", T.LongType()), T.StructField("grp", T.LongType()),
                           T.StructField("open", T.BooleanType())])
    names = schema.names

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, held, n, chunk = TaskContext.get().partitionId() << 33, [], 0, 0

        def flush():
            t = pa.Table.from_batches(held).combine_chunks()
            t = t.set_column(0, "_e_df", arrow_cast(t.column("_e_df").combine_chunks(), payload))
            bin_of, off, fill = best_fit(t.column("size").to_numpy(), capacity)
            stay = handed_on(fill, capacity)[bin_of]
            for c, v in (("bin", bin_of + base), ("off", off), ("grp", np.full(len(off), base)), ("open", stay)):
                t = t.append_column(c, pa.array(v))
            return t.to_batches(max_chunksize=20_000), len(fill)

        for b in batches:
            for lo in range(0, b.num_rows, CHUNK):
                part = b.slice(lo, CHUNK)
                held.append(part)
                n += part.num_rows
                if n >= CHUNK:
                    out, bins = flush()
                    yield from out
                    base, held, n, chunk = base + bins, [], 0, chunk + 1
        if n:
            yield from flush()[0]

    def merge(table: pa.Table) -> pa.Table:
        bins, first, of = np.unique(table.column("bin").to_numpy(), return_index=True, return_inverse=True)
        size = table.column("size").to_numpy()
        item = np.bincount(of, size, minlength=len(bins)).astype(np.int64)
        to, shift, fill = best_fit(item, capacity)
        name = np.full(len(fill), np.iinfo(np.int64).max)
        np.minimum.at(name, to, bins)
        stay = handed_on(fill, capacity)[to][of]
        return pa.Table.from_arrays(
            [arrow_cast(table.column("_e_df").combine_chunks(), payload), pa.array(size), pa.array(name[to][of]),
             pa.array(table.column("off").to_numpy() + shift[of]), pa.array(table.column("grp").to_numpy()),
             pa.array(stay)], names)

    packed = scratch.write(rows.mapInArrow(freeing(local), schema), ["open"])
    done = packed.where("NOT open")
    left = packed.where("open")
    # the chunks that left something, numbered; one row per chunk of CHUNK pieces
    groups = left.select("grp").distinct().select("grp", (F.row_number().over(Window.orderBy("grp")) - 1).cast("long").alias("g"))
    groups = scratch.write(groups)
    count = groups.count()
    left = left.join(groups, "grp").select("_e_df", "size", "bin", "off", F.col("g").alias("grp"), "open")
    while count > 1:
        count = -(-count // FAN_IN)
        merged = left.withColumn("grp", F.floor(F.col("grp") / FAN_IN).cast("long"))
        packed = scratch.write(merged.groupBy("grp").applyInArrow(merge, schema), ["open"])
        done, left = done.unionByName(packed.where("NOT open").select(done.columns)), packed.where("open")
    out = done.unionByName(left.select(done.columns))
    return out.select(*[F.col("_e_df").getField(c).alias(c) for c in own],
                      F.col("bin").alias("sequence_id"), F.col("off").alias("offset"))
