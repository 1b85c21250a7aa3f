"""Language ID: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased, ASCII characters that are no letters become spaces, and
its n-grams of 1 to 3 characters are hashed into cells.  Training counts
(language, cell) in each partition, adds the counts up by Spark and turns them
into log probabilities.  The number of cells is a parameter and does not depend
on the number of languages: the matrix is kept, broadcast and gathered in blocks
of languages, each of at most ``MATRIX`` numbers (256 languages by default), and
all predictions are those of the one matrix.  What grows with the languages, and
with nothing else, is the number of blocks.  N-gram sums add up, so texts are
scored in pieces of ``PIECE`` characters that overlap by two, whatever their length.

Defined cases: a text that is null or has no letter is ``und`` with score 0,
teaches nothing, and so does a null language; with nothing learned every text
is ``und``; ties go to the first language by name; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eavflow.llm.common import col, ship

ORDERS, CELLS, MATRIX, PIECE, SMOOTH, UNKNOWN = (1, 2, 3), 1 << 15, 1 << 23, 1 << 19, 0.1, "und"
RESULT = ("lang_pred", "score")
_HAS_LETTER = re.compile(r"[^\W\d_]").search
_FOLD = np.arange(128, dtype=np.uint32)
_FOLD[[i for i in range(128) if not chr(i).isalpha()]] = 32


def has_letter(text: str | None) -> bool:
    return text is not None and _HAS_LETTER(text) is not None


def grams(texts: list[str], cells: int, starts: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The cells of all n-grams, text by text, and each text's number of them; with ``starts``, of those at its first places."""
    lower = [t.lower() for t in texts]
    size = np.array([len(t) for t in lower], dtype=np.int64)
    c = np.frombuffer("".join(lower).encode("utf-32-le"), dtype=np.uint32)
    c = np.where(c < 128, _FOLD[np.minimum(c, 127)], c).astype(np.uint64)
    ends = np.cumsum(size)
    left = np.repeat(ends, size) - np.arange(len(c))      # characters from here to the text's end
    first = size if starts is None else np.array(starts, dtype=np.int64)
    inside = left > np.repeat(size - first, size)
    out = np.zeros((len(c), len(ORDERS)), dtype=np.int64)
    valid = np.zeros((len(c), len(ORDERS)), dtype=bool)
    h = np.zeros(len(c), dtype=np.uint64)
    shift = np.uint64(64 - (cells.bit_length() - 1))
    for i, n in enumerate(ORDERS):
        h = h * np.uint64(0x100000001B3) + np.concatenate([c[n - 1:], np.zeros(min(n - 1, len(c)), np.uint64)])
        out[:, i] = ((h + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> shift
        valid[:, i] = inside & (left >= n)
    per = np.sum([np.clip(size - n + 1, 0, first) for n in ORDERS], axis=0) if len(size) else size
    return out[valid], per


def _runs(texts: list[str]) -> Iterator[tuple[list[int], list[str], list[int]]]:
    """Runs of about PIECE characters: numbers of texts, pieces of them, and at how many places of a piece its own n-grams start."""
    at, parts, starts, size = [], [], [], 0
    for i, t in enumerate(texts):
        t = t.lower()
        for p in range(0, len(t), PIECE):
            n = min(PIECE, len(t) - p)
            if parts and size + n > PIECE:
                yield at, parts, starts
                at, parts, starts, size = [], [], [], 0
            at.append(i)
            parts.append(t[p:p + n + max(ORDERS) - 1])
            starts.append(n)
            size += n
    if parts:
        yield at, parts, starts


@dataclass
class Bayes:
    langs: list[str]
    blocks: list[np.ndarray]    # log probabilities, (cells, languages), by successive languages

    @property
    def matrix(self) -> np.ndarray:
        return np.concatenate(self.blocks, axis=1)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        at = [i for i, t in enumerate(texts) if self.langs and has_letter(t)]
        total = np.zeros((len(at), len(self.langs)))
        for which, parts, starts in _runs([texts[i] for i in at]):
            cell, n = grams(parts, len(self.blocks[0]), starts)
            cut, k = np.cumsum(n) - n, 0
            for block in self.blocks:
                for j in range(block.shape[1]):
                    np.add.at(total[:, k], which, np.add.reduceat(block[:, j][cell], cut))
                    k += 1
        if at:
            p = np.exp(total - total.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            best = p.argmax(axis=1)
            for i, k in zip(at, best):
                lang[i] = self.langs[k]
            score[at] = p[np.arange(len(best)), best]
        return lang, score


def fit(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", cells: int = CELLS) -> Bayes:
    """Learn from ``rows``: their texts and languages; ``cells`` is a power of two."""
    ship(rows.sparkSession)
    rows = rows.where(col(lang_col).isNotNull()).select(col(text_col).alias("text"), col(lang_col).alias("lang"))
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    number = {x: i for i, x in enumerate(langs)}

    def count(batches):
        total = {}
        for b in batches:
            by = defaultdict(list)
            for t, x in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
                if has_letter(t):
                    by[x].append(t)
            for x, own in by.items():
                n = total.setdefault(x, np.zeros(cells, dtype=np.int64))
                for _, parts, starts in _runs(own):
                    n += np.bincount(grams(parts, cells, starts)[0], minlength=cells)
        for x, n in total.items():
            c = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict({"k": pa.array(np.full(len(c), number[x]), pa.int32()), "c": pa.array(c, pa.int32()), "n": n[c]})

    counts = (rows.mapInArrow(count, "k int, c int, n long").groupBy("k", "c").agg(F.sum("n").alias("n")))
    table = counts.toArrow()        # at most one row per language and cell
    n = np.zeros((cells, max(1, len(langs))))
    n[table.column("c").to_numpy(), table.column("k").to_numpy()] = table.column("n").to_numpy()
    seen = n.sum(axis=0) > 0
    n, langs = n[:, seen], [x for x, s in zip(langs, seen) if s]
    width = max(1, MATRIX // cells)
    return Bayes(langs, [np.log((b + SMOOTH) / (b.sum(axis=0) + SMOOTH * cells))
                         for b in (n[:, k:k + width] for k in range(0, max(1, len(langs)), width))])


def predict(df: DataFrame, model: Bayes, text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: its columns, lang_pred and score.  Columns named like a result are replaced."""
    ship(df.sparkSession)
    langs, sent = model.langs, [df.sparkSession.sparkContext.broadcast(b) for b in model.blocks]

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def of(texts: pa.Array) -> pa.Array:
        lang, score = Bayes(langs, [b.value for b in sent]).predict(texts.to_pylist())
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score)], ["lang_pred", "score"])

    own = [c for c in df.columns if c.lower() not in RESULT]
    out = df.select(*[col(c) for c in own], of(col(text_col)).alias("_e_p"))
    return out.select(*[col(c) for c in own], "_e_p.lang_pred", "_e_p.score")


def held_out(id_: Column, mod: int, rest: int) -> Column:
    """crc32 of the id as text modulo ``mod`` is ``rest``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_.cast("string"), F.lit("")).cast("binary")) % mod == rest
