"""Quality classifier: regularised quadratic discriminant over document statistics.

Each class has a mean and a shrunk covariance of the transformed statistics:
``(1 - POOL) * own + POOL * pooled``, plus ``RIDGE`` of the average variance on
the diagonal.  A score is the logistic of the difference of the two Gaussian
log densities (Mahalanobis distances through Cholesky factors that are computed
once) plus the log prior ratio.

The statistics are computed from whole texts in numpy, one Arrow batch at a
time.  Training reads the documents of at most ``MAX_TRAIN`` labelled ids (the
first by a hash of the id), so the ids are a broadcast of known size and no
text is shuffled; what reaches the driver are sums per class.

Defined cases: null text counts as empty, empty texts have the statistics of an
empty text and are scored like any other; an id with several labels has the
commoner one (0 on a tie), null labels and ids teach nothing; with no labels or
one class the score is the smoothed class rate (0.5 without labels); an empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eavflow.llm import words as WD
from eavflow.llm.common import col, freeing, release, ship

MAX_TRAIN, POOL, RIDGE = 40_000, 0.1, 1e-3
RESULT = ("score", "predicted")

#: Byte classes: 0 other, 1 upper case, 2 lower case, 3 digit, 4 sentence marks, 5 symbols, 6 white space, 7 beyond ASCII.
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 7
_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 4
_CLASS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = 5
_CLASS[WD.SPACE] = 6
_LETTER = np.isin(_CLASS, (1, 2, 7))


def _share(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The share x / n on a logit scale, finite at both ends."""
    p = x / np.maximum(n, 1)
    return np.log((p + 0.004) / (1.004 - p))


def _block(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    docs, size = len(offs) - 1, np.diff(offs)
    starts, ends, n = WD.spans(buf, offs)
    doc = np.repeat(np.arange(docs), n)
    kinds = np.bincount(np.repeat(np.arange(docs) * 8, size) + _CLASS[buf], minlength=8 * docs).reshape(docs, 8)
    length = (ends - starts).astype(np.float64)
    per = lambda x: np.bincount(doc, x, minlength=docs)
    mean = per(length) / np.maximum(n, 1)
    spread = np.sqrt(np.maximum(per(length ** 2) / np.maximum(n, 1) - mean ** 2, 0))
    letters = np.concatenate([[0], np.cumsum(_LETTER[buf])])
    bare = per((letters[ends] == letters[starts]).astype(np.float64))
    last = per(np.isin(buf[ends - 1] if len(ends) else buf[:0], np.flatnonzero(_CLASS == 5)).astype(np.float64))
    key = WD.keys(buf, starts, ends)
    again = np.zeros(len(key))
    again[1:] = (key[1:] == key[:-1]) & (doc[1:] == doc[:-1])
    pair = np.zeros(len(key), dtype=np.uint64)
    pair[1:] = WD.mix64(key[:-1] * np.uint64(3) + key[1:])

    def distinct(k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys of each text, and the count of its most frequent one."""
        if not len(k):
            return np.zeros(docs), np.zeros(docs)
        order = np.lexsort((k, doc))
        new = np.ones(len(k), dtype=bool)
        new[1:] = (k[order][1:] != k[order][:-1]) | (doc[order][1:] != doc[order][:-1])
        at = np.flatnonzero(new)
        top = np.zeros(docs)
        np.maximum.at(top, doc[order][at], np.diff(np.append(at, len(k))))
        return np.bincount(doc[order][at], minlength=docs).astype(np.float64), top

    kinds_of, top = distinct(key)
    pairs_of, _ = distinct(pair)
    lines = np.bincount(np.searchsorted(offs, np.flatnonzero(buf == 10), "right") - 1, minlength=docs)
    letters_of = kinds[:, 1] + kinds[:, 2]
    return np.column_stack([
        np.log1p(n), np.log1p(mean), np.log1p(spread), _share(kinds[:, 1], letters_of), _share(kinds[:, 5], size),
        _share(kinds[:, 4], size), _share(kinds[:, 3], size), _share(kinds[:, 7], size), _share(kinds_of, n),
        _share(top, n), _share(per(again), n), _share(pairs_of, n), _share(bare, n), _share(last, n),
        np.log1p(lines) - np.log1p(n), _share(per((length <= 3).astype(np.float64)), n)])


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of transformed statistics for each whole text."""
    buf, offs = WD.as_bytes(texts)
    parts = [_block(b, o) for _, _, b, o in WD.pieces(buf, offs)]
    return np.concatenate(parts) if parts else np.zeros((0, 16))


@dataclass
class Discriminant:
    """Class 0 and 1: log prior, mean, inverse Cholesky factor and log determinant; rate: used while factors are None."""

    rate: float
    factors: list[tuple[float, np.ndarray, np.ndarray, float]] | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.factors is None:
            return np.full(len(x), self.rate)
        d = []
        for prior, mean, inverse, logdet in self.factors:
            z = (x - mean) @ inverse.T
            d.append(prior - 0.5 * np.einsum("ij,ij->i", z, z) - 0.5 * logdet)
        return 1.0 / (1.0 + np.exp(np.clip(d[0] - d[1], -700, 700)))


def solve(sums: dict[int, tuple[float, np.ndarray, np.ndarray]]) -> Discriminant:
    """From each class's count, sum of x and sum of x x'."""
    n = {c: sums[c][0] if c in sums else 0.0 for c in (0, 1)}
    rate = (n[1] + 0.5) / (n[0] + n[1] + 1.0)
    if min(n.values()) < 2:
        return Discriminant(rate)
    own = {c: sums[c][2] / n[c] - np.outer(sums[c][1] / n[c], sums[c][1] / n[c]) for c in (0, 1)}
    pooled = (n[0] * own[0] + n[1] * own[1]) / (n[0] + n[1])
    out = []
    for c in (0, 1):
        cov = (1 - POOL) * own[c] + POOL * pooled
        cov += (RIDGE * np.trace(pooled) / len(pooled) + 1e-9) * np.eye(len(cov))
        chol = np.linalg.cholesky(cov)
        out.append((float(np.log(n[c] / (n[0] + n[1]))), sums[c][1] / n[c], np.linalg.inv(chol),
                    2 * float(np.log(np.diag(chol)).sum())))
    return Discriminant(rate, out)


def _sums(batches):
    """Per class of this partition: the upper triangle of the sums of (1, x)(1, x)'."""
    total: dict[int, np.ndarray] = {}
    for b in batches:
        x = statistics(b.column("text"))
        x = np.column_stack([np.ones(len(x)), x])
        y = b.column("label").to_numpy(zero_copy_only=False)
        for c in (0, 1):
            total[c] = total.get(c, 0) + x[y == c].T @ x[y == c]
    for c, m in total.items():
        at = np.triu_indices(len(m))
        yield pa.RecordBatch.from_pydict({"label": pa.array([c] * len(at[0]), pa.int32()),
                                          "cell": pa.array(at[0] * len(m) + at[1], pa.int32()), "value": m[at]})


def train_ids(labels: DataFrame, label_col: str, id_col: str = "doc_id", most: int = MAX_TRAIN) -> DataFrame:
    """(id, label) of at most ``most`` labelled ids."""
    ids = (labels.where(col(id_col).isNotNull() & col(label_col).isin(0, 1)).groupBy(col(id_col).alias("_e_id"))
           .agg(F.avg(col(label_col).cast("double")).alias("_e_m")))
    return (ids.select("_e_id", (F.col("_e_m") > 0.5).cast("int").alias("_e_y"))
            .orderBy(F.xxhash64("_e_id"), "_e_id").limit(most))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", text_col: str = "text",
        id_col: str = "doc_id", most: int = MAX_TRAIN) -> Discriminant:
    ship(docs.sparkSession)
    # at most ``most`` rows of an id and an int: a broadcast of known size
    rows = (docs.select(col(id_col).alias("_e_id"), col(text_col).alias("text"))
            .join(F.broadcast(train_ids(labels, label_col, id_col, most)), "_e_id")
            .select("text", F.col("_e_y").alias("label")))
    cells = (rows.mapInArrow(freeing(_sums), "label int, cell int, value double")
             .groupBy("label", "cell").agg(F.sum("value").alias("value")).collect())
    size = 1 + statistics(pa.array([""])).shape[1]
    sums = {}
    for c in (0, 1):
        m = np.zeros((size, size))
        for r in cells:
            if r["label"] == c:
                m[r["cell"] // size, r["cell"] % size] = m[r["cell"] % size, r["cell"] // size] = r["value"]
        if m[0, 0]:
            sums[c] = (m[0, 0], m[0, 1:], m[1:, 1:])
    return solve(sums)


def score(model: Discriminant, text: Column) -> Column:
    """The probability of class 1 for each whole text."""
    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        out = pa.array(model.score(statistics(texts)))
        release()
        return out
    return of(text)


def classify(df: DataFrame, model: Discriminant, text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: its columns, score and predicted.  Columns named like a result are replaced."""
    ship(df.sparkSession)
    s = score(model, col(text_col))
    out = df.select(*[col(c) for c in without_results(df)], s.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_results(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.lower() not in RESULT]
