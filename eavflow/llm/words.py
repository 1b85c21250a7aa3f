"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a run of ``[^\\x20\\x09-\\x0D]``.  Within a batch words are told apart
by their bytes (``coded``).  Across batches a word's 64-bit key is its XXH3
hash, the same on every executor; no structure of words makes keys meet, and
two given words share a key with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SEED = 20240607


def mix64(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit keys (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def as_bytes(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


def pieces(buf: np.ndarray, offs: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive texts of about ``most`` bytes at a time (a longer text comes alone): (first, end, bytes, offsets)."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + most, "right")) - 1)
        hi = min(hi, n)
        yield lo, hi, buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


def spans(buf: np.ndarray, offs: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the number of words of each text; ``space`` tells the bytes between words."""
    inside = ~space[buf]
    before = np.zeros(len(buf) + 1, dtype=bool)
    before[1:] = inside
    before[offs[:-1]] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(buf) + 1, dtype=bool)
    after[:-1] = inside
    after[offs[1:]] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    counts = np.diff(np.searchsorted(starts, offs))
    return starts, ends, counts


def coded(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> tuple[np.ndarray, pa.Array]:
    """Each span's number among the distinct ones, and these (binary): spans are the same if their bytes are."""
    size = ends - starts
    cuts = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    edge = np.zeros(len(buf) + 1, np.int8)
    edge[starts] = 1
    edge[ends] -= 1
    data = buf[np.cumsum(edge[:-1], dtype=np.int8).astype(bool)]
    data = LOWER[data] if lower else data
    words = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(cuts), pa.py_buffer(data)])
    found = words.dictionary_encode()
    return found.indices.to_numpy(), found.dictionary


def keys(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """The 64-bit key of each span of bytes; spans must not overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    code, words = coded(buf, starts, ends, lower)
    each = np.fromiter((xxhash.xxh3_64_intdigest(w, SEED) for w in words.to_pylist()), np.uint64, len(words))
    return each[code]
