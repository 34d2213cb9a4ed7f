"""Word and shingle hashes of whole batches of texts with numpy.

A batch's bytes are hashed at once: prefix sums of byte values times powers of
an odd base give the hash of any range as a difference, so the cost per byte is
a few vector operations, with no Python loop over words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 17         # bytes hashed at a time, so the work arrays stay small
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BYTES = np.random.default_rng(20240101).integers(0, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)

_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _powers or len(_powers["up"]) < n:
        for name, base in (("up", BASE), ("down", INVERSE)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"][:n], _powers["down"][:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column (null: empty) and the offsets of its rows."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_hashes(raw: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of every word, and the index of each row's first word."""
    if lower:
        raw = LOWER[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    solid = ~SPACE[raw]
    before = np.empty(len(raw), bool)
    before[:1] = True
    before[1:] = ~solid[:-1]
    starts = np.flatnonzero(solid & (before | edge[:-1]))
    after = np.empty(len(raw), bool)
    after[-1:] = True
    after[:-1] = ~solid[1:]
    ends = np.flatnonzero(solid & (after | edge[1:])) + 1
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):       # whole words, about CHUNK bytes of them
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + CHUNK)))
        lo, hi = starts[at], ends[to - 1]
        up, down = _tables(int(max(hi - lo, CHUNK)) + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(BYTES[raw[lo:hi]] * up[:hi - lo], out=sums[1:])
        s, e = starts[at:to] - lo, ends[at:to] - lo
        out[at:to] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        at = to
    return out, starts, ends, np.searchsorted(starts, offsets)


FACTORS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word shingles and the index of each row's first one.

    Rows of fewer words have their whole sequence as one shingle; rows without words have none.
    """
    counts = np.diff(first)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(begin[-1]) - np.repeat(begin[:-1] - first[:-1], n)
    have = np.repeat(np.minimum(counts, size), n)
    total = have.astype(np.uint64)
    if len(words):
        for k in range(size):
            word = words[np.minimum(at + k, len(words) - 1)] * FACTORS[k]
            total = total + np.where(k < have, word, np.uint64(0))
    return mix(total), begin


def distinct(hashes: np.ndarray, begin: np.ndarray):
    """For each row its sorted distinct hashes."""
    for i in range(len(begin) - 1):
        x = np.sort(hashes[begin[i]:begin[i + 1]])
        yield x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x
