"""Byte-level BPE over a given rank file: encoding and decoding of whole texts.

A text is cut by the vocabulary's pattern and each match is merged on its own.
The merge loop keeps one bucket of positions per merge rank and a hierarchical
bitmap over the ranks: find-first-set on a few machine words names the lowest
rank that has a position, its leftmost position is merged, and an entry whose
pair has changed since it was put there is skipped. A match of n bytes costs
O(n log n), however long it is (a scan for the best pair would cost O(n^2)).

The work runs in Arrow batches inside tasks; nothing is shuffled.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

MAX_FILE_BYTES = 64 << 20       # the rank file travels with the tasks, so its size is checked
MEMO_PIECES, MEMO_CHARS = 1 << 19, 32       # short matches whose ids a Python worker remembers, twice as many while the newer half fills
LONG_TEXT = 1 << 20             # characters above which matches are taken one by one
DECODED = 1 << 18               # ids whose bytes are gathered at a time
ROWS = 256                      # rows of an Arrow batch worked on at a time


@dataclass(frozen=True)
class Vocabulary:
    """A rank file (lines of a base64 token and its rank) and the pattern that cuts texts."""
    data: bytes
    pattern: str

    @staticmethod
    def read(path: str, pattern: str) -> Vocabulary:
        """Read on the driver; the bytes go to the tasks, so executors need no copy of the file."""
        with open(path, "rb") as f:
            data = f.read(MAX_FILE_BYTES + 1)
        if len(data) > MAX_FILE_BYTES:
            raise ValueError(f"{path} is larger than {MAX_FILE_BYTES} bytes")
        return Vocabulary(data, pattern)


WORD = 8                        # log2 of the bits of one bitmap word (Python's integers have any width)
LOW = (1 << WORD) - 1
BIT = [1 << k for k in range(1 << 12)]     # of a word and of the top: 2^20 ranks


class Coder:
    """Encoder and decoder of one vocabulary, kept by a Python worker."""

    def __init__(self, vocabulary: Vocabulary):
        pairs = (line.split() for line in vocabulary.data.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("a byte has no rank")
        if max(self.ranks.values()) >> WORD >= len(BIT):
            raise ValueError("too many ranks for the bitmap")
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(vocabulary.pattern)
        self.pairs = [[self.ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)]     # ranks of two bytes
        self.words = [0] * ((max(self.tokens) >> WORD) + 1)       # the bitmap over the ranks; empty between two matches
        self.buckets: list[int | list[int] | None] = [None] * (max(self.tokens) + 1)      # by rank; empty between two matches
        ids = np.arange(max(self.tokens) + 1)
        self.sizes = np.array([len(self.tokens.get(i, b"")) for i in ids.tolist()], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(self.tokens.get(i, b"") for i in ids.tolist()), np.uint8)      # all tokens, one after another
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}       # the memo that filled up last; what is asked for again moves to the new one

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern.

        ``buckets`` holds the position of a rank, or a heap of several (leftmost
        first); a bit of ``words`` says that a rank has a bucket, a bit of ``top``
        that a word is not zero. The lowest bits of both name the next rank.
        """
        get, words, buckets, n = self.ranks.get, self.words, self.buckets, len(piece)
        whole = get(piece)
        if whole is not None:
            return [whole]
        pairs = self.pairs
        end = list(range(1, n + 1))         # where the part that starts at a position ends: the list's links to the right
        before = list(range(-1, n))         # ... and where the part on its left starts
        rank = [pairs[a][b] for a, b in zip(piece, piece[1:])]      # of a part joined with the next one, -1 if they don't merge
        rank.append(-1)
        top = 0
        for i, r in enumerate(rank):
            if r >= 0:
                held = buckets[r]
                if held is None:
                    buckets[r] = i
                    at = r >> WORD
                    words[at] |= BIT[r & LOW]
                    top |= BIT[at]
                elif held.__class__ is int:
                    buckets[r] = [held, i]
                else:
                    held.append(i)          # in order, so a heap
        while top:
            at = (top & -top).bit_length() - 1
            word = words[at]
            r = at << WORD | (word & -word).bit_length() - 1
            i = buckets[r]
            if i.__class__ is int:
                buckets[r] = None
                words[at] = word = word & (word - 1)
                if not word:
                    top &= top - 1
            else:
                held = i
                i = heappop(held)
                if len(held) == 1:
                    buckets[r] = held[0]
            if rank[i] != r:                # stale: this part has been merged or has grown since
                continue
            j = end[i]
            e = end[i] = end[j]
            rank[j] = -1
            if e < n:
                before[e] = i
                r = rank[i] = get(piece[i:end[e]], -1)
                if r >= 0:
                    held = buckets[r]
                    if held is None:
                        buckets[r] = i
                        at = r >> WORD
                        words[at] |= BIT[r & LOW]
                        top |= BIT[at]
                    elif held.__class__ is int:
                        buckets[r] = [held, i] if held < i else [i, held]
                    else:
                        heappush(held, i)
            else:
                rank[i] = -1
            i = before[i]
            if i >= 0:
                r = rank[i] = get(piece[i:e], -1)
                if r >= 0:
                    held = buckets[r]
                    if held is None:
                        buckets[r] = i
                        at = r >> WORD
                        words[at] |= BIT[r & LOW]
                        top |= BIT[at]
                    elif held.__class__ is int:
                        buckets[r] = [held, i] if held < i else [i, held]
                    else:
                        heappush(held, i)
        ids, i, ranks = [], 0, self.ranks
        while i < n:
            e = end[i]
            ids.append(ranks[piece[i:e]])
            i = e
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a text, 32 bits each."""
        if len(text) > LONG_TEXT:
            return b"".join(self._pieces([m.group()]) for m in self.pattern.finditer(text))
        return self._pieces(self.pattern.findall(text))

    def _pieces(self, pieces: list[str]) -> bytes:
        memo = self.memo
        parts = list(map(memo.get, pieces))
        if None in parts:
            for k, ids in enumerate(parts):
                if ids is None:
                    piece = pieces[k]
                    ids = memo.get(piece)       # the same match may stand earlier in this text
                    if ids is None:
                        ids = self.older.get(piece)
                        if ids is None:
                            ids = array("i", self.merge(piece.encode())).tobytes()
                        if len(piece) <= MEMO_CHARS:
                            if len(memo) >= MEMO_PIECES:
                                self.older, self.memo = memo, {}
                                memo = self.memo
                            memo[piece] = ids
                    parts[k] = ids
        return b"".join(parts)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids one after another, and each id's number of bytes."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.sizes)) or not (sizes := self.sizes[ids]).all():
            raise KeyError("an id has no token")
        parts = []
        for i in range(0, len(ids), DECODED):
            some, n = ids[i:i + DECODED], sizes[i:i + DECODED]
            at = np.repeat(self.starts[some] - (np.cumsum(n) - n), n)
            at += np.arange(len(at))
            parts.append(self.bytes[at])
        return np.concatenate([*parts, np.zeros(0, np.uint8)]), sizes


@lru_cache(maxsize=2)
def coder(vocabulary: Vocabulary) -> Coder:
    return Coder(vocabulary)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, ROWS):
            yield b.slice(i, ROWS)


def _schema(df: DataFrame, keep: list[str], extra: StructField) -> StructType:
    return StructType([*(df.schema[c] for c in keep), extra])


def encode(df: DataFrame, vocabulary: Vocabulary, keep: list[str], text_col: str = "text", out: str = "ids") -> DataFrame:
    """The columns ``keep`` of every row and ``out``, the array of its text's ids.

    No special tokens: their strings are ordinary text. Null and empty texts give
    an empty array; bytes that are not UTF-8 count as U+FFFD; texts of any length
    are encoded whole; repeated rows stay; no rows give no rows. A kept column
    named ``out`` is replaced.
    """
    keep = [c for c in keep if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(vocabulary)
        for b in _slices(batches):
            ids = [c.encode(t) for t in b.column(len(keep)).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
            values = np.frombuffer(b"".join(ids), np.int32)
            yield pa.record_batch([*b.columns[:len(keep)], pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], [*keep, out])

    text = F.make_valid_utf8(F.coalesce(F.col(text_col), F.lit("")))
    rows = df.select(*keep, text.alias("_text"))
    return rows.mapInArrow(run, _schema(df, keep, StructField(out, ArrayType(IntegerType()))))


def decode(df: DataFrame, vocabulary: Vocabulary, keep: list[str], ids_col: str = "ids", out: str = "bytes") -> DataFrame:
    """The columns ``keep`` of every row and ``out``, the bytes its ids stand for.

    Null and empty arrays give no bytes; a null id or one without a token raises ``KeyError``.
    The bytes of ids made by :func:`encode` are the text's UTF-8 bytes; other ids
    may give bytes that are not UTF-8. A kept column named ``out`` is replaced.
    """
    keep = [c for c in keep if c != out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(vocabulary)
        for b in _slices(batches):
            ids = b.column(len(keep))
            lengths, values = pc.list_value_length(ids).to_numpy(zero_copy_only=False), ids.flatten()
            if values.null_count:
                raise KeyError("an id is null")
            data, sizes = c.decode(values.to_numpy())
            ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(lengths)])]      # of each row's bytes
            column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), b.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(data)])
            yield pa.record_batch([*b.columns[:len(keep)], column.cast(pa.binary())], [*keep, out])

    ids = F.coalesce(F.col(ids_col), F.array().cast("array<int>"))
    return df.select(*keep, ids.alias("_ids")).mapInArrow(run, _schema(df, keep, StructField(out, BinaryType())))
