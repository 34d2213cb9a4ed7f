"""Periodic runs: stretches of a text whose words repeat with a period.

Recursive frequency splitting first. A run of at least ``min_repeats`` periods
holds each of its words at least ``min_repeats`` times, so a word that occurs
more rarely in a segment is in no run there and splits the segment; the parts
are recounted until nothing splits. A split counts only what is not the largest
part (whose counts follow by subtraction), so a text of n words costs
O(n log n) however deep the splitting goes.

Surviving segments are then scanned at every lag q. A run covers at least
``min_repeats - 1`` whole blocks of the grid of blocks of q words, so equal
fingerprints of neighbouring blocks (differences of one prefix sum) find it in
n / q steps; words are then compared one by one to find where it starts and ends.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

MIN_LENGTH, MIN_REPEATS = 6, 4      # words of a run; periods of a run
ROWS = 256                          # rows of an Arrow batch worked on at a time
BASE = np.uint64(0x9E3779B97F4A7C15)
STEP = 64                           # first step of a comparison outwards; it doubles

Run = tuple[int, int, int]          # start, length, period


def segments(words: list, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> list[tuple[int, int]]:
    """(start, end) of the stable segments: each word in one occurs there ``min_repeats`` times or more."""
    out: list[tuple[int, int]] = []
    where: dict[object, list[int]] = {}

    def fresh(lo: int, hi: int):
        if hi - lo >= min_length:
            counts = Counter(words[lo:hi])
            todo.append((lo, hi, counts, [i for i in range(lo, hi) if counts[words[i]] < min_repeats]))

    todo: list[tuple[int, int, Counter, list[int]]] = []
    fresh(0, len(words))
    while todo:
        lo, hi, counts, cuts = todo.pop()
        if not cuts:
            out.append((lo, hi))
            continue
        parts = [(a, b) for a, b in zip([lo, *(c + 1 for c in cuts)], [*cuts, hi]) if b - a >= min_length]
        big = max(parts, key=lambda p: p[1] - p[0], default=None)
        if big is not None and 2 * (big[1] - big[0]) > hi - lo:
            parts.remove(big)
            if not where:
                for i, w in enumerate(words):
                    where.setdefault(w, []).append(i)
            gone = Counter(words[lo:big[0]])
            gone.update(words[big[1]:hi])
            rare: list[int] = []
            for w, n in gone.items():
                counts[w] -= n
                if 0 < counts[w] < min_repeats:
                    at = where[w]
                    rare += at[bisect_left(at, big[0]):bisect_left(at, big[1])]
            todo.append((*big, counts, sorted(rare)))
        for a, b in parts:
            fresh(a, b)
    return sorted(out)


def _extent(ids: np.ndarray, q: int, at: int) -> tuple[int, int]:
    """The greatest stretch (start, end) with period q that has words at and at + q, if those are equal (else empty)."""
    n = len(ids)
    right, step = at, STEP
    while right < n - q:
        to = min(right + step, n - q)
        differ = np.flatnonzero(ids[right:to] != ids[right + q:to + q])
        if len(differ):
            right += int(differ[0])
            break
        right, step = to, 2 * step
    left, step = at, STEP
    while left > 0 and right > at:
        to = max(left - step, 0)
        differ = np.flatnonzero(ids[to:left] != ids[to + q:left + q])
        if len(differ):
            left = to + int(differ[-1]) + 1
            break
        left, step = to, 2 * step
    return left, right + q if right > at else at


def _inside(runs: list[tuple[int, int]], a: int, b: int) -> bool:
    """Is [a, b) inside one of these runs of one period (start, end), sorted?"""
    i = bisect_right(runs, (a, 1 << 62)) - 1
    return i >= 0 and runs[i][1] >= b


def scan(ids: np.ndarray, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> list[Run]:
    """The runs of one segment of word numbers, by period and start."""
    n = len(ids)
    longest = n // min_repeats
    power = np.full(max(n, longest) + 1, BASE, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(x * power[:n], out=sums[1:])
    need = min_repeats - 2                  # equal neighbours among min_repeats - 1 blocks
    found: dict[int, list[tuple[int, int]]] = {}
    for q in range(1, longest + 1):
        marks = sums[::q]
        blocks = marks[1:] - marks[:-1]
        same = np.flatnonzero(blocks[1:] == blocks[:-1] * power[q])
        if len(same) < need:
            continue
        cut = np.flatnonzero(np.diff(same) != 1) + 1
        divisors = [found[p] for p in found if q % p == 0 and p < q]
        for first, last in zip(same[np.concatenate([[0], cut])], same[np.concatenate([cut - 1, [len(same) - 1]])]):
            a, b = int(first) * q, (int(last) + 2) * q          # whole blocks that agree
            if last - first + 1 < need or any(_inside(runs, a, b) for runs in divisors):
                continue            # a stretch of a shorter period, which divides this one
            while a < b - q:
                left, right = _extent(ids, q, a)
                if right - left >= max(min_length, min_repeats * q):
                    found.setdefault(q, []).append((left, right))
                a = max(right - q, a) + 1
        if q in found:
            found[q] = sorted(set(found[q]))
    return [(a, b - a, q) for q, runs in found.items() for a, b in runs]


def find_runs(words: list, min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> list[Run]:
    """The qualifying runs of a list of words, by start, then period."""
    if min_repeats < 3:
        raise ValueError("the block scan needs runs of three periods or more")
    out: list[Run] = []
    for lo, hi in segments(words, min_length, min_repeats):
        number: dict[object, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words[lo:hi]), np.int64, hi - lo)
        out += [(lo + a, length, q) for a, length, q in scan(ids, min_length, min_repeats)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words joined by one space, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    at, kept = 0, []
    for lo, hi in sorted((a + q, a + n) for a, n, q in runs):
        if hi > at:
            kept += words[at:max(lo, at)]
            at = hi
    return b" ".join(kept + words[at:])


RUN = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])


def periodic_runs(df: DataFrame, keep: list[str], text_col: str = "text", min_length: int = MIN_LENGTH, min_repeats: int = MIN_REPEATS) -> DataFrame:
    """The columns ``keep`` of every row with ``n_words``, ``runs`` and ``collapsed``.

    Words are what white space (the six ASCII characters) leaves. A run is a
    stretch of consecutive words with smallest period q, of at least
    ``min_length`` words and ``min_repeats`` periods, that no neighbouring word
    extends; ``runs`` has (start, length, period) by start, then period.
    ``collapsed`` joins by one space the words that no run holds after its first
    period. Null and empty texts have no words, no runs and an empty
    ``collapsed``; bytes that are not UTF-8 count as U+FFFD; texts are read whole;
    repeated rows stay; no rows give no rows. Kept columns named like a result
    are replaced.
    """
    keep = [c for c in keep if c not in ("n_words", "runs", "collapsed")]
    schema = StructType([*(df.schema[c] for c in keep), StructField("n_words", LongType()), StructField("runs", ArrayType(RUN)), StructField("collapsed", StringType())])
    arrow = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                b = batch.slice(i, ROWS)
                numbers, runs, texts = [], [], []
                for text in b.column(len(keep)).cast(pa.binary()).to_pylist():
                    words = text.split()        # bytes split at exactly the six characters
                    found = find_runs(words, min_length, min_repeats)
                    numbers.append(len(words))
                    runs.append([dict(zip(("start", "length", "period"), r)) for r in found])
                    texts.append(collapse(words, found))
                yield pa.record_batch([*b.columns[:len(keep)], pa.array(numbers, pa.int64()), pa.array(runs, arrow), pa.array(texts, pa.binary()).cast(pa.string())],
                                      [*keep, "n_words", "runs", "collapsed"])

    text = F.make_valid_utf8(F.coalesce(F.col(text_col), F.lit("")))
    return df.select(*keep, text.alias("_text")).mapInArrow(run, schema)
