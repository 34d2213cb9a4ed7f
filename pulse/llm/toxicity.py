"""Toxicity by non-negative positive-unlabelled learning (Kiryo et al. 2017).

Confirmed toxic documents are the positives; a sample of all documents that may
be learned from is the unlabelled set, its labels unread. A linear classifier over hashed word features is
trained with numpy on the non-negative risk

    pi * R_p(+) + max(0, R_u(-) - pi * R_p(-))

with the class prior ``pi``; where the corrected negative part turns negative,
its gradient is turned round. Training reads a bounded sample; scoring reads
every text whole, batch by batch, with the weights as its only state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm import hashing as H
from pulse.llm.common import stash

FEATURE_BITS = 20
MASK = (1 << FEATURE_BITS) - 1
PREFIXES = (4, 5, 6, 7, 8)
FULL = 20
MAX_POSITIVE, MAX_UNLABELLED = 6_000, 12_000       # rows that are learned from, at most
MIN_POSITIVES, MIN_Z = 3, 4.0                      # a feature is used if it sets positives apart from the unlabelled
EPOCHS, RATE, DECAY = 400, 0.1, 1e-5
PLAIN = np.zeros(256, bool)
PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
PLAIN |= H.SPACE


def features(column: pa.Array, used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index, value, begin): each row's features, each once, their values, and where each row's begin.

    A word is a run of letters and digits, Latin-1 capitals lower-cased; its features are the
    word and its first ``PREFIXES`` bytes, which inflected and compound forms
    share. The value is the feature's density: occurrences per ``FULL`` words, 1
    at most, so a chance hit in a long text weighs little. ``used`` leaves only
    features for which it is true.
    """
    raw, offsets = H.text_bytes(column)
    raw = np.where(PLAIN[raw], raw, np.uint8(0x20))
    accented = (raw[1:] >= 0x80) & (raw[1:] <= 0x9E) & (raw[1:] != 0x97) & (raw[:-1] == 0xC3)      # capitals from U+00C0 to U+00DE
    raw[1:][accented] += 0x20
    words, starts, ends, first = H.word_hashes(raw, offsets)
    counts = np.diff(first)
    row = np.repeat(np.arange(len(counts)), counts)
    found = [(row << FEATURE_BITS) | (words >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)]
    lower, n = H.LOWER[raw], ends - starts
    head = np.zeros(len(starts), np.uint64)
    for k in range(max(PREFIXES) if len(starts) else 0):
        head = head + H.BYTES[lower[np.minimum(starts + k, len(lower) - 1)]] * H.FACTORS[k]
        if k + 1 in PREFIXES:
            long = n > k + 1
            index = (H.mix(head[long] + np.uint64(k + 1)) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
            found.append((row[long] << FEATURE_BITS) | index)
    pairs = np.concatenate(found)
    if used is not None:
        pairs = pairs[used[pairs & MASK]]
    pairs, times = np.unique(pairs, return_counts=True)
    at = pairs >> FEATURE_BITS
    return pairs & MASK, np.minimum(1.0, FULL * times / np.maximum(counts[at], 1)), np.searchsorted(at, np.arange(len(first)))


def margins(weights: np.ndarray, index: np.ndarray, value: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Bias (the last weight) plus the weighted sum of each row's features."""
    sums = np.concatenate([[0.0], np.cumsum(weights[index] * value)])
    return sums[begin[1:]] - sums[begin[:-1]] + weights[-1]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -60, 60)))


def telling(in_p: np.ndarray, in_u: np.ndarray, n_p: int, n_u: int) -> np.ndarray:
    """Whether a feature's share of the positives differs from its share of the unlabelled by ``MIN_Z`` standard errors."""
    rate = (in_p + in_u + 1) / (n_p + n_u + 2)
    z = (in_p / n_p - in_u / n_u) / np.sqrt(rate * (1 - rate) * (1 / n_p + 1 / n_u))
    return (np.abs(z) >= MIN_Z) & ((in_p >= MIN_POSITIVES) | (z < 0))


def fit(index: np.ndarray, value: np.ndarray, begin: np.ndarray, positive: np.ndarray, prior: float, epochs: int = EPOCHS, rate: float = RATE) -> np.ndarray:
    """Weights (features, then the bias) by full-batch Adam on the non-negative risk.

    ``positive`` marks the confirmed rows, the others are unlabelled. Without
    one of either kind all weights are 0 (every score is 0.5).
    """
    size = 1 << FEATURE_BITS
    weights = np.zeros(size + 1)
    n_p, n_u = int(positive.sum()), int((~positive).sum())
    if not n_p or not n_u:
        return weights
    row = np.repeat(np.arange(len(positive)), np.diff(begin))
    used = telling(np.bincount(index[positive[row]], minlength=size), np.bincount(index[~positive[row]], minlength=size), n_p, n_u)
    mine = used[index]
    index, value, row = index[mine], value[mine], row[mine]
    begin = np.searchsorted(row, np.arange(len(positive) + 1))

    share = np.where(positive, 1.0 / n_p, 1.0 / n_u)
    as_minus = np.where(positive, -prior, 1.0) * share      # weight of a row's loss as a negative
    weights[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, epochs + 1):
        s = sigmoid(margins(weights, index, value, begin))
        minus = as_minus * s
        if (as_minus * -np.log(np.clip(1 - s, 1e-12, 1))).sum() >= 0:
            slope = np.where(positive, prior * (s - 1) * share, 0.0) + minus
        else:       # the corrected part is negative: it has been overfitted, so climb back
            slope = -minus
        gradient = np.append(np.bincount(index, weights=slope[row] * value, minlength=size) + DECAY * weights[:-1] * used, slope.sum())
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient ** 2
        weights = weights - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return weights


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED) -> np.ndarray:
    """Weights learned from at most ``max_positive`` rows with label 1 and
    ``max_unlabelled`` rows of any kind, the least by a hash of their id, then of id and text.

    Equal rows (id and text) count once, whatever number of them there is.

    The class prior is the share of label 1 among all of ``labels`` (kept within
    0.001 and 0.5). The sample's ids are found first, on narrow columns; features
    are counted and chosen on the executors, and only the chosen ones' values reach the driver.
    """
    by_hash = F.xxhash64("id")
    l = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
    prior = l.agg(F.avg((F.col("y") == 1).cast("double"))).first()[0]
    prior = min(0.5, max(0.001, prior or 0.0))
    p = l.where(F.col("y") == 1).select("id").distinct().orderBy(by_hash, "id").limit(max_positive).withColumn("positive", F.lit(True))
    u = docs.select(F.col(id_col).alias("id")).where(F.col("id").isNotNull()).orderBy(by_hash, "id").limit(max_unlabelled).withColumn("positive", F.lit(False))
    chosen = p.union(u.distinct())

    # Two narrow columns of at most max_positive + max_unlabelled rows: a proven bound for the broadcast.
    near = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    near = stash(near.select("positive", "id", F.xxhash64("text").alias("digest"), "text"))
    # An id may have any number of rows: the bound holds for (id, digest), again on narrow columns.
    rows = near.select("positive", "id", "digest").distinct()
    order = F.xxhash64("id", "digest"), "id", "digest"
    kept = rows.where("positive").orderBy(*order).limit(max_positive).union(rows.where("not positive").orderBy(*order).limit(max_unlabelled))
    sample = stash(near.join(F.broadcast(kept), ["positive", "id", "digest"]).dropDuplicates(["positive", "id", "digest"]).select("positive", "text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, 1 << FEATURE_BITS), np.int32)
        for part in _slices(batches):
            index, _, begin = features(part.column("text"))
            of = np.repeat(part.column("positive").to_numpy(zero_copy_only=False).astype(np.int64), np.diff(begin))
            found += np.bincount((of << FEATURE_BITS) | index, minlength=2 << FEATURE_BITS).reshape(2, -1).astype(np.int32)
        some = np.flatnonzero(found.sum(0))
        yield pa.record_batch([pa.array(some), pa.array(found[1, some].astype(np.int64)), pa.array(found[0, some].astype(np.int64))], ["feature", "in_p", "in_u"])

    n = {r["positive"]: r["n"] for r in sample.groupBy("positive").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(n) < 2:
        return np.zeros((1 << FEATURE_BITS) + 1)
    sums = sample.mapInArrow(count, "feature long, in_p long, in_u long").groupBy("feature").agg(F.sum("in_p").alias("in_p"), F.sum("in_u").alias("in_u"))
    # A loose form of the test below, so that only the features that may pass it reach the driver.
    rate = (F.col("in_p") + F.col("in_u")) / (n[True] + n[False] + 2)
    apart = F.abs(F.col("in_p") / n[True] - F.col("in_u") / n[False]) >= 0.9 * MIN_Z * F.sqrt(rate * (1 - rate) * (1 / n[True] + 1 / n[False]))
    top = sums.where(apart).toPandas()
    mask = np.zeros(1 << FEATURE_BITS, bool)
    mask[top["feature"][telling(top["in_p"].to_numpy(), top["in_u"].to_numpy(), n[True], n[False])].to_numpy(np.int64)] = True
    kept = np.flatnonzero(mask)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = np.zeros(1 << FEATURE_BITS, bool)
        used[kept] = True
        for part in _slices(batches):
            index, value, begin = features(part.column("text"), used)
            index, value = index.astype(np.int32), value.astype(np.float32)
            spans = list(zip(begin[:-1], begin[1:]))
            yield pa.record_batch([part.column("positive"), pa.array([index[a:z].tobytes() for a, z in spans], pa.binary()),
                                   pa.array([value[a:z].tobytes() for a, z in spans], pa.binary())], ["positive", "index", "value"])

    rows = sample.mapInArrow(run, "positive boolean, index binary, value binary").collect()
    index = np.frombuffer(b"".join(r["index"] for r in rows), np.int32).astype(np.int64)
    value = np.frombuffer(b"".join(r["value"] for r in rows), np.float32).astype(np.float64)
    begin = np.concatenate([[0], np.cumsum([len(r["index"]) // 4 for r in rows])]).astype(np.int64)
    return fit(index, value, begin, np.array([r["positive"] for r in rows], bool), prior)


def score(docs: DataFrame, weights: np.ndarray, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of every row and ``score``, 0 to 1: the probability of label 1.

    Texts are read whole, in small batches; null and empty texts get the score
    of a text without known words. Equal texts get equal scores.
    """
    some = np.flatnonzero(weights)
    known = some, weights[some]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema) + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense = np.zeros((1 << FEATURE_BITS) + 1)
        dense[known[0]] = known[1]
        used = dense != 0
        for part in _slices(batches):
            index, value, begin = features(part.column("_text"), used)
            yield pa.record_batch([*[part.column(c) for c in keep], pa.array(sigmoid(margins(dense, index, value, begin)))], [*keep, "score"])

    return docs.select(*keep, F.col(text_col).alias("_text")).mapInArrow(run, schema)
