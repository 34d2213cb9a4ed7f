"""Fuzzy line deduplication by SimHash.

Lines are normalised to their words (letters and digits, A-Z lower-cased). The
line's features, its words or, in lines of fewer than four, its pairs of
bytes, are dealt into blocks by their hash, and each block has a SimHash of
its own features: a changed word touches its old and its new block and leaves
the others as they are. That is what makes the pigeonhole hold at an edit
similarity of 0.8, where the bits of one hash over all features do not
(one changed word of ten turns about nine of 64 bits). Lines that agree in as many blocks as
their length asks for meet; those that can't link by their lengths, or by
the SimHash of the whole line, part again; the edit similarity decides.

Equal lines are one line from the start, and where more than a few variants
share blocks, each first meets the bucket's most frequent line: variants linked
to it are connected and never paired among each other. Of every connected group
one occurrence stays, the first by document and position.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.llm import hashing as H
from pulse.llm.common import discard, stash
from pulse.llm.components import components, extended
from pulse.llm.toxicity import PLAIN

MIN_SIMILARITY = 0.8
MAX_BITS, GATED = 16, 60                            # bits of the whole SimHash in which linked lines of GATED characters or more may differ
MIN_WORDS = 5                                       # unless the caller says otherwise, shorter lines stay as they are
SMALL = 8                                           # lines of a bucket that are compared as they stand
FILTER_BITS = 25
FEW = 4                                             # lines of fewer words are told by their pairs of bytes
# Lines of words [from, to): blocks, how many of them a bucket is made of, and the least features of those.
# The ranges overlap, so lines whose numbers of words differ still share one.
LAYOUTS = ((2, 15, 5, 3, 2), (12, 30, 6, 2, 3), (24, 60, 8, 1, 4), (48, 1 << 31, 10, 1, 5))
PAIR_LAYOUT = (6, 2, 2)
AHEAD = 8                                           # words that the quick alignment of two lines looks ahead
AHEAD_STEPS = [(p, d - p) for d in range(1, AHEAD + 1) for p in range(d + 1)]


NORMAL = H.LOWER[np.where(PLAIN, np.arange(256), 0x20)]            # a normalised line's bytes
COUNTED = PLAIN & ~H.SPACE & ((np.arange(256) & 0xC0) != 0x80)     # begin a code point of a word


def _line_rows(raw: np.ndarray, offsets: np.ndarray):
    """The lines of a batch: start and end bytes, row, line number in its row, and word hashes by line."""
    cut = np.unique(np.concatenate([np.flatnonzero(raw == 10) + 1, offsets]))
    starts = cut[cut < len(raw)] if len(raw) else cut[:0]
    ends = np.append(starts[1:], len(raw))
    row = np.searchsorted(offsets, starts, "right") - 1
    number = np.arange(len(starts)) - np.searchsorted(starts, offsets[row])
    words, _, _, first = H.word_hashes(NORMAL[raw], np.append(starts, len(raw)), lower=False)
    return starts, ends, row, number, words, first


def _keys(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Identity of each line's word sequence."""
    n = np.diff(first)
    at = np.arange(len(words)) - np.repeat(first[:-1], n)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(H.mix(words + H.mix(at.astype(np.uint64))), dtype=np.uint64)])
    return H.mix(sums[first[1:]] - sums[first[:-1]] + n.astype(np.uint64))


# A byte's bits as eight counters in one number.
LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64).ravel()


def _blocks(features: np.ndarray, line: np.ndarray, lines: int, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each line's distinct features by block: their number and SimHash (lines x blocks), and the SimHash of the whole line.

    A bit of a SimHash is that of most of the features (0 without any).
    """
    slot = line * blocks + (H.mix(features + np.uint64(blocks)) >> np.uint64(32)).astype(np.int64) % blocks
    bits = np.uint64(max(lines * blocks, 2).bit_length())
    order = np.argsort(slot.astype(np.uint64) << (np.uint64(64) - bits) | features >> bits)     # by block, equal features together
    slot, features = slot[order], features[order]
    once = np.ones(len(slot), bool)
    once[1:] = (slot[1:] != slot[:-1]) | (features[1:] != features[:-1])
    slot, features = slot[once], features[once]
    count = np.bincount(slot, minlength=lines * blocks)
    sums = np.zeros((lines * blocks, 64), np.int32 if len(slot) > 1 << 14 and count.max() * blocks > 1 << 14 else np.int16)
    held = np.flatnonzero(count)
    if len(held):
        pieces = -(-count[held] // 255)                 # a lane counts to 255
        piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = np.repeat(np.cumsum(count[held]) - count[held], pieces) + 255 * piece
        lanes = _lane_sums(features.view(np.uint8).reshape(-1, 8), begin).view(np.uint8)
        sums[held] = lanes if len(begin) == len(held) else np.add.reduceat(lanes, np.cumsum(pieces) - pieces, axis=0, dtype=np.int32)
    by_line = count.reshape(lines, blocks)
    whole = sums.reshape(lines, blocks, 64).sum(axis=1, dtype=sums.dtype)
    return by_line, _majority(sums, count).reshape(lines, blocks), _majority(whole, by_line.sum(axis=1))


def _lane_sums(rows: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The lanes of each group of ``rows`` (bytes of features), which begin at ``begin`` and have 255 rows at most.

    The groups' k-th rows are added together, those of the largest groups first, so each step is one pass over whole arrays.
    """
    size = np.diff(np.append(begin, len(rows)))
    by_size = np.argsort(-size, kind="stable")
    first, left = begin[by_size], size[by_size]
    out = LANES[rows[first]]
    some = len(first)
    for k in range(1, int(left[0])):
        some = int(np.searchsorted(-left[:some], -k, "left"))       # groups of more than k rows
        out[:some] += LANES[rows[first[:some] + k]]
    back = np.empty_like(out)
    back[by_size] = out
    return back


def _majority(sums: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.packbits(sums > (n // 2)[:, None].astype(sums.dtype), axis=1).view(">u8").ravel().astype(np.uint64)


def _meeting(count: np.ndarray, sims: np.ndarray, take: int, least: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(line, bucket) for each choice of ``take`` blocks that hold ``least`` features or more."""
    blocks = sims.shape[1]
    part = H.mix(sims + H.mix(np.arange(blocks, dtype=np.uint64) + np.uint64(64 * salt)) + count.astype(np.uint64))
    at, out = [], []
    for k, choice in enumerate(combinations(range(blocks), take)):
        some = np.flatnonzero(count[:, choice].sum(axis=1) >= least)
        at.append(some)
        out.append(H.mix(part[some][:, choice].sum(axis=1, dtype=np.uint64) + np.uint64(4096 * salt + k)))
    return np.concatenate(at), np.concatenate(out)


def _sketch(words: np.ndarray, first: np.ndarray, pairs: np.ndarray, pair_first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The SimHash of every line, its buckets end to end, and where each line's buckets begin.

    ``pairs``: the byte pairs of the lines of fewer than ``FEW`` words.
    """
    n, lines = np.diff(first), len(first) - 1
    simhash, at, out = np.zeros(lines, np.uint64), [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for salt, (low, high, blocks, take, least) in enumerate(LAYOUTS, 1):
        here = np.flatnonzero((n >= low) & (n < high))
        if len(here):
            within = np.repeat((n >= low) & (n < high), n)
            count, sims, whole = _blocks(words[within], np.repeat(np.arange(len(here)), n[here]), len(here), blocks)
            rows, found = _meeting(count, sims, take, least, salt)
            simhash[here] = whole
            at.append(here[rows])
            out.append(found)
    m = np.diff(pair_first)
    here = np.flatnonzero(m > 0)
    if len(here):
        blocks, take, least = PAIR_LAYOUT
        count, sims, _ = _blocks(pairs, np.repeat(np.arange(len(here)), m[here]), len(here), blocks)
        rows, found = _meeting(count, sims, take, least, 9)
        at.append(here[rows])
        out.append(found)
    line = np.concatenate(at)
    order = np.argsort(line, kind="stable")
    return simhash, np.concatenate(out)[order], np.searchsorted(line[order], np.arange(lines + 1))


def _byte_pairs(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, few: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the byte pairs of the lines marked in ``few``, and each line's first."""
    plain = NORMAL[raw] if few.any() else raw
    out, n = [np.zeros(0, np.uint64)], np.zeros(len(starts) + 1, np.int64)
    for i in np.flatnonzero(few).tolist():
        b = np.frombuffer(b" " + b" ".join(plain[starts[i]:ends[i]].tobytes().split()) + b" ", np.uint8).astype(np.uint64)
        out.append(b[:-1] << np.uint64(8) | b[1:])
        n[i + 1] = len(b) - 1
    return H.mix(np.concatenate(out)), np.cumsum(n)


def _lengths(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Code points of each normalised line: those of its words, and a blank between two."""
    if not len(starts):
        return np.zeros(0, np.int64)
    return np.add.reduceat(COUNTED[raw], starts, dtype=np.int64) + np.maximum(n - 1, 0)      # a line ends where the next one starts


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def line_table(docs: DataFrame, min_words: int) -> DataFrame:
    """(id, digest, pos, key, simhash, n, chars, buckets): a header per document (pos -1, n its
    number of lines), and its lines of ``min_words`` words or more, n words each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            raw, offsets = H.text_bytes(b.column("text"))
            starts, ends, row, number, words, first = _line_rows(raw, offsets)
            n = np.diff(first)
            told = n >= max(min_words, 1)
            sim, buckets, begin = _sketch(words, first, *_byte_pairs(raw, starts, ends, told & (n < FEW)))
            keys, chars, long = _keys(words, first), _lengths(raw, starts, ends, n), np.flatnonzero(told)
            lines = np.bincount(row, minlength=b.num_rows)
            k = b.num_rows
            at = np.concatenate([np.arange(k), row[long]])
            none = np.zeros(k, np.uint64)
            size = np.where(told, np.diff(begin), 0)
            kept = buckets[np.repeat(told, np.diff(begin))].view(np.int64)
            ends_at = np.concatenate([np.zeros(k + 1, np.int32), np.cumsum(size[long])]).astype(np.int32)
            yield pa.record_batch([b.column("id").take(pa.array(at)), b.column("digest").take(pa.array(at)),
                                   pa.array(np.concatenate([np.full(k, -1), number[long]]).astype(np.int32)),
                                   pa.array(np.concatenate([none, keys[long]]).view(np.int64)), pa.array(np.concatenate([none, sim[long]]).view(np.int64)),
                                   pa.array(np.concatenate([lines, n[long]]).astype(np.int32)), pa.array(np.concatenate([np.zeros(k), chars[long]]).astype(np.int32)),
                                   pa.ListArray.from_arrays(pa.array(ends_at), pa.array(kept))], ["id", "digest", "pos", "key", "simhash", "n", "chars", "buckets"])

    return docs.select("id", "digest", "text").mapInArrow(run, "id long, digest long, pos int, key long, simhash long, n int, chars int, buckets array<long>")


def line_texts(docs: DataFrame, min_words: int, bits: np.ndarray) -> DataFrame:
    """(key, line): the normalised text of every line of ``min_words`` words or
    more whose bit is set; the caller's join decides."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            raw, offsets = H.text_bytes(b.column("text"))
            starts, ends, _, _, words, first = _line_rows(raw, offsets)
            keys = _keys(words, first)
            at = (keys & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
            set_ = (bits[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1
            long = np.flatnonzero((np.diff(first) >= min_words) & set_)
            keys = keys[long]
            texts = [" ".join(NORMAL[raw[s:e]].tobytes().decode("utf-8", "replace").split()) for s, e in zip(starts[long], ends[long])]
            yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(texts, pa.string())], ["key", "line"])

    return docs.select("text").mapInArrow(run, "key long, line string")


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance: common ends are cut off, the rest goes through Myers' bit vectors, one step per character."""
    n = min(len(a), len(b))
    i = 0
    while i < n and a[i] == b[i]:
        i += 1
    j = 0
    while j < n - i and a[len(a) - 1 - j] == b[len(b) - 1 - j]:
        j += 1
    a, b = a[i:len(a) - j], b[i:len(b) - j]
    if not a or not b:
        return len(a) + len(b)
    where: dict[str, int] = {}
    for k, c in enumerate(a):
        where[c] = where.get(c, 0) | (1 << k)
    full, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    plus, minus, distance = full, 0, len(a)
    for c in b:
        eq = where.get(c, 0)
        x = eq | minus
        d = ((((eq & plus) + plus) ^ plus) | eq) & full
        hp, hm = (minus | ~(d | plus)) & full, plus & d
        distance += bool(hp & top) - bool(hm & top)
        hp, hm = ((hp << 1) | 1) & full, (hm << 1) & full
        plus, minus = (hm | ~(x | hp)) & full, hp & x
    return distance


def _aligned(x: list[str], y: list[str], most: int) -> int:
    """At least the edit distance of two lines of words, or a number above ``most``: words that
    differ are replaced up to the nearest place, within ``AHEAD`` words, where both go on alike."""
    cost, i, j, m, n = 0, 0, 0, len(x), len(y)
    while i < m and j < n:
        if x[i] == y[j]:
            i += 1
            j += 1
            continue
        for p, q in AHEAD_STEPS:
            if i + p < m and j + q < n and x[i + p] == y[j + q]:
                break
        else:
            if m - i > AHEAD or n - j > AHEAD:
                return most + 1
            break
        cost += max(sum(map(len, x[i:i + p])) + p, sum(map(len, y[j:j + q])) + q)
        if cost > most:
            return cost
        i += p
        j += q
    return cost + max(sum(map(len, x[i:])) + m - i, sum(map(len, y[j:])) + n - j)


def similar(a: str, b: str, least: float) -> bool:
    """Is the edit similarity, 1 - distance / longer length, ``least`` or more? Bounds that are quick to take come first."""
    most = int((1 - least) * max(len(a), len(b)) + 1e-9)
    if abs(len(a) - len(b)) > most:
        return False
    x, y = a.split(" "), b.split(" ")
    if len(x) == len(y) and sum(max(len(p), len(q)) for p, q in zip(x, y) if p != q) <= most or _aligned(x, y, most) <= most:
        return True
    p, q = Counter(a), Counter(b)
    if max((p - q).total(), (q - p).total()) > most:        # each edit mends one character of either side at best
        return False
    return edit_distance(a, b) <= most


def _near(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose edit similarity, 1 - distance / longer length, is ``least`` or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            x, y = b.column("x").to_pylist(), b.column("y").to_pylist()
            ok = [similar(p, q, least) for p, q in zip(x, y)]
            yield pa.record_batch([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(ok))

    both = pairs.join(texts.select(F.col("key").alias("a"), F.col("line").alias("x")), "a")
    both = both.join(texts.select(F.col("key").alias("b"), F.col("line").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _shared(lines: DataFrame) -> DataFrame:
    """(bucket, key) of the buckets with more than one line; only the two numbers are sorted."""
    buckets = lines.select("key", F.explode("buckets").alias("bucket"))
    return buckets.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("bucket"))).where(F.col("_n") > 1).drop("_n")


def _met(shared: DataFrame, lines: DataFrame) -> DataFrame:
    """(bucket, key, simhash, chars, pivot, _s, _c, large, near) of the lines that may link in a bucket.

    In buckets of up to ``SMALL`` lines ``near`` has the close lines that follow,
    so lines that met by chance are gone.
    """
    buckets = shared.join(lines.select("key", "simhash", "chars", "times"), "key")
    w = Window.partitionBy("bucket").orderBy(F.col("times").desc(), "key")
    ahead = [F.lead(F.struct("key", "simhash", "chars"), k).over(w) for k in range(1, SMALL)]
    near = F.filter(F.array(*[F.when(_close(F.col("simhash"), F.col("chars"), x["simhash"], x["chars"]), x["key"]) for x in ahead]), lambda x: x.isNotNull())
    large = F.count(F.lit(1)).over(Window.partitionBy("bucket")) > SMALL
    m = buckets.select("bucket", "key", "simhash", "chars", F.first("key").over(w).alias("pivot"), F.first("simhash").over(w).alias("_s"),
                       F.first("chars").over(w).alias("_c"), large.alias("large"), near.alias("near"))
    return m.where(F.col("large") | (F.size("near") > 0))


def _bit_table(keys: DataFrame) -> np.ndarray:
    """A bit for each residue of the wanted keys, 2**25 of them whatever their number."""
    at = F.pmod("key", F.lit(1 << FILTER_BITS))
    filled = keys.groupBy(F.shiftright(at, 5).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(31).cast("long")).cast("int"))).alias("bits")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    bits[filled["word"].to_numpy()] = filled["bits"].to_numpy().astype(np.uint32)
    return bits


def _close(x: Column, x_chars: Column, y: Column, y_chars: Column) -> Column:
    """Lengths that a link allows, and SimHashes no further apart than linked lines have them."""
    low, high = F.least(x_chars, y_chars), F.greatest(x_chars, y_chars)
    return (low >= MIN_SIMILARITY * high) & ((low < GATED) | (F.bit_count(x.bitwiseXOR(y)) <= MAX_BITS))


def duplicate_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                    least: float = MIN_SIMILARITY) -> DataFrame:
    """One row per row of ``df``: ``id_col``, digest, n_lines, n_dropped and ``dropped``, the numbers of the lines that go.

    A line goes if a linked line, or a line linked to one, stands earlier by
    (id, digest of the text, line number), null ids first. Lines of fewer than
    ``min_words`` words stay (1: every line that has a word is compared, also one
    in a script without blanks, which counts as one word). Null texts have no lines; rows equal in id and
    text are one document with one result each; no rows give no rows; other
    columns are ignored.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = docs.withColumn("digest", F.xxhash64("text"))
    lines = stash(line_table(docs, min_words))
    heads, body = lines.where(F.col("pos") == -1), lines.where(F.col("pos") >= 0)
    first = F.min(F.struct("id", "digest", "pos"))
    distinct = stash(body.groupBy("key").agg(F.first("simhash").alias("simhash"), F.first("chars").alias("chars"), F.count(F.lit(1)).alias("times"),
                                             F.first("buckets").alias("buckets")))

    # Small buckets give their close pairs at once. In larger ones each variant first meets the most
    # frequent one; then pairs across what that connects.
    shared = stash(_shared(distinct))
    met = stash(_met(shared, distinct))
    many = stash(distinct.where("times > 1").select("key"))
    discard(distinct, shared)
    small = met.where(~F.col("large")).select(F.col("key").alias("a"), F.explode("near").alias("b"))
    crowd = met.where("large").drop("near")
    close = _close(F.col("simhash"), F.col("chars"), F.col("_s"), F.col("_c"))
    star = crowd.where((F.col("key") != F.col("pivot")) & close).select(F.col("key").alias("a"), F.col("pivot").alias("b"))
    star = stash(_pairs(star.union(small)))
    may = stash(crowd.select("key").union(star.select("a")).union(star.select("b")).distinct())
    texts = stash(line_texts(docs, min_words, _bit_table(may)).join(may, "key").dropDuplicates(["key"]))
    links = stash(_near(star, texts, least))
    labels = components(links)
    across = _pairs(_across(crowd, labels)).join(star, ["a", "b"], "left_anti")
    labels = extended(labels, stash(_near(across, texts, least)))
    discard(met, star, may, texts, links)

    # Lines that stand once and are linked with none stay: only the others are placed.
    labels = labels.withColumnRenamed("node", "key")
    groups = many.union(labels.select("key")).distinct().join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    placed = body.join(groups, "key")
    place = F.struct("id", "digest", "pos")
    stays = placed.groupBy("label").agg(F.min(place).alias("stays"), F.max(place).alias("last")).where(F.col("stays") != F.col("last"))
    goes = placed.join(stays, "label").where(place != F.col("stays"))
    dropped = goes.groupBy("id", "digest").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
    d = dropped.select(F.col("id").alias("_i"), F.col("digest").alias("_d"), "dropped")
    out = heads.join(d, heads["id"].eqNullSafe(d["_i"]) & (heads["digest"] == d["_d"]), "left")
    gone = F.coalesce("dropped", F.array().cast("array<int>"))
    return out.select(F.col("id").alias(id_col), "digest", F.col("n").alias("n_lines"), F.size(gone).alias("n_dropped"), gone.alias("dropped"))


def _pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _across(crowd: DataFrame, labels: DataFrame) -> DataFrame:
    """Close pairs (a, b) that share a bucket but no component of ``labels``."""
    m = crowd.join(labels.withColumnRenamed("node", "key"), "key", "left").select("bucket", "key", "simhash", "chars", F.coalesce("label", "key").alias("label"))
    several = m.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where(F.col("low") != F.col("high"))
    m = stash(m.join(several.select("bucket"), "bucket"))
    x = m.select("bucket", F.col("key").alias("a"), F.col("simhash").alias("_x"), F.col("chars").alias("_n"), F.col("label").alias("_l"))
    y = m.select("bucket", F.col("key").alias("b"), F.col("simhash").alias("_y"), F.col("chars").alias("_o"), F.col("label").alias("_m"))
    near = _close(F.col("_x"), F.col("_n"), F.col("_y"), F.col("_o"))
    return x.join(y, (x["bucket"] == y["bucket"]) & (F.col("a") < F.col("b")) & (F.col("_l") != F.col("_m")) & near).select("a", "b")


def without_lines(df: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with the lines that ``found`` (of :func:`duplicate_lines`) drops taken out of its texts."""
    f = found.select(F.col(id_col).alias("_i"), F.col("digest").alias("_d"), F.col("dropped").alias("_dropped")).where(F.size("_dropped") > 0).distinct()
    digest = F.xxhash64(F.coalesce(df[text_col], F.lit("")))
    j = df.join(f, df[id_col].eqNullSafe(f["_i"]) & (digest == f["_d"]), "left")
    kept = F.filter(F.split(text_col, "\n", -1), lambda _, i: ~F.array_contains("_dropped", i))
    return j.withColumn(text_col, F.when(F.col("_dropped").isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))).drop("_i", "_d", "_dropped")
