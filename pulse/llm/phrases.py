"""Phrase collocations by Toivonen's sampling: exact counts of the phrases that occur often.

A sample of the documents proposes phrases (those it holds often enough at a
lowered limit). A pass over all documents then counts exactly the proposed
phrases and their negative border, the phrases that were not proposed but all of
whose shorter parts were (every word, and every longer phrase whose two parts
without the last and without the first word were proposed). If a phrase of the
border turns out to be frequent, phrases that hold it were not counted yet: it
joins the proposed ones and another pass counts what the border has gained. The
set is closed when no pass adds to it; the counts are then those of all
documents, whatever the sample proposed.

Which phrases are proposed is kept in one bit table per length, of a fixed size
(``2**filter_bits`` bits) whatever the corpus: a bit set by chance only means
that a phrase is counted in vain. Tasks hash words and count n-grams in Arrow
batches with numpy and hand on one row per distinct phrase of some hundred
thousand words; the rest is grouping and joins. A word is known by 64 bits of its language and text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.llm import hashing as H
from pulse.llm.common import stash

# --- fixed values: the contract's classes ---
BREAKS = ".,;:!?\x0a\x0b\x0c\x0d"       # end a piece
BLANKS = "\x20\x09"                      # separate the words of a piece
NO_LANGUAGE = "und"
SCALE = 1_000_000
# ---------------------------------------------
MIN_COUNT, MAX_WORDS, TOP = 10, 3, 2000
INSIDE_PERCENT = 50             # a candidate goes if a longer one holds this share of its occurrences
SAMPLE, SAMPLE_COUNT = 0.05, 2  # share of the documents that proposes phrases, and how often they must stand there
FILTER_BITS = 24                # 2 MB a table
BUFFER = 1 << 16                # n-grams of a length that a task holds before it counts them
BATCH_BYTES = 1 << 18           # text bytes worked on at a time (a longer text is one batch)

BREAK = np.zeros(256, bool)
BREAK[list(BREAKS.encode())] = True
AS_BLANK = np.arange(256, dtype=np.uint8)
AS_BLANK[list((BREAKS + BLANKS).encode())] = 0x20
LINK = np.uint64(0xD6E8FEB86659FD93)


Tables = dict[int, np.ndarray]          # bit tables by length


def _w(max_words: int) -> list[str]:
    return [f"w{i}" for i in range(max_words)]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of about BATCH_BYTES bytes of text (column 0)."""
    for b in batches:
        offsets = np.concatenate([[0], np.cumsum(pc.binary_length(b.column(0)).to_numpy(zero_copy_only=False), dtype=np.int64)])
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BATCH_BYTES, "right")) - 1)
            yield b.slice(at, to - at)
            at = to
        b = None        # not held while the next one is read


def _words(b: pa.RecordBatch):
    """Hash, start and end of every word of a batch (text, language key), the key of its
    language, the piece it stands in, and the lower-cased bytes."""
    raw, offsets = H.text_bytes(b.column(0))
    raw = H.LOWER[raw]
    words, starts, ends, first = H.word_hashes(AS_BLANK[raw], offsets, lower=False)
    row = np.repeat(np.arange(b.num_rows), np.diff(first))
    keys = b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)[row]
    words = H.mix(words ^ H.mix(keys))
    words[words == 0] = 1                   # 0 fills the columns that a shorter phrase leaves
    piece = np.searchsorted(np.flatnonzero(BREAK[raw]), starts) + row
    return words, starts, ends, keys, piece, raw


def _next(hashes: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of phrases from those without their last word and that word's."""
    return H.mix(hashes * LINK + last)


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes & np.uint64(len(bits) * 32 - 1)).astype(np.int64)
    return (bits[at >> 5] >> (at & 31).astype(np.uint32)) & np.uint32(1) == 1


class _Counter:
    """Counts of one length's phrases: rows of (hash, the output's columns..., count), summed when there are many."""

    def __init__(self):
        self.parts, self.held, self.counted = [], 0, 0

    def add(self, rows: list[np.ndarray]) -> None:
        self.parts.append(rows)
        self.held += len(rows[0])

    def sum(self) -> list[np.ndarray] | None:
        if not self.parts:
            return None
        rows = [np.concatenate(c) for c in zip(*self.parts)]
        order = np.argsort(rows[0], kind="stable")
        hashes = rows[0][order]
        begin = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
        counts = np.add.reduceat(rows[-1][order], begin) if len(begin) else rows[-1]
        out = [c[order[begin]] for c in rows[:-1]] + [counts]
        self.parts, self.held = [out], len(begin)
        self.counted = self.held
        return out

    def full(self) -> list[np.ndarray] | None:
        """The summed rows, once about BUFFER distinct ones are held."""
        if self.held - self.counted < BUFFER:
            return None
        rows = self.sum()
        if self.held < BUFFER // 2:
            return None
        self.parts, self.held, self.counted = [], 0, 0
        return rows


def count_pass(docs: DataFrame, max_words: int, new: Tables | None, old: Tables | None) -> DataFrame:
    """(lang_key, w0.., n): phrases of ``docs`` (text, lang_key) with their counts.

    ``new`` and ``old`` are bit tables by length. Counted is a phrase whose two
    parts are in ``new`` and were not both in ``old`` (an earlier pass counted
    those); without ``new`` every phrase is. The first pass (no ``old``) also
    counts every word, with its language's key, and each language's words (a row
    without words). Longer phrases have language key 0.
    """
    names = ["lang_key", *_w(max_words), "n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = [_Counter() for _ in range(max_words + 1)]

        def rows(k: int, r: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if len(r[0]):
                none = np.zeros(len(r[0]), np.uint64)
                columns = r[1:-1] if k < 2 else [none, *r[1:-1]]
                columns = [*columns, *[none] * (max_words + 1 - len(columns))]
                yield pa.record_batch([*(pa.array(c.view(np.int64)) for c in columns), pa.array(r[-1])], names)

        for b in _chunks(batches):
            words, _, _, keys, piece, _ = _words(b)
            b = None
            if not len(words):
                continue
            one = np.ones(len(words), np.int64)
            if old is None:
                counters[0].add([keys, keys, one])
                counters[1].add([words, keys, words, one])
            hashes = words
            for k in range(2, max_words + 1):
                m = len(words) - k + 1
                if m <= 0:
                    break
                at = piece[:m] == piece[k - 1:]
                if new is not None:
                    parts = hashes[:-1], hashes[1:]
                    at &= _has(new[k - 1], parts[0]) & _has(new[k - 1], parts[1])
                    if old is not None:
                        at &= ~(_has(old[k - 1], parts[0]) & _has(old[k - 1], parts[1]))
                hashes = _next(hashes[:-1], words[k - 1:])
                at = np.flatnonzero(at)
                if len(at):
                    counters[k].add([hashes[at], *(words[at + j] for j in range(k)), np.ones(len(at), np.int64)])
            for k, c in enumerate(counters):
                if (r := c.full()) is not None:
                    yield from rows(k, r)
        for k, c in enumerate(counters):
            if (r := c.sum()) is not None:
                yield from rows(k, r)

    schema = ", ".join(f"{c} long" for c in names)
    return docs.mapInArrow(run, schema).groupBy(*names[:-1]).agg(F.sum("n").alias("n"))


def size_of(max_words: int) -> Column:
    """Words of a counted phrase."""
    return sum((F.when(F.col(c) != 0, 1).otherwise(0) for c in _w(max_words)), F.lit(0))


def bit_tables(phrases: DataFrame, max_words: int, filter_bits: int, known: Tables | None = None) -> Tables:
    """For each length below ``max_words`` a bit table of its phrases' hashes, those of ``known`` included.

    Only words of a table with bits that ``known`` lacks reach the driver, at
    most ``2**(filter_bits - 5)`` a length however many phrases there are.
    """
    w, mask = _w(max_words), np.uint64((1 << filter_bits) - 1)
    known = known or {k: np.zeros(1 << max(filter_bits - 5, 0), np.uint32) for k in range(1, max_words)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = [b.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in w]
            hashes, left = columns[0], np.arange(len(columns[0]))
            for k in range(1, max_words):       # the rows that are left have k words or more
                ends = columns[k][left] == 0
                whole = hashes[ends]
                at = (whole[~_has(known[k], whole)] & mask).astype(np.int64)
                if len(at):
                    yield pa.record_batch([pa.array(np.full(len(at), k, np.int32)), pa.array(at)], ["size", "at"])
                left, hashes = left[~ends], hashes[~ends]
                hashes = _next(hashes, columns[k][left])

    at = phrases.select(*w).where((F.col("w0") != 0) & (F.col(w[-1]) == 0)).mapInArrow(run, "size int, at long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("at") % 32).cast("int"))
    cells = at.groupBy("size", F.shiftright("at", 5).cast("int").alias("cell")).agg(F.bit_or(bit).alias("bits")).toArrow()
    tables = {}
    for k, bits in known.items():
        part = cells.filter(pc.equal(cells["size"], k))
        tables[k] = bits.copy() if len(part) else bits
        tables[k][part["cell"].to_numpy()] |= part["bits"].to_numpy().astype(np.uint32)
    return tables


def frequent_phrases(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, sample: float = SAMPLE,
                     sample_count: int = SAMPLE_COUNT, filter_bits: int = FILTER_BITS) -> tuple[DataFrame, int]:
    """The phrases of up to ``max_words`` words with ``min_count`` occurrences or more, and the number of full passes.

    ``docs``: text, lang_key. Rows as :func:`count_pass` has them; the rows
    without words hold each language's number of words. The sample only steers
    the passes: any share of documents, none included, gives the same rows.
    """
    pick = F.pmod(F.xxhash64("text", F.lit("sample")), F.lit(1 << 20)) < int(sample * (1 << 20))
    proposed = count_pass(docs.where(pick), max_words, None, None).where(F.col("n") >= sample_count)
    new, old, out = bit_tables(proposed, max_words, filter_bits), None, []
    while True:
        frequent = stash(count_pass(docs, max_words, new, old).where((F.col("n") >= min_count) | (F.col("w0") == 0)))
        out.append(frequent)
        grown = bit_tables(frequent, max_words, filter_bits, new)
        if all(grown[k] is new[k] for k in new):        # no phrase of the border is frequent
            return reduce(DataFrame.unionByName, out), len(out)
        new, old = grown, new


def cut_scores(phrases: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """(w0.., lang_key, a, l, r, score) of the phrases of two words or more, by their weakest cut.

    Each cut's two parts are joined with the same table; adaptive execution
    splits a part that begins or ends very many phrases. The score is
    floor(10^6 a a / (l r)) in decimals of 38 digits, exact for counts up to 10^15.
    """
    w = _w(max_words)
    none = F.lit(0).cast("long")
    parts = []
    for k in range(1, max_words):
        left = [F.col(c) for c in w[:k]] + [none] * (max_words - k)
        right = [F.col(c) for c in w[k:]] + [none] * k
        parts += [F.struct(F.lit(2 * k + s).alias("part"), *(p.alias(f"p{i}") for i, p in enumerate(side))) for s, side in ((0, left), (1, right))]
    cut = (F.col("part") / 2).cast("int")
    long = phrases.where(F.col("w1") != 0).select(*w, F.col("n").alias("a"), F.inline(F.array(*parts)))
    long = long.where((cut < size_of(max_words)))
    known = phrases.where(F.col("w0") != 0).select(*(F.col(c).alias(f"p{i}") for i, c in enumerate(w)), F.col("n").alias("f"), F.col("lang_key").alias("key"))
    joined = long.join(known, [f"p{i}" for i in range(max_words)])
    of = [F.max(F.when(F.col("part") == 2 * k + s, F.col("f"))).alias(f"{side}{k}") for k in range(1, max_words) for s, side in ((0, "l"), (1, "r"))]
    wide = joined.groupBy(*w, "a").agg(F.max(F.when(F.col("part") == 2, F.col("key"))).alias("lang_key"), *of)
    cuts = []
    for k in range(1, max_words):
        num = F.col("a").cast("decimal(19,0)") * F.col("a").cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(7,0)")
        den = F.col(f"l{k}").cast("decimal(19,0)") * F.col(f"r{k}").cast("decimal(19,0)")
        score = F.call_function("div", num, den)
        cuts.append(F.when(F.col(f"l{k}").isNotNull(), F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))))
    wide = wide.select(*w, "lang_key", "a", F.array_min(F.array_compact(F.array(*cuts))).alias("c"))
    return wide.select(*w, "lang_key", "a", "c.l", "c.r", "c.score")


def not_inside(scored: DataFrame, phrases: DataFrame, max_words: int = MAX_WORDS, percent: int = INSIDE_PERCENT) -> DataFrame:
    """The scored phrases that no longer frequent phrase holds in ``percent`` of their occurrences or more.

    A phrase's count is at most that of its parts, so one more word decides: if
    a much longer phrase holds that share, so does the one between them.
    """
    w = _w(max_words)
    none = F.lit(0).cast("long")
    size = size_of(max_words)
    longer = phrases.where(F.col("w1") != 0).where(size >= 3)
    last = [F.when(size == i + 1, none).otherwise(F.col(c)) for i, c in enumerate(w)]
    first = [*(F.col(c) for c in w[1:]), none]
    sides = [F.struct(*(p.alias(f"q{i}") for i, p in enumerate(side))) for side in (last, first)]
    held = longer.select("n", F.inline(F.array(*sides))).groupBy(*(f"q{i}" for i in range(max_words))).agg(F.max("n").alias("held"))
    on = reduce(lambda x, y: x & y, (F.col(c) == F.col(f"q{i}") for i, c in enumerate(w)))
    return scored.join(held, on, "left").where(F.col("held").isNull() | (100 * F.col("held") < percent * F.col("a"))).select(*scored.columns)


def word_texts(docs: DataFrame, wanted: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(w, word): the texts of the words in ``wanted`` (w), found by one more pass.

    A bit table of fixed size spares nearly all others. Two words of one hash are
    noticed and raise an error.
    """
    bits = bit_tables(wanted.select(F.col("w").alias("w0"), F.lit(0).cast("long").alias("w1")), 2, filter_bits)[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, bytes] = {}
        for b in _chunks(batches):
            words, starts, ends, _, _, raw = _words(b)
            b = None
            at = np.flatnonzero(_has(bits, words))
            _, first = np.unique(words[at], return_index=True)
            at = at[first]
            fresh = [i for i in at.tolist() if int(words[i]) not in seen]
            if fresh:
                texts = [raw[starts[i]:ends[i]].tobytes() for i in fresh]
                if len(seen) > BUFFER:
                    seen.clear()
                seen.update((int(words[i]), b"") for i in fresh)
                yield pa.record_batch([pa.array(words[fresh].view(np.int64)), pa.array(texts, pa.binary()).cast(pa.string())], ["w", "word"])

    found = docs.mapInArrow(run, "w long, word string").groupBy("w").agg(F.min("word").alias("word"), F.max("word").alias("other"))
    same = F.when(F.col("word") == F.col("other"), F.col("word")).otherwise(F.raise_error(F.lit("two words share a hash")))
    return found.join(wanted.select(F.col("w").alias("_w")).distinct(), F.col("w") == F.col("_w"), "left_semi").select("w", same.alias("word"))


def collocations(df: DataFrame, text_col: str = "text", lang_col: str | None = "lang", top: int = TOP, min_count: int = MIN_COUNT,
                 max_words: int = MAX_WORDS, inside_percent: int = INSIDE_PERCENT, sample: float = SAMPLE,
                 sample_count: int = SAMPLE_COUNT, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and
    into words at blanks and tabs. A phrase of 2 to ``max_words`` words within a
    piece with a >= ``min_count`` occurrences is a candidate; l and r are the
    counts of its two parts at the cut with the least floor(10^6 a a / (l r)), n
    all words of the language. One that a longer candidate holds in
    ``inside_percent`` of its occurrences goes. Ranked by score, a (descending)
    and phrase (UTF-8 bytes). Null texts are empty, a null language is ``und``
    (``lang_col`` None: all are); repeated rows count each time; bytes that are
    not UTF-8 count as U+FFFD; texts are read whole; no rows or no candidates give no rows.
    """
    if max_words < 2:
        raise ValueError("phrases have two words or more")
    w = _w(max_words)
    lang = F.coalesce(F.col(lang_col), F.lit(NO_LANGUAGE)) if lang_col else F.lit(NO_LANGUAGE)
    rows = df.select(F.make_valid_utf8(F.coalesce(F.col(text_col), F.lit(""))).alias("text"), lang.alias("lang"))
    langs = rows.groupBy("lang").agg(F.lit(1).alias("_one")).select("lang", F.xxhash64("lang").alias("lang_key"))
    docs = rows.select("text", F.xxhash64("lang").alias("lang_key"))
    phrases, _ = frequent_phrases(docs, min_count, max_words, sample, sample_count, filter_bits)
    kept = not_inside(cut_scores(phrases, max_words), phrases, max_words, inside_percent)
    # a language's candidates are cut in as many parts as the session shuffles to, then those left together; ties stay for the text to decide
    order = [F.desc("score"), F.desc("a")]
    part = F.pmod(F.xxhash64(*w), F.lit(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    best = kept.withColumn("_part", part).withColumn("_at", F.rank().over(Window.partitionBy("lang_key", "_part").orderBy(*order))).where(F.col("_at") <= top)
    best = best.withColumn("_at", F.rank().over(Window.partitionBy("lang_key").orderBy(*order))).where(F.col("_at") <= top)
    best = stash(best.select(*w, "lang_key", "a", "l", "r", "score"))
    words = best.select(F.explode(F.array(*w)).alias("w")).where(F.col("w") != 0)
    texts = word_texts(docs, words, filter_bits)
    spelt = best.select("*", F.posexplode(F.array(*w)).alias("_i", "w")).join(texts, "w")
    spelt = spelt.groupBy(*best.columns).agg(F.array_sort(F.collect_list(F.struct("_i", "word"))).alias("_words"))      # at most max_words a group
    spelt = spelt.withColumn("phrase", F.array_join(F.transform("_words", lambda x: x["word"]), " "))
    totals = phrases.where(F.col("w0") == 0).select("lang_key", F.col("n").alias("n"))
    ranked = spelt.withColumn("rank", F.row_number().over(Window.partitionBy("lang_key").orderBy(*order, "phrase")).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang_key").join(langs, "lang_key").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
