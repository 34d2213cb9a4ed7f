"""Quality rules: base features and cross-document line frequency, in Spark SQL.

Lines are normalised and hashed; the distinct documents of each (host, line)
are counted; lines of five words or 40 characters (parameters) above a number
of documents that doesn't grow with the host are removed, and documents that lose more than half of their words that way are
rejected. Exact copies of a text count once, as one document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import SPACES, stash, words

# --- fixed values of the base rules ---
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
# --------------------------------------
LINE_LIMIT = 10         # distinct documents of a host that may share a line
LINE_SHARE = 0.0        # ... and their share of the host's distinct documents, if a caller wants one
LINE_WORDS, LINE_CHARS = 5, 40      # lines of fewer words and characters stay: headings, dates and list marks recur in good documents
MIN_LEFT_PERCENT = 50   # words that a document must keep


def base_features(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words (long) and base_failed. Null text: no words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    solid = F.translate(text, SPACES, "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    d = df.select("*", words(F.col(text_col)).alias("_words"), lines.alias("_lines"),
                  F.length(solid).cast("long").alias("word_chars"),
                  (F.length(solid) - F.length(F.translate(solid, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    n = F.size("_words")
    w = F.col("_words")
    windows = F.when(n < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))
    d = d.select("*", n.cast("long").alias("n_words"),
                 (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
                 windows.alias("_h")).drop("_words", "_lines")
    h = F.col("_h")
    repeats = F.size(F.array_distinct(h)) < F.size(h)
    d = d.withColumn("_at", F.when(repeats, F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    at = F.col("_at")
    twice = F.transform(F.filter(F.transform(at, lambda x, k: F.struct(
        (((k > 0) & (F.get(at, k - 1)["h"] == x["h"])) | F.coalesce(F.get(at, k + 1)["h"] == x["h"], F.lit(False))).alias("twice"), x["i"].alias("i"))),
        lambda x: x["twice"]), lambda x: x["i"])
    covered = F.aggregate(F.sort_array(twice), F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
                          lambda s, i: F.struct((s["n"] + F.least(F.lit(3), i - s["last"])).alias("n"), i.alias("last")), lambda s: s["n"])
    d = d.select("*", F.when(repeats, covered).otherwise(F.lit(0)).cast("long").alias("n_repeat_words")).drop("_h", "_at")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return d.withColumn("base_failed", failed)


def normal_line(line: Column) -> Column:
    """Lower case, runs of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D]+", " "))


def line_table(text: Column) -> Column:
    """The text's lines as (hash of the normalised line, words, characters); lines without a word have hash null."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: _line(normal_line(x)))


def _line(norm: Column) -> Column:
    blanks = F.length(norm) - F.length(F.translate(norm, " ", ""))
    return F.struct(F.when(norm != "", F.xxhash64(norm)).alias("h"), F.when(norm != "", blanks + 1).otherwise(F.lit(0)).alias("w"), F.length(norm).alias("c"))


def frequent_lines(lines: DataFrame, limit: int = LINE_LIMIT, share: float = LINE_SHARE) -> DataFrame:
    """(host, h) of the lines in more than ``limit`` distinct documents and more than ``share`` of their host's.

    ``lines``: host, h, text_key, one row for each line of a document or more.
    Counts are aggregated before and after the shuffle, so a line that stands in
    every document costs each task one row.
    """
    often = lines.groupBy("host", "h", "text_key").agg(F.lit(1).alias("one")).groupBy("host", "h").agg(F.count(F.lit(1)).alias("n"))
    often = often.where(F.col("n") > limit)
    if share <= 0:
        return often.select("host", "h")
    docs = lines.groupBy("host", "text_key").agg(F.lit(1).alias("one")).groupBy(F.col("host").alias("_host")).agg(F.count(F.lit(1)).alias("docs"))
    return often.join(docs, often["host"].eqNullSafe(docs["_host"])).where(F.col("n") > share * F.col("docs")).select("host", "h")


def quality_rules(df: DataFrame, keep: list[str] | None = None, host_col: str = "source", text_col: str = "text",
                  limit: int = LINE_LIMIT, share: float = LINE_SHARE, min_left_percent: int = MIN_LEFT_PERCENT,
                  line_words: int = LINE_WORDS, line_chars: int = LINE_CHARS) -> DataFrame:
    """The columns ``keep`` (default: all) with the base features, ``removed_words``,
    ``removed`` (hashes of the document's removed lines; null if none) and ``kept``.

    One row per row of ``df``. A document is kept unless a base rule fails or
    fewer than ``min_left_percent`` of its words stand outside lines of
    ``line_words`` words or ``line_chars`` characters that more than ``limit`` distinct documents and
    more than ``share`` of those of its host hold. Null text has no words
    and fails; a null host is a host; repeated rows count once and are judged
    alike; no rows give no rows. Columns of ``df`` named like a result are
    replaced.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c not in RESULTS]
    base = base_features(df.select(*keep, F.col(host_col).alias("_host"), F.col(text_col).alias("_text")), "_text")
    base = base.withColumn("_key", F.xxhash64("_text")).withColumn("_lines", line_table(F.col("_text"))).drop("_text")
    base = stash(base.withColumn("_row", F.monotonically_increasing_id()))
    lines = base.select("_row", F.col("_host").alias("host"), F.col("_key").alias("text_key"), F.explode("_lines").alias("l"))
    lines = lines.select("_row", "host", "text_key", "l.h", "l.w", "l.c").where(
        F.col("h").isNotNull() & ((F.col("w") >= line_words) | (F.col("c") >= line_chars))).drop("c")
    often = stash(frequent_lines(lines, limit, share))
    o = often.select(F.col("host").alias("_h1"), F.col("h").alias("_h2"))
    hits = lines.join(o, lines["host"].eqNullSafe(o["_h1"]) & (lines["h"] == o["_h2"]))
    lost = hits.groupBy("_row").agg(F.sum("w").alias("_lost"), F.collect_set("h").alias("removed"))
    out = base.join(lost.withColumnRenamed("_row", "_r"), base["_row"] == F.col("_r"), "left")
    removed = F.coalesce(F.col("_lost"), F.lit(0)).cast("long")
    kept = ~F.col("base_failed") & (100 * (F.col("n_words") - removed) >= min_left_percent * F.col("n_words"))
    return out.select(*keep, *FEATURES, "base_failed", removed.alias("removed_words"), "removed", kept.alias("kept"))


FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RESULTS = [*FEATURES, "base_failed", "removed_words", "removed", "kept"]


def without_lines(text: Column, removed: Column) -> Column:
    """``text`` without the lines whose hash is in ``removed`` (null: the text as it is)."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: ~F.coalesce(F.array_contains(removed, _line(normal_line(x))["h"]), F.lit(False)))
    return F.when(removed.isNull(), text).otherwise(F.array_join(lines, "\n"))


def clean_documents(df: DataFrame, host_col: str = "source", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The kept rows of ``df``, their texts without the removed lines; ``length_col`` is set to the text's code points."""
    judged = quality_rules(df, host_col=host_col, text_col=text_col).where("kept")
    out = judged.withColumn(text_col, without_lines(F.col(text_col), F.col("removed")))
    if length_col:
        out = out.withColumn(length_col, F.length(text_col).cast(df.schema[length_col].dataType))
    return out.select(*df.columns)
