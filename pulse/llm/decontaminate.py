"""Benchmark decontamination by templates, in Spark SQL.

Numbers, names and units become typed placeholders, so a question that was
copied with other values keeps its template. Windows of template words of the
documents meet those of the benchmark in a hash join. Where a template has
slots, the values on both sides must map one to one over the whole match:
``3 apples ... 3 pears`` may become ``5 ... 5`` but not ``5 ... 6``.
Names are told by their capitals, so a copy in other letter case has another
template: the lower-cased words go through the same join in windows of their
own, and an item of fewer words than a window as one window of all its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import stash

WINDOW = 8              # template words that must agree in a row
MIN_LITERAL = 4         # of those, words that are no placeholder
MIN_WINDOWS = 6         # windows that must agree at one offset (13 words), or all of a shorter item
BROADCAST_ROWS = 500_000
# --- fixed values: unit words, and the marks of placeholders (a caseless letter first) ---
UNITS = ("mm|cm|m|km|inch|inches|foot|feet|ft|yard|yards|mile|miles|mg|g|kg|gram|grams|ton|tons|ounce|ounces|oz|lb|lbs|pound|pounds|"
         "ml|l|liter|liters|litre|litres|gallon|gallons|s|sec|second|seconds|min|minute|minutes|h|hour|hours|day|days|week|weeks|month|months|"
         "year|years|percent|dollar|dollars|euro|euros|cent|cents|mph|kmh|degree|degrees")
NUMBER_MARK, UNIT_MARK, NAME_MARK = "ªd", "ªu", "ªn"
# -----------------------------------------------------------------------------------------
TOKEN = r"[\p{L}\p{N}]+(?:[.,]\p{N}+)*"
EDGE = r"(?![\p{L}\p{N}])"
NUMBER = r"(?<![\p{L}\p{N}])\p{N}+(?:[.,]\p{N}+)*"


def template_text(text: Column) -> Column:
    """The text with numbers, units (after a number) and names (capitalised words
    that don't begin a sentence) as marks, in lower case; each mark takes the place of one token."""
    named = F.regexp_replace(text, r"(?<=[\p{L}\p{N},;][ \n])\p{Lu}[\p{L}\p{N}]+", NAME_MARK)
    lower = F.lower(named)
    numbers = F.regexp_replace(lower, f"{NUMBER}{EDGE}", NUMBER_MARK)
    glued = F.regexp_replace(numbers, f"{NUMBER}(?:{UNITS}){EDGE}", NUMBER_MARK + UNIT_MARK)
    return F.regexp_replace(glued, f"(?<={NUMBER_MARK} )(?:{UNITS}){EDGE}", UNIT_MARK)


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def _hashes(tokens: str, window: int, *salt: Column) -> Column:
    """Hashes of the windows of a column of token hashes; empty if too short."""
    t, n = F.col(tokens), F.size(tokens)
    hashes = F.transform(F.sequence(F.lit(0), F.greatest(n - window, F.lit(0))),
                         lambda i: F.xxhash64(*salt, *[F.get(t, i + k) for k in range(window)]))
    return F.when(n >= window, hashes).otherwise(F.array().cast("array<bigint>"))


def _with_windows(df: DataFrame, text_col: str, window: int) -> DataFrame:
    """``df`` with ``_tokens`` (hashes of template words) and ``_windows`` (hashes of windows; empty if too short)."""
    d = df.withColumn("_words", _tokens(template_text(F.coalesce(F.col(text_col), F.lit("")))))
    d = d.withColumn("_tokens", F.transform("_words", lambda w: F.xxhash64(w)))
    return d.withColumn("_windows", _hashes("_tokens", window))


def _with_plain(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` with ``_plain`` (hashes of the lower-cased words)."""
    return df.withColumn("_plain", F.transform(_tokens(F.lower(F.coalesce(F.col(text_col), F.lit("")))), lambda w: F.xxhash64(w)))


def _plain_windows(length: int) -> Column:
    """Hashes of the windows of ``length`` plain words, apart from those of template words and of other lengths."""
    return _hashes("_plain", length, F.lit("plain"), F.lit(length))


def _slots(text: Column) -> tuple[Column, Column]:
    """Template words and the lower-cased words of a text, one for one."""
    return _tokens(template_text(text)), _tokens(F.lower(text))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text: str = "text", window: int = WINDOW, min_literal: int = MIN_LITERAL, min_windows: int = MIN_WINDOWS, plain: bool = False) -> DataFrame:
    """(id, text_key, item, n_windows, item_windows, reparameterised): the documents that hold a benchmark item.

    One row for each distinct (id, text) and item of which at least
    ``min_windows`` windows agree at one offset (all of them in a shorter item),
    with consistent slots. Windows with fewer than ``min_literal`` plain words
    prove nothing and are left out; items of fewer than ``window`` words never
    match as templates. With ``plain``, as many windows of the lower-cased words
    prove a copy as well, whatever its letter case and however few of its words
    are no placeholder; an item of fewer than ``window`` words is one window of
    all its words, and only items without a word never match. The counts are
    those of the template where it matches. Null ids are values, null texts are empty, repeated rows
    of either table give one row, extra columns are ignored; no documents or items give no rows.
    """
    items = stash(_with_windows(benchmark.select(F.col(item_col).alias("item"), F.coalesce(F.col(item_text), F.lit("")).alias("_item_text")).distinct(), "_item_text", window)
                  .select("item", "_item_text", "_words", "_windows"))
    marks = F.transform("_words", lambda w: w.startswith("ª").cast("int"))
    b = items.withColumn("_marks", marks).select("item", "_item_text", F.size("_windows").alias("item_windows"), "_marks",
                                                 F.posexplode_outer("_windows").alias("ipos", "h")).where(F.col("h").isNotNull())
    inside = F.aggregate(F.slice("_marks", F.col("ipos") + 1, F.lit(window)), F.lit(0), lambda s, x: s + x)
    b = b.withColumn("slots", inside).where(F.col("slots") <= window - min_literal)
    by_item = F.count(F.lit(1)).over(_by("item", "_item_text"))
    b = b.withColumn("item_windows", by_item).withColumn("item_key", F.xxhash64("_item_text")).withColumn("length", F.lit(0))
    b = b.select("item", "item_key", "item_windows", "ipos", "h", "slots", "length")
    lengths: list[int] = []     # of plain windows; template windows have length 0
    if plain:
        words = stash(_with_plain(items.select("item", F.xxhash64("_item_text").alias("item_key"), "_item_text"), "_item_text").drop("_item_text")
                      .withColumn("length", F.least(F.size("_plain"), F.lit(window))))
        lengths = sorted(r[0] for r in words.where(F.col("length") > 0).select("length").distinct().collect())      # at most ``window`` numbers
        for n in lengths:
            own = words.where(F.col("length") == n).withColumn("h", _plain_windows(n))
            b = b.union(own.select("item", "item_key", F.size("h").alias("item_windows"), F.posexplode("h").alias("ipos", "h"), F.lit(0).alias("slots"), "length"))
    b = stash(b)

    d = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("_doc_text")).withColumn("text_key", F.xxhash64("_doc_text"))
    # Outer: for the inner form Spark infers a filter on the array's size and pushes it, with the
    # whole tokenising copied into it, below the projections.
    # Plain windows follow the template's; their offsets are all shifted alike.
    w = _with_windows(d, "_doc_text", window)
    w = (_with_plain(w, "_doc_text") if lengths else w).withColumn("_all", F.concat("_windows", *[_plain_windows(n) for n in lengths]))
    w = w.select("id", "text_key", F.posexplode_outer("_all").alias("pos", "_h"))
    small = b.count() <= BROADCAST_ROWS     # a checked size; beyond it Spark joins by shuffle
    hits = w.join(F.broadcast(b) if small else b, w["_h"] == b["h"])
    hits = stash(hits.select("id", "text_key", "pos", "item", "item_key", "item_windows", "ipos", "slots", "length").distinct())

    keys = ["id", "text_key", "item", "item_key"]
    runs = hits.groupBy(*keys, "length", "item_windows", (F.col("pos") - F.col("ipos")).alias("offset")).agg(
        F.countDistinct("ipos").alias("n"), F.min("ipos").alias("first"), F.max("ipos").alias("last"), F.max("slots").alias("slots"))
    runs = stash(runs.where(F.col("n") >= F.least(F.lit(min_windows), F.col("item_windows"))))

    # Slots: both texts again, only for runs over a template that has some.
    open_runs = runs.where(F.col("slots") > 0)
    texts = d.join(open_runs.select(F.col("id").alias("_i"), F.col("text_key").alias("_k")).distinct(),
                   d["id"].eqNullSafe(F.col("_i")) & (d["text_key"] == F.col("_k"))).select("id", "text_key", "_doc_text").dropDuplicates(["id", "text_key"])
    t, raw = _slots(F.col("_doc_text"))
    texts = texts.select(F.col("id").alias("_i"), F.col("text_key").alias("_k"), raw.alias("_doc_words"))
    it, iraw = _slots(F.col("_item_text"))
    names = items.select(F.col("item").alias("_it"), F.xxhash64("_item_text").alias("_ik"), it.alias("_item_marks"), iraw.alias("_item_words"))
    both = open_runs.join(texts, open_runs["id"].eqNullSafe(texts["_i"]) & (open_runs["text_key"] == texts["_k"]))
    both = both.join(names, both["item"].eqNullSafe(names["_it"]) & (both["item_key"] == names["_ik"]))
    at = both.select(*keys, "offset", "_item_marks", "_item_words", "_doc_words", F.explode(F.sequence("first", F.col("last") + window - 1)).alias("i"))
    at = at.where(F.get("_item_marks", F.col("i")).startswith("ª"))
    pairs = at.select(*keys, "offset", F.get("_item_words", F.col("i")).alias("theirs"), F.get("_doc_words", F.col("i") + F.col("offset")).alias("ours")).distinct()
    checked = pairs.groupBy(*keys, "offset").agg(
        ((F.count(F.lit(1)) == F.countDistinct("theirs")) & (F.count(F.lit(1)) == F.countDistinct("ours"))).alias("consistent"),
        F.max((F.col("theirs") != F.col("ours"))).alias("changed"))
    c = checked.select(*[F.col(k).alias("_" + k) for k in keys], F.col("offset").alias("_offset"), "consistent", "changed")
    same = runs["slots"] > 0
    for k in keys:
        same = same & runs[k].eqNullSafe(c["_" + k])
    out = runs.join(c, same & (runs["offset"] == c["_offset"]), "left").where((F.col("slots") == 0) | F.col("consistent"))
    counts = F.max(F.struct(F.col("length") == 0, F.col("n").alias("n_windows"), "item_windows")).alias("_counts")
    out = out.groupBy(*keys).agg(counts, F.max(F.coalesce("changed", F.lit(False))).alias("reparameterised"))
    return out.select("id", "text_key", "item", "_counts.n_windows", "_counts.item_windows", "reparameterised")


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", plain: bool = False) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item (``plain``: see :func:`leaks`)."""
    found = leaks(docs, benchmark, id_col, text_col, plain=plain).select(F.col("id").alias("_i"), F.col("text_key").alias("_k")).distinct()
    d = docs.withColumn("_key", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    return d.join(found, (d["_key"] == found["_k"]) & d[id_col].eqNullSafe(found["_i"]), "left_anti").drop("_key")


def _by(*cols):
    from pyspark.sql import Window

    return Window.partitionBy(*cols)
