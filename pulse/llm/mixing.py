"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in Spark SQL.

Each source gets a token budget. Complete epochs come first: a source takes
every document ``budget div size`` times. What is left of the budget is a
fractional epoch: documents are ordered by exponential keys scaled by their
quality weight (``-ln(u) / weight``, the weighted sample without replacement of
Efraimidis and Spirakis 2006) and taken while the prefix sum of their sizes
stays nearest the rest. Documents are taken whole.

Nothing sorts a source in one task: keys fall into equal slices of the unit
interval by ``1 - exp(-key)``, slices are summed first, and only rows of one
slice are sorted together. With weights of at least 1 no slice holds more than
the greatest weight times the average.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.llm.common import collapse_rows, stash, word_count

ROWS_PER_SLICE = 50_000
JUNK = "0123456789#*$%&|<>"
UNIT = float(1 << 52)


def quality_weight(text: Column) -> Column:
    """Between 1 and 2: 2 less the share of digits and symbols among the characters (1 without text)."""
    n = F.length(text)
    junk = n - F.length(F.translate(text, JUNK, ""))
    return F.when(n > 0, F.lit(2.0) - junk / n).otherwise(F.lit(1.0))


def water_fill(sources: DataFrame, cap: float) -> DataFrame:
    """``sources`` (source, source_size, weight) with ``target``.

    All sizes are shared by weight; a target stops at ``cap`` times its source's
    size and the excess is reshared by weight until none is above. Sorted by
    size per weight, the capped sources come first; the level is the rest over
    the weights that remain after them.
    The table has one row for each source of the mixture.
    """
    w = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    up_to = w.rowsBetween(Window.unboundedPreceding, -1)
    s = (sources.withColumn("_cap", F.col("source_size") * cap)
         .withColumn("_all", F.sum("source_size").over(everything).cast("double"))
         .withColumn("_weights", F.sum("weight").over(everything))
         .withColumn("_capped", F.coalesce(F.sum("_cap").over(up_to), F.lit(0.0)))
         .withColumn("_done", F.coalesce(F.sum("weight").over(up_to), F.lit(0))))
    ratio = (F.col("_all") - F.col("_capped")) / (F.col("_weights") - F.col("_done"))
    s = s.withColumn("_level", ratio)
    # The level rises along the capped sources and falls after them, so it is the greatest.
    level = F.max("_level").over(everything)
    target = F.least(F.col("_cap"), level * F.col("weight"))
    return s.select("source", "source_size", "weight", target.alias("target"))


def repeating_weights(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    """``weight`` by position: sources in code point order, null last, weigh ``weights`` in turn."""
    at = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(x) for x in weights]), (at % len(weights)) + 1))


def mix(df: DataFrame, id_col: str, size: Column, quality: Column | None = None, source_col: str = "source",
        weights=repeating_weights, cap: float = 3.0, seed: int = 0, text_col: str = "text",
        rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """One row per row of ``df``: ``id_col``, size, source, source_size, target
    and ``taken`` (words the mix takes, repeats counted), ``times`` (how often).

    ``weights`` maps (source, source_size) to the same with ``weight``. Keys are
    digests of id, text and ``seed``, so reruns agree and copies with other ids
    draw anew; ties go by id and text. Null ids and sources are values like
    others (null sorts last); rows of size 0 take nothing but are counted as
    their key falls. Equal rows are counted before any shuffle and drawn in
    parts. No rows give no rows; other columns are ignored.
    """
    quality = quality_weight(F.col(text_col)) if quality is None else quality
    narrow = df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.cast("long").alias("size"),
                       F.greatest(F.lit(1.0), F.coalesce(quality, F.lit(1.0))).cast("double").alias("quality"),
                       F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("digest"))
    cols = ["id", "source", "size", "quality", "digest"]
    rows = stash(collapse_rows(narrow, cols))
    total = rows.agg(F.sum("copies")).first()[0] or 0
    slices = total // rows_per_slice + 1

    sizes = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    plan = stash(water_fill(weights(sizes), cap))

    text_key = F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("")), "digest",
                           F.col("part").cast("string"), F.lit(str(seed)))
    u = (F.conv(F.substring(F.md5(text_key.cast("binary")), 1, 13), 16, 10).cast("long").cast("double") + 0.5) / UNIT
    key = -F.log(u) / F.col("quality")
    rows = rows.withColumn("key", key).withColumn(
        "slice", F.floor(F.least(F.lit(1.0 - 1e-12), 1.0 - F.exp(-F.col("key"))) * slices).cast("long"))

    # Sums of the slices; what each source's earlier slices hold; epochs and the rest of its budget.
    sums = rows.groupBy("source", "slice").agg(F.sum(F.col("size") * F.col("copies")).alias("_sum"))
    earlier = F.sum("_sum").over(Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.withColumn("before", F.coalesce(earlier, F.lit(0)))
    p = plan.select(F.col("source").alias("_source"), "source_size", "target")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    budget = (sums.join(p, F.col("source").eqNullSafe(F.col("_source"))).withColumn("epochs", epochs)
              .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
              .select(F.col("source").alias("_source"), F.col("slice").alias("_slice"), "before", "source_size", "target", "epochs", "rest"))

    joined = rows.join(budget, rows["source"].eqNullSafe(budget["_source"]) & (rows["slice"] == budget["_slice"]))
    order = Window.partitionBy("source", "slice").orderBy("key", F.col("id").asc_nulls_last(), "digest", "part", "quality", "size")
    inside = F.sum(F.col("size") * F.col("copies")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    start = F.col("before") + inside - F.col("size") * F.col("copies")
    # Of equal rows in a part, as many as bring the prefix sum nearest the rest.
    room = F.col("rest") - F.col("_start")
    fit = (F.when((F.col("rest") <= 0) | (room < 0), F.lit(0))
           .when(F.col("size") == 0, F.col("copies"))
           .otherwise(F.least(F.col("copies"), F.floor(room / F.col("size") + 0.5))).cast("long"))
    drawn = joined.withColumn("_start", start).withColumn("fit", fit)
    each = drawn.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    times = F.col("epochs") + F.when(F.col("_i") <= F.col("fit"), 1).otherwise(0)
    return each.select(F.col("id").alias(id_col), "size", "digest", "source", "source_size", "target",
                       (F.col("size") * times).alias("taken"), times.cast("int").alias("times"))


def mixed(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` as often as the mix takes them; rows that it leaves out are gone."""
    found = mix(df, id_col, word_count(F.col(text_col)), source_col=source_col, text_col=text_col, **options)
    times = found.groupBy(F.col(id_col).alias("_id"), F.col("source").alias("_source"), F.col("digest").alias("_digest")).agg(F.sum("times").alias("_times"))
    times = times.where(F.col("_times") > 0)
    d = df.withColumn("_key", F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    same = (d["_key"] == times["_digest"]) & d[id_col].eqNullSafe(times["_id"]) & d[source_col].eqNullSafe(times["_source"])
    # Equal rows were drawn together, so one of them is written for all.
    first = F.row_number().over(Window.partitionBy("_key", id_col, source_col).orderBy("_key"))
    one = d.join(times, same).withColumn("_nth", first).where(F.col("_nth") == 1)
    return one.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), "_times"))).select(*df.columns)
