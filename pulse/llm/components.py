"""Connected components of a link table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.llm.common import discard, stash


def components(links: DataFrame) -> DataFrame:
    """(node, label): the least node of each linked node's component.

    ``links``: a, b (64-bit). In each round every label becomes the least label
    next to it, is handed to its old label's node as well, and then jumps to the
    label of its label, so chains shorten by halves. Only counts reach the
    driver; a round's labels are deleted when the next one's are written. No links
    give no rows.
    """
    links = links.where(F.col("a") != F.col("b"))
    both = stash(links.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))).distinct())
    labels = stash(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("label")))
    held = labels
    while True:
        l = labels.select(F.col("node").alias("b"), "label")
        near = both.join(l, "b").groupBy("a").agg(F.min("label").alias("near"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "near").alias("new"))
        told = step.select(F.inline(F.array(F.struct("node", "new", F.col("label").alias("was")),
                                            F.struct(F.col("label").alias("node"), "new", F.lit(None).cast("long").alias("was")))))
        told = told.groupBy("node").agg(F.min("new").alias("label"), F.max("was").alias("was"))
        up = told.select(F.col("node").alias("label"), F.col("label").alias("top"))
        after = stash(told.join(up, "label", "left").select("node", F.coalesce("top", "label").alias("label"), "was"))
        discard(held)
        held, labels = after, after.drop("was")
        if not after.where(F.col("label") != F.col("was")).take(1):
            discard(both)
            return labels


def extended(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels``, as :func:`components` gives them, after more ``links``: what it would give for all links together.

    Only the new links between components, each named by its label, go through the rounds.
    """
    def name(end: str) -> DataFrame:
        return labels.select(F.col("node").alias(end), F.col("label").alias("_" + end))

    between = links.join(name("a"), "a", "left").join(name("b"), "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
    tops = components(between)
    held = labels.join(tops.select(F.col("node").alias("label"), F.col("label").alias("top")), "label", "left")
    return stash(held.select("node", F.coalesce("top", "label").alias("label")).union(tops.join(labels, "node", "left_anti").select("node", "label")))
