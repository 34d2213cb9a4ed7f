"""Mergeable sketches of a window: distinct counts and heavy hitters of constant size.

Exact metrics per domain or user keep one row of state for every value. A
sketch has the same size whatever the window holds, and sketches of short
windows merge into those of long ones without reading an event again: one per
5 minutes is kept, hours and days are merges. All are Spark's own aggregates
(HyperLogLog, frequent items), so partial sketches are merged before and after
the shuffle and a hot window is a few kilobytes per task.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.config import WATERMARK, WINDOW_DOMAIN
from pulse.operators.metrics import unpack_window

LG_K = 12                   # HyperLogLog buckets: 2**12, 3 kilobytes at most
TRACKED = 512               # items that a frequent-items sketch follows
DISTINCT_DIMS = ("domain", "user")
TOP_DIM = "domain"


def window_sketches(events: DataFrame, window: str = WINDOW_DOMAIN, watermark: str | None = WATERMARK, distinct: tuple[str, ...] = DISTINCT_DIMS,
                    top: str = TOP_DIM, lg_k: int = LG_K, tracked: int = TRACKED) -> DataFrame:
    """``window_start, window_end, n``, a ``<dim>_hll`` for each dim of ``distinct`` and ``<top>_items``.

    Batch or streaming (update or append mode). Nulls are in no sketch but in
    ``n``; events without a time are in no window.
    """
    if watermark:
        events = events.withWatermark("event_time", watermark)
    hll = [F.hll_sketch_agg(d, F.lit(lg_k)).alias(f"{d}_hll") for d in distinct]
    items = F.call_function("approx_top_k_accumulate", F.col(top), F.lit(tracked)).alias(f"{top}_items")
    return unpack_window(events.groupBy(F.window("event_time", window).alias("w")).agg(F.count(F.lit(1)).alias("n"), *hll, items))


def merge_sketches(sketches: DataFrame, window: str, tracked: int = TRACKED) -> DataFrame:
    """Sketches of longer windows (a multiple of the given ones) from those of shorter ones; same columns."""
    merged = [F.sum("n").cast("long").alias("n")]
    merged += [F.hll_union_agg(c).alias(c) for c in sketches.columns if c.endswith("_hll")]
    merged += [F.call_function("approx_top_k_combine", F.col(c), F.lit(tracked)).alias(c) for c in sketches.columns if c.endswith("_items")]
    return unpack_window(sketches.groupBy(F.window("window_start", window).alias("w")).agg(*merged))


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """``window_start, window_end, n`` and ``<dim>_distinct`` (estimate) for each HyperLogLog column."""
    names = [c[:-len("_hll")] for c in sketches.columns if c.endswith("_hll")]
    return sketches.select("window_start", "window_end", "n", *(F.hll_sketch_estimate(f"{d}_hll").alias(f"{d}_distinct") for d in names))


def top_estimates(sketches: DataFrame, dim: str = TOP_DIM, k: int = 10) -> DataFrame:
    """``window_start, window_end, <dim>, cnt`` (estimate, never below the true count's lower bound): the ``k`` most frequent."""
    top = F.call_function("approx_top_k_estimate", F.col(f"{dim}_items"), F.lit(k))
    out = sketches.select("window_start", "window_end", F.inline(top))
    return out.select("window_start", "window_end", F.col("item").alias(dim), F.col("count").alias("cnt"))


def distinct_error(lg_k: int = LG_K, deviations: float = 3.0) -> float:
    """Relative error that a distinct estimate stays within, at so many standard deviations (HyperLogLog: 1.04 / sqrt(buckets))."""
    return deviations * 1.04 / sqrt(1 << lg_k)


def top_error(tracked: int = TRACKED) -> float:
    """Share of a window's events by which a frequent item's estimate may be off: 1 / (0.75 x items followed)."""
    return 1 / (0.75 * tracked)
