"""The five windowed metrics (plus the re-aggregation used by top-N).

Each takes the standard-event DataFrame, batch or streaming, and is a single
hash aggregate: partial counts per map task -> shuffle on the window key ->
final merge. Partial aggregation is what keeps a hot window (one key holding a
large share of all rows) cheap: every map task ships one row per window it
saw, never the rows themselves. On a batch input the watermark is ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.config import (
    STREAM_REVISION_CREATE,
    WATERMARK,
    WINDOW_BOT,
    WINDOW_BY_TYPE,
    WINDOW_CONTENT,
    WINDOW_DOMAIN,
    WINDOW_TOTAL,
)
from pulse.functions.time import duration_seconds
from pulse.functions.values import flag_count
from pulse.operators.parse import revisions_only

WINDOW_KEYS = ["window_start", "window_end"]
# The standard-event columns the five metrics read.
METRIC_COLUMNS = ["event_time", "domain", "stream", "event_type", "bot", "rev_content_changed"]


def _grouped(df: DataFrame, window: str, watermark: str | None, dims: list[str]):
    if watermark:
        df = df.withWatermark("event_time", watermark)
    return df.groupBy(F.window("event_time", window).alias("w"), *dims)


def unpack_window(df: DataFrame, col: str = "w") -> DataFrame:
    """``window`` struct to ``window_start``/``window_end`` columns."""
    rest = [c for c in df.columns if c != col]
    return df.select(
        F.col(f"{col}.start").alias("window_start"), F.col(f"{col}.end").alias("window_end"), *rest
    )


def windowed_count(df: DataFrame, window: str, dims: list[str] | None = None,
                   name: str = "cnt", watermark: str | None = WATERMARK) -> DataFrame:
    dims = list(dims or [])
    agg = _grouped(df, window, watermark, dims).agg(F.count(F.lit(1)).alias(name))
    return unpack_window(agg)


def windowed_ratio(df: DataFrame, flag: str, window: str, total_name: str, flag_name: str,
                   ratio_name: str, watermark: str | None = WATERMARK) -> DataFrame:
    """Per window: row count, rows with ``flag`` true, and their ratio."""
    agg = _grouped(df, window, watermark, []).agg(
        F.count(F.lit(1)).alias(total_name), flag_count(flag).alias(flag_name)
    )
    return unpack_window(agg).withColumn(ratio_name, F.col(flag_name) / F.col(total_name))


def _streams(df: DataFrame, streams):
    return df if streams is None else df.filter(F.col("stream").isin(list(streams)))


def total_events(df: DataFrame, window: str = WINDOW_TOTAL, watermark: str | None = WATERMARK,
                 streams=None) -> DataFrame:
    """Metric 1: ``window_start, window_end, event_count``."""
    return windowed_count(_streams(df, streams), window, name="event_count", watermark=watermark)


def events_by_type(df: DataFrame, window: str = WINDOW_BY_TYPE, watermark: str | None = WATERMARK,
                   streams=None) -> DataFrame:
    """Metric 2: ``window_start, window_end, event_type, cnt`` (null type is a group)."""
    return windowed_count(_streams(df, streams), window, ["event_type"], watermark=watermark)


def bot_ratio(df: DataFrame, window: str = WINDOW_BOT, watermark: str | None = WATERMARK,
              streams=None) -> DataFrame:
    """Metric 3: ``total_count, bot_count, bot_ratio`` per window."""
    return windowed_ratio(_streams(df, streams), "bot", window, "total_count", "bot_count",
                          "bot_ratio", watermark)


def domain_counts(df: DataFrame, window: str = WINDOW_DOMAIN, watermark: str | None = WATERMARK,
                  streams=None) -> DataFrame:
    """Metric 4: ``window_start, window_end, domain, cnt``."""
    return windowed_count(_streams(df, streams), window, ["domain"], watermark=watermark)


def content_change_ratio(df: DataFrame, window: str = WINDOW_CONTENT,
                         watermark: str | None = WATERMARK) -> DataFrame:
    """Metric 5 over revision-create events: ``total_revision_count,
    content_changed_count, content_change_ratio`` per window.

    The stream filter sits below the watermark so it reaches the source.
    """
    return windowed_ratio(revisions_only(df), "rev_content_changed", window,
                          "total_revision_count", "content_changed_count",
                          "content_change_ratio", watermark)


def reaggregate(df: DataFrame, keys: list[str], value: str = "cnt") -> DataFrame:
    """``sum(value)`` by ``keys`` (e.g. after relabelling into ``others``)."""
    return df.groupBy(*keys).agg(F.sum(value).cast("long").alias(value))


# --- one pass for all five ----------------------------------------------------------

def base_cube(df: DataFrame) -> DataFrame:
    """``dim, t, value`` with counts: events by (10 seconds, type) and by (5 minutes, domain), in one pass.

    All metric windows are multiples of these, so the five metrics roll up from
    here. Each event counts in two small groupings, summed before the shuffle;
    the result has a row per window and type or domain, whatever the events.
    """
    micros = F.unix_micros("event_time")

    def start(window: str):
        width = duration_seconds(window) * 1_000_000
        return F.timestamp_micros(micros - F.pmod(micros, F.lit(width)))

    revision = F.coalesce(F.col("stream") == STREAM_REVISION_CREATE, F.lit(False))
    sides = [F.struct(F.lit(dim).alias("dim"), start(window).alias("t"), F.col(dim).alias("value")) for dim, window in (("event_type", WINDOW_BY_TYPE), ("domain", WINDOW_DOMAIN))]
    rows = df.where(F.col("event_time").isNotNull()).select("bot", (revision & F.col("rev_content_changed")).alias("changed"), revision.alias("revision"), F.inline(F.array(*sides)))
    return rows.groupBy("dim", "t", "value").agg(F.count(F.lit(1)).alias("n"), flag_count("bot").alias("n_bot"), flag_count("revision").alias("n_revision"), flag_count("changed").alias("n_changed"))


def metrics_of_cube(cube: DataFrame) -> dict[str, DataFrame]:
    """The five metric tables of :func:`base_cube`, equal to those of its events."""
    def rolled(dim: str, window: str, dims: list[str], counts: dict[str, str]):
        rows = cube.where(F.col("dim") == dim).withColumnRenamed("value", dim)
        return unpack_window(rows.groupBy(F.window("t", window).alias("w"), *dims).agg(*(F.sum(c).cast("long").alias(name) for c, name in counts.items())))

    m3 = rolled("event_type", WINDOW_BOT, [], {"n": "total_count", "n_bot": "bot_count"})
    m5 = rolled("event_type", WINDOW_CONTENT, [], {"n_revision": "total_revision_count", "n_changed": "content_changed_count"}).where(F.col("total_revision_count") > 0)
    return {
        "m1": rolled("event_type", WINDOW_TOTAL, [], {"n": "event_count"}),
        "m2": rolled("event_type", WINDOW_BY_TYPE, ["event_type"], {"n": "cnt"}),
        "m3": m3.withColumn("bot_ratio", F.col("bot_count") / F.col("total_count")),
        "m4": rolled("domain", WINDOW_DOMAIN, ["domain"], {"n": "cnt"}),
        "m5": m5.withColumn("content_change_ratio", F.col("content_changed_count") / F.col("total_revision_count")),
    }
