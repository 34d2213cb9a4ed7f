"""Each message and each edit once.

Delivery is at least once: a producer that retries sends the same message
again, with the same ``message_id``. And an edit is announced on two topics, as
a recent change and as a new revision, so a count over both counts it twice.

* :func:`unique_messages` drops repeats of a message within the watermark;
* :func:`unique_edits` joins the two announcements of an edit on (wiki, new
  revision id) within a time range: one row per edit, whether one topic told of
  it or both.

Both run on batch and streaming input. Their streaming state is bounded by the
watermark (and the range): what is older has left it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulse.config import STREAM_RECENTCHANGE, STREAM_REVISION_CREATE, WATERMARK

EDIT_RANGE = "5 minutes"        # how far apart the two announcements of an edit may be
# What unique_edits reads of an event.
EDIT_COLUMNS = ["event_time", "domain", "stream", "event_type", "bot", "wiki", "rev_content_changed", "revision"]


def unique_messages(events: DataFrame, watermark: str = WATERMARK, key: str = "message_id") -> DataFrame:
    """``events`` without repeats of a ``message_id``.

    Streaming: ``dropDuplicatesWithinWatermark``, so a repeat is caught when it
    arrives within the watermark of the first copy, and a key leaves the state
    when the watermark has passed it. Batch: every repeat, whatever its time. A
    message without an id is no repeat of another; one without an event time is
    in no window and passes as it is (streaming state cannot age it).
    """
    known = F.col(key).isNotNull() & F.col("event_time").isNotNull()
    with_id, others = events.where(known), events.where(~known)
    if events.isStreaming:
        once = with_id.withWatermark("event_time", watermark).dropDuplicatesWithinWatermark([key])
    else:
        once = with_id.dropDuplicates([key])
    return once.unionByName(others)


def _side(events: DataFrame, stream: str, prefix: str, watermark: str) -> DataFrame:
    rows = events.where(F.col("stream") == stream)
    if events.isStreaming:
        rows = rows.withWatermark("event_time", watermark)
    return rows.select(*(F.col(c).alias(f"{prefix}_{c}") for c in EDIT_COLUMNS if c != "stream"))


def unique_edits(events: DataFrame, watermark: str = WATERMARK, within: str = EDIT_RANGE) -> DataFrame:
    """One row per edit: ``wiki, revision, event_time, domain, event_type, bot, rev_content_changed, told_by``.

    A recent change and a new revision of one (wiki, revision id), at most
    ``within`` apart, are one edit, told by ``both``; any other event of the two
    streams is an edit of its own, told by its stream. The columns come from the
    recent change where there is one, the content flag from the new revision;
    the time is that of the earlier event. Events without a wiki, a revision id
    or a time are told by their stream alone; events of other streams are left
    out. A message delivered twice would pair twice: drop repeats first
    (:func:`unique_messages`).

    Streaming (append mode): a watermarked full outer join. A pair comes out when
    its second half arrives, a single event when the watermark has passed its
    time by ``within``; state holds no event longer than that. The keys are
    nearly unique, so the join has no hot key; events without one don't enter it.
    """
    keyed = F.col("wiki").isNotNull() & F.col("revision").isNotNull() & F.col("event_time").isNotNull()
    paired = events.where(keyed)
    change, created = _side(paired, STREAM_RECENTCHANGE, "c", watermark), _side(paired, STREAM_REVISION_CREATE, "r", watermark)
    apart = F.expr(f"INTERVAL {within}")
    on = ((F.col("c_wiki") == F.col("r_wiki")) & (F.col("c_revision") == F.col("r_revision"))
          & (F.col("r_event_time") >= F.col("c_event_time") - apart) & (F.col("r_event_time") <= F.col("c_event_time") + apart))
    both = change.join(created, on, "full_outer")
    has_c, has_r = F.col("c_event_time").isNotNull(), F.col("r_event_time").isNotNull()
    pick = {c: F.coalesce(f"c_{c}", f"r_{c}") for c in ("wiki", "revision", "domain", "event_type", "bot")}
    told = F.when(has_c & has_r, F.lit("both")).when(has_c, F.lit(STREAM_RECENTCHANGE)).otherwise(F.lit(STREAM_REVISION_CREATE))
    edits = both.select(*(e.alias(c) for c, e in pick.items()), F.least("c_event_time", "r_event_time").alias("event_time"),
                        F.coalesce("r_rev_content_changed", "c_rev_content_changed").alias("rev_content_changed"), told.alias("told_by"))
    alone = events.where(~keyed & F.col("stream").isin(STREAM_RECENTCHANGE, STREAM_REVISION_CREATE))
    return edits.unionByName(alone.select(*(F.col(c) for c in pick), "event_time", "rev_content_changed", F.col("stream").alias("told_by")))


def closed_edits(edits: DataFrame, events: DataFrame, watermark: str = WATERMARK, within: str = EDIT_RANGE) -> DataFrame:
    """The edits that a stream over ``events`` has surely told of by its end.

    The watermark ends at the older of the two streams' newest events less the
    delay; single events newer than that less ``within`` may still be waiting.
    """
    newest = events.where(F.col("stream").isin(STREAM_RECENTCHANGE, STREAM_REVISION_CREATE) & F.col("wiki").isNotNull() & F.col("revision").isNotNull())
    newest = newest.groupBy("stream").agg(F.max("event_time").alias("t"))
    end = newest.agg((F.min("t") - F.expr(f"INTERVAL {watermark}") - F.expr(f"INTERVAL {within}")).alias("end")).scalar()
    return edits.where(F.col("event_time") < end)
