"""Stand-in inputs of the streaming queries: messages of the ``events`` table as they might arrive.

Each builder gives rows of (offset, value, slot): the JSON text of a message
and the hour in which it arrives. :func:`deliver` writes the slots one after
the other and lets a stream run after each, so a slot is one micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.plans.barriers import materialize
from pulse.plans.fixtures import BAD_TIME, NO_BOT, NO_CHANGED, T0_MICROS, capture_values, consumed_records, event_time, read_table

SLOT_SECONDS = 3600
LATE_EVERY, LATE_SECONDS = 20, 900          # every 20th message is 15 minutes late,
SLOW_EVERY, SLOW_SECONDS = 7, 90            # every 7th is 90 seconds late
AGAIN_EVERY, AGAIN_SECONDS = 5, 30          # every 5th is delivered again half a minute later
LAG_EVERY, LAG_SECONDS = 50, 600            # every 50th edit's new revision is told 10 minutes after its change
VERSION_EVERY, REQUEST_EVERY, TEXT_FLAG_EVERY = 9, 13, 31      # messages with a new field, a new field in meta, a flag as text
FILE_EVENTS = 200_000                       # messages that a task sorts and writes to the captures' files
NO_REVISION = 41                            # every 41st edit has no revision id


def _slot(seconds: Column) -> Column:
    return F.floor((seconds - T0_MICROS // 1_000_000) / SLOT_SECONDS).cast("int")


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consumed_records(spark, sf_dir).select("offset", F.col("value").cast("string").alias("value"), F.unix_seconds("timestamp").alias("s"))


def shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that arrive out of order."""
    o = F.col("offset")
    delay = F.when(o % LATE_EVERY == 0, LATE_SECONDS).when(o % SLOW_EVERY == 0, SLOW_SECONDS).otherwise(o % 5)
    return _records(spark, sf_dir).select("offset", "value", _slot(F.col("s") + delay).alias("slot"))


def redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in time order, some of them twice or three times."""
    r = _records(spark, sf_dir)
    times = 1 + (F.col("offset") % AGAIN_EVERY == 0).cast("int") + (F.col("offset") % (7 * AGAIN_EVERY) == 0).cast("int")
    copies = r.select("*", F.explode(F.sequence(F.lit(0), times - 1)).alias("copy"))
    return copies.select("offset", "value", _slot(F.col("s") + F.col("copy") * AGAIN_SECONDS).alias("slot"))


def captured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All captured messages; every 7th has lost its closing brace."""
    cut = F.when(F.col("offset") % 7 == 0, F.regexp_replace("value", r"\}$", "")).otherwise(F.col("value"))
    return capture_values(spark, sf_dir).select("offset", cut.alias("value"), _slot(F.unix_seconds("ingest_time")).alias("slot"))


def drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured messages of which some have fields that the schema lacks, or a flag as text."""
    o, v = F.col("offset"), F.col("value")
    v = F.when(o % VERSION_EVERY == 0, F.regexp_replace(v, r"^\{", '{"schema_version":2,')).otherwise(v)
    v = F.when(o % REQUEST_EVERY == 0, F.regexp_replace(v, r'"meta":\{', '"meta":{"request_id":"r",')).otherwise(v)
    v = F.when(o % TEXT_FLAG_EVERY == 0, F.regexp_replace(v, r'"bot":(true|false)', '"bot":"$1"')).otherwise(v)
    return capture_values(spark, sf_dir).select("offset", v.alias("value"))


def in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consumed messages in time order, in two halves."""
    r = _records(spark, sf_dir)
    return r.select("offset", "value", (_slot(F.col("s")) >= 3).cast("int").alias("slot"))


def announced_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edits told by a recent change (three of four), a new revision (three of four) or both, some seconds apart."""
    ev = read_table(spark, sf_dir, "events", columns=["event_id", "ts", "user_id", "event_type", "props"])
    e, k = F.col("event_id"), F.get_json_object("props", "$.k").cast("long")
    lag = F.when(e % LAG_EVERY == 8, LAG_SECONDS).otherwise(e % 20)
    told = F.filter(F.array(F.when(e % 4 != 3, F.struct(F.lit("mediawiki.recentchange").alias("stream"), F.lit(0).cast("long").alias("lag"))),
                            F.when(e % 4 != 1, F.struct(F.lit("mediawiki.revision-create").alias("stream"), lag.cast("long").alias("lag")))), lambda x: x.isNotNull())
    rows = ev.select("*", event_time().alias("t"), F.inline(told))
    rows = rows.withColumn("t", F.timestamp_micros(F.unix_micros("t") + F.col("lag") * 1_000_000))
    wiki = F.concat(F.lit("w"), (F.col("user_id") % 40).cast("string"))
    dt = F.when(e % BAD_TIME == 0, F.lit("12:30")).otherwise(F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    meta = F.struct(dt.alias("dt"), F.concat(wiki, F.lit(".example.org")).alias("domain"), F.col("stream").alias("stream"),
                    F.concat(e.cast("string"), F.substring("stream", 11, 3)).alias("id"))
    event = F.struct(meta.alias("meta"), F.col("event_type").alias("type"), F.concat(wiki, F.lit("wiki")).alias("wiki"), F.when(e % NO_BOT != 0, k % 4 == 0).alias("bot"),
                     F.when(e % NO_REVISION != 0, F.struct((e * 2 + 1).alias("new"))).alias("revision"),
                     F.when((e % NO_CHANGED != 0) & (F.col("stream") == "mediawiki.revision-create"), k % 5 != 0).alias("rev_content_changed"))
    return rows.select(e.alias("offset"), F.to_json(event).alias("value"), _slot(F.unix_seconds("t")).alias("slot"))


def capture_files(messages: DataFrame, folder: str, files: int = 6, cut: bool = True) -> str:
    """Write messages (offset, value) as the rotated files of two captures: event, id and two ``data:`` lines and a
    blank one each. Files end where the line count says, mostly inside an event (``cut``), or between two events.
    A capture has ``files`` files, or more of about ``FILE_EVENTS`` messages of both: a file is sorted by one task."""
    files = max(files, -(-messages.count() // FILE_EVENTS))
    first = F.length(F.substring_index("value", ",", 1)) + 1
    lines = F.array(F.lit("event: message"), F.concat(F.lit("id: "), F.col("offset").cast("string")), F.concat(F.lit("data: "), F.substring("value", F.lit(1), first)),
                    F.concat(F.lit("data: "), F.substring("value", first + 1, F.length("value"))), F.lit(""))
    rows = messages.select((F.col("offset") % 2).alias("capture"), "offset", F.posexplode(lines).alias("i", "value"))
    rows = rows.select("capture", "offset", (F.col("offset") * 5 + F.col("i")).alias("at"), "value").repartitionByRange(files, "at" if cut else "offset").sortWithinPartitions("capture", "at")
    rows.select("capture", "value").write.partitionBy("capture").text(f"{folder}/captures")
    return f"{folder}/captures"


def deliver(messages: DataFrame, folder: str, run: Callable[[str], None]) -> None:
    """Write the slots' messages to ``<folder>/lines`` one after the other, and ``run`` a stream over it after each."""
    messages = materialize(messages)
    slots = sorted(r.slot for r in messages.select("slot").distinct().collect())       # a few hours
    for slot in slots:
        messages.where(F.col("slot") == slot).select("value").write.mode("append").text(f"{folder}/lines")
        run(f"{folder}/lines")
