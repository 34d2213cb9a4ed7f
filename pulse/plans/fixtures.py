"""Edit-event messages derived from the driver's ``events`` table.

The derivation (documented in FIXTURES.md §4) turns every ``events`` row into
one JSON edit event, compresses time 120x so that 10-second windows hold
several events, routes it to a topic and keeps what a consumer subscribed to
the two metric topics sees. Every registered query starts here, so its work
grows with the table and goes through the real JSON parse path.

Fields with no counterpart in ``events`` (wiki, title, user, comment,
namespace, minor, revision, length, patrolled) are derived by simple rules,
stated next to each column below and mirrored in the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.config import Config, use_utc
from pulse.sources.files import ensure_parallelism
from pulse.operators.parse import parse_events, subscribed, topic_for

T0_MICROS = 1704067200000000  # 2024-01-01T00:00:00Z
TIME_COMPRESSION = 120
KAFKA_PARTITIONS = 4
# Every n-th event_id has a time without a date, no type, the type "null", no flag.
BAD_TIME, NO_TYPE, NULL_LABEL, NO_BOT, NO_CHANGED = 101, 97, 89, 11, 13


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read one driver table, as it is split.

    Only where the session names ``spark.pulse.minPartitions`` (the local
    benchmark does, whose tables are one split each) is a scan of fewer splits
    spread (see :func:`pulse.sources.files.ensure_parallelism`), after
    ``columns`` are selected.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if columns is not None:
        df = df.select(*columns)
    least = spark.conf.get("spark.pulse.minPartitions", None)
    return ensure_parallelism(df, int(least)) if least else df


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("long")


def event_time() -> Column:
    """Time of an ``events`` row, compressed."""
    offset = F.expr(f"(unix_micros(cast(ts as timestamp)) - {T0_MICROS}) div {TIME_COMPRESSION}")
    return F.timestamp_micros(F.lit(T0_MICROS) + offset)


def _s(col: Column) -> Column:
    return col.cast("string")


def _capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    ev = read_table(spark, sf_dir, "events", columns=["event_id", "ts", "user_id", "event_type", "props"])
    base = ev.select(
        "event_id", "user_id", F.col("event_type").alias("base_type"), _k().alias("k"),
        event_time().alias("event_time"),
    )
    eid, uid, k = F.col("event_id"), F.col("user_id"), F.col("k")
    domain = F.concat(F.lit("w"), _s(uid % 40), F.lit(".example.org"))
    stream = (F.when(eid % 50 == 0, F.lit("other"))
              .when(eid % 2 == 0, F.lit("mediawiki.recentchange"))
              .otherwise(F.lit("mediawiki.revision-create")))
    page = F.concat(F.lit("Page "), _s(eid % 997))
    meta = F.struct(
        F.when(eid % BAD_TIME == 0, F.lit("12:30"))
        .otherwise(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).alias("dt"),
        domain.alias("domain"),
        stream.alias("stream"),
        F.concat(F.lit("https://"), domain, F.lit("/wiki/"), page).alias("uri"),
        _s(eid).alias("id"),
    )
    event = F.struct(
        meta.alias("meta"),
        F.when(eid % NO_TYPE == 0, F.lit(None).cast("string")).when(eid % NULL_LABEL == 0, F.lit("null"))
        .otherwise(F.concat(F.col("base_type"), F.lit("_"), _s(k % 3))).alias("type"),
        F.concat(F.lit("w"), _s(uid % 40), F.lit("wiki")).alias("wiki"),
        page.alias("title"),
        F.col("base_type").alias("comment"),
        F.concat(F.lit("user"), _s(uid)).alias("user"),
        F.when(eid % NO_BOT != 0, k % 4 == 0).alias("bot"),
        (k % 7 == 0).alias("minor"),
        (k % 16).cast("int").alias("namespace"),
        F.struct((eid * 2 + 1).alias("new"), (eid * 2).alias("old")).alias("revision"),
        F.struct((k + 100).alias("new"), F.lit(100).cast("long").alias("old")).alias("length"),
        (k % 2 == 0).alias("patrolled"),
        F.unix_seconds("event_time").alias("timestamp"),
        F.when(eid % NO_CHANGED != 0, k % 5 != 0).alias("rev_content_changed"),
    )
    return base.select(eid.alias("offset"), F.to_json(event).alias("value"),
                       F.col("event_time").alias("ingest_time"), stream.alias("stream"))


def capture_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON edit event per ``events`` row: ``offset`` (= event_id), ``value`` (text)."""
    return _capture(spark, sf_dir).drop("stream")


def kafka_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture values routed to topics, in the Kafka record column contract.

    The producer routes on the event's ``meta.stream`` before serialising it,
    so the topic comes from the stream column (the text-based router,
    :func:`pulse.operators.parse.with_topic`, gives the same topics).
    """
    routed = _capture(spark, sf_dir).withColumn("topic", topic_for(F.col("stream")))
    return routed.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        "topic",
        (F.col("offset") % KAFKA_PARTITIONS).cast("int").alias("partition"),
        "offset",
        F.col("ingest_time").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def consumed_records(spark: SparkSession, sf_dir: str, config: Config = Config()) -> DataFrame:
    """What the metric job reads: records of the subscribed topics only."""
    return subscribed(kafka_records(spark, sf_dir), config.topics)


def standard_events(spark: SparkSession, sf_dir: str, config: Config = Config(),
                    columns: list[str] | None = None) -> DataFrame:
    """Parsed standard events of the subscribed topics (the input of every
    metric); ``columns`` limits the parse to what the caller reads."""
    return parse_events(consumed_records(spark, sf_dir, config), columns=columns)
