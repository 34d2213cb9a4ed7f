"""Configuration constants and session helpers.

Everything here is plain data: importing the package starts no session and
reads no environment variable.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# --- fixed values that must equal the original pipeline's -------------------
# Kafka topics, routing and serving keys, with their value lifetimes (seconds).
TOPIC_RECENTCHANGE = "wiki-recentchange"
TOPIC_REVISION_CREATE = "wiki-revision-create"
TOPIC_UNKNOWN = "wiki-unknown"
STREAM_RECENTCHANGE = "mediawiki.recentchange"
STREAM_REVISION_CREATE = "mediawiki.revision-create"

KEY_TOTAL = "metrics:events_total_10m_10s"
KEY_BY_TYPE = "metrics:events_by_type_10m_10s"
KEY_BOT = "metrics:bot_ratio_1m"
KEY_TOP = "metrics:top_domain_5m_top10"
KEY_CONTENT = "metrics:content_change_ratio_1m"
TTL_SECONDS = {KEY_TOTAL: 10800, KEY_BY_TYPE: 10800, KEY_BOT: 300, KEY_TOP: 600, KEY_CONTENT: 300}

WATERMARK = "2 minutes"
WINDOW_TOTAL = "10 seconds"
WINDOW_BY_TYPE = "10 seconds"
WINDOW_BOT = "1 minute"
WINDOW_DOMAIN = "5 minutes"
WINDOW_CONTENT = "1 minute"
TOP_TYPES = 5
OTHERS_LABEL = "others"
TOP_DOMAINS = 10
RETAINED_WINDOWS = 1000
SERIES_KEYS = 8
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSX"

# Dashboard document defaults (server side and client-side normaliser).
BUCKET_SEC = 10
RANGE_MIN = 10
BOT_WINDOW_SEC = 60
CONTENT_WINDOW_SEC = 60
NORMALIZED_RANGE_MIN = 300
NORMALIZED_WINDOW_SEC = 60
UNKNOWN_KEY = "unknown"
# ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Config:
    """Run-time settings of the streaming job (all overridable by the caller)."""

    kafka_servers: str = "localhost:9092"
    topics: tuple[str, ...] = (TOPIC_RECENTCHANGE, TOPIC_REVISION_CREATE)
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = False
    # Intake cap per trigger and least number of source splits. The original's
    # 5,000 and 2 are single-node values, so neither is a default here.
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    watermark: str = WATERMARK
    retained_windows: int = RETAINED_WINDOWS
    kafka_producer_options: dict = field(
        default_factory=lambda: {"acks": "all", "retries": "10", "linger.ms": "50"}
    )


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` (stable across
    application restarts, unlike the per-application folder Spark derives from
    it for RDD checkpoints). ``fallback`` only applies when it is unset, as in
    tests."""
    from pulse.plans.barriers import checkpoint_folder

    return checkpoint_folder(spark, fallback)


def use_utc(spark: SparkSession) -> None:
    """Event times are instants; all windows and ISO strings are UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    # A repeated key is valid JSON: the last one wins.
    if spark.conf.get("spark.sql.variant.allowDuplicateKeys", "false") != "true":
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
