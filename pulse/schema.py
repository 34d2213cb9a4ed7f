"""Event schemas: the nested wire format and the flat standard event."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _s(name, dtype):
    return StructField(name, dtype, True)


_META = StructType([_s(n, StringType()) for n in ("dt", "domain", "stream", "uri", "id")])
_NEW_OLD = StructType([_s("new", LongType()), _s("old", LongType())])

# Nested edit event as it arrives on the wire; every field nullable.
EVENT_SCHEMA = StructType(
    [
        _s("meta", _META),
        _s("type", StringType()),
        _s("wiki", StringType()),
        _s("title", StringType()),
        _s("comment", StringType()),
        _s("user", StringType()),
        _s("bot", BooleanType()),
        _s("minor", BooleanType()),
        _s("namespace", IntegerType()),
        _s("revision", _NEW_OLD),
        _s("length", _NEW_OLD),
        _s("patrolled", BooleanType()),
        _s("timestamp", LongType()),
        _s("rev_content_changed", BooleanType()),
    ]
)

# The single input of every metric.
STANDARD_EVENT = StructType(
    [
        _s("event_time", TimestampType()),
        _s("domain", StringType()),
        _s("stream", StringType()),
        _s("event_type", StringType()),
        _s("bot", BooleanType()),
        _s("wiki", StringType()),
        _s("title", StringType()),
        _s("user", StringType()),
        _s("comment", StringType()),
        _s("namespace", IntegerType()),
        _s("minor", BooleanType()),
        _s("rev_content_changed", BooleanType()),
        _s("raw_json", StringType()),
    ]
)
STANDARD_COLUMNS = [f.name for f in STANDARD_EVENT.fields]
PARTITION_COLUMNS = ["year", "month", "day", "hour"]

# Column contract of a Kafka record (what the Kafka source yields and what
# the file-based replay sources imitate).
KAFKA_RECORD = StructType(
    [
        _s("key", BinaryType()),
        _s("value", BinaryType()),
        _s("topic", StringType()),
        _s("partition", IntegerType()),
        _s("offset", LongType()),
        _s("timestamp", TimestampType()),
        _s("timestampType", IntegerType()),
    ]
)
