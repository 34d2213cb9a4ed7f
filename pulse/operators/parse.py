"""Parse, projection, filter and routing operators (stateless, map-only).

None of these shuffles; on a streaming input they run inside the source
stage. ``parse_events(columns=...)`` parses only the fields the caller reads.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from pulse.config import (
    STREAM_RECENTCHANGE,
    STREAM_REVISION_CREATE,
    TOPIC_RECENTCHANGE,
    TOPIC_REVISION_CREATE,
    TOPIC_UNKNOWN,
)
from pulse.functions.time import event_ts
from pulse.functions.values import default_false
from pulse.plans.barriers import fence
from pulse.schema import EVENT_SCHEMA, STANDARD_COLUMNS

DEFAULT_ROUTES: Mapping[str, str] = {
    STREAM_RECENTCHANGE: TOPIC_RECENTCHANGE,
    STREAM_REVISION_CREATE: TOPIC_REVISION_CREATE,
}


def _text(df: DataFrame, col: str = "value") -> Column:
    dtype = df.schema[col].dataType.typeName()
    return F.col(col).cast("string") if dtype == "binary" else F.col(col)


def decode_value(df: DataFrame, col: str = "value", alias: str = "json_str") -> DataFrame:
    """Bytes to UTF-8 text (``CAST(value AS STRING)``); other columns kept."""
    return df.withColumn(alias, _text(df, col))


def parse_json(df: DataFrame, schema: StructType = EVENT_SCHEMA, col: str = "json_str",
               alias: str = "data") -> DataFrame:
    """JSON text to a struct of the fixed schema (PERMISSIVE: bad text -> nulls)."""
    return df.withColumn(alias, F.from_json(F.col(col), schema))


# Which part of the wire event each standard column reads.
_SOURCE = {
    "event_time": ("meta", "dt"), "domain": ("meta", "domain"), "stream": ("meta", "stream"),
    "event_type": ("type",), "bot": ("bot",), "wiki": ("wiki",), "title": ("title",), "user": ("user",),
    "comment": ("comment",), "namespace": ("namespace",), "minor": ("minor",),
    "rev_content_changed": ("rev_content_changed",), "raw_json": (),
    "message_id": ("meta", "id"), "revision": ("revision", "new"),
}
# Columns beyond the standard event, parsed only where ``columns`` names them.
EXTRA_COLUMNS = ["message_id", "revision"]


def pruned_schema(columns, schema: StructType = EVENT_SCHEMA) -> StructType:
    """The part of the wire schema the given standard columns read."""
    need: dict[str, set] = {}
    for c in columns:
        path = _SOURCE[c]
        if path:
            need.setdefault(path[0], set()).update(path[1:])
    fields = []
    for f in schema.fields:
        if f.name not in need:
            continue
        sub = need[f.name]
        if sub and isinstance(f.dataType, StructType):
            f = StructField(f.name, StructType([g for g in f.dataType.fields if g.name in sub]), True)
        fields.append(f)
    return StructType(fields)


def parse_events(df: DataFrame, schema: StructType = EVENT_SCHEMA, col: str = "value",
                 columns: list[str] | None = None) -> DataFrame:
    """Raw messages (``value`` bytes or text) to the 13-column standard event.

    Booleans ``bot``, ``minor`` and ``rev_content_changed`` default to false;
    an unparsable ``meta.dt`` gives a null ``event_time`` (such rows stay in
    the archive but fall out of every window).

    ``columns`` (default: all 13) restricts the output, and the JSON parse, to
    the columns a caller reads, of the standard ones and ``EXTRA_COLUMNS``
    (``event_time`` and ``stream`` are always kept): the nested schema is pruned by hand, because Catalyst
    cannot prune a parse whose result feeds several columns.

    The JSON is parsed once per message. ``event_time`` and ``stream`` -- the
    two columns later filtered on (``window()`` drops null times, metric 5
    keeps one stream) -- leave through a one-row generator, so those filters
    stay above it instead of being pushed below the parse and re-evaluating
    ``from_json`` inside the filter. (A streaming watermark already blocks the
    push-down; this makes batch reads of raw messages behave the same.)
    """
    wanted = list(STANDARD_COLUMNS if columns is None else
                  [c for c in (*STANDARD_COLUMNS, *EXTRA_COLUMNS) if c in set(columns) | {"event_time", "stream"}])
    if columns is not None:
        schema = pruned_schema(wanted, schema)
    text = _text(df, col)
    data = df.select(text.alias("json_str"), F.from_json(text, schema).alias("data"))
    exprs = {
        "event_time": event_ts(F.col("data.meta.dt")),
        "domain": F.col("data.meta.domain"),
        "stream": F.col("data.meta.stream"),
        "event_type": F.col("data.type"),
        "bot": default_false("data.bot"),
        "wiki": F.col("data.wiki"),
        "title": F.col("data.title"),
        "user": F.col("data.user"),
        "comment": F.col("data.comment"),
        "namespace": F.col("data.namespace"),
        "minor": default_false("data.minor"),
        "rev_content_changed": default_false("data.rev_content_changed"),
        "raw_json": F.col("json_str"),
        "message_id": F.col("data.meta.id"),
        "revision": F.col("data.revision.new"),
    }
    flat = data.select(*[exprs[c].alias(c) for c in wanted])
    return fence(flat, ["event_time", "stream"]).select(*wanted)


# Closes the probe array of is_valid_json; no payload contains it by chance.
_END = "end-of-value-5b1e0c7a"


def is_valid_json(col) -> Column:
    """True for exactly one well-formed JSON value.

    The variant parser stops after the first value, so the text is parsed as
    the first of two array elements: trailing text breaks the array or moves
    the second element away. Duplicate keys are valid (last one wins, set by
    :func:`pulse.config.use_utc`); ``NaN`` and ``Infinity`` are not JSON and
    are rejected.
    """
    c = F.col(col) if isinstance(col, str) else col
    probe = F.try_parse_json(F.concat(F.lit("["), c, F.lit(f',"{_END}"]')))
    return (F.coalesce(F.try_variant_get(probe, "$[1]", "string") == _END, F.lit(False))
            & F.try_variant_get(probe, "$[2]", "string").isNull() & F.try_parse_json(c).isNotNull())


def one_line(col) -> Column:
    """Well-formed JSON text on one line. A raw line break cannot stand inside a
    JSON string, so every one is white space between tokens."""
    c = F.col(col) if isinstance(col, str) else col
    return F.translate(c.cast("string"), "\r\n", "  ")


def valid_json(df: DataFrame, col: str = "value") -> DataFrame:
    """Rows whose payload is well-formed JSON (the stream keeps going)."""
    return df.filter(is_valid_json(_text(df, col)))


def malformed_json(df: DataFrame, col: str = "value") -> DataFrame:
    """Dead-letter side of :func:`valid_json` (null payloads included)."""
    return df.filter(~F.coalesce(is_valid_json(_text(df, col)), F.lit(False)))


def revisions_only(df: DataFrame) -> DataFrame:
    """Keep revision-create events only."""
    return df.filter(F.col("stream") == STREAM_REVISION_CREATE)


def topic_for(stream: Column, routes: Mapping[str, str] = DEFAULT_ROUTES,
              default: str = TOPIC_UNKNOWN) -> Column:
    expr = None
    for name, topic in routes.items():
        expr = (F.when(stream == name, topic) if expr is None
                else expr.when(stream == name, topic))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def with_topic(df: DataFrame, routes: Mapping[str, str] = DEFAULT_ROUTES,
               default: str = TOPIC_UNKNOWN, col: str = "value") -> DataFrame:
    """Add the Kafka ``topic`` chosen from ``meta.stream``.

    Missing or null ``meta`` or ``stream`` (and non-object JSON) route to the
    ``default`` topic.
    """
    stream = F.get_json_object(_text(df, col), "$.meta.stream")
    return df.withColumn("topic", topic_for(stream, routes, default))


def subscribed(df: DataFrame, topics: Iterable[str]) -> DataFrame:
    """What a consumer subscribed to ``topics`` sees of a routed record set."""
    return df.filter(F.col("topic").isin(list(topics)))


def to_value(df: DataFrame, col: str = "raw_json") -> DataFrame:
    """Standard events back to a one-column ``value``: the original JSON on one
    line (non-ASCII kept as is); rows without text are re-serialised from columns."""
    fallback = F.to_json(F.struct(*[c for c in df.columns if c != col]))
    return df.select(F.coalesce(one_line(col), fallback).alias("value"))
