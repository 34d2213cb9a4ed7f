"""Column-level time helpers (all JVM built-ins, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulse.config import EVENT_TIME_PATTERN


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def event_ts(col) -> Column:
    """ISO-8601 text to a timestamp; null (never an error) on bad input.

    The fixed pattern ``yyyy-MM-dd'T'HH:mm:ss.SSSX`` is tried first; the
    pattern-free parse then accepts the other valid ISO shapes (no millis,
    micros, ``+00:00`` offsets), so this accepts more than the fixed pattern.
    Text without a full date is bad input: a bare time would become today's.
    """
    c = _c(col)
    dated = F.when(c.rlike(r"^\s*\d{4}-\d{2}-\d{2}"), c)
    return F.coalesce(F.try_to_timestamp(c, F.lit(EVENT_TIME_PATTERN)), F.try_to_timestamp(dated))


def iso_to_epoch(col) -> Column:
    """ISO text to epoch seconds (long), null when it cannot be parsed."""
    return F.unix_seconds(event_ts(col))


def epoch_seconds(col) -> Column:
    """Timestamp to epoch seconds (long)."""
    return F.unix_seconds(_c(col))


def iso_text(col) -> Column:
    """Timestamp to naive ISO text (``2024-01-01T00:00:10``) in the session zone."""
    return F.date_format(_c(col), "yyyy-MM-dd'T'HH:mm:ss")


def with_time_partitions(df, time_col: str = "event_time"):
    """Calendar partition columns year/month/day/hour of the event time."""
    t = F.col(time_col)
    return df.select(
        "*",
        F.year(t).alias("year"),
        F.month(t).alias("month"),
        F.dayofmonth(t).alias("day"),
        F.hour(t).alias("hour"),
    )


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def duration_seconds(text: str) -> int:
    """Seconds of a duration such as ``10 seconds`` or ``2 minutes``."""
    n, unit = text.split()
    return int(n) * _UNIT_SECONDS[unit.lower().rstrip("s")]
