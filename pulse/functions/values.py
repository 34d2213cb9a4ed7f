"""Small value helpers shared by metrics and shaping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def default_false(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit(False))


def flag_count(col) -> Column:
    """Number of rows where the boolean is true (null counts as false)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.count_if(F.coalesce(c, F.lit(False)))


def percent(col) -> Column:
    """Whole percent of a 0..1 ratio, half-up rounded; null counts as 0."""
    c = F.col(col) if isinstance(col, str) else col
    return F.floor(F.coalesce(c.cast("double"), F.lit(0.0)) * 100 + 0.5).cast("long")
