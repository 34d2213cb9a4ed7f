"""Data-quality counters that ride on a pass over the events (``DataFrame.observe``).

The counters are aggregates beside the rows: they cost no scan and no shuffle of
their own, only the one predicate each. In batch an ``Observation`` gives them
when the pass has run; in a stream every micro-batch's progress carries them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from pulse.config import STREAM_RECENTCHANGE, STREAM_REVISION_CREATE
from pulse.operators.parse import is_valid_json

COUNTERS = ["rows", "malformed", "null_time", "unknown_stream", "no_type"]
NAME = "quality"


def quality_columns(streams: Iterable[str] = (STREAM_RECENTCHANGE, STREAM_REVISION_CREATE)) -> list[Column]:
    """One aggregate per counter over standard events (with ``raw_json``).

    ``malformed`` rows hold no well-formed JSON value (null text included),
    ``null_time`` rows have no usable event time (they are in no window and in
    the archive's default partition), ``unknown_stream`` rows name none of
    ``streams``, ``no_type`` rows have no type. A row counts in all that fit.
    """
    known = F.coalesce(F.col("stream").isin(list(streams)), F.lit(False))
    malformed = ~F.coalesce(is_valid_json("raw_json"), F.lit(False))
    found = [F.count(F.lit(1)), F.count_if(malformed), F.count_if(F.col("event_time").isNull()), F.count_if(~known), F.count_if(F.col("event_type").isNull())]
    return [c.alias(name) for name, c in zip(COUNTERS, found)]


def observed(events: DataFrame, observation: Observation | str = NAME) -> DataFrame:
    """``events`` unchanged, counted on the way: batch with an ``Observation``, stream with a name."""
    return events.observe(observation, *quality_columns())


def counter_rows(spark: SparkSession, counters: dict) -> DataFrame:
    """(counter, n) of observed values; an empty pass has zeros."""
    rows = [(c, int(counters.get(c) or 0)) for c in COUNTERS]
    return spark.createDataFrame(rows, "counter string, n long")


def progress_counters(progress) -> dict[str, int]:
    """The counters of one micro-batch's progress ({} if the query observes none)."""
    seen = progress["observedMetrics"] if isinstance(progress, dict) else progress.observedMetrics
    row = dict(seen or {}).get(NAME)
    if row is None:
        return {}
    values = row.asDict() if hasattr(row, "asDict") else dict(row)
    return {c: int(values[c]) for c in COUNTERS}


class QualityLog(StreamingQueryListener):
    """Counters of every query that observes them, summed over its micro-batches.

    Kept by batch id, so a micro-batch that runs again after a failure counts
    once. Add with ``spark.streams.addListener``. ``totals`` gives the sums.
    """

    def __init__(self) -> None:
        self.closed: dict[str, dict[str, int]] = {}
        self.last: dict[str, tuple[int, dict[str, int]]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = progress_counters(event.progress)
        if not found:
            return
        query, batch = str(event.progress.id), event.progress.batchId
        before = self.last.get(query)
        if before is not None and before[0] < batch:
            total = self.closed.setdefault(query, dict.fromkeys(COUNTERS, 0))
            for c in COUNTERS:
                total[c] += before[1][c]
        if before is None or before[0] <= batch:
            self.last[query] = (batch, found)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def totals(self, query_id: str) -> dict[str, int]:
        """Sums of one query's counters, by its id (stable over restarts from its checkpoint)."""
        closed = self.closed.get(query_id, {})
        last = self.last.get(query_id, (0, {}))[1]
        return {c: closed.get(c, 0) + last.get(c, 0) for c in COUNTERS}
