"""Late events as rows: a side output beside the counted ones.

A stateful aggregate drops what its watermark has passed and tells only how
much that was. :class:`LateSplit` decides itself, micro-batch by micro-batch:
an event is late when its window ended at or before the watermark, which is the
newest event time of all earlier micro-batches less the delay. Late events are
kept as rows, with their window and their lateness; the others are counted, so
that the counts and the late rows together are all events that have a time.

Nothing is shuffled but partial counts; the state is one row per micro-batch.
Every output is keyed by the batch id and overwritten, so a micro-batch that
runs again after a failure leaves what its first run would have left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulse.config import WATERMARK, WINDOW_TOTAL
from pulse.functions.time import duration_seconds
from pulse.operators import metrics as M
from pulse.operators.metrics import WINDOW_KEYS

# One counted metric: events -> window_start, window_end, dimensions..., count.
Count = Callable[[DataFrame], DataFrame]


class LateSplit:
    """Splits a stream of standard events into counted windows and late rows, under ``path``.

    ``count`` is a windowed count without a watermark (default: metric 1) over
    ``window``; its last column is the count. ``late/``, ``counts/`` and
    ``bounds/`` hold one directory per micro-batch.
    """

    def __init__(self, path: str, window: str = WINDOW_TOTAL, watermark: str = WATERMARK, count: Count | None = None):
        self.path = path.rstrip("/")
        self.window, self.watermark = duration_seconds(window), duration_seconds(watermark)
        self.count = count or (lambda events: M.total_events(events, window, watermark=None))

    def _bound(self, spark: SparkSession, batch_id: int):
        """Newest event time (microseconds) before this micro-batch; None before the first event."""
        if batch_id == 0:
            return None
        return spark.read.parquet(f"{self.path}/bounds/batch_id={batch_id - 1}").first()["newest"]

    def on_batch(self, batch: DataFrame, batch_id: int) -> None:
        """The ``foreachBatch`` callback. One row of sums and the bound reach the driver."""
        spark = batch.sparkSession
        bound = self._bound(spark, batch_id)
        t = F.unix_micros("event_time")
        width = self.window * 1_000_000
        start = t - F.pmod(t, F.lit(width))
        limit = F.lit(None if bound is None else bound - self.watermark * 1_000_000).cast("long")
        late = F.coalesce(start + width <= limit, F.lit(False))
        batch = batch.persist()
        try:
            got = batch.agg(F.max(t).alias("newest"), F.count(F.lit(1)).alias("rows"), F.count_if(late).alias("late"), F.count_if(t.isNull()).alias("untimed")).first()
            side = batch.where(late).select("*", F.timestamp_micros(start).alias("window_start"), F.timestamp_micros(start + width).alias("window_end"), (limit - t).alias("late_micros"))
            side.write.mode("overwrite").parquet(f"{self.path}/late/batch_id={batch_id}")
            self.count(batch.where(~late)).write.mode("overwrite").parquet(f"{self.path}/counts/batch_id={batch_id}")
        finally:
            batch.unpersist()
        newest = max((x for x in (bound, got["newest"]) if x is not None), default=None)
        row = (newest, got["rows"], got["late"], got["untimed"])
        spark.createDataFrame([row], "newest long, rows long, late long, untimed long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/bounds/batch_id={batch_id}")

    def start(self, events: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """Keep ``checkpoint`` with ``path``: a new checkpoint numbers its micro-batches anew."""
        w = events.writeStream.foreachBatch(self.on_batch).option("checkpointLocation", checkpoint)
        return (w.trigger(**trigger) if trigger else w).start()

    def late(self, spark: SparkSession) -> DataFrame:
        """Late events with ``window_start, window_end, late_micros`` (watermark less event time) and ``batch_id``."""
        return spark.read.parquet(f"{self.path}/late")

    def counted(self, spark: SparkSession) -> DataFrame:
        """The windows' counts: each micro-batch's are increments, summed here."""
        log = spark.read.parquet(f"{self.path}/counts").drop("batch_id")
        *keys, n = log.columns
        return log.groupBy(*keys).agg(F.sum(n).cast("long").alias(n))

    def totals(self, spark: SparkSession) -> DataFrame:
        """Rows read, late and without a time, over all micro-batches."""
        sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("rows", "late", "untimed")]
        try:
            return spark.read.parquet(f"{self.path}/bounds").agg(*sums)
        except AnalysisException:       # no micro-batch yet
            return spark.createDataFrame([], "rows long, late long, untimed long").agg(*sums)


def window_lateness(late: DataFrame) -> DataFrame:
    """Per window: ``late_count`` and the greatest lateness in microseconds."""
    return late.groupBy(*WINDOW_KEYS).agg(F.count(F.lit(1)).alias("late_count"), F.max("late_micros").alias("max_late_micros"))
