"""Streaming jobs: the five update-mode metric queries and the raw archive.

Each metric query is ``metric(events)`` -> ``writeStream.outputMode("update")
.foreachBatch`` with one checkpoint per query under a common base. The batch
callback writes the changed rows to the metric's update log (one write
action, replay-safe) and then refreshes that metric's serving snapshot from
the log's current revisions.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from pulse.config import (
    RETAINED_WINDOWS,
    KEY_BOT,
    KEY_BY_TYPE,
    KEY_CONTENT,
    KEY_TOP,
    KEY_TOTAL,
    WATERMARK,
    checkpoint_root,
)
from pulse.operators import metrics as M
from pulse.operators import ranking as R
from pulse.operators.metrics import WINDOW_KEYS
from pulse.streaming import sinks as S


_WIN = "window_start timestamp, window_end timestamp"
# Output schema of every metric (JSON history logs are read back with it).
METRIC_SCHEMAS = {
    "events_total": f"{_WIN}, event_count long",
    "events_by_type": f"{_WIN}, event_type string, cnt long",
    "bot_ratio": f"{_WIN}, total_count long, bot_count long, bot_ratio double",
    "top_domains": f"{_WIN}, domain string, cnt long",
    "content_change_ratio": f"{_WIN}, total_revision_count long, content_changed_count long, "
                            "content_change_ratio double",
}


@dataclass(frozen=True)
class MetricSpec:
    name: str
    build: Callable[[DataFrame, str], DataFrame]   # (events, watermark) -> metric
    keys: tuple[str, ...]                           # key of one metric row
    snapshot_key: str
    snapshot: Callable[[DataFrame], DataFrame]      # current metric -> one-row payload
    retained: int = RETAINED_WINDOWS                # windows that the serving value can show


METRICS: dict[str, MetricSpec] = {
    "events_total": MetricSpec(
        "events_total", lambda ev, wm: M.total_events(ev, watermark=wm), tuple(WINDOW_KEYS),
        KEY_TOTAL, S.series_snapshot),
    "events_by_type": MetricSpec(
        "events_by_type", lambda ev, wm: M.events_by_type(ev, watermark=wm),
        (*WINDOW_KEYS, "event_type"), KEY_BY_TYPE,
        lambda cur: S.type_series_snapshot(R.top_n_with_others(cur))),
    "bot_ratio": MetricSpec(
        "bot_ratio", lambda ev, wm: M.bot_ratio(ev, watermark=wm), tuple(WINDOW_KEYS), KEY_BOT,
        lambda cur: S.latest_snapshot(cur, "bot_ratio", ["bot_count", "total_count"]), retained=1),
    "top_domains": MetricSpec(
        "top_domains", lambda ev, wm: M.domain_counts(ev, watermark=wm), (*WINDOW_KEYS, "domain"),
        KEY_TOP, S.ranking_snapshot, retained=1),
    "content_change_ratio": MetricSpec(
        "content_change_ratio", lambda ev, wm: M.content_change_ratio(ev, watermark=wm),
        tuple(WINDOW_KEYS), KEY_CONTENT,
        lambda cur: S.latest_snapshot(cur, "content_change_ratio",
                                      ["content_changed_count", "total_revision_count"]), retained=1),
}


class RunLayout:
    """Where one run keeps its outputs: raw archive, update logs, snapshots
    and checkpoints under one base, so batch ids and logs stay consistent
    (a new checkpoint restarts batch ids at 0 -- use a new base with it)."""

    def __init__(self, base: str):
        self.base = base.rstrip("/")

    def raw(self) -> str:
        return f"{self.base}/raw"

    def log(self, name: str) -> str:
        return f"{self.base}/history/{name}"

    def snapshots(self) -> str:
        return f"{self.base}/snapshots"

    def serving(self, name: str) -> str:
        return f"{self.base}/serving/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.base}/checkpoints/{name}"


def default_layout(spark: SparkSession, run: str = "pulse", fallback: str | None = None) -> RunLayout:
    """Layout under the cluster's shared ``spark.checkpoint.dir``."""
    return RunLayout(f"{checkpoint_root(spark, fallback)}/{run}")


def _log(layout: RunLayout, name: str, history_format: str) -> S.UpdateLog:
    schema = StructType.fromDDL(METRIC_SCHEMAS[name]) if history_format != "parquet" else None
    return S.UpdateLog(layout.log(name), history_format, schema)


def metric_batch_writer(spec: MetricSpec, layout: RunLayout, refresh_snapshot: bool = True,
                        retained: int | None = None, history_format: str = "parquet"):
    """The ``foreachBatch`` callback of one metric query.

    Writes the changed rows to the history log; with ``refresh_snapshot`` it
    also merges them into the bounded serving state and rewrites the metric's
    serving value from that state (never from the whole history).
    """
    log = _log(layout, spec.name, history_format)
    serving = S.ServingState(layout.serving(spec.name), list(spec.keys), retained or spec.retained)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():          # no-data batch (watermark advance only)
                return
            log.write(batch, batch_id)
            cur = serving.update(batch, batch_id) if refresh_snapshot else None
        finally:
            batch.unpersist()
        if refresh_snapshot:
            now = F.current_timestamp()
            row = S.snapshot_rows(spec.snapshot(cur), spec.snapshot_key, now)
            S.write_snapshot(row, f"{layout.snapshots()}/metric={spec.name}", batch_id)

    return on_batch


def start_metric(events: DataFrame, name: str, layout: RunLayout, watermark: str | None = WATERMARK,
                 trigger: dict | None = None, refresh_snapshot: bool = True,
                 history_format: str = "parquet") -> StreamingQuery:
    spec = METRICS[name]
    w = (spec.build(events, watermark).writeStream.outputMode("update")
         .foreachBatch(metric_batch_writer(spec, layout, refresh_snapshot, history_format=history_format))
         .option("checkpointLocation", layout.checkpoint(name)).queryName(f"pulse_{name}"))
    return (w.trigger(**trigger) if trigger else w).start()


def start_raw(events: DataFrame, layout: RunLayout, trigger: dict | None = None) -> StreamingQuery:
    return S.raw_sink(events, layout.raw(), layout.checkpoint("raw"), trigger)


def run_all(events: DataFrame, layout: RunLayout, watermark: str = WATERMARK,
            trigger: dict | None = None, metrics: list[str] | None = None,
            raw: bool = True, metrics_from_archive: bool = False,
            history_format: str = "parquet") -> list[StreamingQuery]:
    """Start the raw archive and the metric queries over one event stream.

    By default every metric query reads ``events`` itself (one source read and
    JSON parse per query, as in the original job). With
    ``metrics_from_archive=True`` only the archive query parses; the metric
    queries stream the archived Parquet instead, column-pruned and parse-free,
    at the cost of one archive commit of extra latency.
    """
    queries = [start_raw(events, layout, trigger)] if raw or metrics_from_archive else []
    source = events
    if metrics_from_archive:
        from pulse.sources.archive import archive_stream

        if trigger and (trigger.get("availableNow") or trigger.get("once")):
            # run-to-completion triggers see only the files present at start:
            # let the archive finish before its readers start
            queries[0].awaitTermination()
        source = archive_stream(events.sparkSession, layout.raw())
    for name in metrics or list(METRICS):
        queries.append(start_metric(source, name, layout, watermark, trigger, history_format=history_format))
    return queries


def await_any(spark: SparkSession, timeout: float | None = None) -> None:
    """Return when any query stops (its error, if any, is raised)."""
    spark.streams.awaitAnyTermination(timeout)


def current_metric(spark: SparkSession, layout: RunLayout, name: str,
                   history_format: str = "parquet") -> DataFrame:
    """Current revision of every row of a metric's update log."""
    spec = METRICS[name]
    return S.current(_log(layout, name, history_format).read(spark), list(spec.keys))


def stored_snapshots(spark: SparkSession, layout: RunLayout) -> DataFrame:
    return spark.read.parquet(layout.snapshots())


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming aggregation state in RocksDB (Spark's built-in provider)
    instead of executor memory: the per-(window, domain) state of metric 4
    grows with the number of wikis. Must be set before a query first starts
    from its checkpoint."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass",
                   "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB (:func:`use_rocksdb_state`); the session's setting comes back after."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    use_rocksdb_state(spark)
    try:
        yield
    finally:
        spark.conf.set(key, before)


class LateRows(StreamingQueryListener):
    """Rows that the stateful aggregates dropped as late, per query name, over all
    micro-batches since it was added (``spark.streams.addListener``)."""

    def __init__(self) -> None:
        self.dropped: dict[str | None, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        late = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        self.dropped[event.progress.name] = self.dropped.get(event.progress.name, 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def dropped_late_rows(query: StreamingQuery) -> int:
    """Rows the stateful aggregate dropped as late, over the micro-batches
    still in the query's progress history (``recentProgress``); :class:`LateRows`
    counts all of them."""
    return sum(op.get("numRowsDroppedByWatermark", 0)
               for progress in (query.recentProgress or [])
               for op in progress.get("stateOperators", []))


def main(argv: list[str] | None = None) -> None:
    """``spark-submit -m pulse.streaming.jobs --servers ... [--base ...]``.

    Kafka (both topics) -> parse -> raw archive + five metric queries, all
    outputs under ``--base`` (default: ``<spark.checkpoint.dir>/pulse``);
    returns when any query stops.
    """
    import argparse

    from pulse.config import Config, use_utc
    from pulse.operators.parse import parse_events
    from pulse.sources.kafka import kafka_source

    ap = argparse.ArgumentParser(prog="pulse")
    ap.add_argument("--servers", default=Config.kafka_servers)
    ap.add_argument("--topics", default=",".join(Config.topics))
    ap.add_argument("--max-offsets-per-trigger", type=int, default=Config.max_offsets_per_trigger)
    ap.add_argument("--min-partitions", type=int, default=Config.min_partitions)
    ap.add_argument("--base", default=None)
    ap.add_argument("--watermark", default=Config.watermark)
    ap.add_argument("--metrics-from-archive", action="store_true")
    ap.add_argument("--rocksdb-state", action="store_true")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("pulse").getOrCreate()
    use_utc(spark)
    if args.rocksdb_state:
        use_rocksdb_state(spark)
    cfg = Config(kafka_servers=args.servers, topics=tuple(args.topics.split(",")),
                 max_offsets_per_trigger=args.max_offsets_per_trigger, min_partitions=args.min_partitions)
    layout = RunLayout(args.base) if args.base else default_layout(spark)
    events = parse_events(kafka_source(spark, cfg))
    run_all(events, layout, args.watermark, metrics_from_archive=args.metrics_from_archive)
    await_any(spark)


if __name__ == "__main__":
    main()


def capture_producer(spark: SparkSession, captures: str, out: str, checkpoint: str,
                     trigger: dict | None = None, max_files_per_trigger: int | None = None,
                     kafka_servers: str | None = None) -> StreamingQuery:
    """Ingest job: new SSE capture files -> framed events -> topic routing.

    Each micro-batch frames the capture files that arrived (whole files, line
    split, see :mod:`pulse.sources.capture`), drops malformed events and routes
    the rest by ``meta.stream``. The result goes to JSON lines under
    ``<out>/batch_id=<n>/topic=<topic>`` (overwrite per batch id, so a replay
    rewrites its own output) or, with ``kafka_servers``, to Kafka.
    """
    from pulse.operators.parse import one_line, with_topic
    from pulse.sources.capture import frame_lines, valid_events

    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(captures)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        # positions are taken on the micro-batch (a plain scan of its new files)
        located = batch.select(F.input_file_name().alias("file"), F.input_file_block_start().alias("split"),
                               F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line"))
        routed = with_topic(valid_events(frame_lines(located)))
        if kafka_servers:
            for_kafka = S.kafka_frame(routed).write.format("kafka")
            for k, v in S.kafka_sink_options(kafka_servers).items():
                for_kafka = for_kafka.option(k, v)
            for_kafka.save()
        else:
            (routed.select(one_line("value").alias("value"), "topic")
             .write.mode("overwrite").partitionBy("topic").text(f"{out}/batch_id={batch_id}"))

    w = lines.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()
