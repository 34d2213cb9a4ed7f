"""Registered queries: name -> ``(spark, sf_dir) -> DataFrame``.

Each query reads the driver's tables through :mod:`pulse.plans.fixtures` and
runs one library operator over the whole input; column names equal those of
the matching oracle in :mod:`pulse.plans.oracles`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulse.config import Config

from pulse.functions.time import with_time_partitions
from pulse.operators import metrics as M
from pulse.operators import parse as P
from pulse.operators import ranking as R
from pulse.operators import shaping as S
from pulse.plans.barriers import fence, materialize, run_folder
from pulse.plans.fixtures import capture_values, consumed_records, standard_events
from pulse.plans.streams import QUERIES as STREAM_QUERIES
from pulse.schema import STANDARD_COLUMNS
from pulse.sources.archive import compact_archive, read_raw
from pulse.sources.capture import frame_lines
from pulse.sources.files import jsonl_source
from pulse.streaming import jobs as J
from pulse.streaming import sinks as SK

Query = Callable[[SparkSession, str], DataFrame]


def _ev(spark, sf_dir):
    """Standard events, parsed down to the columns the metrics read."""
    return standard_events(spark, sf_dir, columns=M.METRIC_COLUMNS)


def q_parse_events(spark, sf_dir):
    cols = [c for c in STANDARD_COLUMNS if c != "raw_json"]
    return standard_events(spark, sf_dir, columns=cols)


def q_total_events_10s(spark, sf_dir):
    return M.total_events(_ev(spark, sf_dir))


def q_events_by_type_10s(spark, sf_dir):
    return M.events_by_type(_ev(spark, sf_dir))


def q_type_rank_10s(spark, sf_dir):
    return R.rank_in_window(M.events_by_type(_ev(spark, sf_dir)), "event_type")


def _top5(spark, sf_dir):
    # the ranking reads the per-(window, type) counts in three branches (top
    # rows, kept total, window total): materialise them once
    return R.top_n_with_others(materialize(M.events_by_type(_ev(spark, sf_dir))))


def q_top5_types_with_others(spark, sf_dir):
    return _top5(spark, sf_dir)


def q_bot_ratio_1m(spark, sf_dir):
    return M.bot_ratio(_ev(spark, sf_dir))


def q_latest_bot_ratio(spark, sf_dir):
    return R.latest_row(M.bot_ratio(_ev(spark, sf_dir)))


def q_domain_counts_5m(spark, sf_dir):
    return M.domain_counts(_ev(spark, sf_dir))


def q_top10_domains_latest(spark, sf_dir):
    # two passes (newest-window subquery, top-k): both read the materialised counts
    return R.top_domains(materialize(M.domain_counts(_ev(spark, sf_dir))))


def q_content_change_ratio_1m(spark, sf_dir):
    return M.content_change_ratio(_ev(spark, sf_dir))


def q_latest_content_change(spark, sf_dir):
    return R.latest_row(M.content_change_ratio(_ev(spark, sf_dir)))


def _retained_top5(spark, sf_dir):
    # ranking is per window, so the cut to the newest windows goes first
    return R.top_n_with_others(materialize(R.retain_latest(materialize(M.events_by_type(_ev(spark, sf_dir))))))


def q_retained_windows(spark, sf_dir):
    return _retained_top5(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "parse_events": q_parse_events,
    "total_events_10s": q_total_events_10s,
    "events_by_type_10s": q_events_by_type_10s,
    "type_rank_10s": q_type_rank_10s,
    "top5_types_with_others": q_top5_types_with_others,
    "bot_ratio_1m": q_bot_ratio_1m,
    "latest_bot_ratio": q_latest_bot_ratio,
    "domain_counts_5m": q_domain_counts_5m,
    "top10_domains_latest": q_top10_domains_latest,
    "content_change_ratio_1m": q_content_change_ratio_1m,
    "latest_content_change": q_latest_content_change,
    "retained_windows": q_retained_windows,
}


# --- routing, dead letters, archive layout -----------------------------------------


SERIES_POINTS = 60      # last-N of the series views (10 minutes of 10 s buckets)
PIE_POINTS = 360        # last-N of the type-share view (1 hour)
CORRUPT_EVERY = 7       # malformed_events: every 7th message loses its closing brace


def q_topic_routing(spark, sf_dir):
    """Text-based routing of every captured event: messages per topic."""
    routed = P.with_topic(capture_values(spark, sf_dir))
    return routed.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def q_malformed_events(spark, sf_dir):
    """Dead-letter side over a damaged copy of the whole capture (every 7th
    message loses its closing brace, i.e. arrives cut off): offsets of the
    messages that fail to parse. Every message is checked."""
    cap = capture_values(spark, sf_dir)
    cut = F.when(F.col("offset") % CORRUPT_EVERY == 0,
                 F.regexp_replace("value", r"\}$", "")).otherwise(F.col("value"))
    # fenced: the validity filter must not be pushed into the scan stage,
    # where it would re-serialise every event inside the filter
    damaged = fence(cap.select("offset", cut.alias("value")))
    return P.malformed_json(damaged).select("offset")


def q_raw_partitions(spark, sf_dir):
    """Rows per hourly archive partition (null times form the default partition)."""
    parts = with_time_partitions(_ev(spark, sf_dir).select("event_time"))
    out = parts.groupBy("year", "month", "day", "hour").agg(F.count(F.lit(1)).alias("n"))
    return out.fillna(-1, ["year", "month", "day", "hour"])      # -1: the default partition


# --- shaping ----------------------------------------------------------------------------

def _series(spark, sf_dir):
    return S.type_points(_retained_top5(spark, sf_dir))


def q_total_series_last_n(spark, sf_dir):
    return S.total_series(M.total_events(_ev(spark, sf_dir)), SERIES_POINTS)


def q_by_type_series_last_n(spark, sf_dir):
    return S.by_type_series(_retained_top5(spark, sf_dir), SERIES_POINTS)


def q_type_totals_share(spark, sf_dir):
    return S.type_share(materialize(S.type_totals(_series(spark, sf_dir), PIE_POINTS)))


def q_series_keys(spark, sf_dir):
    return R.series_keys(_series(spark, sf_dir))


def q_stacked_by_type(spark, sf_dir):
    series = materialize(_series(spark, sf_dir))     # keys, cutoff and pivot passes
    keys = S.series_key_list(series)
    return S.stacked_long(S.stacked_by_type(series, keys, SERIES_POINTS), keys)


def q_gauge_percent(spark, sf_dir):
    return S.gauge(M.bot_ratio(_ev(spark, sf_dir)), "bot_ratio")


def q_bot_object(spark, sf_dir):
    return S.bot_object(M.bot_ratio(_ev(spark, sf_dir)))


def q_content_change_object(spark, sf_dir):
    return S.content_change_object(M.content_change_ratio(_ev(spark, sf_dir)))


def q_top_wiki(spark, sf_dir):
    return S.top_wiki(R.top_domains(materialize(M.domain_counts(_ev(spark, sf_dir)))))


def _all_metrics(spark, sf_dir):
    """(the five metrics with metric 2 cut and ranked, newest event time) from one pass over the events."""
    ev = _ev(spark, sf_dir)
    m = M.metrics_of_cube(materialize(M.base_cube(ev)))
    top5 = materialize(R.top_n_with_others(materialize(R.retain_latest(materialize(m["m2"])))))
    return (materialize(m["m1"]), top5, materialize(m["m3"]), materialize(m["m4"]), materialize(m["m5"])), ev.select(F.max("event_time")).scalar()


def q_dashboard_document(spark, sf_dir):
    metrics, _ = _all_metrics(spark, sf_dir)
    return _filled(S.document_rows(S.dashboard(*metrics, limit=SERIES_POINTS, now=F.lit(0).cast("long"))))


def _filled(rows):
    """Document rows with -1 for a point's or value's absent numbers."""
    return rows.fillna(-1, ["t", "v"]).fillna(-1.0, ["ratio"])


def _store(spark, sf_dir):
    metrics, stamp = _all_metrics(spark, sf_dir)
    return materialize(SK.snapshot_table(*metrics, stamp))


def _document_at(spark, sf_dir, age: int):
    table = _store(spark, sf_dir)
    at = F.col("updated_at") + F.make_interval(secs=F.lit(age))
    return _filled(S.document_rows(S.dashboard_from_snapshots(SK.live_snapshots(table, at), SERIES_POINTS, F.lit(0).cast("long"))))


def q_dashboard_from_store(spark, sf_dir):
    """The document from the stored serving values, read as they are written."""
    return _document_at(spark, sf_dir, 0)


def q_dashboard_from_store_400s(spark, sf_dir):
    """... read 400 s later: the two 300 s values have expired and give zeros."""
    return _document_at(spark, sf_dir, SNAPSHOT_AGE_SECONDS)


QUERIES.update({
    "topic_routing": q_topic_routing,
    "malformed_events": q_malformed_events,
    "raw_partitions": q_raw_partitions,
    "total_series_last_n": q_total_series_last_n,
    "by_type_series_last_n": q_by_type_series_last_n,
    "type_totals_share": q_type_totals_share,
    "series_keys": q_series_keys,
    "stacked_by_type": q_stacked_by_type,
    "gauge_percent": q_gauge_percent,
    "bot_object": q_bot_object,
    "content_change_object": q_content_change_object,
    "top_wiki": q_top_wiki,
    "dashboard_document": q_dashboard_document,
    "dashboard_from_store": q_dashboard_from_store,
    "dashboard_from_store_400s": q_dashboard_from_store_400s,
})


# --- serving store and stored documents ---------------------------------------------------


SNAPSHOT_AGE_SECONDS = 400      # snapshot_live reads the store 400 s after writing it


def q_snapshot_live(spark, sf_dir):
    """Every value in the store stamped at the newest event time and read 400 s
    later: the 300 s values (bot ratio, content change) have expired."""
    table = _store(spark, sf_dir)
    live = SK.live_snapshots(table, F.col("updated_at") + F.make_interval(secs=F.lit(SNAPSHOT_AGE_SECONDS)))
    kind = "array<struct<ts:string,count:bigint,domain:string,type_counts:map<string,bigint>>>"
    rows = live.select("metric_key", "updated_at", "expires_at", F.inline(F.from_json("payload", kind)))
    counts = F.when(F.col("type_counts").isNull(), F.create_map(F.coalesce("domain", F.lit("")), "count")).otherwise(F.col("type_counts"))
    out = rows.select("metric_key", "updated_at", "expires_at", "ts", F.explode(counts).alias("name", "n"))
    return out.withColumn("name", F.nullif("name", F.lit("")))


def q_normalized_documents(spark, sf_dir):
    """Bot-ratio documents stored under three field namings, normalised."""
    m3 = M.bot_ratio(_ev(spark, sf_dir))
    style = (F.unix_seconds("window_start") / 60).cast("long") % 3
    iso = F.date_format("window_start", "yyyy-MM-dd'T'HH:mm:ss")
    doc = (F.when(style == 0, F.to_json(F.struct(
               F.struct(iso.alias("ts"), "bot_ratio", "bot_count", "total_count").alias("metric3"),
               F.lit(10).alias("bucketSec"))))
           .when(style == 1, F.to_json(F.struct(
               F.struct(F.col("bot_ratio").alias("ratio"), F.col("bot_count").alias("bot"),
                        F.col("total_count").alias("total"), F.lit(60).alias("windowSec")).alias("bot"),
               F.lit(10).alias("rangeMin"))))
           .otherwise(F.to_json(F.struct(
               F.struct("bot_ratio", "total_count").alias("bot_ratio")))))
    docs = m3.select(F.unix_seconds("window_start").alias("doc_id"), doc.alias("json"))
    out = S.normalize_dashboard(docs)
    return out.select("doc_id", "bucketSec", "rangeMin", F.col("bot.ratio").alias("ratio"),
                      F.col("bot.bot").alias("bot"), F.col("bot.total").alias("total"),
                      F.col("bot.windowSec").alias("windowSec"))


CAPTURE_FILES = 4        # capture_framing: events spread over 4 capture files
CAPTURE_SPLIT = 1000     # ... each cut into splits of 1000 events (bounded groups)


def _capture_lines(events):
    """(file, split, pos, line) of capture files that hold ``events`` (offset, value)."""
    cut = F.length(F.substring_index("value", ",", 1)) + 1          # position of the first comma
    lines = F.array(F.lit("event: message"), F.concat(F.lit("id: "), F.col("offset").cast("string")),
                    F.concat(F.lit("data: "), F.substring("value", 1, cut)),
                    F.concat(F.lit("data: "), F.expr("substring(value, length(substring_index(value, ',', 1)) + 2)")),
                    F.lit(""))
    per_event = events.select("offset", F.posexplode(lines).alias("i", "line"))
    return per_event.select(
        F.concat(F.lit("capture-"), (F.col("offset") % CAPTURE_FILES).cast("string")).alias("file"),
        (F.col("offset") / CAPTURE_FILES / CAPTURE_SPLIT).cast("long").alias("split"),
        (F.col("offset") * 5 + F.col("i")).alias("pos"), "line")


def q_capture_framing(spark, sf_dir):
    """SSE framing over a capture derived from the whole table.

    Every event becomes ``event:``, ``id:`` and two ``data:`` lines (its JSON
    cut after the first comma, so framing must re-join the parts) and a
    terminating blank line; every 7th event loses its closing brace. Lines go
    to 4 capture files in splits of 1000 events, are written once (like
    capture files on disk) and go through
    :func:`pulse.sources.capture.frame_lines`."""
    cap = capture_values(spark, sf_dir)
    damaged = cap.select("offset", F.when(F.col("offset") % CORRUPT_EVERY == 0,
                                          F.regexp_replace("value", r"\}$", "")).otherwise(F.col("value")).alias("v"))
    located = _capture_lines(damaged.select("offset", F.col("v").alias("value")))
    # written once, as capture files would be: framing reads it in two passes
    framed = frame_lines(materialize(located))
    meta = F.from_json("value", "type string, title string, revision struct<new:bigint>, meta struct<domain:string>")
    read = framed.select("sse_id", "is_valid", F.when(F.col("is_valid"), meta).alias("e"))
    return read.select("sse_id", "is_valid", F.col("e.type").alias("event_type"), F.col("e.title").alias("title"),
                       F.coalesce("e.revision.new", F.lit(-1).cast("long")).alias("revision"), F.col("e.meta.domain").alias("domain"))


QUERIES.update({
    "capture_framing": q_capture_framing,
    "snapshot_live": q_snapshot_live,
    "normalized_documents": q_normalized_documents,
})


# --- streams, sinks and the archive over files derived from the table -----------------


def _replayed(spark, sf_dir, folder: str):
    """The consumed records as JSON lines, read back as a stream."""
    consumed_records(spark, sf_dir).select(F.col("value").cast("string").alias("value")).write.text(f"{folder}/lines")
    return P.parse_events(jsonl_source(spark, f"{folder}/lines", streaming=True), columns=M.METRIC_COLUMNS)


def _stream_metric(name: str) -> Query:
    def query(spark, sf_dir):
        folder = run_folder(spark)
        layout = J.RunLayout(folder)
        J.start_metric(_replayed(spark, sf_dir, folder), name, layout, trigger={"availableNow": True}, refresh_snapshot=False).awaitTermination()
        return J.current_metric(spark, layout, name).select(*StructType.fromDDL(J.METRIC_SCHEMAS[name]).names)

    query.__doc__ = f"{name} as an update-mode stream over JSON lines, run to completion: the current revisions."
    return query


def q_jsonl_roundtrip(spark, sf_dir):
    """Every captured event cut into two ``data:`` lines, framed, written as JSON lines by
    the sink, read back and parsed: the same windows as the direct parse."""
    folder = run_folder(spark)
    framed = frame_lines(materialize(_capture_lines(capture_values(spark, sf_dir))))
    framed.select("value").write.parquet(f"{folder}/framed")
    stream = spark.readStream.schema("value string").parquet(f"{folder}/framed")
    SK.jsonl_sink(stream, f"{folder}/lines", f"{folder}/checkpoint", {"availableNow": True}).awaitTermination()
    records = P.subscribed(P.with_topic(jsonl_source(spark, f"{folder}/lines")), Config().topics)
    return M.events_by_type(P.parse_events(records, columns=M.METRIC_COLUMNS))


def q_archive_compacted_read(spark, sf_dir):
    """Rows per hour of a pruned range of the raw archive, of which closed hours were
    compacted before half of the events (late ones) arrived."""
    folder = run_folder(spark)
    ev = _ev(spark, sf_dir).withColumn("late", F.pmod(F.xxhash64("event_time", "domain", "event_type"), F.lit(2)))
    for late in (0, 1):
        SK.write_raw(ev.where(F.col("late") == late).drop("late"), f"{folder}/raw")
        if not late:
            compact_archive(spark, f"{folder}/raw", f"{folder}/compacted", "2024-01-01T04:00:00Z")
    rows = read_raw(spark, f"{folder}/raw", "2024-01-01T01:00:00Z", "2024-01-01T05:00:00Z", f"{folder}/compacted")
    return rows.groupBy("year", "month", "day", "hour").agg(F.count(F.lit(1)).alias("n"))


QUERIES.update({f"stream_metric_{i + 1}": _stream_metric(name) for i, name in enumerate(J.METRICS)})
QUERIES.update({"jsonl_roundtrip": q_jsonl_roundtrip, "archive_compacted_read": q_archive_compacted_read})
QUERIES.update(STREAM_QUERIES)
