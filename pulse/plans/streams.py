"""Registered queries that run a stream over replayed messages, and those of the operators built with them.

Names and columns equal those of the oracles in :mod:`pulse.plans.stream_oracles`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulse.operators import counters as C
from pulse.operators import edits as E
from pulse.operators import metrics as M
from pulse.operators import parse as P
from pulse.operators import sketches as K
from pulse.operators.drift import schema_drift
from pulse.plans import replays
from pulse.plans.barriers import materialize, run_folder
from pulse.plans.fixtures import standard_events
from pulse.schema import STANDARD_COLUMNS
from pulse.sources.archive import read_raw
from pulse.sources.capture import sse_events
from pulse.sources.capture_source import capture_source
from pulse.sources.files import jsonl_source
from pulse.streaming import jobs as J
from pulse.streaming import sinks as SK
from pulse.streaming.audit import open_windows
from pulse.streaming.late import LateSplit
from pulse.streaming.top import top_types_closed

NOW = {"availableNow": True}


def _stream(spark, lines: str, columns=None) -> DataFrame:
    return P.parse_events(jsonl_source(spark, lines, streaming=True), columns=columns)


# --- captures as a data source (SRC2) -----------------------------------------------------


def _capture_fields(events):
    meta = F.from_json("value", "type string, title string, revision struct<new:bigint>, meta struct<domain:string>")
    read = events.select("sse_id", "is_valid", F.when(F.col("is_valid"), meta).alias("e"))
    return read.select("sse_id", "is_valid", F.col("e.type").alias("event_type"), F.col("e.title").alias("title"),
                       F.coalesce("e.revision.new", F.lit(-1).cast("long")).alias("revision"), F.col("e.meta.domain").alias("domain"))


def q_capture_files(spark, sf_dir):
    """Capture files read line by line as Spark splits them, and framed."""
    path = replays.capture_files(replays.captured(spark, sf_dir), run_folder(spark), cut=False)
    return _capture_fields(sse_events(spark, f"{path}/*"))


def q_capture_source(spark, sf_dir):
    """Two captures in rotated files that cut events, read by the data source in ranges smaller than a file."""
    path = replays.capture_files(replays.captured(spark, sf_dir), run_folder(spark))
    return _capture_fields(capture_source(spark, path, split_bytes=1 << 20))


def q_stream_capture_source(spark, sf_dir):
    """The same as a stream, run to completion."""
    folder = run_folder(spark)
    path = replays.capture_files(replays.captured(spark, sf_dir), folder)
    stream = capture_source(spark, path, streaming=True, split_bytes=1 << 20)
    (stream.writeStream.format("parquet").option("path", f"{folder}/events").option("checkpointLocation", f"{folder}/checkpoint").trigger(**NOW).start().awaitTermination())
    return _capture_fields(spark.read.parquet(f"{folder}/events"))


# --- late rows (STR3) -------------------------------------------------------------------


def q_late_events(spark, sf_dir):
    """Shuffled messages split as they arrive: every late event as a row, and the windows' counts of all others."""
    folder = run_folder(spark)
    split = LateSplit(f"{folder}/split")
    columns = ["event_time", "domain", "event_type"]
    replays.deliver(replays.shuffled(spark, sf_dir), folder,
                    lambda lines: split.start(_stream(spark, lines, columns), f"{folder}/checkpoint", NOW).awaitTermination())
    late = split.late(spark).select(F.lit("late").alias("part"), "window_start", "event_time", "domain", "event_type", "late_micros", F.lit(1).cast("long").alias("n"))
    counted = split.counted(spark).select(F.lit("counted").alias("part"), "window_start", F.lit(None).cast("timestamp").alias("event_time"), F.lit(None).cast("string").alias("domain"),
                                          F.lit(None).cast("string").alias("event_type"), F.lit(None).cast("long").alias("late_micros"), F.col("event_count").alias("n"))
    totals = split.totals(spark).select(F.lit("untimed").alias("part"), *(F.lit(None).cast(counted.schema[c].dataType).alias(c) for c in counted.columns[1:-1]), F.col("untimed").alias("n"))
    return _plain(late.unionByName(counted).unionByName(totals))


def _plain(rows):
    """-1 for the numbers that a part does not have."""
    return rows.fillna(-1, ["late_micros"])


# --- quality counters (D20) ---------------------------------------------------------------


def q_quality_counters(spark, sf_dir):
    """Counters over a damaged capture, taken by the pass that archives it."""
    seen = Observation(C.NAME)
    SK.write_raw(C.observed(P.parse_events(replays.captured(spark, sf_dir).select("value")), seen), f"{run_folder(spark)}/raw")
    return C.counter_rows(spark, seen.get)


def q_stream_quality_counters(spark, sf_dir):
    """The same counters from the micro-batches of the streaming archive."""
    folder, totals = run_folder(spark), dict.fromkeys(C.COUNTERS, 0)

    def run(lines: str) -> None:
        query = J.start_raw(C.observed(_stream(spark, lines)), J.RunLayout(folder), NOW)
        query.awaitTermination()
        for progress in query.recentProgress:       # one micro-batch a run
            for c, n in C.progress_counters(progress).items():
                totals[c] += n

    replays.deliver(replays.captured(spark, sf_dir), folder, run)
    return C.counter_rows(spark, totals)


# --- each message and each edit once (D6) ---------------------------------------------------


def q_stream_unique_messages(spark, sf_dir):
    """Metric 1 over messages of which some are delivered again: as if each had come once."""
    folder = run_folder(spark)
    layout = J.RunLayout(folder)

    def run(lines: str) -> None:
        once = E.unique_messages(_stream(spark, lines, [*M.METRIC_COLUMNS, "message_id"]))
        J.start_metric(once, "events_total", layout, watermark=None, trigger=NOW, refresh_snapshot=False).awaitTermination()

    replays.deliver(replays.redelivered(spark, sf_dir), folder, run)
    return J.current_metric(spark, layout, "events_total").select(*StructType.fromDDL(J.METRIC_SCHEMAS["events_total"]).names)


def _edit_windows(edits):
    """Edits per 10-second window and who told of them."""
    timed = edits.where(F.col("event_time").isNotNull())
    out = timed.groupBy(F.window("event_time", "10 seconds").alias("w"), "told_by").agg(
        F.count(F.lit(1)).alias("edits"), F.count_if("bot").alias("bots"), F.count_if("rev_content_changed").alias("changed"))
    return M.unpack_window(out)


def q_unique_edits_10s(spark, sf_dir):
    """Edits per window, each once, whichever topics told of it."""
    messages = replays.announced_edits(spark, sf_dir).select("value")
    return _edit_windows(E.unique_edits(P.parse_events(messages, columns=E.EDIT_COLUMNS)))


def q_unique_bot_ratio_1m(spark, sf_dir):
    """Metric 3 over edits instead of events: an edit that both topics tell of counts once."""
    messages = replays.announced_edits(spark, sf_dir).select("value")
    return M.bot_ratio(E.unique_edits(P.parse_events(messages, columns=E.EDIT_COLUMNS)))


def q_stream_unique_edits(spark, sf_dir):
    """The same by a stream-stream join over messages as they arrive, up to where the watermark has closed it."""
    folder = run_folder(spark)

    def run(lines: str) -> None:
        edits = E.unique_edits(_stream(spark, lines, E.EDIT_COLUMNS))
        (edits.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/edits")
         .option("checkpointLocation", f"{folder}/checkpoint").trigger(**NOW).start().awaitTermination())

    replays.deliver(replays.announced_edits(spark, sf_dir), folder, run)
    events = P.parse_events(jsonl_source(spark, f"{folder}/lines"), columns=E.EDIT_COLUMNS)
    return _edit_windows(E.closed_edits(spark.read.parquet(f"{folder}/edits"), events))


# --- sketches -----------------------------------------------------------------------------


def _hourly_sketches(spark, sf_dir):
    five = materialize(K.window_sketches(standard_events(spark, sf_dir, columns=["event_time", "domain", "user"])))
    return K.merge_sketches(five, "1 hour")


def q_sketch_distinct_1h(spark, sf_dir):
    """Hourly distinct domains and users from merged 5-minute sketches, held against exact counts."""
    exact = standard_events(spark, sf_dir, columns=["event_time", "domain", "user"])
    exact = M.unpack_window(exact.groupBy(F.window("event_time", "1 hour").alias("w")).agg(F.countDistinct("domain").alias("domains"), F.countDistinct("user").alias("users")))
    both = K.distinct_estimates(_hourly_sketches(spark, sf_dir)).join(exact, M.WINDOW_KEYS)

    def near(dim: str, name: str):
        return (F.abs(F.col(f"{dim}_distinct") - F.col(name)) <= F.greatest(F.lit(1.0), K.distinct_error() * F.col(name))).alias(f"{name}_near")

    return both.select(*M.WINDOW_KEYS, "n", "domains", "users", near("domain", "domains"), near("user", "users"))


def q_sketch_domains_1h(spark, sf_dir):
    """Hourly domain counts from merged 5-minute sketches: exact while fewer domains than followed items occur."""
    return K.top_estimates(_hourly_sketches(spark, sf_dir), k=K.TRACKED // 2)


# --- ranking closed windows in the stream, state audit, schema drift ------------------------


def q_stream_top5_closed(spark, sf_dir):
    """Top 5 + others of every window that the watermark has closed, given out once by the stream itself."""
    folder = run_folder(spark)

    def run(lines: str) -> None:
        top = top_types_closed(_stream(spark, lines, M.METRIC_COLUMNS))
        (top.writeStream.format("parquet").outputMode("append").option("path", f"{folder}/top")
         .option("checkpointLocation", f"{folder}/checkpoint").trigger(**NOW).start().awaitTermination())

    with J.rocksdb_state(spark):
        replays.deliver(replays.in_order(spark, sf_dir), folder, run)
    return spark.read.parquet(f"{folder}/top")


def q_state_audit(spark, sf_dir):
    """The open windows of metric 2 after a run: what the stream's state holds and what its log says."""
    folder = run_folder(spark)
    layout = J.RunLayout(folder)
    replays.deliver(replays.in_order(spark, sf_dir), folder, lambda lines: J.start_metric(
        _stream(spark, lines, M.METRIC_COLUMNS), "events_by_type", layout, trigger=NOW, refresh_snapshot=False).awaitTermination())
    return open_windows(spark, layout, "events_by_type")


def q_schema_drift(spark, sf_dir):
    """Fields that the fixed schema drops or nulls, per stream, with their types, over a capture that has drifted."""
    return schema_drift(replays.drifted(spark, sf_dir))


# --- the streaming archive and the whole job (STR5, STR8, PRJ6, PRJ9) ----------------------


def q_stream_raw_archive(spark, sf_dir):
    """The streaming raw archive read back: every message's own JSON beside its columns, with fields that no column has."""
    folder = run_folder(spark)
    layout = J.RunLayout(folder)
    replays.deliver(replays.in_order(spark, sf_dir), folder, lambda lines: J.start_raw(_stream(spark, lines), layout, NOW).awaitTermination())
    fields = F.from_json("raw_json", "meta struct<id:string,uri:string>, revision struct<new:bigint,old:bigint>, length struct<new:bigint>, patrolled boolean")
    return read_raw(spark, layout.raw()).select("event_time", "domain", "year", "hour", fields.alias("f")).select(
        F.col("f.meta.id").alias("id"), F.col("f.meta.uri").alias("uri"), F.col("f.revision.new").alias("revision"), F.col("f.revision.old").alias("parent"),
        F.col("f.length.new").alias("length"), F.col("f.patrolled").alias("patrolled"), "event_time", "domain",
        F.coalesce("year", F.lit(-1)).alias("year"), F.coalesce("hour", F.lit(-1)).alias("hour"))


def q_archive_domain_read(spark, sf_dir):
    """One domain's events of a range of hours from an archive clustered by domain: other row groups are skipped."""
    path = f"{run_folder(spark)}/raw"
    SK.write_raw(standard_events(spark, sf_dir, columns=["event_time", "domain", "event_type", "title"]), path, cluster_by=["domain"], row_group_bytes=1 << 15)
    rows = read_raw(spark, path, "2024-01-01T01:00:00Z", "2024-01-01T05:00:00Z").where(F.col("domain") == "w7.example.org")
    return rows.select("event_time", "domain", "event_type", "title")


def q_reserialised_events(spark, sf_dir):
    """Standard events to JSON and back: the original text where it was kept, else from the columns."""
    events = standard_events(spark, sf_dir, columns=[*STANDARD_COLUMNS, "message_id"])
    some = events.withColumn("raw_json", F.when(F.col("message_id").cast("long") % 3 != 0, F.col("raw_json")))
    read = F.from_json("value", "meta struct<id:string,domain:string>, type string, title string, message_id string, domain string, event_type string, bot boolean")
    out = P.to_value(some).select(read.alias("e"))
    return out.select(F.coalesce("e.meta.id", "e.message_id").alias("id"), F.coalesce("e.meta.domain", "e.domain").alias("domain"),
                      F.coalesce("e.type", "e.event_type").alias("event_type"), "e.title", F.col("e.meta").isNotNull().alias("as_received"))


def q_run_all_store(spark, sf_dir):
    """The whole job in two micro-batches (archive, five metrics, serving values refreshed by each): the stored values."""
    folder = run_folder(spark)
    layout = J.RunLayout(folder)

    def run(lines: str) -> None:
        for q in J.run_all(_stream(spark, lines), layout, trigger=NOW):
            q.awaitTermination()

    replays.deliver(replays.in_order(spark, sf_dir), folder, run)
    newest = SK.current(J.stored_snapshots(spark, layout).withColumn("_v", F.unix_micros("updated_at")), ["metric_key"], "_v")
    series = "array<struct<ts:string,count:bigint,domain:string,type_counts:map<string,bigint>>>"
    single = "struct<ts:string,bot_count:bigint,total_count:bigint,content_changed_count:bigint,total_revision_count:bigint>"
    rows = newest.where(F.col("payload").startswith("[")).select("metric_key", F.inline(F.from_json("payload", series)))
    counts = F.when(F.col("type_counts").isNull(), F.create_map(F.coalesce("domain", F.lit("count")), "count")).otherwise(F.col("type_counts"))
    rows = rows.select("metric_key", "ts", F.explode(counts).alias("name", "n"))
    one = newest.where(~F.col("payload").startswith("[")).select("metric_key", F.from_json("payload", single).alias("e"))
    values = F.map_filter(F.create_map(*(x for c in ("bot_count", "total_count", "content_changed_count", "total_revision_count") for x in (F.lit(c), F.col(f"e.{c}")))),
                          lambda k, v: v.isNotNull())
    return rows.unionByName(one.select("metric_key", F.col("e.ts").alias("ts"), F.explode(values).alias("name", "n")))


QUERIES = {f.__name__[2:]: f for f in (
    q_capture_files, q_capture_source, q_stream_capture_source,
    q_late_events, q_quality_counters, q_stream_quality_counters, q_stream_unique_messages, q_unique_edits_10s, q_unique_bot_ratio_1m, q_stream_unique_edits,
    q_sketch_distinct_1h, q_sketch_domains_1h, q_stream_top5_closed, q_state_audit, q_schema_drift, q_stream_raw_archive, q_archive_domain_read, q_reserialised_events, q_run_all_store)}
