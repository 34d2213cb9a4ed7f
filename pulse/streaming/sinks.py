"""Sinks: raw archive, replay-safe metric update log, serving snapshots,
JSON-lines archive and Kafka.

The update log replaces the original's "append every micro-batch's changed
rows" files: each micro-batch is written to ``<log>/batch_id=<n>`` with
overwrite, so a replayed batch id rewrites its own directory instead of
appending duplicates, and :func:`current` picks the newest revision of every
key. Serving snapshots are computed from ``current`` (complete windows), not
from the rows changed in one micro-batch.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pulse.config import (
    KEY_BOT,
    KEY_BY_TYPE,
    KEY_CONTENT,
    KEY_TOP,
    KEY_TOTAL,
    RETAINED_WINDOWS,
    TTL_SECONDS,
)
from pulse.functions.time import iso_text, with_time_partitions
from pulse.operators import ranking as R
from pulse.operators.parse import one_line, valid_json
from pulse.schema import PARTITION_COLUMNS

# --- raw archive (SINK1) -----------------------------------------------------------


def raw_sink(events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append-mode Parquet archive partitioned by year/month/day/hour.

    Stateless: the task that reads a source partition writes its files; the
    file sink's log makes it exactly-once.
    """
    w = (with_time_partitions(events).writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint)
         .partitionBy(*PARTITION_COLUMNS))
    return (w.trigger(**trigger) if trigger else w).start()


def bloom_options(columns: list[str], distinct: int = 10_000) -> dict[str, str]:
    """Parquet writer options: a bloom filter on each column, sized for ``distinct`` values a row group."""
    out = {}
    for c in columns:
        out[f"parquet.bloom.filter.enabled#{c}"] = "true"
        out[f"parquet.bloom.filter.expected.ndv#{c}"] = str(distinct)
    return out


def write_raw(events: DataFrame, path: str, cluster_by: list[str] | None = None, row_group_bytes: int | None = None) -> None:
    """Batch form of :func:`raw_sink` (back-fills).

    With ``cluster_by`` (columns that readers filter on, such as domain and wiki)
    each file is sorted by them and its row groups carry bloom filters on them: a
    read of one value skips the row groups whose bounds or filter exclude it. The
    sort is inside the files, so it adds no shuffle. ``row_group_bytes`` sets the
    size of a row group (Parquet's default: 128 MB), the unit that is skipped.
    """
    rows = with_time_partitions(events)
    options: dict[str, str] = {}
    if cluster_by:
        rows = rows.sortWithinPartitions(*PARTITION_COLUMNS, *cluster_by)
        options = bloom_options(cluster_by)
    if row_group_bytes:
        options["parquet.block.size"] = str(row_group_bytes)
    rows.write.mode("append").options(**options).partitionBy(*PARTITION_COLUMNS).parquet(path)


# --- metric update log (SINK2) and current revisions ---------------------------------


class UpdateLog:
    """Versioned metric history: one directory per micro-batch id."""

    def __init__(self, path: str, fmt: str = "parquet", schema: StructType | None = None):
        self.path = path.rstrip("/")
        self.fmt = fmt
        self.schema = schema

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """Write one micro-batch in sized files; replaying the same id overwrites it."""
        batch.hint("rebalance").write.mode("overwrite").format(self.fmt).save(f"{self.path}/batch_id={batch_id}")

    def read(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.format(self.fmt)
        if self.schema is not None:
            reader = reader.schema(StructType(list(self.schema.fields)).add("batch_id", "long"))
        return reader.load(self.path)


def current(log: DataFrame, keys: list[str], version: str = "batch_id") -> DataFrame:
    """Newest revision of every key of an update log.

    ``max_by`` is a partial-aggregatable function, so a key revised in many
    micro-batches is reduced map-side before the shuffle.
    """
    cols = [c for c in log.columns if c not in keys and c != version]
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.col(version)).alias("_r"))
    return newest.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in cols])


def compact(log: UpdateLog, keys: list[str], spark: SparkSession, out: str) -> None:
    """Rewrite a log as its current revisions (a single version ``0``) under
    ``out``; bounds the size the snapshot refresh reads."""
    current(log.read(spark), keys).write.mode("overwrite").format(log.fmt).save(f"{out}/batch_id=0")


class ServingState:
    """Current revisions of the newest ``retained`` windows of one metric.

    The snapshot refresh must not read the whole history on every
    micro-batch. This state holds only what a serving value can show, in two
    alternating slots: batch ``n`` merges the newest version older than ``n``
    with its changed rows, keeps the newest windows and writes the *other*
    slot. The work per batch is bounded by the retention, not the history; a
    replayed batch id re-derives its version from the same predecessor.
    """

    def __init__(self, path: str, keys: list[str], retained: int = RETAINED_WINDOWS):
        self.path = path.rstrip("/")
        self.keys = keys
        self.retained = retained

    def _slot(self, spark: SparkSession, slot: int) -> DataFrame | None:
        try:
            return spark.read.parquet(f"{self.path}/slot={slot}")
        except AnalysisException:       # slot not written yet
            return None

    def _latest_before(self, spark: SparkSession, batch_id: int):
        best = (None, None, -1)
        for slot in (0, 1):
            df = self._slot(spark, slot)
            if df is None:
                continue
            v = df.select(F.max("_version")).first()[0]     # one value per slot
            if v is not None and best[2] < v < batch_id:
                best = (slot, df, v)
        return best[0], best[1]

    def update(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Merge one micro-batch; returns the new current state."""
        spark = batch.sparkSession
        slot, prev = self._latest_before(spark, batch_id)
        rows = batch.withColumn("_version", F.lit(batch_id).cast("long"))
        if prev is not None:
            rows = prev.drop("slot").unionByName(rows)
        state = R.retain_latest(current(rows, self.keys, "_version"), self.retained)
        target = f"{self.path}/slot={(1 - slot) if slot is not None else batch_id % 2}"
        state.withColumn("_version", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(target)
        return spark.read.parquet(target).drop("_version")


# --- serving snapshots (SINK3-SINK6, SINK9) ----------------------------------------


def _newest_first(df: DataFrame, fields: dict[str, Column]) -> Column:
    """JSON array of ``fields`` per row, newest window first (bounded input)."""
    entry = F.struct((-F.unix_micros("window_start")).alias("o"), *[c.alias(k) for k, c in fields.items()])
    names = list(fields)
    by_o = F.array_sort(F.collect_list(entry), lambda a, b: F.signum(a["o"] - b["o"]).cast("int"))
    return F.to_json(F.transform(by_o, lambda x: F.struct(*[x[n].alias(n) for n in names])))


def series_snapshot(m1: DataFrame, retained: int = RETAINED_WINDOWS) -> DataFrame:
    """Metric 1 serving value: ``[{ts,count}]`` newest first, newest windows only."""
    kept = R.retain_latest(m1, retained)
    return kept.agg(_newest_first(kept, {"ts": iso_text("window_start"),
                                         "count": F.col("event_count")}).alias("payload"))


def type_series_snapshot(m2_top: DataFrame, retained: int = RETAINED_WINDOWS,
                         type_col: str = "final_type") -> DataFrame:
    """Metric 2 serving value: ``[{ts,type_counts:{type:n}}]`` newest first."""
    kept = R.retain_latest(m2_top, retained)
    # a null type and a type named "null" are one label: summed before the map is built
    labelled = kept.groupBy("window_start", F.coalesce(F.col(type_col), F.lit("null")).alias("_type")).agg(F.sum("cnt").alias("_cnt"))
    per_window = labelled.groupBy("window_start").agg(
        F.map_from_entries(F.collect_list(F.struct("_type", "_cnt"))).alias("type_counts"))
    return per_window.agg(_newest_first(per_window, {"ts": iso_text("window_start"),
                                                     "type_counts": F.col("type_counts")}).alias("payload"))


def latest_snapshot(df: DataFrame, ratio: str, counts: list[str]) -> DataFrame:
    """Metrics 3 and 5 serving value: the newest window's ratio and counts; a
    null ratio becomes 0.0. No row when the metric is empty."""
    row = R.latest_row(df)
    fields = [iso_text("window_start").alias("ts"),
              F.coalesce(F.col(ratio), F.lit(0.0)).alias(ratio)] + [F.col(c) for c in counts]
    return row.select(F.to_json(F.struct(*fields)).alias("payload"))


def ranking_snapshot(m4: DataFrame) -> DataFrame:
    """Metric 4 serving value: ``[{domain,count}]`` of the newest window."""
    top = R.top_domains(m4).select((-F.col("cnt")).alias("o"), "domain", "cnt")
    arr = F.transform(F.sort_array(F.collect_list(F.struct("o", "domain", "cnt"))),
                      lambda x: F.struct(x["domain"].alias("domain"), x["cnt"].alias("count")))
    return top.agg(F.to_json(arr).alias("payload"))


def snapshot_rows(payload: DataFrame, key: str, now: Column) -> DataFrame:
    """Key a one-row payload: ``metric_key, payload, updated_at, expires_at``."""
    return payload.select(F.lit(key).alias("metric_key"), "payload", now.alias("updated_at"),
                          (now + F.make_interval(secs=F.lit(TTL_SECONDS[key]))).alias("expires_at"))


def snapshot_table(m1: DataFrame, m2_top: DataFrame, m3: DataFrame, m4: DataFrame, m5: DataFrame,
                   now: Column) -> DataFrame:
    """All five serving values, keyed and stamped with their expiry."""
    parts = [
        snapshot_rows(series_snapshot(m1), KEY_TOTAL, now),
        snapshot_rows(type_series_snapshot(m2_top), KEY_BY_TYPE, now),
        snapshot_rows(latest_snapshot(m3, "bot_ratio", ["bot_count", "total_count"]), KEY_BOT, now),
        snapshot_rows(ranking_snapshot(m4), KEY_TOP, now),
        snapshot_rows(latest_snapshot(m5, "content_change_ratio",
                                      ["content_changed_count", "total_revision_count"]), KEY_CONTENT, now),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_snapshot(row: DataFrame, path: str, batch_id: int) -> None:
    """Write one metric's snapshot row to the slot that does not hold its newest
    version, so a reader always finds one complete slot. A replayed batch
    rewrites the slot it wrote before."""
    spark = row.sparkSession
    held: dict[int, int] = {}
    for slot in (0, 1):
        try:
            v = spark.read.parquet(f"{path}/slot={slot}").agg(F.max("batch_id")).first()[0]
        except AnalysisException:       # slot not written yet
            v = None
        held[slot] = -1 if v is None else v
    same = [s for s in held if held[s] == batch_id]
    target = same[0] if same else min(held, key=lambda s: (held[s], s))
    row.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(f"{path}/slot={target}")


def live_snapshots(snapshots: DataFrame, now: Column) -> DataFrame:
    """The store's view at ``now``: unexpired rows, newest per key."""
    alive = snapshots.filter(F.col("expires_at") > now)
    return current(alive.withColumn("_v", F.unix_micros("updated_at")), ["metric_key"], "_v")


# --- JSON lines (SINK7) and Kafka (SINK8) ----------------------------------------------


def jsonl_sink(records: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append every well-formed record's JSON text as one line, whatever line breaks it had (malformed
    records are skipped instead of stopping the archive)."""
    lines = valid_json(records).select(one_line("value").alias("value"))
    w = lines.writeStream.format("text").outputMode("append").option("path", path) \
        .option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()


def kafka_sink_options(servers: str, producer_options: dict | None = None) -> dict[str, str]:
    opts = {"kafka.bootstrap.servers": servers}
    for k, v in (producer_options or {"acks": "all", "retries": "10", "linger.ms": "50"}).items():
        opts[f"kafka.{k}"] = str(v)
    return opts


def kafka_frame(records: DataFrame) -> DataFrame:
    """Column contract of the Kafka writer: ``topic``, ``value`` (no key)."""
    return records.select("topic", one_line("value").cast("binary").alias("value"))


def kafka_sink(records: DataFrame, servers: str, checkpoint: str,
               producer_options: dict | None = None) -> StreamingQuery:
    """Publish routed records (see :func:`pulse.operators.parse.with_topic`)."""
    w = kafka_frame(records).writeStream.format("kafka").option("checkpointLocation", checkpoint)
    for k, v in kafka_sink_options(servers, producer_options).items():
        w = w.option(k, v)
    return w.start()
