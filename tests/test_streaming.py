import json
import os
import time

import pytest
from pyspark.sql import functions as F

from pulse.config import Config
from pulse.operators import metrics as M
from pulse.operators import parse as P
from pulse.operators import ranking as R
from pulse.plans.fixtures import capture_values
from pulse.sources.archive import read_raw
from pulse.sources.files import jsonl_source
from pulse.sources.kafka import kafka_source_options
from pulse.streaming import jobs as J
from pulse.streaming import sinks as S

SF = "/root/testdata/sf0.001"
AVAILABLE_NOW = {"availableNow": True}


def _write_lines(path, name, values, mtime=None):
    """Write one JSON-lines file; the file source takes files in modification
    time order, so replays that must stay in time order set ``mtime``."""
    os.makedirs(path, exist_ok=True)
    target = os.path.join(path, name)
    with open(target, "w") as f:
        for v in values:
            f.write(v + "\n")
    if mtime is not None:
        os.utime(target, (mtime, mtime))


def _set(df, *cols):
    return sorted(tuple(str(r[c]) for c in cols) for r in df.collect())


@pytest.fixture(scope="module")
def replay(spark, tmp_path_factory):
    """sf0.001 events as 5 time-ordered JSON-lines files."""
    base = tmp_path_factory.mktemp("replay")
    rows = capture_values(spark, SF).orderBy("ingest_time", "offset").select("value").collect()
    values = [r.value for r in rows]
    chunk = (len(values) + 4) // 5
    for i in range(5):
        _write_lines(str(base / "in"), f"part-{i}.jsonl", values[i * chunk:(i + 1) * chunk],
                     mtime=1_700_000_000 + 10 * i)
    return base, values


def test_stream_equals_batch(spark, replay):
    base, values = replay
    layout = J.RunLayout(str(base / "run"))
    events = P.parse_events(jsonl_source(spark, str(base / "in"), streaming=True, max_files_per_trigger=1))
    queries = J.run_all(events, layout, trigger=AVAILABLE_NOW)
    for q in queries:
        q.awaitTermination(300)
        assert q.exception() is None
    batch = P.parse_events(spark.createDataFrame([(v,) for v in values], "value string"))

    assert _set(J.current_metric(spark, layout, "events_total"), "window_start", "event_count") == \
        _set(M.total_events(batch), "window_start", "event_count")
    assert _set(J.current_metric(spark, layout, "events_by_type"), "window_start", "event_type", "cnt") == \
        _set(M.events_by_type(batch), "window_start", "event_type", "cnt")
    assert _set(J.current_metric(spark, layout, "bot_ratio"), "window_start", "bot_count", "total_count") == \
        _set(M.bot_ratio(batch), "window_start", "bot_count", "total_count")
    assert _set(J.current_metric(spark, layout, "top_domains"), "window_start", "domain", "cnt") == \
        _set(M.domain_counts(batch), "window_start", "domain", "cnt")
    assert _set(J.current_metric(spark, layout, "content_change_ratio"), "window_start",
                "content_changed_count") == _set(M.content_change_ratio(batch), "window_start",
                                                  "content_changed_count")
    # top-5 over the complete current windows equals the batch ranking
    cur_top = R.top_n_with_others(J.current_metric(spark, layout, "events_by_type"))
    assert _set(cur_top, "window_start", "final_type", "cnt") == \
        _set(R.top_n_with_others(M.events_by_type(batch)), "window_start", "final_type", "cnt")
    # raw archive holds every event, partitioned by hour
    raw = spark.read.parquet(layout.raw())
    assert raw.count() == len(values)
    assert set(raw.columns) >= {"event_time", "year", "month", "day", "hour", "raw_json"}
    # one snapshot per metric; the series payload is newest first, at most 1000 windows
    snaps = J.stored_snapshots(spark, layout)
    live = S.live_snapshots(snaps, F.current_timestamp()).collect()
    assert {r.metric_key for r in live} == {"metrics:events_total_10m_10s", "metrics:events_by_type_10m_10s",
                                            "metrics:bot_ratio_1m", "metrics:top_domain_5m_top10",
                                            "metrics:content_change_ratio_1m"}
    series = json.loads(next(r.payload for r in live if r.metric_key == "metrics:events_total_10m_10s"))
    assert [p["ts"] for p in series] == sorted((p["ts"] for p in series), reverse=True)
    assert 0 < len(series) <= 1000


def test_late_data_dropped_after_spacer(spark, tmp_path):
    src, layout = str(tmp_path / "in"), J.RunLayout(str(tmp_path / "run"))

    def ev(t, typ="edit"):
        return json.dumps({"meta": {"dt": t, "stream": "mediawiki.recentchange"}, "type": typ})

    def run_once():
        events = P.parse_events(jsonl_source(spark, src, streaming=True, max_files_per_trigger=1))
        q = J.start_metric(events, "events_total", layout, trigger=AVAILABLE_NOW, refresh_snapshot=False)
        q.awaitTermination(300)
        assert q.exception() is None
        return q

    late = J.LateRows()
    spark.streams.addListener(late)
    _write_lines(src, "1.jsonl", [ev("2024-01-01T00:10:00.000Z")] * 3)
    run_once()
    _write_lines(src, "2.jsonl", [ev("2024-01-01T00:20:00.000Z")])          # watermark jumps
    run_once()
    _write_lines(src, "3.jsonl", [ev("2024-01-01T00:20:05.000Z")])          # spacer
    run_once()
    _write_lines(src, "4.jsonl", [ev("2024-01-01T00:05:00.000Z"),           # late beyond 2 min
                                  ev("2024-01-01T00:19:00.000Z"),           # late, inside 2 min
                                  ev("2024-01-01T00:10:01.000Z")])          # late, beyond
    q = run_once()
    cur = {str(r.window_start)[11:]: r.event_count for r in J.current_metric(spark, layout, "events_total").collect()}
    assert cur == {"00:10:00": 3, "00:20:00": 2, "00:19:00": 1}
    assert "00:05:00" not in cur
    assert J.dropped_late_rows(q) == 2                                        # 00:05:00, 00:10:01
    for _ in range(100):        # progress events arrive a little later
        if late.dropped.get("pulse_events_total") == 2:
            break
        time.sleep(0.1)
    spark.streams.removeListener(late)
    assert late.dropped["pulse_events_total"] == 2


def test_update_log_replay_safe(spark, tmp_path):
    log = S.UpdateLog(str(tmp_path / "log"))
    a = spark.createDataFrame([("w1", 1), ("w2", 5)], "k string, n long")
    b = spark.createDataFrame([("w1", 2)], "k string, n long")
    log.write(a, 0)
    log.write(b, 1)
    log.write(b, 1)                                    # replayed batch id: no duplicates
    assert log.read(spark).count() == 3
    cur = {r.k: r.n for r in S.current(log.read(spark), ["k"]).collect()}
    assert cur == {"w1": 2, "w2": 5}
    S.compact(log, ["k"], spark, str(tmp_path / "compacted"))
    assert spark.read.parquet(str(tmp_path / "compacted")).count() == 2


def test_batch_writer_skips_empty_and_replays(spark, tmp_path):
    layout = J.RunLayout(str(tmp_path / "run"))
    spec = J.METRICS["bot_ratio"]
    writer = J.metric_batch_writer(spec, layout)
    rows = spark.createDataFrame(
        [("2024-01-01 00:00:00", "2024-01-01 00:01:00", 4, 1, 0.25)],
        "window_start string, window_end string, total_count long, bot_count long, bot_ratio double",
    ).select(F.col("window_start").cast("timestamp"), F.col("window_end").cast("timestamp"),
             "total_count", "bot_count", "bot_ratio")
    writer(rows.limit(0), 0)
    assert not os.path.exists(layout.log("bot_ratio"))
    writer(rows, 1)
    writer(rows, 1)
    assert J.current_metric(spark, layout, "bot_ratio").count() == 1
    snap = J.stored_snapshots(spark, layout).collect()
    assert json.loads(snap[0].payload) == {"ts": "2024-01-01T00:00:00", "bot_ratio": 0.25,
                                           "bot_count": 1, "total_count": 4}


def test_snapshot_expiry(spark):
    rows = spark.createDataFrame([
        ("k1", "old", "2024-01-01 00:00:00", "2024-01-01 00:05:00"),
        ("k1", "new", "2024-01-01 00:01:00", "2024-01-01 00:06:00"),
        ("k2", "gone", "2024-01-01 00:00:00", "2024-01-01 00:00:30"),
    ], "metric_key string, payload string, updated_at string, expires_at string").select(
        "metric_key", "payload", F.col("updated_at").cast("timestamp"), F.col("expires_at").cast("timestamp"))
    live = {r.metric_key: r.payload for r in
            S.live_snapshots(rows, F.lit("2024-01-01 00:02:00").cast("timestamp")).collect()}
    assert live == {"k1": "new"}


def test_raw_archive_pruned_reads(spark, tmp_path):
    events = P.parse_events(capture_values(spark, SF).select("value"))
    path = str(tmp_path / "raw")
    S.write_raw(events, path)
    got = read_raw(spark, path, "2024-01-01T00:30:00Z", "2024-01-01T01:00:00Z")
    want = events.filter((F.col("event_time") >= F.lit("2024-01-01 00:30:00").cast("timestamp"))
                         & (F.col("event_time") < F.lit("2024-01-01 01:00:00").cast("timestamp")))
    assert got.count() == want.count() > 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert read_raw(spark, path).count() == events.count()


def test_jsonl_sink_skips_malformed(spark, tmp_path):
    src = str(tmp_path / "in")
    _write_lines(src, "a.jsonl", ['{"a": 1}', "{broken", '{"b": 2}'])
    q = S.jsonl_sink(jsonl_source(spark, src, streaming=True), str(tmp_path / "out"),
                     str(tmp_path / "ckpt"), AVAILABLE_NOW)
    q.awaitTermination(120)
    out = sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect())
    assert out == ['{"a": 1}', '{"b": 2}']


def test_kafka_options():
    plain = kafka_source_options(Config())         # no intake cap and no split count unless asked for
    assert "maxOffsetsPerTrigger" not in plain and "minPartitions" not in plain
    opts = kafka_source_options(Config(kafka_servers="k:9092", max_offsets_per_trigger=5000, min_partitions=2))
    assert opts == {"kafka.bootstrap.servers": "k:9092", "subscribe": "wiki-recentchange,wiki-revision-create",
                    "startingOffsets": "latest", "failOnDataLoss": "false", "minPartitions": "2",
                    "maxOffsetsPerTrigger": "5000"}
    batch = kafka_source_options(Config(), streaming=False)
    assert "maxOffsetsPerTrigger" not in batch and batch["startingOffsets"] == "earliest"
    assert S.kafka_sink_options("k:9092") == {"kafka.bootstrap.servers": "k:9092", "kafka.acks": "all",
                                               "kafka.retries": "10", "kafka.linger.ms": "50"}


def test_kafka_frame_contract(spark):
    df = P.with_topic(spark.createDataFrame([('{"meta": {"stream": "mediawiki.recentchange"}}',)], "value string"))
    frame = S.kafka_frame(df)
    assert frame.columns == ["topic", "value"] and frame.schema["value"].dataType.typeName() == "binary"


def test_null_event_time_archived_but_not_counted(spark, tmp_path):
    src, layout = str(tmp_path / "in"), J.RunLayout(str(tmp_path / "run"))
    rows = [json.dumps({"meta": {"dt": "2024-01-01T00:00:01.000Z", "stream": "mediawiki.recentchange"}}),
            json.dumps({"meta": {"dt": "garbage", "stream": "mediawiki.recentchange"}}),
            json.dumps({"type": "no meta"})]
    _write_lines(src, "a.jsonl", rows)
    events = P.parse_events(jsonl_source(spark, src, streaming=True))
    for q in J.run_all(events, layout, trigger=AVAILABLE_NOW, metrics=["events_total"]):
        q.awaitTermination(120)
        assert q.exception() is None
    raw = spark.read.parquet(layout.raw())
    assert raw.count() == 3 and raw.filter(F.col("year").isNull()).count() == 2
    assert [r.event_count for r in J.current_metric(spark, layout, "events_total").collect()] == [1]


def test_metrics_fed_from_archive(spark, replay):
    """Parse once into the archive; metric queries stream the Parquet."""
    base, values = replay
    layout = J.RunLayout(str(base / "run_archive"))
    events = P.parse_events(jsonl_source(spark, str(base / "in"), streaming=True, max_files_per_trigger=1))
    raw_q = J.start_raw(events, layout, AVAILABLE_NOW)
    raw_q.awaitTermination(300)
    assert raw_q.exception() is None
    metric_qs = J.run_all(events, layout, trigger=AVAILABLE_NOW, raw=False, metrics_from_archive=True,
                          metrics=["events_total", "events_by_type"])
    for q in metric_qs:
        q.awaitTermination(300)
        assert q.exception() is None
    batch = P.parse_events(spark.createDataFrame([(v,) for v in values], "value string"))
    assert _set(J.current_metric(spark, layout, "events_by_type"), "window_start", "event_type", "cnt") == \
        _set(M.events_by_type(batch), "window_start", "event_type", "cnt")
    assert _set(J.current_metric(spark, layout, "events_total"), "window_start", "event_count") == \
        _set(M.total_events(batch), "window_start", "event_count")


def test_serving_state_is_bounded_and_replay_safe(spark, tmp_path):
    layout = J.RunLayout(str(tmp_path / "run"))
    writer = J.metric_batch_writer(J.METRICS["events_total"], layout, retained=2)

    def batch(minute, count):
        return spark.createDataFrame(
            [(f"2024-01-01 00:{minute:02d}:00", f"2024-01-01 00:{minute:02d}:10", count)],
            "window_start string, window_end string, event_count long").select(
            F.col("window_start").cast("timestamp"), F.col("window_end").cast("timestamp"), "event_count")

    for i in range(5):
        writer(batch(i, i + 1), i)
    writer(batch(1, 99), 5)            # late revision of an old, no longer retained window
    writer(batch(4, 7), 6)             # revision of a retained window
    writer(batch(4, 7), 6)             # replayed batch id
    state = {r.window_start.minute: r.event_count
             for r in spark.read.parquet(layout.serving("events_total")).filter("_version = 6").collect()}
    assert state == {3: 4, 4: 7}
    snaps = J.stored_snapshots(spark, layout).filter("batch_id = 6").collect()
    assert [p["count"] for p in json.loads(snaps[0].payload)] == [7, 4]
    # the full history is still in the log
    assert J.current_metric(spark, layout, "events_total").count() == 5


def test_json_history_log(spark, tmp_path):
    layout = J.RunLayout(str(tmp_path / "run"))
    writer = J.metric_batch_writer(J.METRICS["bot_ratio"], layout, history_format="json")
    rows = spark.createDataFrame(
        [("2024-01-01 00:00:00", "2024-01-01 00:01:00", 4, 1, 0.25)],
        "window_start string, window_end string, total_count long, bot_count long, bot_ratio double",
    ).select(F.col("window_start").cast("timestamp"), F.col("window_end").cast("timestamp"),
             "total_count", "bot_count", "bot_ratio")
    writer(rows, 0)
    writer(rows.withColumn("bot_count", F.lit(2).cast("long")), 1)
    assert os.listdir(layout.log("bot_ratio") + "/batch_id=0")
    assert any(f.endswith(".json") for f in os.listdir(layout.log("bot_ratio") + "/batch_id=0"))
    cur = J.current_metric(spark, layout, "bot_ratio", history_format="json").collect()
    assert len(cur) == 1 and cur[0].bot_count == 2 and str(cur[0].window_start) == "2024-01-01 00:00:00"


def test_capture_producer(spark, tmp_path):
    caps = tmp_path / "captures"
    caps.mkdir()
    (caps / "a.txt").write_text(
        'event: message\ndata: {"meta": {"stream": "mediawiki.recentchange"}, "type": "edit"}\n\n'
        "data: {broken\n\n"
        'data: {"meta": {"stream": "mediawiki.revision-create"}}\n\n'
        'data: {"meta": {"stream": "mediawiki.page-create"}}\n\n'
        'data: {"meta": {"stream": "mediawiki.recentchange"}, "type": "tail"}\n')
    q = J.capture_producer(spark, str(caps), str(tmp_path / "out"), str(tmp_path / "ckpt"), AVAILABLE_NOW)
    q.awaitTermination(120)
    assert q.exception() is None
    out = spark.read.text(str(tmp_path / "out"))
    got = sorted((r.topic, json.loads(r.value)["meta"]["stream"]) for r in out.collect())
    assert got == [("wiki-recentchange", "mediawiki.recentchange"),
                   ("wiki-revision-create", "mediawiki.revision-create"),
                   ("wiki-unknown", "mediawiki.page-create")]


def test_rocksdb_state_store(spark, tmp_path):
    src, layout = str(tmp_path / "in"), J.RunLayout(str(tmp_path / "run"))
    _write_lines(src, "a.jsonl", [json.dumps({"meta": {"dt": "2024-01-01T00:00:01.000Z", "domain": "d",
                                                       "stream": "mediawiki.recentchange"}})] * 3)
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    J.use_rocksdb_state(spark)
    try:
        events = P.parse_events(jsonl_source(spark, src, streaming=True))
        q = J.start_metric(events, "top_domains", layout, trigger=AVAILABLE_NOW)
        q.awaitTermination(120)
        assert q.exception() is None
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
    assert [(r.domain, r.cnt) for r in J.current_metric(spark, layout, "top_domains").collect()] == [("d", 3)]


def test_main_entry_point(spark, tmp_path, monkeypatch):
    """The spark-submit entry wires source -> parse -> archive + metrics."""
    import pulse.sources.kafka as K

    src = str(tmp_path / "in")
    _write_lines(src, "a.jsonl", [json.dumps({"meta": {"dt": "2024-01-01T00:00:01.000Z", "domain": "d",
                                                       "stream": "mediawiki.revision-create"},
                                              "type": "edit", "rev_content_changed": True})] * 2)
    monkeypatch.setattr(K, "kafka_source", lambda spark, cfg: jsonl_source(spark, src, streaming=True))

    def finish(spark, timeout=None):
        for q in spark.streams.active:
            q.processAllAvailable()
            q.stop()

    monkeypatch.setattr(J, "await_any", finish)
    base = str(tmp_path / "run")
    J.main(["--servers", "unused:9092", "--base", base])
    layout = J.RunLayout(base)
    assert spark.read.parquet(layout.raw()).count() == 2
    assert [r.content_changed_count for r in J.current_metric(spark, layout, "content_change_ratio").collect()] == [2]


def test_read_raw_range_boundaries(spark, tmp_path):
    rows = [json.dumps({"meta": {"dt": t}}) for t in
            ["2024-01-01T00:59:59.999Z", "2024-01-01T01:00:00.000Z", "2024-01-01T01:30:00.000Z",
             "2024-01-01T02:00:00.000Z", "garbage"]]
    path = str(tmp_path / "raw")
    S.write_raw(P.parse_events(spark.createDataFrame([(r,) for r in rows], "value string")), path)

    def hours(df):
        return sorted(str(r.event_time)[11:19] for r in df.collect())

    assert hours(read_raw(spark, path, "2024-01-01T01:00:00Z", "2024-01-01T02:00:00Z")) == ["01:00:00", "01:30:00"]
    assert hours(read_raw(spark, path, start="2024-01-01T01:30:00Z")) == ["01:30:00", "02:00:00"]
    assert hours(read_raw(spark, path, end="2024-01-01T01:00:00Z")) == ["00:59:59"]
    assert read_raw(spark, path).count() == 5                 # no range: the null-time row too


def test_compact_archive(spark, tmp_path):
    from pulse.sources.archive import compact_archive

    live, comp = str(tmp_path / "raw"), str(tmp_path / "compacted")
    events = P.parse_events(capture_values(spark, SF).select("value"))
    for part in range(3):                                   # three appends = many small files
        S.write_raw(events.filter(F.expr(f"hash(raw_json) % 3 = {part} or hash(raw_json) % 3 = -{part}")), live)
    compact_archive(spark, live, comp, "2024-01-01T01:00:00Z")
    before = read_raw(spark, live).count()
    both = read_raw(spark, live, compacted=comp)
    assert both.count() == before == events.count()
    assert read_raw(spark, live, "2024-01-01T00:30:00Z", "2024-01-01T01:30:00Z", compacted=comp).count() == \
        read_raw(spark, live, "2024-01-01T00:30:00Z", "2024-01-01T01:30:00Z").count()
    hour0 = [f for f in os.listdir(f"{comp}/data/run=0/year=2024/month=1/day=1/hour=0") if f.endswith(".parquet")]
    live0 = [f for f in os.listdir(f"{live}/year=2024/month=1/day=1/hour=0") if f.endswith(".parquet")]
    assert 0 < len(hour0) < len(live0)
    assert not os.path.exists(f"{comp}/data/run=0/year=2024/month=1/day=1/hour=1")   # open hour stays live
    compact_archive(spark, live, comp, "2024-01-01T01:00:00Z")          # rerun: same result
    assert read_raw(spark, live, compacted=comp).count() == before
    assert not os.path.exists(f"{comp}/data/run=1")         # nothing new, nothing rewritten
