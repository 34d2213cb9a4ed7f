"""Cases that once lost data or crashed."""

import json

from pyspark.sql import functions as F

from pulse.config import KEY_BOT, KEY_BY_TYPE, KEY_CONTENT, KEY_TOP, KEY_TOTAL, Config, use_utc
from pulse.functions.time import event_ts
from pulse.operators import metrics as M
from pulse.operators import parse as P
from pulse.operators import ranking as R
from pulse.operators import shaping as S
from pulse.sources.archive import compact_archive, read_raw
from pulse.streaming import sinks as SK

WIN = "window_start timestamp, window_end timestamp"


def _value(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_exactly_one_json_value(spark):
    use_utc(spark)
    good = ['{"a":1,"a":2}', "[]", "1", "null", '"x"', ' {"a" : [1, {}]} ', '{"a":\n1}', "[1,2]"]
    bad = ['{"a":1} trailing', '{"a":1}{"b":2}', "1,2", "1],[2", '{"a":NaN}', "", "{", "a", '{"a":1}]']
    ok = {r.value for r in P.valid_json(_value(spark, good + bad)).collect()}
    assert ok == set(good)
    assert {r.value for r in P.malformed_json(_value(spark, good + bad)).collect()} == set(bad)


def test_values_stay_on_one_line(spark, tmp_path):
    texts = ['{"a":\n1,\r\n"b":"x y"}', '{"c":"\\n"}']
    _value(spark, texts).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("value string").parquet(str(tmp_path / "in"))
    SK.jsonl_sink(stream, str(tmp_path / "out"), str(tmp_path / "cp"), {"availableNow": True}).awaitTermination()
    lines = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(map(json.dumps, map(json.loads, lines))) == sorted(map(json.dumps, map(json.loads, texts)))
    frame = SK.kafka_frame(_value(spark, texts).withColumn("topic", F.lit("t"))).collect()
    assert all(b"\n" not in r.value and json.loads(r.value) for r in frame)


def test_times_need_a_date(spark):
    t = spark.createDataFrame([("12:30",), ("2024-01-01",), ("2024-01-01T00:00:01Z",), ("T10",), ("",)], "s string")
    assert [r[0] is not None for r in t.select(event_ts("s")).collect()] == [False, True, True, False, False]


def test_null_and_named_null_and_dotted_types(spark):
    rows = [("2024-01-01 00:00:00", None, 3), ("2024-01-01 00:00:00", "null", 4), ("2024-01-01 00:00:10", "page.edit", 2), ("2024-01-01 00:00:10", None, 1)]
    m2 = spark.createDataFrame(rows, "t string, event_type string, cnt long").select(
        F.col("t").cast("timestamp").alias("window_start"), (F.col("t").cast("timestamp") + F.expr("interval 10 seconds")).alias("window_end"), "event_type", "cnt")
    top = R.top_n_with_others(m2)
    stored = json.loads(SK.type_series_snapshot(top).first().payload)
    assert [x["type_counts"] for x in stored] == [{"page.edit": 2, "null": 1}, {"null": 7}]
    series = S.type_points(top)
    keys = S.series_key_list(series)
    assert sorted(keys) == ["null", "page.edit"]
    long = {(r.t, r.type): r.v for r in S.stacked_long(S.stacked_by_type(series, keys, 10), keys).collect()}
    t0 = 1704067200
    assert long == {(t0, "null"): 7, (t0, "page.edit"): 0, (t0 + 10, "null"): 1, (t0 + 10, "page.edit"): 2}
    m1 = spark.createDataFrame([], f"{WIN}, event_count long")
    ratio = "total_count long, bot_count long, bot_ratio double"
    change = "total_revision_count long, content_changed_count long, content_change_ratio double"
    doc = S.dashboard(m1, top, spark.createDataFrame([], f"{WIN}, {ratio}"), spark.createDataFrame([], f"{WIN}, domain string, cnt long"),
                      spark.createDataFrame([], f"{WIN}, {change}"), now=F.lit(0).cast("long"))
    assert {k: [p.v for p in v] for k, v in doc.first().byType.items()} == {"null": [7, 1], "page.edit": [2]}


def test_late_rows_survive_compaction(spark, tmp_path):
    live, comp = str(tmp_path / "raw"), str(tmp_path / "comp")

    def add(*times):
        SK.write_raw(spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp").alias("event_time")), live)
    add("2024-01-01 00:10:00", "2024-01-01 05:00:00")
    compact_archive(spark, live, comp, "2024-01-01T03:00:00Z")
    add("2024-01-01 00:20:00")
    assert read_raw(spark, live, compacted=comp).count() == 3
    assert read_raw(spark, live, "2024-01-01T00:00:00Z", "2024-01-01T01:00:00Z", comp).count() == 2
    compact_archive(spark, live, comp, "2024-01-01T06:00:00Z")
    assert read_raw(spark, live, compacted=comp).count() == 3
    assert spark.read.parquet(f"{comp}/data/run=1").count() == 2      # only what the first run did not cover


def test_a_complete_slot_survives_every_refresh(spark, tmp_path):
    path = str(tmp_path / "metric")
    row = spark.createDataFrame([("k", "p")], "metric_key string, payload string")
    for batch in (0, 2, 4, 4, 7):
        SK.write_snapshot(row, path, batch)
    assert sorted(r.batch_id for r in spark.read.parquet(path).collect()) == [4, 7]


def test_intake_has_no_cap_unless_asked():
    assert Config().max_offsets_per_trigger is None and Config().min_partitions is None


def test_cube_rolls_up_to_the_metrics(spark):
    ev = spark.range(4000).select(
        F.timestamp_micros(F.lit(1704067200000000) + F.col("id") * 777_000).alias("event_time"), F.concat(F.lit("d"), F.col("id") % 7).alias("domain"),
        F.when(F.col("id") % 3 == 0, "mediawiki.revision-create").otherwise("mediawiki.recentchange").alias("stream"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("t"), F.col("id") % 5)).alias("event_type"), (F.col("id") % 4 == 0).alias("bot"),
        F.when(F.col("id") % 11 > 0, F.col("id") % 2 == 0).alias("rev_content_changed"))
    got = M.metrics_of_cube(M.base_cube(ev))
    want = {"m1": M.total_events(ev), "m2": M.events_by_type(ev), "m3": M.bot_ratio(ev), "m4": M.domain_counts(ev), "m5": M.content_change_ratio(ev)}
    for k, df in want.items():
        assert got[k].columns == df.columns
        assert sorted(map(str, got[k].collect())) == sorted(map(str, df.collect())), k


def test_normaliser_reads_numbers_of_any_kind(spark):
    doc = {"metric1": [{"ts": "2024-01-01T00:00:00", "count": 3.0}, {"ts": "2024-01-01T00:00:10", "event_count": "7"}],
           "metric2": [{"ts": "2024-01-01T00:00:10", "type_counts": {"b": 2, "a": "5"}}, {"ts": "2024-01-01T00:00:00", "typeCounts": {"a": 1.0}}],
           "metric3": {"bot_ratio": "0.5", "bot_count": 2.0, "total_count": 4}, "top_domains": [{"domain": "d", "count": 9.0}]}
    r = S.normalize_dashboard(spark.createDataFrame([(json.dumps(doc),)], "json string")).first()
    assert [(p.t, p.v) for p in r.total] == [(1704067200, 3), (1704067210, 7)]
    assert {k: [(p.t - 1704067200, p.v) for p in v] for k, v in r.byType.items()} == {"a": [(0, 1), (10, 5)], "b": [(10, 2)]}
    assert (r.bot.ratio, r.bot.bot, r.bot.total) == (0.5, 2, 4) and [(x.k, x.v) for x in r.topWiki] == [("d", 9)]


def test_document_from_the_store_skips_bad_values(spark):
    live = spark.createDataFrame([
        (KEY_TOTAL, '[{"ts":"2024-01-01T00:00:10","count":2},{"ts":null,"count":5},{"ts":"junk","count":1},{"ts":"2024-01-01T00:00:00","count":1}]'),
        (KEY_BY_TYPE, '[{"ts":"2024-01-01T00:00:10","type_counts":{"x":1}},{"ts":"2024-01-01T00:00:00","type_counts":{"x":2,"y":3}}]'),
        (KEY_BOT, "not json"), (KEY_TOP, '[{"domain":"a","count":4}]')], "metric_key string, payload string")
    r = S.dashboard_from_snapshots(live, 1, F.lit(5).cast("long")).first()
    assert [(p.t, p.v) for p in r.total] == [(1704067210, 2)]
    assert {k: [p.v for p in v] for k, v in r.byType.items()} == {"x": [1], "y": [3]}
    assert (r.bot.total, r.bot.ratio, r.contentChange.total, r.topWiki[0].k) == (0, 0.0, 0, "a")
    assert S.dashboard_from_snapshots(live.where("metric_key = 'none'")).count() == 0
    assert S.dashboard_from_snapshots(live.where(F.col("metric_key") == KEY_CONTENT)).count() == 0
