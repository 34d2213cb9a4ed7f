"""Closed-window ranking, state audit and schema drift: cases that the replayed table does not have."""

import json
import os

import pytest
from pyspark.sql import functions as F

from pulse.operators import drift as D
from pulse.operators import metrics as M
from pulse.operators import parse as P
from pulse.operators import ranking as R
from pulse.sources.files import jsonl_source
from pulse.streaming import audit as A
from pulse.streaming import jobs as J
from pulse.streaming import sinks as S
from pulse.streaming.top import top_types_closed

NOW = {"availableNow": True}


def line(second, kind, domain="d"):
    return json.dumps({"meta": {"dt": f"2024-01-01T00:{second // 60:02d}:{second % 60:02d}.000Z", "stream": "mediawiki.recentchange", "domain": domain}, "type": kind})


def write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def test_closed_windows_are_ranked_like_the_batch(spark, tmp_path):
    """Ties, a null type, a type named like the bucket, windows over several micro-batches; state is small and leaves."""
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    parts = [[line(1, k) for k in ["a", "a", "b", "c", "d", None, "others", "others"]] + [line(11, "x")],
             [line(2, k) for k in ["e", "f", None, "z"]] + [line(12, k) for k in "abcdefg"],
             [line(300, "x")], [line(900, "y")], [line(1500, "y")]]
    state = []
    with J.rocksdb_state(spark):
        for i, p in enumerate(parts):
            write(src, f"{i}.jsonl", p)
            q = (top_types_closed(P.parse_events(jsonl_source(spark, src, streaming=True))).writeStream.format("parquet").outputMode("append")
                 .option("path", out).option("checkpointLocation", str(tmp_path / "cp")).trigger(**NOW).start())
            q.awaitTermination(120)
            assert q.exception() is None
            state.append(sum(op["numRowsTotal"] for op in q.recentProgress[-1]["stateOperators"]))
    assert "HDFSBacked" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    every = P.parse_events(spark.createDataFrame([(v,) for p in parts for v in p], "value string"))
    want = R.top_n_with_others(M.events_by_type(every)).where(F.col("window_end") <= F.lit("2024-01-01 00:23:00").cast("timestamp"))
    got = spark.read.parquet(out)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    first = {r.final_type: r.cnt for r in got.where("window_start = timestamp'2024-01-01 00:00:00'").collect()}
    assert first == {None: 2, "a": 2, "others": 6, "b": 1, "c": 1}      # two events named others and the four left over
    assert state[-1] <= 2


@pytest.fixture(scope="module")
def metric_run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("audit")
    layout = J.RunLayout(str(base / "run"))
    for i, p in enumerate([[line(s, k, f"d{s % 3}") for s in range(0, 600, 7) for k in ("a", "b", None)], [line(s, "c", None) for s in range(560, 720, 5)]]):
        write(str(base / "in"), f"{i}.jsonl", p)
        for name in J.METRICS:
            J.start_metric(P.parse_events(jsonl_source(spark, str(base / "in"), streaming=True)), name, layout, trigger=NOW, refresh_snapshot=False).awaitTermination()
    return layout


@pytest.mark.parametrize("name", ["events_total", "events_by_type", "bot_ratio", "top_domains"])
def test_state_and_log_agree_on_open_windows(spark, metric_run, name):
    both = A.open_windows(spark, metric_run, name)
    assert both.count() > 1 and A.differences(spark, metric_run, name).count() == 0
    state = A.state_rows(spark, metric_run, name)
    assert state.agg(F.min("window_end")).first()[0] > state.sparkSession.sql("select timestamp'2024-01-01 00:09:55'").first()[0]


def test_a_planted_fault_is_listed(spark, metric_run):
    log = S.UpdateLog(metric_run.log("events_by_type"))
    newest = J.current_metric(spark, metric_run, "events_by_type").orderBy(F.desc("window_start")).limit(1)
    cnt = newest.first().cnt
    wrong = newest.withColumn("cnt", F.col("cnt") + 5).unionByName(newest.withColumn("event_type", F.lit("never seen")))
    log.write(wrong, 99)
    found = A.differences(spark, metric_run, "events_by_type").collect()
    assert {r.event_type: (r.state_cnt, r.log_cnt) for r in found} == {"c": (cnt, cnt + 5), "never seen": (None, cnt)} and len(found) == 2


def test_drift(spark):
    good = {"meta": {"dt": "2024-01-01T00:00:00Z", "stream": "s"}, "type": "edit", "bot": True, "namespace": 0, "revision": {"new": 1}, "title": 5, "comment": None}
    rows = [json.dumps(good)] * 3 + [json.dumps({**good, "new": [1], "bot": "no", "meta": {"stream": "s", "k": {"deep": 1}}, "revision": 7})] + ["{cut", "[1]", "", "5", None]
    df = spark.createDataFrame([(v,) for v in rows], "value string")
    got = {(r.stream, r.path, r.type, r.problem, r.n) for r in D.schema_drift(df).collect()}
    assert got == {("s", "new", "ARRAY", "unknown", 1), ("s", "meta.k", "OBJECT", "unknown", 1), ("s", "bot", "STRING", "other_type", 1), ("s", "revision", "BIGINT", "other_type", 1)}
    assert [r[0] for r in df.select(D.field("meta.k.deep", "long")).where(F.col("value").contains("deep")).collect()] == [1]
    assert df.select(D.field("revision.new", "long").alias("x")).where("x = 1").count() == 3
    assert D.schema_drift(df.limit(0)).count() == 0
    plan = D.schema_drift(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_a_clustered_archive_skips_row_groups(spark, tmp_path):
    """Rows that the scan reads for one domain, with and without clustering; a value that is not there reads nothing."""
    events = spark.range(0, 40_000, numPartitions=2).select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 3600).alias("event_time"), F.concat(F.lit("d"), F.pmod(F.xxhash64("id"), F.lit(97)).cast("string")).alias("domain"),
        F.repeat(F.sha2(F.col("id").cast("string"), 256), F.lit(2)).alias("title"))

    def read(path, domain):
        df = spark.read.parquet(path).where(F.col("domain") == domain).select("title")
        n = len(df.collect())
        leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
        return n, leaf.metrics().apply("numOutputRows").value()

    S.write_raw(events, str(tmp_path / "plain"), row_group_bytes=1 << 16)
    S.write_raw(events, str(tmp_path / "clustered"), cluster_by=["domain"], row_group_bytes=1 << 16)
    (n, plain), (m, clustered) = read(str(tmp_path / "plain"), "d42"), read(str(tmp_path / "clustered"), "d42")
    assert n == m > 300 and plain > 30_000 and clustered < 5_000
    assert read(str(tmp_path / "clustered"), "d42x") == (0, 0)       # between two domains' bounds: the bloom filter says no
    assert spark.read.parquet(str(tmp_path / "clustered")).exceptAll(spark.read.parquet(str(tmp_path / "plain"))).count() == 0
