"""Late rows, quality counters, unique messages and edits, sketches: cases, streams against batch, bounded state."""

import json
import os
import time

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from pulse.operators import counters as C
from pulse.operators import edits as E
from pulse.operators import metrics as M
from pulse.operators import parse as P
from pulse.operators import sketches as K
from pulse.sources.files import jsonl_source
from pulse.streaming import jobs as J
from pulse.streaming import sinks as S
from pulse.streaming.late import LateSplit, window_lateness

NOW = {"availableNow": True}
CHANGE, CREATE = "mediawiki.recentchange", "mediawiki.revision-create"


def times(spark, rows, schema="t string, event_type string"):
    df = spark.createDataFrame(rows, schema)
    return df.select(F.col("t").cast("timestamp").alias("event_time"), *df.columns[1:])


def message(t, stream=CHANGE, wiki="w", revision=None, ident=None, kind="edit", **extra):
    return json.dumps({"meta": {"dt": t, "stream": stream, "id": ident, "domain": "d"}, "type": kind, "wiki": wiki, "revision": {"new": revision}, **extra})


def write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


# --- late rows ----------------------------------------------------------------------------

def test_late_rows_and_counts_are_all_rows(spark, tmp_path):
    split = LateSplit(str(tmp_path / "s"), count=lambda ev: M.windowed_count(ev, "10 seconds", ["event_type"], watermark=None))
    b0 = times(spark, [("2024-01-01 00:10:00", "a"), ("2024-01-01 00:20:00", None), (None, "a")])
    b1 = times(spark, [("2024-01-01 00:17:49", "late"), ("2024-01-01 00:17:50", "on"), ("2024-01-01 00:17:50", "on"), (None, "a"), ("2024-01-01 00:01:00", "late")])
    b2 = b0.limit(0)
    b3 = times(spark, [("2024-01-01 00:18:00.000001", "on")])
    for i, b in enumerate((b0, b1, b2, b3)):
        split.on_batch(b, i)
    once = sorted(map(str, split.late(spark).collect()))
    split.on_batch(b1, 1)                   # a micro-batch that runs again after a failure
    assert sorted(map(str, split.late(spark).collect())) == once
    late = {str(r.event_time): r for r in split.late(spark).collect()}
    # watermark 00:18:00: the window 00:17:40 ended before it, 00:17:50 at it (late), 00:18:00 after it
    assert set(late) == {"2024-01-01 00:17:49", "2024-01-01 00:17:50", "2024-01-01 00:01:00"}
    assert late["2024-01-01 00:17:49"].late_micros == 11_000_000 and str(late["2024-01-01 00:17:49"].window_start) == "2024-01-01 00:17:40"
    totals = split.totals(spark).first()
    counted = split.counted(spark).agg(F.sum("cnt")).first()[0]
    assert (totals.rows, totals.late, totals.untimed) == (9, 4, 2) and counted == 3
    assert totals.rows == totals.late + totals.untimed + counted
    assert {r.late_count for r in window_lateness(split.late(spark)).collect()} == {1, 2}


def test_late_split_without_any_event(spark, tmp_path):
    split = LateSplit(str(tmp_path / "s"))
    assert tuple(split.totals(spark).first()) == (0, 0, 0)
    empty = times(spark, [("2024-01-01 00:00:00", "a")]).limit(0)
    split.on_batch(empty, 0)
    split.on_batch(times(spark, [(None, "a")]), 1)
    split.on_batch(times(spark, [("2024-01-01 00:00:00", "a")]), 2)
    assert split.late(spark).count() == 0 and split.counted(spark).first().event_count == 1


# --- quality counters -----------------------------------------------------------------------

DAMAGED = [message("2024-01-01T00:00:00.000Z"), message("12:30"), message("2024-01-01T00:00:00.000Z", stream="other"), message("2024-01-01T00:00:00.000Z", kind=None),
           "{cut", "", "[1]", message("2024-01-01T00:00:00.000Z")[:-1]]
WANT = {"rows": 8, "malformed": 3, "null_time": 5, "unknown_stream": 5, "no_type": 5}


def test_counters_ride_on_one_scan(spark, tmp_path):
    spark.createDataFrame([(v,) for v in DAMAGED], "value string").write.parquet(str(tmp_path / "in"))
    seen = Observation()
    events = C.observed(P.parse_events(spark.read.parquet(str(tmp_path / "in"))), seen)
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    S.write_raw(events, str(tmp_path / "raw"))
    assert {c: seen.get[c] for c in C.COUNTERS} == WANT
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 8
    assert {r.counter: r.n for r in C.counter_rows(spark, {}).collect()} == dict.fromkeys(C.COUNTERS, 0)


def test_counters_of_a_stream(spark, tmp_path):
    log = C.QualityLog()
    spark.streams.addListener(log)
    layout, ident = J.RunLayout(str(tmp_path / "run")), None
    for i, part in enumerate((DAMAGED[:5], DAMAGED[6:])):       # the line source skips the empty line
        write(str(tmp_path / "in"), f"{i}.jsonl", part)
        q = J.start_raw(C.observed(P.parse_events(jsonl_source(spark, str(tmp_path / "in"), streaming=True))), layout, NOW)
        q.awaitTermination(120)
        ident = str(q.id)
    want = {"rows": 7, "malformed": 2, "null_time": 4, "unknown_stream": 4, "no_type": 4}
    for _ in range(100):            # progress events arrive a little later
        if log.totals(ident) == want:
            break
        time.sleep(0.1)
    spark.streams.removeListener(log)
    assert log.totals(ident) == want


def test_a_micro_batch_reported_twice_counts_once():
    class Progress:
        def __init__(self, batch, n):
            self.id, self.batchId, self.observedMetrics = "q", batch, {C.NAME: dict.fromkeys(C.COUNTERS, n)}

    class Event:
        def __init__(self, *a):
            self.progress = Progress(*a)

    log = C.QualityLog()
    for batch, n in ((0, 5), (1, 7), (1, 7), (0, 5), (2, 1)):
        log.onQueryProgress(Event(batch, n))
    assert log.totals("q")["rows"] == 13 and log.totals("other")["rows"] == 0


# --- each message once --------------------------------------------------------------------------

def run_parts(spark, folder, parts, build):
    """Deliver parts as micro-batches of one query; returns its rows, and the state rows of each run's end."""
    state = []
    for i, part in enumerate(parts):
        write(f"{folder}/in", f"{i}.jsonl", part)
        events = P.parse_events(jsonl_source(spark, f"{folder}/in", streaming=True), columns=[*E.EDIT_COLUMNS, "message_id"])
        q = (build(events).writeStream.format("parquet").outputMode("append").option("path", f"{folder}/out")
             .option("checkpointLocation", f"{folder}/cp").trigger(**NOW).start())
        q.awaitTermination(120)
        assert q.exception() is None
        last = [p for p in q.recentProgress if p["stateOperators"]]
        state.append(sum(op["numRowsTotal"] for op in last[-1]["stateOperators"]) if last else 0)
    return spark.read.parquet(f"{folder}/out"), state


def test_repeated_messages(spark, tmp_path):
    a, b = message("2024-01-01T00:00:00.000Z", ident="a"), message("2024-01-01T00:00:01.000Z", ident="b")
    nameless, timeless = message("2024-01-01T00:00:02.000Z"), message("12:30", ident="t")
    lines = [a, a, b, nameless, nameless, timeless, timeless]
    batch = P.parse_events(spark.createDataFrame([(v,) for v in lines], "value string"), columns=[*E.EDIT_COLUMNS, "message_id"])
    assert E.unique_messages(batch).count() == 6
    assert E.unique_messages(batch.limit(0)).count() == 0
    later = [[message(f"2024-01-01T{h:02d}:00:00.000Z", ident=f"h{h}")] for h in range(1, 6)]
    rows, state = run_parts(spark, str(tmp_path), [lines, [a, b], *later], E.unique_messages)
    assert sorted(r.message_id or "" for r in rows.collect()) == sorted(["a", "b", "", "", "t", "t", *(f"h{h}" for h in range(1, 6))])
    assert state[0] == 2 and max(state[3:]) <= 2        # what the watermark has passed has left


# --- each edit once -----------------------------------------------------------------------------

def at(minute, second=0):
    return f"2024-01-01T00:{minute:02d}:{second:02d}.000Z"


def test_edits_of_two_topics(spark, tmp_path):
    first = [message(at(0), CHANGE, "w", 1, bot=True), message(at(0, 9), CREATE, "w", 1, rev_content_changed=True),        # one edit
             message(at(1), CREATE, "w", 2), message(at(0, 30), CHANGE, "w", 2),                                           # one, told the other way round
             message(at(0), CHANGE, "w", 3), message(at(5, 1), CREATE, "w", 3),                                            # too far apart
             message(at(1), CHANGE, "x", 1), message(at(1), CREATE, None, 9), message(at(1), CHANGE, "w", None),           # alone: another wiki, no wiki, no revision
             message("12:30", CHANGE, "w", 4), message(at(1), "other", "w", 5)]
    end = [message(at(m), s, "end", 100 + m) for m in (30, 31) for s in (CHANGE, CREATE)]
    want = sorted([("w", 1, at(0), "both", True, True), ("w", 2, at(0, 30), "both", False, False), ("w", 3, at(0), CHANGE, False, False), ("w", 3, at(5, 1), CREATE, False, False),
                   ("x", 1, at(1), CHANGE, False, False), (None, 9, at(1), CREATE, False, False), ("w", None, at(1), CHANGE, False, False), ("w", 4, None, CHANGE, False, False)], key=str)

    def rows(edits):
        iso = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
        return sorted((tuple(r) for r in edits.where("wiki is null or wiki <> 'end'").select("wiki", "revision", iso, "told_by", "bot", "rev_content_changed").collect()), key=str)

    batch = P.parse_events(spark.createDataFrame([(v,) for v in first + end], "value string"), columns=E.EDIT_COLUMNS)
    assert rows(E.unique_edits(batch)) == want
    assert E.unique_edits(batch.limit(0)).count() == 0
    out, state = run_parts(spark, str(tmp_path), [first[:5], first[5:], end[:2], end[2:]], E.unique_edits)
    assert rows(out) == want
    assert state[-1] <= 4                                # only the last minutes' events are held
    closed = E.closed_edits(out, batch)
    assert rows(closed) == [r for r in want if r[2]] and closed.where("wiki = 'end'").count() == 0


# --- sketches -------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def skewed(spark):
    """60,000 events of an hour: 20,000 users, domains of falling frequency."""
    i = F.col("id")
    return spark.range(60_000, numPartitions=6).select(
        F.timestamp_seconds(F.lit(1704067200) + i % 3600).alias("event_time"), F.concat(F.lit("u"), F.pmod(F.xxhash64("id"), F.lit(20_000)).cast("string")).alias("user"),
        F.concat(F.lit("d"), F.floor(3000 * F.pow(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10_000)) / 10_000, 6)).cast("string")).alias("domain"))


def test_merged_sketches_stay_within_their_bounds(spark, skewed):
    five = K.window_sketches(skewed)
    hour = K.merge_sketches(five, "1 hour")
    est = K.distinct_estimates(hour).first()
    exact = skewed.agg(F.countDistinct("domain").alias("d"), F.countDistinct("user").alias("u")).first()
    assert est.n == 60_000
    assert abs(est.domain_distinct - exact.d) <= K.distinct_error() * exact.d
    assert abs(est.user_distinct - exact.u) <= K.distinct_error() * exact.u and exact.u > 15_000
    counts = {r.domain: r["count"] for r in skewed.groupBy("domain").count().collect()}
    top = K.top_estimates(hour).collect()
    assert len(top) == 10 and len(counts) > K.TRACKED
    assert all(abs(r.cnt - counts[r.domain]) <= K.top_error() * 60_000 for r in top)
    true_top = sorted(counts.values(), reverse=True)[:10]
    assert all(counts[r.domain] >= true_top[-1] - K.top_error() * 60_000 for r in top)


def test_a_sketch_has_a_bounded_size(spark, skewed):
    sizes = K.window_sketches(skewed, "1 hour").select(F.length("user_hll").alias("hll"), F.length("domain_items.sketch").alias("items")).first()
    assert sizes.hll <= (1 << K.LG_K) + 100 and sizes.items <= 40 * K.TRACKED


def test_sketches_of_a_stream(spark, tmp_path, skewed):
    some = skewed.where(F.col("event_time") < F.timestamp_seconds(F.lit(1704067200 + 900)))
    some.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(some.schema).parquet(str(tmp_path / "in"))
    log = S.UpdateLog(str(tmp_path / "log"))
    q = K.window_sketches(stream).writeStream.outputMode("update").foreachBatch(log.write).option("checkpointLocation", str(tmp_path / "cp")).trigger(**NOW).start()
    q.awaitTermination(120)
    got = K.distinct_estimates(K.merge_sketches(S.current(log.read(spark), M.WINDOW_KEYS), "1 hour")).collect()
    assert got == K.distinct_estimates(K.merge_sketches(K.window_sketches(some), "1 hour")).collect()
