import json

import pytest
from conftest import events_df
from pyspark.sql import functions as F

from pulse.functions.values import percent
from pulse.operators import metrics as M
from pulse.operators import ranking as R
from pulse.operators import shaping as S

RC, RV = "mediawiki.recentchange", "mediawiki.revision-create"


@pytest.fixture(scope="module")
def ev(spark):
    rows = []
    for minute in range(12):
        for s in range(0, 60, 7):
            t = f"2024-01-01 00:{minute:02d}:{s:02d}"
            typ = ["edit", "log", "new", "categorize", "external", "other1", "other2"][(minute + s) % 7]
            rows.append((t, typ, (s % 3) == 0, f"w{(minute * s) % 4}.org", RC if s % 2 else RV, s % 5 != 0))
    return events_df(spark, rows)


def _series(spark, pts):
    return spark.createDataFrame(pts, "type string, t long, v long")


def test_latest_and_top_domains(spark, ev):
    m4 = M.domain_counts(ev)
    latest = R.latest_window(m4).collect()
    assert {str(r.window_start) for r in latest} == {"2024-01-01 00:10:00"}
    top = R.top_domains(m4, 2).collect()
    assert len(top) == 2 and top[0].cnt >= top[1].cnt
    assert R.latest_row(M.bot_ratio(ev)).collect()[0].window_start.minute == 11


def test_last_n_points_limits(spark):
    pts = spark.createDataFrame([(t, t * 10) for t in range(10)], "t long, v long")
    assert [r.t for r in R.last_n_points(pts, 3).collect()] == [7, 8, 9]
    assert len(R.last_n_points(pts, 0).collect()) == 10
    assert len(R.last_n_points(pts, -1).collect()) == 10
    assert len(R.last_n_points(pts, 100).collect()) == 10
    assert len(R.last_n_points(pts, None).collect()) == 10


def test_last_n_per_series_vs_shared_timestamps(spark):
    s = _series(spark, [("a", 1, 1), ("a", 2, 1), ("a", 3, 1), ("b", 1, 5)])
    per = sorted((r.type, r.t) for r in R.last_n_per_series(s, "type", 1).collect())
    assert per == [("a", 3), ("b", 1)]                     # sparse b keeps an old point
    shared = sorted((r.type, r.t) for r in R.last_n_timestamps(s, 1).collect())
    assert shared == [("a", 3)]                             # the stacked view cuts on shared t


def test_retain_latest(spark, ev):
    top = R.top_n_with_others(M.events_by_type(ev))
    kept = R.retain_latest(top, 3)
    assert kept.select("window_start").distinct().count() == 3
    all_windows = top.select("window_start").distinct().count()
    assert R.retain_latest(top, 10_000).count() == top.count() and all_windows > 3


def test_series_keys_and_stacked(spark):
    s = _series(spark, [("a", 1, 1), ("b", 1, 5), ("c", 2, 5), ("b", 2, 1)])
    keys = S.series_key_list(s, 2)
    assert keys == ["b", "c"]                               # total desc (6, 5), then name
    wide = S.stacked_by_type(s, keys, 10).orderBy("t").collect()
    assert [(r.t, r.b, r.c) for r in wide] == [(1, 5, 0), (2, 1, 5)]
    assert S.stacked_by_type(s, [], 1).count() == 1


def test_type_totals_and_share(spark):
    s = _series(spark, [("a", 1, 1), ("a", 2, 3), ("b", 2, 0), ("c", 2, 4)])
    rows = {r.name: (r.value, r.share) for r in S.type_share(S.type_totals(s, 1)).collect()}
    assert rows == {"a": (3, 3 / 7), "c": (4, 4 / 7)}       # zero total dropped


def test_objects_with_defaults(spark, ev):
    empty = M.bot_ratio(ev.limit(0))
    obj = S.bot_object(empty).collect()[0]
    assert (obj.windowSec, obj.total, obj.bot, obj.ratio) == (60, 0, 0, 0.0)
    obj = S.bot_object(M.bot_ratio(ev)).collect()[0]
    assert obj.total > 0 and 0 <= obj.ratio <= 1
    cc = S.content_change_object(M.content_change_ratio(ev)).collect()[0]
    assert cc.windowSec == 60 and cc.changed <= cc.total


def test_percent_half_up(spark):
    df = spark.createDataFrame([(0.125,), (0.005,), (None,), (0.994,), (0.995,)], "r double")
    assert [r.p for r in df.select(percent("r").alias("p")).collect()] == [13, 1, 0, 99, 100]


def test_dashboard_document(spark, ev):
    m1, m2 = M.total_events(ev), R.top_n_with_others(M.events_by_type(ev))
    m3, m4, m5 = M.bot_ratio(ev), M.domain_counts(ev), M.content_change_ratio(ev)
    doc = S.dashboard(m1, m2, m3, m4, m5, limit=5, now=F.lit(123)).collect()
    assert len(doc) == 1
    d = doc[0].asDict(recursive=True)
    assert (d["bucketSec"], d["rangeMin"], d["now"]) == (10, 10, 123)
    assert len(d["total"]) == 5 and [p["t"] for p in d["total"]] == sorted(p["t"] for p in d["total"])
    assert all(len(v) <= 5 for v in d["byType"].values())
    assert d["bot"]["windowSec"] == 60 and d["contentChange"]["windowSec"] == 60
    assert [x["v"] for x in d["topWiki"]] == sorted((x["v"] for x in d["topWiki"]), reverse=True)
    # window sums of the by-type series equal the totals at the same timestamps
    tot = {p["t"]: p["v"] for p in d["total"]}
    sums = {}
    for pts in d["byType"].values():
        for p in pts:
            sums[p["t"]] = sums.get(p["t"], 0) + p["v"]
    assert all(sums[t] == v for t, v in tot.items() if t in sums)
    empties = [x.limit(0) for x in (m1, m2, m3, m4, m5)]
    assert S.dashboard(*empties, now=F.lit(1)).count() == 0
    json.dumps(d)
