from conftest import events_df

from pulse.operators import metrics as M
from pulse.operators import ranking as R

RC, RV = "mediawiki.recentchange", "mediawiki.revision-create"


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_total_and_by_type(spark):
    ev = events_df(spark, [
        ("2024-01-01 00:00:01", "edit", True, "a", RC, None),
        ("2024-01-01 00:00:09.999", "edit", False, "a", RV, True),
        ("2024-01-01 00:00:10", "log", None, "b", RV, False),
        (None, "edit", False, "a", RC, None),
    ])
    tot = _rows(M.total_events(ev), "window_start", "event_count")
    assert [(str(t), n) for t, n in tot] == [("2024-01-01 00:00:00", 2), ("2024-01-01 00:00:10", 1)]
    by = _rows(M.events_by_type(ev), "window_start", "event_type", "cnt")
    assert [(str(t)[-8:], e, n) for t, e, n in by] == [("00:00:00", "edit", 2), ("00:00:10", "log", 1)]
    ends = {str(r.window_end) for r in M.total_events(ev).collect()}
    assert ends == {"2024-01-01 00:00:10", "2024-01-01 00:00:20"}


def test_ratios(spark):
    ev = events_df(spark, [
        ("2024-01-01 00:00:01", "edit", True, "a", RC, None),
        ("2024-01-01 00:00:30", "edit", False, "a", RV, True),
        ("2024-01-01 00:00:59", "edit", None, "a", RV, False),
        ("2024-01-01 00:01:00", "edit", True, "a", RC, True),
    ])
    bot = _rows(M.bot_ratio(ev), "window_start", "total_count", "bot_count", "bot_ratio")
    assert [(b, c, round(r, 6)) for _, b, c, r in bot] == [(3, 1, 0.333333), (1, 1, 1.0)]
    cc = _rows(M.content_change_ratio(ev), "window_start", "total_revision_count", "content_changed_count",
               "content_change_ratio")
    assert [(a, b, r) for _, a, b, r in cc] == [(2, 1, 0.5)]      # recentchange rows ignored
    dom = _rows(M.domain_counts(ev), "window_start", "domain", "cnt")
    assert [(d, n) for _, d, n in dom] == [("a", 4)]


def test_streams_parameter(spark):
    ev = events_df(spark, [("2024-01-01 00:00:01", "e", False, "a", RC, None),
                           ("2024-01-01 00:00:02", "e", False, "a", RV, None)])
    assert M.total_events(ev, streams=[RV]).collect()[0].event_count == 1


def test_top5_with_others_ties_null_and_others_name(spark):
    rows = []
    counts = {"a": 5, "b": 5, "c": 4, "d": 3, "others": 3, None: 3, "f": 1, "g": 1}
    for t, n in counts.items():
        rows += [("2024-01-01 00:00:01", t, False, "x", RC, None)] * n
    ev = events_df(spark, rows)
    m2 = M.events_by_type(ev)
    top = {r.final_type: r.cnt for r in R.top_n_with_others(m2).collect()}
    # rank: a,b (5, tie by name), c (4), then the 3s ordered null first, d, others
    assert top == {"a": 5, "b": 5, "c": 4, None: 3, "d": 3, "others": 3 + 1 + 1}
    total = M.total_events(ev).collect()[0].event_count
    assert sum(top.values()) == total
    assert len(top) <= 6


def test_top5_fewer_than_five_types(spark):
    ev = events_df(spark, [("2024-01-01 00:00:01", "a", False, "x", RC, None),
                           ("2024-01-01 00:00:02", "b", False, "x", RC, None)])
    top = {r.final_type: r.cnt for r in R.top_n_with_others(M.events_by_type(ev)).collect()}
    assert top == {"a": 1, "b": 1}


def test_complete_window_ranking_differs_from_batch_delta(spark):
    """Ranking uses the whole window: {a:3,b:3,c:3} + one d keeps a,b,c."""
    rows = [("2024-01-01 00:00:01", t, False, "x", RC, None) for t in "aaabbbccc"] + [
        ("2024-01-01 00:00:05", "d", False, "x", RC, None)]
    top = {r.final_type: r.cnt for r in R.top_n_with_others(M.events_by_type(events_df(spark, rows))).collect()}
    assert top == {"a": 3, "b": 3, "c": 3, "d": 1}
