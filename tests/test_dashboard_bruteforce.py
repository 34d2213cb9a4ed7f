"""The dashboard document against a brute-force build, besides its SQL oracle.

The expected document is assembled in plain Python, following the original
API's shaping rules, from metric tables that DuckDB computes over the same
small fixture (sf0.001); the Spark document must equal it field by field.
"""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from oracle_check import duck
from pulse.operators import shaping as S
from pulse.plans.catalog import SERIES_POINTS, _all_metrics
from pulse.plans.oracles import M1, M2, M2_TOP, M3, M4, M5, _with

SF = "/root/testdata/sf0.001"


def _epoch(t):
    return int(t.replace(tzinfo=dt.timezone.utc).timestamp())


def expected_document(sf_dir, limit):
    con = duck(sf_dir)

    def rows(sql):
        return con.execute(_with(M1, M2, M2_TOP, M3, M4, M5) + "\n" + sql).fetchall()

    # total: [{t,v}] ascending, last `limit`
    total = sorted(({"t": _epoch(w), "v": n} for w, n in rows("SELECT window_start, event_count FROM m1")),
                   key=lambda p: p["t"])[-limit:]
    # byType: per type, points ascending, last `limit` each
    by_type = {}
    for w, typ, n in rows("SELECT window_start, final_type, cnt FROM top5"):
        points = by_type.setdefault("null" if typ is None else typ, {})
        points[_epoch(w)] = points.get(_epoch(w), 0) + n
    by_type = {k: [{"t": t, "v": v[t]} for t in sorted(v)[-limit:]] for k, v in by_type.items()}
    # bot / contentChange: newest window, zero defaults
    b = rows("SELECT total_count, bot_count, bot_ratio FROM m3 ORDER BY window_start DESC LIMIT 1")
    bot = {"windowSec": 60, "total": 0, "bot": 0, "ratio": 0.0}
    if b:
        bot.update(total=b[0][0], bot=b[0][1], ratio=float(b[0][2] or 0.0))
    c = rows("SELECT total_revision_count, content_changed_count, content_change_ratio "
             "FROM m5 ORDER BY window_start DESC LIMIT 1")
    cc = {"windowSec": 60, "total": 0, "changed": 0, "ratio": 0.0}
    if c:
        cc.update(total=c[0][0], changed=c[0][1], ratio=float(c[0][2] or 0.0))
    # topWiki: newest 5-minute window, count desc then domain, 10 entries
    top = [{"k": d, "v": n} for d, n in rows(
        "SELECT domain, cnt FROM m4 WHERE window_start = (SELECT max(window_start) FROM m4) "
        "ORDER BY cnt DESC, domain LIMIT 10")]
    now = rows("SELECT max(event_time) FROM ev")[0][0]
    return {"bucketSec": 10, "rangeMin": 10, "now": _epoch(now), "total": total, "byType": by_type,
            "bot": bot, "topWiki": top, "contentChange": cc}


@pytest.mark.parametrize("sf", [SF])
def test_dashboard_equals_bruteforce(spark, sf):
    metrics, newest = _all_metrics(spark, sf)
    got = S.dashboard(*metrics, limit=SERIES_POINTS, now=F.unix_seconds(newest)).collect()
    assert len(got) == 1
    doc = got[0].asDict(recursive=True)
    want = expected_document(sf, SERIES_POINTS)
    assert doc["total"] == want["total"]
    assert doc["byType"] == want["byType"]
    assert doc["topWiki"] == want["topWiki"]
    assert doc["bot"] == want["bot"]
    assert doc["contentChange"] == want["contentChange"]
    assert doc == want
