"""DuckDB SQL equivalents of the registered queries.

``EVENTS_CTE`` mirrors the derivation of :mod:`pulse.plans.fixtures` column by
column, then keeps the two subscribed streams; every oracle builds on it.
Integer sums are cast to BIGINT (DuckDB sums to HUGEINT) and every ranking
has the same explicit tie-break as the Spark side.
"""

from __future__ import annotations

from pulse.config import RETAINED_WINDOWS
from pulse.plans.fixtures import BAD_TIME, NO_BOT, NO_CHANGED, NO_TYPE, NULL_LABEL, T0_MICROS, TIME_COMPRESSION

SRC_CTE = f"""
src AS (
  SELECT event_id, user_id, event_type AS base_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CASE WHEN event_id % {BAD_TIME} <> 0 THEN
           make_timestamp({T0_MICROS} + ((epoch_us(ts) - {T0_MICROS}) // {TIME_COMPRESSION}) // 1000 * 1000) END AS event_time
  FROM events
),
allev AS (
  SELECT event_id, event_time,
         'w' || CAST(user_id % 40 AS VARCHAR) || '.example.org' AS domain,
         CASE WHEN event_id % 50 = 0 THEN 'other'
              WHEN event_id % 2 = 0 THEN 'mediawiki.recentchange'
              ELSE 'mediawiki.revision-create' END AS stream,
         CASE WHEN event_id % {NO_TYPE} = 0 THEN NULL WHEN event_id % {NULL_LABEL} = 0 THEN 'null'
              ELSE base_type || '_' || CAST(k % 3 AS VARCHAR) END AS event_type,
         event_id % {NO_BOT} <> 0 AND k % 4 = 0 AS bot,
         'w' || CAST(user_id % 40 AS VARCHAR) || 'wiki' AS wiki,
         'Page ' || CAST(event_id % 997 AS VARCHAR) AS title,
         'user' || CAST(user_id AS VARCHAR) AS "user",
         base_type AS comment,
         CAST(k % 16 AS INTEGER) AS namespace,
         k % 7 = 0 AS minor,
         event_id % {NO_CHANGED} <> 0 AND k % 5 <> 0 AS rev_content_changed
  FROM src
),
ev AS (
  SELECT * FROM allev WHERE stream IN ('mediawiki.recentchange', 'mediawiki.revision-create')
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([SRC_CTE, *ctes])


M1 = """m1 AS (
  SELECT time_bucket(INTERVAL 10 SECOND, event_time) AS window_start,
         time_bucket(INTERVAL 10 SECOND, event_time) + INTERVAL 10 SECOND AS window_end,
         count(*) AS event_count
  FROM ev WHERE event_time IS NOT NULL GROUP BY 1, 2
)"""
M2 = """m2 AS (
  SELECT time_bucket(INTERVAL 10 SECOND, event_time) AS window_start,
         time_bucket(INTERVAL 10 SECOND, event_time) + INTERVAL 10 SECOND AS window_end,
         event_type, count(*) AS cnt
  FROM ev WHERE event_time IS NOT NULL GROUP BY 1, 2, 3
)"""
M2_TOP = """ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY window_start, window_end
                                    ORDER BY cnt DESC, event_type ASC NULLS FIRST) AS INTEGER) AS rank
  FROM m2
),
top5 AS (
  SELECT window_start, window_end,
         CASE WHEN rank <= 5 THEN event_type ELSE 'others' END AS final_type,
         CAST(sum(cnt) AS BIGINT) AS cnt
  FROM ranked GROUP BY 1, 2, 3
)"""
M3 = """m3 AS (
  SELECT time_bucket(INTERVAL 1 MINUTE, event_time) AS window_start,
         time_bucket(INTERVAL 1 MINUTE, event_time) + INTERVAL 1 MINUTE AS window_end,
         count(*) AS total_count, count(*) FILTER (WHERE bot) AS bot_count,
         count(*) FILTER (WHERE bot) / count(*) AS bot_ratio
  FROM ev WHERE event_time IS NOT NULL GROUP BY 1, 2
)"""
M4 = """m4 AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, event_time) AS window_start,
         time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE AS window_end,
         domain, count(*) AS cnt
  FROM ev WHERE event_time IS NOT NULL GROUP BY 1, 2, 3
)"""
M5 = """m5 AS (
  SELECT time_bucket(INTERVAL 1 MINUTE, event_time) AS window_start,
         time_bucket(INTERVAL 1 MINUTE, event_time) + INTERVAL 1 MINUTE AS window_end,
         count(*) AS total_revision_count,
         count(*) FILTER (WHERE rev_content_changed) AS content_changed_count,
         count(*) FILTER (WHERE rev_content_changed) / count(*) AS content_change_ratio
  FROM ev WHERE event_time IS NOT NULL AND stream = 'mediawiki.revision-create' GROUP BY 1, 2
)"""
RETAINED = f"""keep AS (
  SELECT min(window_start) AS cut FROM (SELECT DISTINCT window_start FROM m2 ORDER BY window_start DESC LIMIT {RETAINED_WINDOWS})
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY window_start, window_end ORDER BY cnt DESC, event_type ASC NULLS FIRST) AS rank
  FROM m2 WHERE window_start >= (SELECT cut FROM keep)
),
top5 AS (
  SELECT window_start, window_end, CASE WHEN rank <= 5 THEN event_type ELSE 'others' END AS final_type, CAST(sum(cnt) AS BIGINT) AS cnt
  FROM ranked GROUP BY 1, 2, 3
)"""
# Long by-type series (t, type, v) over the top-5 + others table.
SERIES2 = """s2 AS (
  SELECT CAST(epoch(window_start) AS BIGINT) AS t, final_type AS type, cnt AS v FROM top5
)"""


ORACLES: dict[str, str] = {
    "parse_events": _with() + """
SELECT event_time, domain, stream, event_type, bot, wiki, title, "user", comment,
       namespace, minor, rev_content_changed
FROM ev""",
    "total_events_10s": _with(M1) + "\nSELECT * FROM m1",
    "events_by_type_10s": _with(M2) + "\nSELECT * FROM m2",
    "type_rank_10s": _with(M2, M2_TOP) + "\nSELECT * FROM ranked",
    "top5_types_with_others": _with(M2, M2_TOP) + "\nSELECT * FROM top5",
    "bot_ratio_1m": _with(M3) + "\nSELECT * FROM m3",
    "latest_bot_ratio": _with(M3) + "\nSELECT * FROM m3 ORDER BY window_start DESC LIMIT 1",
    "domain_counts_5m": _with(M4) + "\nSELECT * FROM m4",
    "top10_domains_latest": _with(M4) + """
SELECT * FROM m4 WHERE window_start = (SELECT max(window_start) FROM m4)
ORDER BY cnt DESC, domain ASC NULLS FIRST LIMIT 10""",
    "content_change_ratio_1m": _with(M5) + "\nSELECT * FROM m5",
    "latest_content_change": _with(M5) + "\nSELECT * FROM m5 ORDER BY window_start DESC LIMIT 1",
    "retained_windows": _with(M2, RETAINED) + "\nSELECT * FROM top5",
}

SERIES_POINTS = 60
PIE_POINTS = 360

ORACLES.update({
    "topic_routing": _with() + """
SELECT CASE WHEN stream = 'mediawiki.recentchange' THEN 'wiki-recentchange'
            WHEN stream = 'mediawiki.revision-create' THEN 'wiki-revision-create'
            ELSE 'wiki-unknown' END AS topic,
       count(*) AS n
FROM allev GROUP BY 1""",
    "malformed_events": "SELECT event_id AS \"offset\" FROM events WHERE event_id % 7 = 0",
    "raw_partitions": _with() + """
SELECT CAST(coalesce(year(event_time), -1) AS INTEGER) AS year, CAST(coalesce(month(event_time), -1) AS INTEGER) AS month,
       CAST(coalesce(day(event_time), -1) AS INTEGER) AS day, CAST(coalesce(hour(event_time), -1) AS INTEGER) AS hour,
       count(*) AS n
FROM ev GROUP BY 1, 2, 3, 4""",
    "total_series_last_n": _with(M1) + f"""
SELECT CAST(epoch(window_start) AS BIGINT) AS t, event_count AS v
FROM m1 ORDER BY t DESC LIMIT {SERIES_POINTS}""",
    "by_type_series_last_n": _with(M2, RETAINED, SERIES2) + f"""
SELECT type, t, v FROM (
  SELECT *, row_number() OVER (PARTITION BY type ORDER BY t DESC) AS rn FROM s2)
WHERE rn <= {SERIES_POINTS}""",
    "type_totals_share": _with(M2, RETAINED, SERIES2) + f""",
last AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY type ORDER BY t DESC) AS rn FROM s2)
  WHERE rn <= {PIE_POINTS}
),
totals AS (SELECT type AS name, CAST(sum(v) AS BIGINT) AS value FROM last GROUP BY 1 HAVING sum(v) > 0)
SELECT name, value, value / (SELECT sum(value) FROM totals) AS share FROM totals""",
    "series_keys": _with(M2, RETAINED, SERIES2) + """
SELECT CAST(row_number() OVER (ORDER BY total DESC, type ASC NULLS FIRST) AS INTEGER) AS position,
       type AS key
FROM (SELECT type, sum(v) AS total FROM s2 GROUP BY 1)
ORDER BY total DESC, type ASC NULLS FIRST LIMIT 8""",
    "stacked_by_type": _with(M2, RETAINED, SERIES2) + f""",
ks AS (SELECT DISTINCT coalesce(type, 'null') AS type FROM (SELECT type FROM s2 GROUP BY type ORDER BY sum(v) DESC, type ASC NULLS FIRST LIMIT 8)),
ts AS (SELECT DISTINCT t FROM s2 ORDER BY t DESC LIMIT {SERIES_POINTS}),
sums AS (SELECT t, coalesce(type, 'null') AS type, sum(v) AS v FROM s2 GROUP BY 1, 2)
SELECT ts.t, ks.type, CAST(coalesce(sums.v, 0) AS BIGINT) AS v
FROM ts CROSS JOIN ks LEFT JOIN sums ON sums.t = ts.t AND sums.type = ks.type""",
    "gauge_percent": _with(M3) + """
SELECT window_start, bot_ratio AS ratio, CAST(floor(coalesce(bot_ratio, 0) * 100 + 0.5) AS BIGINT) AS percent
FROM m3""",
    "bot_object": _with(M3) + """
SELECT 60 AS "windowSec", coalesce(max(total_count), 0) AS total, coalesce(max(bot_count), 0) AS bot,
       coalesce(max(bot_ratio), 0.0) AS ratio
FROM (SELECT * FROM m3 ORDER BY window_start DESC LIMIT 1)""",
    "content_change_object": _with(M5) + """
SELECT 60 AS "windowSec", coalesce(max(total_revision_count), 0) AS total,
       coalesce(max(content_changed_count), 0) AS changed, coalesce(max(content_change_ratio), 0.0) AS ratio
FROM (SELECT * FROM m5 ORDER BY window_start DESC LIMIT 1)""",
    "top_wiki": _with(M4) + """
SELECT domain AS k, cnt AS v FROM m4 WHERE window_start = (SELECT max(window_start) FROM m4)
ORDER BY cnt DESC, domain ASC NULLS FIRST LIMIT 10""",
})

# Rows of the dashboard document: part, key, t, v, ratio. The labels of null and "null" types are one.
DOCUMENT = f"""
labelled AS (SELECT coalesce(type, 'null') AS type, t, CAST(sum(v) AS BIGINT) AS v FROM s2 GROUP BY 1, 2),
last AS (SELECT *, row_number() OVER (PARTITION BY type ORDER BY t DESC) AS rn FROM labelled),
total AS (SELECT 'total' AS part, NULL AS key, CAST(epoch(window_start) AS BIGINT) AS t, event_count AS v, NULL::DOUBLE AS ratio
          FROM m1 ORDER BY t DESC LIMIT 60),
types AS (SELECT 'byType' AS part, type AS key, t, v, NULL::DOUBLE AS ratio FROM last WHERE rn <= 60),
bot AS (SELECT * FROM m3 ORDER BY window_start DESC LIMIT 1),
change AS (SELECT * FROM m5 ORDER BY window_start DESC LIMIT 1),
top AS (SELECT 'topWiki' AS part, domain AS key, NULL::BIGINT AS t, cnt AS v, NULL::DOUBLE AS ratio FROM m4
        WHERE window_start = (SELECT max(window_start) FROM m4) ORDER BY cnt DESC, domain ASC NULLS FIRST LIMIT 10)"""
_SERIES_ROWS = "SELECT * FROM total UNION ALL SELECT * FROM types UNION ALL SELECT * FROM top"
_OBJECT_ROWS = """
UNION ALL SELECT 'bot', 'total', NULL, total_count, NULL FROM bot UNION ALL SELECT 'bot', 'bot', NULL, bot_count, NULL FROM bot
UNION ALL SELECT 'bot', 'ratio', NULL, NULL, bot_ratio FROM bot
UNION ALL SELECT 'contentChange', 'total', NULL, total_revision_count, NULL FROM change
UNION ALL SELECT 'contentChange', 'changed', NULL, content_changed_count, NULL FROM change
UNION ALL SELECT 'contentChange', 'ratio', NULL, NULL, content_change_ratio FROM change"""
_OBJECT_ZEROS = """
UNION ALL SELECT 'bot', 'total', NULL, 0, NULL UNION ALL SELECT 'bot', 'bot', NULL, 0, NULL UNION ALL SELECT 'bot', 'ratio', NULL, NULL, 0.0
UNION ALL SELECT 'contentChange', 'total', NULL, 0, NULL UNION ALL SELECT 'contentChange', 'changed', NULL, 0, NULL
UNION ALL SELECT 'contentChange', 'ratio', NULL, NULL, 0.0"""


def _document(objects: str) -> str:
    parts = _with(M1, M2, RETAINED, SERIES2, M3, M4, M5, DOCUMENT)
    return f"""{parts},
doc AS ({_SERIES_ROWS} {objects})
SELECT part, key, coalesce(t, -1) AS t, CAST(coalesce(v, -1) AS BIGINT) AS v, coalesce(ratio, -1.0::DOUBLE) AS ratio FROM doc"""


ORACLES.update({
    "dashboard_document": _document(_OBJECT_ROWS),
    "dashboard_from_store": _document(_OBJECT_ROWS),
    "dashboard_from_store_400s": _document(_OBJECT_ZEROS),
    "snapshot_live": _with(M1, M2, RETAINED, M3, M4, M5) + f""",
stamp AS (SELECT max(event_time) AS now0 FROM ev),
rows AS (
  SELECT 'metrics:events_total_10m_10s' AS metric_key, 10800 AS ttl, strftime(window_start, '%Y-%m-%dT%H:%M:%S') AS ts, NULL AS name, event_count AS n
  FROM m1 WHERE window_start >= (SELECT min(window_start) FROM (SELECT window_start FROM m1 ORDER BY window_start DESC LIMIT {RETAINED_WINDOWS}))
  UNION ALL SELECT 'metrics:events_by_type_10m_10s', 10800, strftime(window_start, '%Y-%m-%dT%H:%M:%S'), coalesce(final_type, 'null'), CAST(sum(cnt) AS BIGINT)
  FROM top5 GROUP BY window_start, 4
  UNION ALL (SELECT 'metrics:top_domain_5m_top10', 600, NULL, domain, cnt FROM m4 WHERE window_start = (SELECT max(window_start) FROM m4)
             ORDER BY cnt DESC, domain ASC NULLS FIRST LIMIT 10)
)
SELECT metric_key, now0 AS updated_at, now0 + to_seconds(ttl) AS expires_at, ts, name, n FROM rows, stamp""",
    "normalized_documents": _with(M3) + """
SELECT CAST(epoch(window_start) AS BIGINT) AS doc_id,
       CAST(10 AS BIGINT) AS "bucketSec",
       CAST(CASE WHEN (CAST(epoch(window_start) AS BIGINT) // 60) % 3 = 1 THEN 10 ELSE 300 END AS BIGINT) AS "rangeMin",
       bot_ratio AS ratio,
       CASE WHEN (CAST(epoch(window_start) AS BIGINT) // 60) % 3 = 2 THEN 0 ELSE bot_count END AS bot,
       total_count AS total,
       CAST(60 AS BIGINT) AS "windowSec"
FROM m3""",
})

ORACLES.update({
    "capture_framing": _with() + """
SELECT CAST(event_id AS VARCHAR) AS sse_id, event_id % 7 <> 0 AS is_valid,
       CASE WHEN event_id % 7 <> 0 THEN event_type END AS event_type, CASE WHEN event_id % 7 <> 0 THEN title END AS title,
       CASE WHEN event_id % 7 <> 0 THEN event_id * 2 + 1 ELSE -1 END AS revision, CASE WHEN event_id % 7 <> 0 THEN domain END AS domain
FROM allev""",
})
ORACLES["stream_metric_1"] = ORACLES["total_events_10s"]
ORACLES["stream_metric_2"] = ORACLES["events_by_type_10s"]
ORACLES["stream_metric_3"] = ORACLES["bot_ratio_1m"]
ORACLES["stream_metric_4"] = ORACLES["domain_counts_5m"]
ORACLES["stream_metric_5"] = ORACLES["content_change_ratio_1m"]
ORACLES["jsonl_roundtrip"] = ORACLES["events_by_type_10s"]
ORACLES["archive_compacted_read"] = _with() + """
SELECT year(event_time)::INT AS year, month(event_time)::INT AS month, day(event_time)::INT AS day, hour(event_time)::INT AS hour, count(*) AS n
FROM ev WHERE event_time >= TIMESTAMP '2024-01-01 01:00:00' AND event_time < TIMESTAMP '2024-01-01 05:00:00' GROUP BY ALL"""
