"""DuckDB SQL equivalents of :mod:`pulse.plans.streams`; the CTEs mirror the inputs of :mod:`pulse.plans.replays`."""

from __future__ import annotations

from pulse.config import RETAINED_WINDOWS
from pulse.plans.fixtures import BAD_TIME, NO_BOT, NO_CHANGED, T0_MICROS, TIME_COMPRESSION
from pulse.plans.oracles import M1, M2, M2_TOP, M3, M4, M5, RETAINED, _with
from pulse.plans.oracles import ORACLES as BATCH
from pulse.plans.replays import LAG_EVERY, LAG_SECONDS, LATE_EVERY, LATE_SECONDS, NO_REVISION, SLOT_SECONDS, SLOW_EVERY, SLOW_SECONDS
from pulse.plans.replays import REQUEST_EVERY, TEXT_FLAG_EVERY, VERSION_EVERY

_MICROS = f"({T0_MICROS} + (epoch_us(ts) - {T0_MICROS}) // {TIME_COMPRESSION})"

ORACLES: dict[str, str] = {
    "late_events": _with() + f""",
arrived AS (
  SELECT ev.*, ({_MICROS} // 1000000 - {T0_MICROS // 1_000_000}
                + CASE WHEN e.event_id % {LATE_EVERY} = 0 THEN {LATE_SECONDS} WHEN e.event_id % {SLOW_EVERY} = 0 THEN {SLOW_SECONDS} ELSE e.event_id % 5 END) // {SLOT_SECONDS} AS slot
  FROM ev JOIN events e USING (event_id)),
newest AS (SELECT slot, max(max(event_time)) OVER (ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 2 MINUTE AS watermark FROM arrived GROUP BY slot),
judged AS (
  SELECT arrived.*, watermark, time_bucket(INTERVAL 10 SECOND, event_time) AS window_start,
         coalesce(time_bucket(INTERVAL 10 SECOND, event_time) + INTERVAL 10 SECOND <= watermark, false) AS late
  FROM arrived JOIN newest USING (slot))
SELECT 'late' AS part, window_start, event_time, domain, event_type, epoch_us(watermark) - epoch_us(event_time) AS late_micros, CAST(1 AS BIGINT) AS n FROM judged WHERE late
UNION ALL SELECT 'counted', window_start, NULL, NULL, NULL, -1, count(*) FROM judged WHERE NOT late AND event_time IS NOT NULL GROUP BY window_start
UNION ALL SELECT 'untimed', NULL, NULL, NULL, NULL, -1, count(*) FROM judged WHERE event_time IS NULL""",
    "quality_counters": _with() + """
SELECT 'rows' AS counter, count(*) AS n FROM allev
UNION ALL SELECT 'malformed', count(*) FROM allev WHERE event_id % 7 = 0
UNION ALL SELECT 'null_time', count(*) FROM allev WHERE event_time IS NULL OR event_id % 7 = 0
UNION ALL SELECT 'unknown_stream', count(*) FROM allev WHERE stream = 'other' OR event_id % 7 = 0
UNION ALL SELECT 'no_type', count(*) FROM allev WHERE event_type IS NULL OR event_id % 7 = 0""",
    "stream_unique_messages": _with(M1) + "\nSELECT * FROM m1",
}
ORACLES["capture_files"] = ORACLES["capture_source"] = ORACLES["stream_capture_source"] = BATCH["capture_framing"]
ORACLES["stream_quality_counters"] = ORACLES["quality_counters"]

_EDITS = f"""WITH told AS (
  SELECT event_id, 'w' || CAST(user_id % 40 AS VARCHAR) AS wiki, CASE WHEN event_id % {NO_REVISION} <> 0 THEN event_id * 2 + 1 END AS revision,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, {_MICROS} AS us,
         CASE WHEN event_id % {LAG_EVERY} = 8 THEN {LAG_SECONDS} ELSE event_id % 20 END AS lag
  FROM events),
c AS (
  SELECT *, CASE WHEN event_id % {BAD_TIME} <> 0 THEN make_timestamp(us // 1000 * 1000) END AS t, event_id % {NO_BOT} <> 0 AND k % 4 = 0 AS bot
  FROM told WHERE event_id % 4 <> 3),
r AS (
  SELECT *, CASE WHEN event_id % {BAD_TIME} <> 0 THEN make_timestamp((us + lag * 1000000) // 1000 * 1000) END AS t, event_id % {NO_BOT} <> 0 AND k % 4 = 0 AS bot,
         event_id % {NO_CHANGED} <> 0 AND k % 5 <> 0 AS changed
  FROM told WHERE event_id % 4 <> 1),
edits AS (
  SELECT least(c.t, r.t) AS t, coalesce(c.bot, r.bot) AS bot, coalesce(r.changed, false) AS changed,
         CASE WHEN c.event_id IS NULL THEN 'mediawiki.revision-create' WHEN r.event_id IS NULL THEN 'mediawiki.recentchange' ELSE 'both' END AS told_by
  FROM c FULL JOIN r ON c.wiki = r.wiki AND c.revision = r.revision AND r.t BETWEEN c.t - INTERVAL 5 MINUTE AND c.t + INTERVAL 5 MINUTE)"""
_EDIT_WINDOWS = """
SELECT time_bucket(INTERVAL 10 SECOND, t) AS window_start, time_bucket(INTERVAL 10 SECOND, t) + INTERVAL 10 SECOND AS window_end, told_by,
       count(*) AS edits, count(*) FILTER (WHERE bot) AS bots, count(*) FILTER (WHERE changed) AS changed
FROM edits WHERE t IS NOT NULL {} GROUP BY ALL"""
ORACLES["unique_edits_10s"] = _EDITS + _EDIT_WINDOWS.format("")
ORACLES["unique_bot_ratio_1m"] = _EDITS + """
SELECT time_bucket(INTERVAL 1 MINUTE, t) AS window_start, time_bucket(INTERVAL 1 MINUTE, t) + INTERVAL 1 MINUTE AS window_end,
       count(*) AS total_count, count(*) FILTER (WHERE bot) AS bot_count, count(*) FILTER (WHERE bot) / count(*) AS bot_ratio
FROM edits WHERE t IS NOT NULL GROUP BY ALL"""
ORACLES["stream_unique_edits"] = _EDITS + _EDIT_WINDOWS.format(
    "AND t < least((SELECT max(t) FROM c WHERE revision IS NOT NULL), (SELECT max(t) FROM r WHERE revision IS NOT NULL)) - INTERVAL 7 MINUTE")

_HOUR = "time_bucket(INTERVAL 1 HOUR, event_time)"
ORACLES.update({
    "sketch_distinct_1h": _with() + f"""
SELECT {_HOUR} AS window_start, {_HOUR} + INTERVAL 1 HOUR AS window_end, count(*) AS n, count(DISTINCT domain) AS domains, count(DISTINCT "user") AS users,
       true AS domains_near, true AS users_near
FROM ev WHERE event_time IS NOT NULL GROUP BY 1, 2""",
    "sketch_domains_1h": _with() + f"""
SELECT {_HOUR} AS window_start, {_HOUR} + INTERVAL 1 HOUR AS window_end, domain, count(*) AS cnt FROM ev WHERE event_time IS NOT NULL GROUP BY 1, 2, 3""",
    "stream_raw_archive": _with() + """
SELECT CAST(event_id AS VARCHAR) AS id, 'https://' || domain || '/wiki/' || title AS uri, event_id * 2 + 1 AS revision, event_id * 2 AS parent, k + 100 AS length, k % 2 = 0 AS patrolled,
       ev.event_time, domain, CAST(coalesce(year(ev.event_time), -1) AS INTEGER) AS year, CAST(coalesce(hour(ev.event_time), -1) AS INTEGER) AS hour
FROM ev JOIN (SELECT event_id, k FROM src) USING (event_id)""",
    "archive_domain_read": _with() + """
SELECT event_time, domain, event_type, title FROM ev
WHERE event_time >= TIMESTAMP '2024-01-01 01:00:00' AND event_time < TIMESTAMP '2024-01-01 05:00:00' AND domain = 'w7.example.org'""",
    "reserialised_events": _with() + """
SELECT CAST(event_id AS VARCHAR) AS id, domain, event_type, title, event_id % 3 <> 0 AS as_received FROM ev""",
    "run_all_store": _with(M1, M2, RETAINED, M3, M4, M5) + f""",
bot AS (SELECT * FROM m3 ORDER BY window_start DESC LIMIT 1),
change AS (SELECT * FROM m5 ORDER BY window_start DESC LIMIT 1)
SELECT 'metrics:events_total_10m_10s' AS metric_key, strftime(window_start, '%Y-%m-%dT%H:%M:%S') AS ts, 'count' AS name, event_count AS n
FROM m1 WHERE window_start >= (SELECT min(window_start) FROM (SELECT window_start FROM m1 ORDER BY window_start DESC LIMIT {RETAINED_WINDOWS}))
UNION ALL SELECT 'metrics:events_by_type_10m_10s', strftime(window_start, '%Y-%m-%dT%H:%M:%S'), coalesce(final_type, 'null'), CAST(sum(cnt) AS BIGINT) FROM top5 GROUP BY window_start, 3
UNION ALL (SELECT 'metrics:top_domain_5m_top10', NULL, domain, cnt FROM m4 WHERE window_start = (SELECT max(window_start) FROM m4) ORDER BY cnt DESC, domain ASC NULLS FIRST LIMIT 10)
UNION ALL SELECT 'metrics:bot_ratio_1m', strftime(window_start, '%Y-%m-%dT%H:%M:%S'), unnest(['bot_count', 'total_count']), unnest([bot_count, total_count]) FROM bot
UNION ALL SELECT 'metrics:content_change_ratio_1m', strftime(window_start, '%Y-%m-%dT%H:%M:%S'), unnest(['content_changed_count', 'total_revision_count']),
                 unnest([content_changed_count, total_revision_count]) FROM change""",
})

_WATERMARK = "(SELECT max(event_time) - INTERVAL 2 MINUTE FROM ev)"
ORACLES.update({
    "stream_top5_closed": _with(M2, M2_TOP) + f"\nSELECT * FROM top5 WHERE window_end <= {_WATERMARK}",
    "state_audit": _with(M2) + f"\nSELECT window_start, window_end, event_type, cnt AS state_cnt, cnt AS log_cnt FROM m2 WHERE window_end > {_WATERMARK}",
    "schema_drift": _with() + f"""
SELECT stream, 'schema_version' AS path, 'BIGINT' AS type, 'unknown' AS problem, count(*) AS n FROM allev WHERE event_id % {VERSION_EVERY} = 0 GROUP BY stream
UNION ALL SELECT stream, 'meta.request_id', 'STRING', 'unknown', count(*) FROM allev WHERE event_id % {REQUEST_EVERY} = 0 GROUP BY stream
UNION ALL SELECT stream, 'bot', 'STRING', 'other_type', count(*) FROM allev WHERE event_id % {TEXT_FLAG_EVERY} = 0 AND event_id % {NO_BOT} <> 0 GROUP BY stream""",
})
