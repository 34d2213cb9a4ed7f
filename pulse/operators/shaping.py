"""Dashboard shaping: series, rankings and the single dashboard document.

Inputs are metric tables (current revisions). Everything is expressed as
DataFrame operations; the only array/map building happens on data already
bounded by a feature limit (retention of the newest windows, last-N points,
top-k), never on a whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, MapType, StringType, StructField, StructType

from pulse.config import (
    BOT_WINDOW_SEC,
    BUCKET_SEC,
    CONTENT_WINDOW_SEC,
    KEY_BOT,
    KEY_BY_TYPE,
    KEY_CONTENT,
    KEY_TOP,
    KEY_TOTAL,
    NORMALIZED_RANGE_MIN,
    NORMALIZED_WINDOW_SEC,
    RANGE_MIN,
    RETAINED_WINDOWS,
    SERIES_KEYS,
    UNKNOWN_KEY,
)
from pulse.functions.time import iso_to_epoch
from pulse.functions.values import percent
from pulse.operators import ranking as R


# --- series -------------------------------------------------------------------

def total_series(m1: DataFrame, limit: int | None = None) -> DataFrame:
    """Metric 1 as points ``t`` (epoch s), ``v``; ascending; optional last N."""
    pts = m1.select(F.unix_seconds("window_start").alias("t"), F.col("event_count").alias("v"))
    return R.last_n_points(pts.filter(F.col("t").isNotNull()), limit)


def type_points(top: DataFrame, type_col: str = "final_type") -> DataFrame:
    """Top-5+others rows as long points ``type, t, v``."""
    return top.select(F.col(type_col).alias("type"), F.unix_seconds("window_start").alias("t"),
                      F.col("cnt").alias("v")).filter(F.col("t").isNotNull())


def by_type_series(top: DataFrame, limit: int | None = None) -> DataFrame:
    """Per-type series ``type, t, v``: each type's last N points, by type and time."""
    return _type_series(top, limit).orderBy(F.col("type").asc_nulls_first(), "t")


def _type_series(top: DataFrame, limit: int | None) -> DataFrame:
    return R.last_n_per_series(type_points(top), "type", limit)


def type_totals(series: DataFrame, last_n: int | None = None) -> DataFrame:
    """Sum of each type's last N points; zero totals dropped: ``name, value``."""
    pts = R.last_n_per_series(series, "type", last_n)
    totals = pts.groupBy("type").agg(F.sum(F.coalesce("v", F.lit(0))).cast("long").alias("value"))
    return (totals.filter(F.col("value") > 0).select(F.col("type").alias("name"), "value")
            .orderBy(F.col("value").desc(), F.col("name").asc_nulls_first()))


def type_share(totals: DataFrame) -> DataFrame:
    """Share of the overall total per type (the grand total is a one-row subquery)."""
    grand = totals.select(F.sum("value")).scalar()
    return totals.withColumn("share", F.col("value") / grand)


def stacked_by_type(series: DataFrame, keys: list[str], last_n: int | None = None) -> DataFrame:
    """One row per shared timestamp (the last N across all types), one column
    per key, missing points as 0. ``keys`` come from :func:`series_key_list`; a
    null type is labelled ``null``."""
    pts = R.last_n_timestamps(series, last_n, "t")
    if not keys:
        return pts.select("t").distinct()
    label = F.coalesce(F.col("type"), F.lit("null"))
    cols = [F.coalesce(F.sum(F.when(label == k, F.col("v"))), F.lit(0).cast("long")).alias(k) for k in keys]
    return pts.groupBy("t").agg(*cols).orderBy("t")


def stacked_long(wide: DataFrame, keys: list[str]) -> DataFrame:
    """The stacked rows as ``t, type, v``, zeros included."""
    entries = F.array(*[F.struct(F.lit(k).alias("type"), F.col(f"`{k}`").alias("v")) for k in keys])
    return wide.select("t", F.inline(entries)) if keys else wide.select("t", F.lit(None).cast("string").alias("type"), F.lit(0).cast("long").alias("v")).limit(0)


def series_key_list(series: DataFrame, n: int = SERIES_KEYS) -> list[str]:
    """The first ``n`` series keys as a Python list (at most ``n`` values cross
    to the driver: the pivot needs its column names before planning)."""
    rows = R.series_keys(series, "type", "v", n).orderBy("position").collect()
    return list(dict.fromkeys("null" if r["key"] is None else r["key"] for r in rows))


# --- single-value objects -------------------------------------------------------

def _latest_object(latest: DataFrame, window_sec: int, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """One row from a 0/1-row input, zero defaults when absent (a global
    aggregate always yields exactly one row)."""
    cols = [F.lit(window_sec).alias("windowSec")]
    for out, (src, kind) in fields.items():
        zero = F.lit(0.0) if kind == "double" else F.lit(0).cast("long")
        cols.append(F.coalesce(F.max(F.col(src).cast(kind)), zero).alias(out))
    return latest.agg(*cols)


def bot_object(m3: DataFrame, window_sec: int = BOT_WINDOW_SEC) -> DataFrame:
    """``windowSec, total, bot, ratio`` of the newest bot-ratio window."""
    return _latest_object(R.latest_row(m3), window_sec, {
        "total": ("total_count", "long"), "bot": ("bot_count", "long"), "ratio": ("bot_ratio", "double")})


def content_change_object(m5: DataFrame, window_sec: int = CONTENT_WINDOW_SEC) -> DataFrame:
    """``windowSec, total, changed, ratio`` of the newest content-change window."""
    return _latest_object(R.latest_row(m5), window_sec, {
        "total": ("total_revision_count", "long"), "changed": ("content_changed_count", "long"),
        "ratio": ("content_change_ratio", "double")})


def top_wiki(m4_top: DataFrame) -> DataFrame:
    """Top list ``k`` (domain), ``v`` (count)."""
    return m4_top.select(F.col("domain").alias("k"), F.col("cnt").alias("v"))


def gauge(df: DataFrame, ratio_col: str) -> DataFrame:
    """Whole-percent gauge value per window (half-up; null ratio = 0)."""
    return df.select("window_start", F.col(ratio_col).alias("ratio"), percent(ratio_col).alias("percent"))


# --- the document ----------------------------------------------------------------

def _points(df: DataFrame) -> Column:
    return F.array_sort(F.collect_list(F.struct("t", "v")))


def dashboard(m1: DataFrame, m2_top: DataFrame, m3: DataFrame, m4: DataFrame, m5: DataFrame,
              limit: int | None = None, now: Column | None = None,
              retained: int = RETAINED_WINDOWS) -> DataFrame:
    """The dashboard document as one row (no row when all five inputs are empty).

    ``bucketSec, rangeMin, now, total[{t,v}], byType{type:[{t,v}]},
    bot{windowSec,total,bot,ratio}, topWiki[{k,v}], contentChange{...}``.
    Series are first cut to the newest ``retained`` windows (the serving
    retention), then to the last ``limit`` points; every part is a one-row
    scalar subquery over that bounded data.
    """
    spark = m1.sparkSession
    total = total_series(R.retain_latest(m1, retained), limit)
    # a null type and a type named "null" are one label: summed before the map is built
    labelled = type_points(R.retain_latest(m2_top, retained)).groupBy(F.coalesce("type", F.lit("null")).alias("type"), "t").agg(F.sum("v").alias("v"))
    series = R.last_n_per_series(labelled, "type", limit)       # arrays are sorted below
    per_type = series.groupBy("type").agg(_points(series).alias("points"))
    by_type = per_type.agg(F.map_from_entries(F.collect_list(F.struct("type", "points"))))
    ranked = top_wiki(R.top_domains(m4)).select((-F.col("v")).alias("o"), "k", "v")
    top = ranked.agg(F.transform(F.sort_array(F.collect_list(F.struct("o", "k", "v"))),
                                 lambda x: F.struct(x["k"].alias("k"), x["v"].alias("v"))))
    bot = bot_object(m3).select(F.struct("windowSec", "total", "bot", "ratio"))
    cc = content_change_object(m5).select(F.struct("windowSec", "total", "changed", "ratio"))
    total_arr = total.agg(_points(total))
    doc = spark.range(1).select(
        F.lit(BUCKET_SEC).alias("bucketSec"),
        F.lit(RANGE_MIN).alias("rangeMin"),
        (now if now is not None else F.unix_seconds(F.current_timestamp())).alias("now"),
        total_arr.scalar().alias("total"),
        by_type.scalar().alias("byType"),
        bot.scalar().alias("bot"),
        top.scalar().alias("topWiki"),
        cc.scalar().alias("contentChange"),
    )
    # A metric is present iff its part is non-empty (counts are >= 1 in any
    # window), so no extra pass over the inputs is needed.
    present = ((F.size("total") > 0) | (F.size("byType") > 0) | (F.col("bot.total") > 0)
               | (F.size("topWiki") > 0) | (F.col("contentChange.total") > 0))
    return doc.filter(present)


def dashboard_from_snapshots(live: DataFrame, limit: int | None = None, now: Column | None = None) -> DataFrame:
    """The dashboard document from the store's unexpired values (``metric_key, payload``).

    Absent and unreadable payloads give empty lists and zero objects; points
    with a null or bad ``ts`` are skipped; series are cut to their last
    ``limit`` points. No row when no key is present. Payloads are bounded by the
    retention, and each is reshaped inside its row.
    """
    keys = (KEY_TOTAL, KEY_BY_TYPE, KEY_BOT, KEY_TOP, KEY_CONTENT)
    payload = [F.max(F.when(F.col("metric_key") == k, F.col("payload"))).alias(f"_{i}") for i, k in enumerate(keys)]
    row = live.where(F.try_parse_json("payload").isNotNull()).agg(F.count(F.lit(1)).alias("_n"), *payload).where(F.col("_n") > 0)

    def last(points: Column) -> Column:
        points = F.array_sort(F.filter(points, lambda p: p["t"].isNotNull()))
        if limit is None or limit <= 0:
            return points
        return F.slice(points, F.greatest(F.size(points) - limit + 1, F.lit(1)), limit)

    m1 = F.from_json("_0", "array<struct<ts:string,count:bigint>>")
    total = last(F.transform(m1, lambda x: F.struct(iso_to_epoch(x["ts"]).alias("t"), F.coalesce(x["count"], F.lit(0).cast("long")).alias("v"))))
    m2 = F.from_json("_1", "array<struct<ts:string,type_counts:map<string,bigint>>>")
    entries = F.flatten(F.transform(m2, lambda w: F.transform(F.map_entries(w["type_counts"]), lambda e: F.struct(
        e["key"].alias("type"), iso_to_epoch(w["ts"]).alias("t"), e["value"].alias("v")))))
    one = row.select("*", total.alias("_total"), F.array_sort(entries).alias("_entries"))
    names = F.transform("_entries", lambda e: e["type"])
    types = F.array_distinct(names)
    by_type = F.map_from_arrays(types, F.transform(types, lambda ty, i: last(F.transform(
        F.slice("_entries", F.array_position(names, ty).cast("int"),
                (F.coalesce(F.array_position(names, F.get(types, i + 1)), F.size("_entries") + 1) - F.array_position(names, ty)).cast("int")),
        lambda e: F.struct(e["t"].alias("t"), e["v"].alias("v"))))))
    zero, none = F.lit(0).cast("long"), F.lit(0.0)
    bot = F.from_json("_2", "struct<bot_ratio:double,bot_count:bigint,total_count:bigint>")
    change = F.from_json("_4", "struct<content_change_ratio:double,content_changed_count:bigint,total_revision_count:bigint>")
    top = F.transform(F.from_json("_3", "array<struct<domain:string,count:bigint>>"), lambda x: F.struct(x["domain"].alias("k"), x["count"].alias("v")))
    return one.select(
        F.lit(BUCKET_SEC).alias("bucketSec"), F.lit(RANGE_MIN).alias("rangeMin"),
        (now if now is not None else F.unix_seconds(F.current_timestamp())).alias("now"),
        F.coalesce("_total", F.array().cast("array<struct<t:bigint,v:bigint>>")).alias("total"),
        F.coalesce(by_type, F.create_map().cast("map<string,array<struct<t:bigint,v:bigint>>>")).alias("byType"),
        F.struct(F.lit(BOT_WINDOW_SEC).alias("windowSec"), F.coalesce(bot["total_count"], zero).alias("total"),
                 F.coalesce(bot["bot_count"], zero).alias("bot"), F.coalesce(bot["bot_ratio"], none).alias("ratio")).alias("bot"),
        F.coalesce(top, F.array().cast("array<struct<k:string,v:bigint>>")).alias("topWiki"),
        F.struct(F.lit(CONTENT_WINDOW_SEC).alias("windowSec"), F.coalesce(change["total_revision_count"], zero).alias("total"),
                 F.coalesce(change["content_changed_count"], zero).alias("changed"), F.coalesce(change["content_change_ratio"], none).alias("ratio")).alias("contentChange"))


def document_rows(doc: DataFrame) -> DataFrame:
    """A dashboard document as rows ``part, key, t, v, ratio``."""
    nil, no_t, no_r = F.lit(None).cast("string"), F.lit(None).cast("long"), F.lit(None).cast("double")

    def entry(part, key, t, v, ratio):
        return F.struct(F.lit(part).alias("part"), key.alias("key"), t.alias("t"), v.cast("long").alias("v"), ratio.alias("ratio"))

    def whole(part: str, names: tuple[str, str]) -> Column:
        c = F.col(part)
        return F.array(*[entry(part, F.lit(n), no_t, c[n], no_r) for n in names], entry(part, F.lit("ratio"), no_t, no_t, c["ratio"]))

    parts = F.concat(
        F.transform("total", lambda p: entry("total", nil, p["t"], p["v"], no_r)),
        F.flatten(F.transform(F.map_entries("byType"), lambda e: F.transform(e["value"], lambda p: entry("byType", e["key"], p["t"], p["v"], no_r)))),
        F.transform("topWiki", lambda p: entry("topWiki", p["k"], no_t, p["v"], no_r)),
        whole("bot", ("total", "bot")), whole("contentChange", ("total", "changed")))
    return doc.select(F.inline(parts))


# --- schema-variant normaliser (SHP8) -------------------------------------------------

def _st(**fields) -> StructType:
    return StructType([StructField(k, v, True) for k, v in fields.items()])


_L, _D, _S = LongType(), DoubleType(), StringType()
_POINT = _st(t=_L, v=_L)
_M1 = ArrayType(_st(ts=_S, window_start=_S, t=_S, count=_S, event_count=_S, v=_S))
_M2 = ArrayType(_st(ts=_S, type_counts=MapType(_S, _S), typeCounts=MapType(_S, _S)))
# Counts are read as text: producers wrote 3, 3.0 and "3" (see _number).
_M3 = _st(bot_ratio=_S, ratio=_S, bot_count=_S, bot=_S, total_count=_S, total=_S, windowSec=_S)
_M4 = ArrayType(_st(domain=_S, k=_S, count=_S, v=_S))
_M5 = _st(content_change_ratio=_S, ratio=_S, content_changed_count=_S, changed=_S,
          total_revision_count=_S, total=_S, windowSec=_S)

# Every field name any producer version used, in one schema.
RAW_DASHBOARD = _st(
    bucketSec=_L, rangeMin=_L,
    total=_M1, metric1=_M1, events_total=_M1,
    byType=MapType(_S, ArrayType(_POINT)), metric2=_M2, events_by_type=_M2, byTypeWindows=_M2,
    bot=_M3, metric3=_M3, bot_ratio=_M3,
    topWiki=_M4, metric4=_M4, top_domains=_M4, top_domain=_M4,
    contentChange=_M5, metric5=_M5, content_change_ratio=_M5,
)


def _number(c: Column, kind: str = "long") -> Column:
    """A JSON number or numeric text; null if it is neither."""
    d = c.cast("string").try_cast("double")
    return d if kind == "double" else d.try_cast("long")


def _first(raw, *names):
    return F.coalesce(*[raw[n] for n in names])


def normalize_dashboard(df: DataFrame, col: str = "json") -> DataFrame:
    """Normalise stored dashboard documents written under any field naming.

    Accepts ``metric1``/``events_total``/``total`` with ``ts``/``window_start``/``t``
    and ``count``/``event_count``/``v``; ``type_counts``/``typeCounts``; ``bot_ratio``/``ratio``
    and the other pairs; defaults ``bucketSec=10``, ``rangeMin=300``,
    ``windowSec=60`` and key ``unknown``. A document that already has ``total``,
    ``byType`` and ``topWiki`` passes through unchanged. Row-local: each
    document is reshaped with higher-order functions, no shuffle. Adds
    ``bucketSec, rangeMin, total, byType, bot, topWiki, contentChange``.
    """
    raw = F.from_json(F.col(col), RAW_DASHBOARD)
    d = df.withColumn("_raw", raw)
    r = F.col("_raw")
    normal = r["total"].isNotNull() & r["byType"].isNotNull() & r["topWiki"].isNotNull()

    m1 = _first(r, "metric1", "events_total", "total")
    total = F.filter(F.transform(m1, lambda x: F.struct(
        iso_to_epoch(F.coalesce(x["ts"], x["window_start"], x["t"])).alias("t"),
        _number(F.coalesce(x["count"], x["event_count"], x["v"], F.lit("0"))).alias("v"))),
        lambda p: p["t"].isNotNull())
    total_pass = F.transform(r["total"], lambda x: F.struct(
        _number(x["t"]).alias("t"), _number(x["v"]).alias("v")))

    m2 = _first(r, "metric2", "events_by_type", "byTypeWindows")
    windows = F.filter(F.transform(m2, lambda w: F.struct(
        iso_to_epoch(w["ts"]).alias("t"),
        F.coalesce(w["type_counts"], w["typeCounts"], F.create_map().cast("map<string,string>")).alias("c"))),
        lambda w: w["t"].isNotNull())
    entries = F.flatten(F.transform(windows, lambda w: F.transform(F.map_entries(w["c"]), lambda e: F.struct(
        e["key"].alias("type"), w["t"].alias("t"),
        F.coalesce(e["value"].cast("double").cast("long"), F.lit(0).cast("long")).alias("v")))))
    # sorted by type, each type is one slice of the entries
    entries = F.array_sort(entries)
    types = F.array_distinct(F.transform(entries, lambda e: e["type"]))
    names = F.transform(entries, lambda e: e["type"])
    by_type = F.map_from_arrays(types, F.transform(types, lambda ty, i: F.transform(
        F.slice(entries, F.array_position(names, ty).cast("int"),
                F.coalesce(F.array_position(names, F.get(types, i + 1)), F.size(entries) + 1).cast("int") - F.array_position(names, ty).cast("int")),
        lambda e: F.struct(e["t"].alias("t"), e["v"].alias("v")))))

    def obj(src, pairs):
        return F.when(src.isNotNull(), F.struct(*[
            F.coalesce(*[_number(src[n], "double" if isinstance(default, float) else "long") for n in names], F.lit(default)).alias(out)
            for out, names, default in pairs]))

    m3 = _first(r, "metric3", "bot_ratio", "bot")
    bot = obj(m3, [("ratio", ("bot_ratio", "ratio"), 0.0), ("bot", ("bot_count", "bot"), 0),
                   ("total", ("total_count", "total"), 0), ("windowSec", ("windowSec",), NORMALIZED_WINDOW_SEC)])
    bot_pass = F.struct(_number(r["bot"]["ratio"], "double").alias("ratio"), *[_number(r["bot"][n]).alias(n) for n in ("bot", "total", "windowSec")])
    m5 = _first(r, "metric5", "content_change_ratio", "contentChange")
    cc = obj(m5, [("ratio", ("content_change_ratio", "ratio"), 0.0),
                  ("changed", ("content_changed_count", "changed"), 0),
                  ("total", ("total_revision_count", "total"), 0),
                  ("windowSec", ("windowSec",), NORMALIZED_WINDOW_SEC)])
    cc_pass = F.struct(_number(r["contentChange"]["ratio"], "double").alias("ratio"),
                       *[_number(r["contentChange"][n]).alias(n) for n in ("changed", "total", "windowSec")])
    m4 = _first(r, "metric4", "top_domains", "topWiki", "top_domain")
    top = F.coalesce(F.transform(m4, lambda x: F.struct(
        F.coalesce(x["domain"], x["k"], F.lit(UNKNOWN_KEY)).alias("k"),
        _number(F.coalesce(x["count"], x["v"], F.lit("0"))).alias("v"))), F.array())
    top_pass = F.transform(r["topWiki"], lambda x: F.struct(x["k"].alias("k"), _number(x["v"]).alias("v")))

    def pick(passthrough, built):
        return F.when(normal, passthrough).otherwise(built)

    return d.select(
        *[c for c in df.columns],
        pick(r["bucketSec"], F.coalesce(r["bucketSec"], F.lit(BUCKET_SEC).cast("long"))).alias("bucketSec"),
        pick(r["rangeMin"], F.coalesce(r["rangeMin"], F.lit(NORMALIZED_RANGE_MIN).cast("long"))).alias("rangeMin"),
        pick(total_pass, F.coalesce(total, F.array())).alias("total"),
        pick(r["byType"], F.coalesce(by_type, F.create_map().cast("map<string,array<struct<t:bigint,v:bigint>>>"))
             ).alias("byType"),
        pick(F.when(r["bot"].isNotNull(), bot_pass), bot).alias("bot"),
        pick(top_pass, top).alias("topWiki"),
        pick(F.when(r["contentChange"].isNotNull(), cc_pass), cc).alias("contentChange"),
    ).filter(F.try_parse_json(F.col(col)).isNotNull())     # unreadable = absent document
