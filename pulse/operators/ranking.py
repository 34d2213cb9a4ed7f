"""Ranking, top-k, "latest" and last-N operators.

Design rules for scale:
* ranking always runs on already-aggregated rows (one row per window and
  dimension value), so a hot window costs one row per distinct value;
* "latest" and "last N" cuts are computed as a one-row scalar subquery (the
  cutoff) and applied as a plain filter -- nothing is collected to the driver
  and nothing grows with the data is broadcast;
* top-k uses ``orderBy().limit()``, planned as a distributed
  TakeOrderedAndProject (per-partition top-k, then a k-row merge);
* per-series last-N uses ``row_number() <= n``, for which Catalyst inserts a
  partial WindowGroupLimit before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.config import OTHERS_LABEL, RETAINED_WINDOWS, SERIES_KEYS, TOP_DOMAINS, TOP_TYPES
from pulse.operators.metrics import WINDOW_KEYS, reaggregate


def _by_count(value: str, dim: str) -> list[Column]:
    # Count descending, dimension ascending (nulls first) as the tie-break.
    return [F.col(value).desc(), F.col(dim).asc_nulls_first()]


def rank_in_window(df: DataFrame, dim: str, value: str = "cnt", name: str = "rank") -> DataFrame:
    """Rank dimension values inside each window by ``value`` descending."""
    w = Window.partitionBy(*WINDOW_KEYS).orderBy(*_by_count(value, dim))
    return df.withColumn(name, F.row_number().over(w))


def top_n_with_others(df: DataFrame, dim: str = "event_type", n: int = TOP_TYPES,
                      other: str = OTHERS_LABEL, value: str = "cnt",
                      out: str = "final_type") -> DataFrame:
    """Top-``n`` values per window plus one ``other`` bucket for the rest.

    Ranks the *complete* window (not only the rows changed in a micro-batch).
    A real value equal to ``other`` merges with the bucket; a null value stays
    its own group. Output: ``window_start, window_end, <out>, cnt``.

    Hot windows stay cheap however many distinct values they hold: the top
    rows come from a ``row_number() <= n`` filter, which Catalyst plans with a
    partial WindowGroupLimit before the shuffle (at most ``n`` rows per window
    leave each task), and the bucket is the window total minus the kept total,
    both partial aggregates. It exists only when the window has more than
    ``n`` values.
    """
    w = Window.partitionBy(*WINDOW_KEYS).orderBy(*_by_count(value, dim))
    top = df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n)
    kept = top.groupBy(*WINDOW_KEYS).agg(F.sum(value).alias("_kept"), F.count(F.lit(1)).alias("_n_kept"))
    totals = df.groupBy(*WINDOW_KEYS).agg(F.sum(value).alias("_total"), F.count(F.lit(1)).alias("_n"))
    rest = (totals.join(kept, WINDOW_KEYS)
            .filter(F.col("_n") > F.col("_n_kept"))
            .select(*WINDOW_KEYS, F.lit(other).alias(out), (F.col("_total") - F.col("_kept")).alias(value)))
    labelled = top.select(*WINDOW_KEYS, F.col(dim).alias(out), F.col(value))
    return reaggregate(labelled.unionByName(rest), [*WINDOW_KEYS, out], value)


def latest_time(df: DataFrame, t: str = "window_start") -> Column:
    """Scalar subquery: the newest value of ``t`` (null on empty input)."""
    return df.select(F.max(t)).scalar()


def latest_window(df: DataFrame, t: str = "window_start") -> DataFrame:
    """All rows of the newest window."""
    return df.filter(F.col(t) == latest_time(df, t))


def top_in_latest_window(df: DataFrame, dim: str = "domain", n: int = TOP_DOMAINS,
                         value: str = "cnt") -> DataFrame:
    """Top-``n`` of the newest window, count descending, then ``dim`` ascending."""
    return latest_window(df).orderBy(*_by_count(value, dim)).limit(n)


def top_domains(df: DataFrame, n: int = TOP_DOMAINS) -> DataFrame:
    """Top-10 domains of the newest 5-minute window."""
    return top_in_latest_window(df, "domain", n)


def latest_row(df: DataFrame, t: str = "window_start") -> DataFrame:
    """The single newest row."""
    return df.orderBy(F.col(t).desc()).limit(1)


def last_n_points(df: DataFrame, n: int | None, t: str = "t") -> DataFrame:
    """Last ``n`` points of one series, ascending; ``n`` <= 0 or None = all."""
    if n is not None and n > 0:
        df = df.orderBy(F.col(t).desc()).limit(n)
    return df.orderBy(F.col(t).asc())


def last_n_per_series(df: DataFrame, key: str, n: int | None, t: str = "t") -> DataFrame:
    """Last ``n`` points of every series ``key`` (each may span a different time range).

    Up to ``spark.sql.optimizer.windowGroupLimitThreshold`` (1000, the serving
    retention) Catalyst adds a partial WindowGroupLimit, so a long series
    never reaches one task whole; beyond it the series is ranked in full.
    """
    if n is None or n <= 0:
        return df
    w = Window.partitionBy(key).orderBy(F.col(t).desc())
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def cutoff_of_latest(df: DataFrame, n: int, t: str) -> Column:
    """Scalar subquery: the ``n``-th newest distinct value of ``t``."""
    newest = df.select(t).distinct().orderBy(F.col(t).desc()).limit(n)
    return newest.select(F.min(t)).scalar()


def keep_latest(df: DataFrame, n: int | None, t: str) -> DataFrame:
    """Rows whose ``t`` is among the ``n`` newest distinct values of ``t``."""
    if n is None or n <= 0:
        return df
    return df.filter(F.col(t) >= cutoff_of_latest(df, n, t))


def retain_latest(df: DataFrame, n: int = RETAINED_WINDOWS, t: str = "window_start") -> DataFrame:
    """Retention: keep every row of the newest ``n`` windows."""
    return keep_latest(df, n, t)


def last_n_timestamps(df: DataFrame, n: int | None, t: str = "t") -> DataFrame:
    """Rows at the ``n`` newest timestamps shared across all series."""
    return keep_latest(df, n, t)


def series_keys(df: DataFrame, key: str = "type", value: str = "v", n: int = SERIES_KEYS) -> DataFrame:
    """The first ``n`` series keys: total descending, then key ascending.

    Output ``position`` (1-based) and ``key``; at most ``n`` rows.
    """
    totals = df.groupBy(key).agg(F.sum(value).alias("_total"))
    top = totals.orderBy(*_by_count("_total", key)).limit(n)
    w = Window.orderBy(*_by_count("_total", key))  # over <= n rows
    return top.select(F.row_number().over(w).alias("position"), F.col(key).alias("key"))
