"""Reader of the hour-partitioned raw archive with partition pruning."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _utc(t) -> datetime:
    if isinstance(t, str):
        t = datetime.fromisoformat(t.replace("Z", "+00:00"))
    return t.replace(tzinfo=timezone.utc) if t.tzinfo is None else t.astimezone(timezone.utc)


def _hour_key(t: datetime) -> int:
    return ((t.year * 100 + t.month) * 100 + t.day) * 100 + t.hour


def _hour_col():
    return ((F.col("year") * 100 + F.col("month")) * 100 + F.col("day")) * 100 + F.col("hour")


def _in_hours(df: DataFrame, start=None, end=None) -> DataFrame:
    """Rows in the hours of ``start <= t < end``: a predicate on partition columns alone."""
    if start is not None:
        df = df.filter(_hour_col() >= _hour_key(_utc(start)))
    if end is not None:
        df = df.filter(_hour_col() <= _hour_key(_utc(end) - timedelta(microseconds=1)))
    return df


_FILE = "_metadata.file_path"
MAX_NAMES = 10_000      # files up to which a list of names becomes a predicate, not a join


def _covered(spark: SparkSession, compacted: str) -> tuple[int, DataFrame | None]:
    """Number of finished compaction runs, and the table of the live files they cover (path and hour)."""
    try:
        files = spark.read.parquet(f"{compacted}/files")
    except AnalysisException:       # no run yet
        return 0, None
    return files.agg(F.max("run")).first()[0] + 1, files


def _by_file(df: DataFrame, files: DataFrame, how: str) -> DataFrame:
    """Rows of ``df`` in those files (``left_semi``) or in none of them (``left_anti``).

    Up to ``MAX_NAMES`` names are a predicate on the file name, so the other
    files are never opened; more of them are joined with the rows, and no list
    of that size comes to the driver.
    """
    names = [r[0] for r in files.select("path").limit(MAX_NAMES + 1).collect()]
    if len(names) > MAX_NAMES:
        listed = files.select(F.col("path").alias("_path")).distinct()
        return df.withColumn("_at", F.col(_FILE)).join(listed, F.col("_at") == F.col("_path"), how).drop("_at")
    inside = F.col(_FILE).isin(names) if names else F.lit(False)
    return df.filter(inside if how == "left_semi" else ~inside)


def compact_archive(spark: SparkSession, live: str, compacted: str, until) -> None:
    """Copy the closed hours (before ``until``) of the streaming archive into few,
    well-sized files per hour.

    The streaming sink writes one file per task and hour on every micro-batch.
    Each run lists the live files of closed hours without opening them, takes
    those that no earlier run covered (newly closed hours, and late files of
    older ones; an anti-join of two tables of names), and writes their rows
    under ``data/run=<n>`` with a ``rebalance`` hint: adaptive execution sizes
    the output files and splits a hot hour over several tasks. The run's file
    list, written last under ``files/run=<n>``, makes it count; a run that died
    before that is overwritten by the next. The live archive is left as it is.
    """
    from pulse.schema import PARTITION_COLUMNS

    run, covered = _covered(spark, compacted)
    closed = _hour_col() < _hour_key(_utc(until))
    listed = spark.read.format("binaryFile").load(live).filter(closed).select(F.col(_FILE).alias("path"), *PARTITION_COLUMNS)
    if covered is not None:
        listed = listed.join(covered.select("path"), "path", "left_anti")
    listed.write.mode("overwrite").parquet(f"{compacted}/todo")
    todo = spark.read.schema(listed.schema).parquet(f"{compacted}/todo")
    if todo.isEmpty():
        return
    new = _by_file(spark.read.parquet(live).filter(closed), todo, "left_semi")
    (new.hint("rebalance", *PARTITION_COLUMNS).write.mode("overwrite")
     .partitionBy(*PARTITION_COLUMNS).parquet(f"{compacted}/data/run={run}"))
    todo.write.mode("overwrite").parquet(f"{compacted}/files/run={run}")


def read_raw(spark: SparkSession, path: str, start=None, end=None, compacted: str | None = None) -> DataFrame:
    """Archived standard events with ``start <= event_time < end`` (UTC).

    Besides the exact ``event_time`` predicate (pushed into the Parquet scan),
    the range is turned into a predicate on the partition columns alone, so
    directories outside the hours of the range are never listed or opened.
    Rows with a null event time live in the default partition and are only
    returned when no range is given. With ``compacted`` (see
    :func:`compact_archive`) the files it covers are read from the copy, all
    others, late ones of closed hours among them, from the live archive; only
    the file lists of the range's hours are read.
    """
    df = spark.read.parquet(path)
    if compacted is not None:
        runs, covered = _covered(spark, compacted)
        if runs:
            old = spark.read.parquet(f"{compacted}/data").filter(F.col("run") < runs).drop("run")
            df = old.unionByName(_by_file(df, _in_hours(covered, start, end), "left_anti"))
    df = _in_hours(df, start, end)
    if start is not None:
        df = df.filter(F.col("event_time") >= F.lit(_utc(start)))
    if end is not None:
        df = df.filter(F.col("event_time") < F.lit(_utc(end)))
    return df


def archive_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The raw archive as a stream of standard events (no JSON parsing).

    Reading the output folder of the archive's file sink goes through that
    sink's metadata log, so only committed files are seen, each exactly once.
    Metric queries fed from here parse nothing and read only the columns they
    use.
    """
    from pulse.schema import PARTITION_COLUMNS, STANDARD_EVENT
    from pyspark.sql.types import IntegerType, StructField, StructType

    schema = StructType(list(STANDARD_EVENT.fields) + [StructField(c, IntegerType(), True) for c in PARTITION_COLUMNS])
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
