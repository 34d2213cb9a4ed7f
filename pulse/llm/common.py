"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.plans.barriers import checkpoint_folder

# --- fixed values: the word and white-space classes of the operators' contract ---
WORD = r"[^\x20\x09-\x0D]+"
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
# ----------------------------------------------------------------------------------

_FOLDERS: dict[str, tuple[SparkSession, str]] = {}


def _remove(app: str) -> None:
    spark, folder = _FOLDERS.pop(app)
    try:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:       # the session is gone; the shared folder's owner cleans up
        pass


def stash(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage at a copy that every executor can read, and gives the
    planner the true size of what follows. The application's stashes share one
    folder, removed when the driver's Python exits.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        _FOLDERS[app] = (spark, f"{checkpoint_folder(spark)}/llm-{uuid.uuid4().hex}")
        atexit.register(_remove, app)
    path = f"{_FOLDERS[app][1]}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stash = path
    return out


def discard(*stashed: DataFrame | None) -> None:
    """Delete stashes whose last reader has run: what was made of them is stashed itself or has been collected."""
    for df in stashed:
        path = getattr(df, "_stash", None)
        if path is not None:
            sc = df.sparkSession.sparkContext
            p = sc._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of the contract (0 for null): runs of anything but the six white-space characters.

    A word starts where a non-space character follows a space or the start, so
    the count is the number of distinct runs after all white space is made one
    kind: pieces of the split that are not empty, counted without building them.
    """
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: Column) -> Column:
    """Array of the contract's words ([] for null)."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def collapse_rows(df: DataFrame, cols: list[str], chunk: int = 10_000) -> DataFrame:
    """Equal rows as one row with ``copies`` (at most ``chunk``) and ``part``.

    Partial aggregation runs before the shuffle, so a row repeated a billion
    times costs each task one row; its count is then dealt into parts, each of
    which later stages place on its own.
    """
    counted = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    last = F.floor((F.col("_n") - 1) / chunk)
    parts = counted.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return parts.select(*cols, "part",
                        F.least(F.lit(chunk), F.col("_n") - F.col("part") * chunk).cast("long").alias("copies"))
