"""Plan-shaping helpers: where Catalyst must not move work, and where a
multi-pass query reads a materialised intermediate instead of recomputing it.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def fence(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Emit ``columns`` (default: all) through a one-row generator.

    Catalyst pushes a filter below every projection by substituting the
    projected expressions into it, which re-evaluates costly ones (a JSON
    parse, a serialisation) inside the filter, and past a round-robin
    repartition into the scan stage. A filter on a generated column cannot be
    pushed below the generator, so it stays where it is written. Costs one
    struct per row; no shuffle, no materialisation.
    """
    cols = list(columns or df.columns)
    keep = [c for c in df.columns if c not in cols]
    return df.select(*keep, F.inline(F.array(F.struct(*cols))))


_LOCAL_FOLDERS: dict[str, str] = {}     # private folder of a local session without one


def checkpoint_folder(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, as configured.

    Only a local session without one gets ``fallback`` or a private folder
    (tests); a cluster session must name a shared folder. The session config
    is read, never changed (Spark refuses runtime changes of core settings).
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not d:
        sc = spark.sparkContext
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        if sc.applicationId not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[sc.applicationId] = tempfile.mkdtemp(prefix="pulse-checkpoint-")
        d = _LOCAL_FOLDERS[sc.applicationId]
    return d.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` write under :func:`checkpoint_folder`."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = checkpoint_folder(spark)
    sc.setCheckpointDir(d)
    return d


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the reliable checkpoint folder and read it back.

    Used where a query makes several passes over the same intermediate (a
    cutoff subquery plus the main pass, pivot keys plus the pivot): the
    expensive upstream work runs once, later passes scan the written copy,
    and the lineage is cut, so a lost executor never forces a recompute from
    the raw input.
    """
    try:
        ensure_checkpoint_dir(df.sparkSession)
    except (NotImplementedError, AttributeError):   # Spark Connect: the server owns the folder
        pass
    return df.checkpoint(eager=True)


_RUNS: dict[str, tuple[SparkSession, str]] = {}


def _remove_runs(app: str) -> None:
    spark, folder = _RUNS.pop(app)
    try:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:       # the session is gone; the shared folder's owner cleans up
        pass


def run_folder(spark: SparkSession) -> str:
    """A new folder under :func:`checkpoint_folder` for one run's files; an application's
    are removed when its driver's Python exits."""
    app = spark.sparkContext.applicationId
    if app not in _RUNS:
        _RUNS[app] = (spark, f"{checkpoint_folder(spark)}/pulse-runs-{uuid.uuid4().hex}")
        atexit.register(_remove_runs, app)
    return f"{_RUNS[app][1]}/{uuid.uuid4().hex}"
