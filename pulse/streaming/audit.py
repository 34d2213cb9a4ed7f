"""State audit: what a running metric query holds for its open windows, against its update log.

The log's newest revisions and the query's state are two records of the same
counts: every changed row of the state is written to the log by the same
micro-batch. After a committed micro-batch they must agree on every open
window. The state is read with Spark's ``statestore`` source, straight from the
checkpoint, by one task per state partition; nothing stops the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulse.operators.metrics import WINDOW_KEYS
from pulse.streaming.jobs import METRIC_SCHEMAS, METRICS, RunLayout, current_metric


def state_rows(spark: SparkSession, layout: RunLayout, name: str) -> DataFrame:
    """The state of a metric's open windows as rows: its keys and its counts (a ratio is not in the state)."""
    state = spark.read.format("statestore").load(layout.checkpoint(name))
    keys = METRICS[name].keys
    counts = [f.name for f in StructType.fromDDL(METRIC_SCHEMAS[name]) if f.name not in keys and f.dataType.typeName() == "long"]
    window, *dims = [f"key.`{f.name}`" for f in state.schema["key"].dataType]       # in the order of the query's grouping
    out = [F.col(f"{window}.start").alias(keys[0]), F.col(f"{window}.end").alias(keys[1])]
    out += [F.col(c).alias(k) for c, k in zip(dims, keys[2:], strict=True)]
    values = F.col("value").cast(f"struct<{', '.join(f'{c}: bigint' for c in counts)}>")     # by place: two buffers may have one name
    out += [values[c].alias(c) for c in counts]
    return state.select(*out)


def open_windows(spark: SparkSession, layout: RunLayout, name: str) -> DataFrame:
    """Each row of an open window from both records: the keys, ``state_<count>`` and ``log_<count>`` (null where one lacks it).

    Windows older than the oldest one in the state have left it and are not compared.
    """
    state = state_rows(spark, layout, name)
    keys = METRICS[name].keys
    counts = [c for c in state.columns if c not in keys]
    oldest = state.agg(F.min(WINDOW_KEYS[0])).scalar()
    log = current_metric(spark, layout, name).where(F.col(WINDOW_KEYS[0]) >= oldest)
    a = state.select(*(F.col(k).alias(f"a_{k}") for k in keys), *(F.col(c).alias(f"state_{c}") for c in counts), F.lit(True).alias("_a"))
    b = log.select(*(F.col(k).alias(f"b_{k}") for k in keys), *(F.col(c).alias(f"log_{c}") for c in counts))
    on = [F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}")) for k in keys]
    both = a.join(b, on, "full_outer")
    return both.select(*(F.when(F.col("_a"), F.col(f"a_{k}")).otherwise(F.col(f"b_{k}")).alias(k) for k in keys),
                       *(F.col(f"{side}_{c}") for c in counts for side in ("state", "log")))


def differences(spark: SparkSession, layout: RunLayout, name: str) -> DataFrame:
    """The rows of :func:`open_windows` on which the two records disagree (none after a sound run)."""
    both = open_windows(spark, layout, name)
    counts = [c[len("state_"):] for c in both.columns if c.startswith("state_")]
    same = F.lit(True)
    for c in counts:
        same = same & F.col(f"state_{c}").eqNullSafe(F.col(f"log_{c}"))
    return both.where(~same)
