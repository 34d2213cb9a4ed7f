"""File-based sources: JSON-lines replay and shared helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulse.schema import KAFKA_RECORD


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan over at least ``min_partitions`` tasks (default: the
    cluster's default parallelism), like Kafka's ``minPartitions``.

    Only a source with *fewer* partitions than that is repartitioned, before
    any parsing, so the parse runs on every core. Rows are hashed on all their
    columns: deterministic under task retries without the per-row sort a
    round-robin repartition needs. A large input already has thousands of
    splits and is returned unchanged -- no shuffle at scale. Asking for the
    partition count plans the scan but runs no job.
    """
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except (NotImplementedError, AttributeError):   # no RDD view (Spark Connect)
        return df
    if have >= want:
        return df
    return df.repartition(want, *df.columns)


def jsonl_source(spark: SparkSession, path: str, streaming: bool = False,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Read back JSON-lines archives as ``value`` records (one line = one event).

    Batch or streaming; the output has the Kafka record columns so every
    parse operator runs unchanged (``topic``/``partition``/``offset`` are null,
    ``timestamp`` is null -- event time comes from the payload).
    """
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.format("text").load(path)
    cols = []
    for f in KAFKA_RECORD.fields:
        if f.name == "value":
            cols.append(F.col("value").cast("binary").alias("value"))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return lines.filter(F.length(F.trim("value")) > 0).select(*cols)
