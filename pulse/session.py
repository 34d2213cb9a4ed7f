"""Local session for tests, the benchmark and examples.

On a cluster the platform builds the session; library code never does.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, scratch: str | None = None,
                  min_partitions: int | None = None, **conf) -> SparkSession:
    scratch = scratch or tempfile.mkdtemp(prefix="pulse-", dir=os.environ.get("PULSE_SCRATCH", "/tmp"))
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("pulse")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.local.dir", scratch)
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if min_partitions:      # one-split test tables are spread over the cores (plans.fixtures.read_table)
        b = b.config("spark.pulse.minPartitions", str(min_partitions))
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
