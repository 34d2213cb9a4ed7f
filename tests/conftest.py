import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pulse.session import local_session

    scratch = tmp_path_factory.mktemp("spark")
    s = local_session(cpus=4, shuffle_partitions=4, scratch=str(scratch))
    yield s
    s.stop()


def events_df(spark, rows):
    """Standard events from (iso time, type, bot, domain, stream, changed) tuples."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(
        rows, "t string, event_type string, bot boolean, domain string, stream string, rev_content_changed boolean")
    return df.select(F.col("t").cast("timestamp").alias("event_time"), "domain", "stream", "event_type",
                     F.coalesce("bot", F.lit(False)).alias("bot"),
                     F.coalesce("rev_content_changed", F.lit(False)).alias("rev_content_changed"))
