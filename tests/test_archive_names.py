"""Compacted archives: file lists as a predicate or as a join, late files, and lists of the range's hours only."""

import pytest
from pyspark.sql import functions as F

from pulse.plans.fixtures import standard_events
from pulse.sources import archive as A
from pulse.streaming.sinks import write_raw

SF = "/root/testdata/sf0.001"
RANGES = [(None, None), ("2024-01-01T01:00:00Z", "2024-01-01T03:30:00Z"), (None, "2024-01-01T02:00:00Z"), ("2024-01-01T03:00:00Z", None)]


def rows(df):
    return sorted(map(str, df.select("event_time", "event_type", "domain").collect()))


@pytest.mark.parametrize("names", [0, 1, 10_000])
def test_reads_are_the_same_by_name_and_by_join(spark, tmp_path, monkeypatch, names):
    monkeypatch.setattr(A, "MAX_NAMES", names)
    live, comp = str(tmp_path / "raw"), str(tmp_path / "compacted")
    events = standard_events(spark, SF)
    early = F.xxhash64("event_time", "domain") % 3 == 0
    write_raw(events.where(early), live)
    A.compact_archive(spark, live, comp, "2024-01-01T00:00:00Z")        # no closed hour yet
    assert rows(A.read_raw(spark, live, compacted=comp)) == rows(events.where(early))
    A.compact_archive(spark, live, comp, "2024-01-01T02:00:00Z")
    write_raw(events.where(~early | early.isNull()), live)              # late files of closed hours among them
    for _ in range(2):
        for start, end in RANGES:
            want = rows(A.read_raw(spark, live, start, end))
            assert want and rows(A.read_raw(spark, live, start, end, comp)) == want
        A.compact_archive(spark, live, comp, "2024-01-01T04:00:00Z")
    files = spark.read.parquet(f"{comp}/files")
    assert files.count() == files.select("path").distinct().count()
    assert files.where(A._hour_col() >= 2024010104).isEmpty()


def test_only_the_lists_of_the_range_reach_the_predicate(spark, tmp_path):
    live, comp = str(tmp_path / "raw"), str(tmp_path / "compacted")
    write_raw(standard_events(spark, SF), live)
    A.compact_archive(spark, live, comp, "2024-01-01T06:00:00Z")
    plan = A.read_raw(spark, live, "2024-01-01T01:00:00Z", "2024-01-01T02:00:00Z", comp)._jdf.queryExecution().optimizedPlan().toString()
    assert "hour=1/" in plan and "hour=2/" not in plan and "hour=3/" not in plan
