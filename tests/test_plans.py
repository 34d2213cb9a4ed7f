"""Physical-plan properties the design relies on."""

from pyspark.sql import functions as F

from pulse.operators import metrics as M
from pulse.operators import ranking as R
from pulse.plans.barriers import fence, materialize
from pulse.plans.fixtures import standard_events
from pulse.sources.archive import read_raw
from pulse.sources.files import ensure_parallelism
from pulse.streaming.sinks import write_raw

SF = "/root/testdata/sf0.001"


def _physical(df):
    df.collect()                                   # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_metrics_aggregate_partially_before_the_shuffle(spark):
    plan = _physical(M.events_by_type(standard_events(spark, SF)))
    assert "partial_count" in plan
    assert plan.index("partial_count") > plan.index("Exchange")   # partial sits below the exchange


def test_top_k_is_take_ordered(spark):
    plan = _physical(R.top_domains(M.domain_counts(standard_events(spark, SF))))
    assert "TakeOrderedAndProject" in plan
    assert "Subquery" in plan and "BroadcastNestedLoopJoin" not in plan


def test_last_n_per_series_uses_group_limit(spark):
    pts = spark.range(1000).select((F.col("id") % 7).alias("type"), F.col("id").alias("t"))
    plan = _physical(R.last_n_per_series(pts, "type", 5))
    assert "WindowGroupLimit" in plan


def test_no_cartesian_or_nested_loop_joins_in_registered_queries(spark):
    from pulse.plans.catalog import QUERIES

    for name, q in QUERIES.items():
        plan = _physical(q(spark, SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_archive_reads_prune_partitions_and_columns(spark, tmp_path):
    path = str(tmp_path / "raw")
    write_raw(standard_events(spark, SF), path)
    df = read_raw(spark, path, "2024-01-01T00:30:00Z", "2024-01-01T01:00:00Z").select("event_time", "event_type")
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line or "Scan parquet" in line][0]
    assert "PartitionFilters: [" in scan and "PushedFilters: [" in scan and "event_time" in scan
    assert "ReadSchema: struct<event_time:timestamp,event_type:string>" in scan


def test_parallelism_only_added_to_small_sources(spark, tmp_path):
    one = spark.read.parquet(f"{SF}/events.parquet")
    assert ensure_parallelism(one, 4).rdd.getNumPartitions() == 4
    many = spark.range(0, 100, 1, 6)
    assert ensure_parallelism(many, 4) is many


def test_fence_keeps_filters_above(spark):
    df = spark.range(10).select(F.to_json(F.struct("id")).alias("j"))
    plan = fence(df).filter(F.col("j").contains("1"))._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    assert lines[0].startswith("Filter") and "Generate" in lines[1]


def test_materialize_uses_reliable_checkpoint(spark):
    df = materialize(spark.range(5))
    assert df.count() == 5
    assert spark.sparkContext.getCheckpointDir()


def test_top_n_with_others_limits_rows_before_the_shuffle(spark):
    pts = spark.range(5000).select(
        F.timestamp_seconds((F.col("id") % 3) * 10).alias("window_start"),
        F.timestamp_seconds((F.col("id") % 3) * 10 + 10).alias("window_end"),
        (F.col("id") % 977).cast("string").alias("event_type"), F.lit(1).cast("long").alias("cnt"))
    plan = _physical(R.top_n_with_others(pts))
    assert "WindowGroupLimit" in plan


def test_layout_uses_the_sessions_checkpoint_folder(spark):
    from pulse.config import checkpoint_root
    from pulse.streaming.jobs import default_layout

    root = checkpoint_root(spark, fallback="/should/not/be/used")
    assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")   # as configured, no per-app suffix
    assert "/should/not/be/used" not in root                      # a configured folder wins
    layout = default_layout(spark, run="r1")
    assert layout.checkpoint("bot_ratio").startswith(root) and layout.checkpoint("bot_ratio").endswith(
        "/r1/checkpoints/bot_ratio")
