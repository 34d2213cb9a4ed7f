"""Kafka source (batch or streaming).

The Kafka connector jar is not bundled with PySpark; on a cluster it comes
with the platform (``spark.jars.packages``). The option maps are plain
functions so they can be checked without a broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulse.config import Config


def kafka_source_options(config: Config = Config(), streaming: bool = True) -> dict[str, str]:
    opts = {
        "kafka.bootstrap.servers": config.kafka_servers,
        "subscribe": ",".join(config.topics),
        "startingOffsets": config.starting_offsets,
        "failOnDataLoss": str(config.fail_on_data_loss).lower(),
    }
    if config.min_partitions:
        opts["minPartitions"] = str(config.min_partitions)
    if streaming and config.max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(config.max_offsets_per_trigger)
    if not streaming and config.starting_offsets == "latest":
        opts["startingOffsets"] = "earliest"   # batch reads cannot start at latest
    return opts


def kafka_source(spark: SparkSession, config: Config = Config(), streaming: bool = True) -> DataFrame:
    """Records of the subscribed topics (``key, value, topic, partition, offset, ...``)."""
    reader = spark.readStream if streaming else spark.read
    reader = reader.format("kafka")
    for k, v in kafka_source_options(config, streaming).items():
        reader = reader.option(k, v)
    return reader.load()
