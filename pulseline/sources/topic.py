"""The heartbeat topic: batch scan, stream (SRC-3) and binary decode (SRC-2).

Offline the topic is a folder of parquet files with the Kafka record columns
``key, value, partition, offset, timestamp``. With the Kafka connector on the
classpath the same functions read the broker instead (``kafka_options``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseline.functions.codec import decode_binary
from pulseline.functions.scalars import millis_to_ts
from pulseline.schemas import TOPIC


def read_topic(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TOPIC).parquet(path)


# Fixed value — the reference's poll size (records per poll and consumer).
REFERENCE_POLL_RECORDS = 1000


def heartbeat_stream(spark: SparkSession, path: str | None = None,
                     max_files_per_trigger: int | None = None,
                     kafka_options: dict | None = None,
                     max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Streaming topic records (SRC-3).

    ``kafka_options`` (``kafka.bootstrap.servers``, ``subscribe`` …) selects the
    broker: earliest offsets when no checkpoint exists; micro-batch size is
    bounded by ``max_offsets_per_trigger`` when given. The reference polls
    ``REFERENCE_POLL_RECORDS`` per consumer thread; on a cluster the bound is
    set from the data rate instead (one micro-batch spans all partitions).
    Otherwise the folder ``path`` is read as a file stream,
    ``maxFilesPerTrigger`` files per micro-batch.
    """
    if kafka_options:
        reader = (spark.readStream.format("kafka")
                  .option("startingOffsets", "earliest"))
        if max_offsets_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        for k, v in kafka_options.items():
            reader = reader.option(k, v)
        raw = reader.load()
        # broker time is an instant; keep it as UTC wall clock, zone-independent
        return raw.select(F.col("key").cast("string").alias("key"), "value",
                          "partition", "offset",
                          millis_to_ts(F.unix_millis("timestamp")).alias("timestamp"))
    reader = spark.readStream.schema(TOPIC).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def read_binary_heartbeats(spark: SparkSession, path: str) -> DataFrame:
    """Topic folder → decoded heartbeat columns plus ``decode_error`` (SRC-2)."""
    return decode_binary(read_topic(spark, path), "value")
