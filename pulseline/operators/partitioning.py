"""Topic layout by session (ORD-1) and partition load (FN-6 applied)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseline.functions.murmur import murmur2, session_partition_id

# Fixed value — partition count of the heartbeat topic.
TOPIC_PARTITIONS = 24


def with_partition_id(df: DataFrame, key: str = "session_id",
                      num_partitions: int = TOPIC_PARTITIONS) -> DataFrame:
    return df.withColumn("partition_id", session_partition_id(key, num_partitions))


def order_by_session(df: DataFrame, key: str = "session_id",
                     num_partitions: int = TOPIC_PARTITIONS,
                     order=("ts", "arrival_seq"),
                     spark_partitions: int | None = None) -> DataFrame:
    """Events laid out by topic partition, session and publish order (ORD-1).

    ``partition_id`` is the exact topic partition (Murmur2 rule). The rows
    are range-partitioned on (partition_id, session, time…) and sorted
    within partitions, so reading Spark partitions in order yields each topic
    partition as a contiguous run, each session contiguous and in publish
    order. Range boundaries come from sampling, so a session holding a third
    of all rows is split over several tasks by time instead of landing in
    one, and the number of Spark partitions follows the data
    (``spark_partitions`` or the shuffle-partition setting), not the 24 topic
    partitions.
    """
    order_cols = [c for c in order if c in df.columns]
    cols = ["partition_id", key, *order_cols]
    tagged = with_partition_id(df, key, num_partitions)
    if spark_partitions:
        return tagged.repartitionByRange(spark_partitions, *cols).sortWithinPartitions(*cols)
    return tagged.orderBy(*cols)


def session_hashes(df: DataFrame, key: str = "session_id",
                   sizes=(12, TOPIC_PARTITIONS)) -> DataFrame:
    """Distinct keys with their Murmur2 hash and partition for each size (FN-5, FN-6).

    Keys are made distinct first (partial aggregation), so the hash runs once
    per session, not once per event.
    """
    keys = df.select(key).distinct()
    return keys.select(key, murmur2(key).alias("murmur2_hash"),
                       *[session_partition_id(key, n).alias(f"partition_{n}") for n in sizes])


def partition_load(df: DataFrame, key: str = "session_id",
                   num_partitions: int = TOPIC_PARTITIONS) -> DataFrame:
    """Events and sessions per topic partition.

    Events are counted per session first (partial aggregation), the hash is
    computed per session, then sessions are rolled up per partition — a
    session with a third of all rows costs one counter, not one task.
    """
    per_session = df.groupBy(key).agg(F.count(F.lit(1)).alias("events"))
    tagged = per_session.withColumn("partition_id", session_partition_id(key, num_partitions))
    return tagged.groupBy("partition_id").agg(
        F.count(F.lit(1)).alias("sessions"), F.sum("events").alias("events"))
