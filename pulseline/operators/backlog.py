"""Outage backlog: FIFO slices and what waits where (ORD-2, ORD-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseline.functions.murmur import session_partition_id
from pulseline.operators.partitioning import TOPIC_PARTITIONS

# Fixed value — replay slice size.
REPLAY_SLICE = 500


def backlog_slice(backlog: DataFrame, n: int = REPLAY_SLICE, offset: int = 0,
                  arrival: str = "arrival_seq") -> DataFrame:
    """The next ``n`` buffered events in arrival order, skipping ``offset`` (ORD-2).

    A bounded top-k (each task keeps its best ``offset + n`` rows, the
    driver merges them); the limit is the feature here: one drain call.
    """
    ordered = backlog.orderBy(F.col(arrival).asc())
    if offset:
        return ordered.offset(offset).limit(n)
    return ordered.limit(n)


def backlog_report(backlog: DataFrame, num_partitions: int = TOPIC_PARTITIONS,
                   arrival: str = "arrival_seq", ts: str = "ts") -> DataFrame:
    """What waits for each topic partition and session (ORD-3).

    ``partition_id, session_id, buffered, first_seq, last_seq, oldest``: the
    events buffered, the first and last arrival, and the oldest event time.
    One aggregate with a partial step; sessions are hashed once, after it.
    Nothing is dropped, so there is no capacity to report against.
    """
    per = backlog.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("buffered"), F.min(arrival).alias("first_seq"),
        F.max(arrival).alias("last_seq"), F.min(ts).alias("oldest"))
    return per.select(session_partition_id("session_id", num_partitions).alias("partition_id"),
                      "session_id", "buffered", "first_seq", "last_seq", "oldest")
