"""Sinks: topic (SNK-1), raw events (SNK-2), session KPIs (SNK-3), dead letters (SNK-4).

Table sinks write one ``source_id=<s>/batch_id=<n>`` partition per micro-batch
with dynamic partition overwrite, so re-running a batch (a retry after a lost
executor or a restart from the checkpoint) replaces its own output instead of
adding to it (STR-3). The source (the live topic, one backlog, one dead-letter
run) keeps the batch numbers of different checkpoints apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseline.functions.murmur import session_partition_id
from pulseline.operators.partitioning import TOPIC_PARTITIONS
from pulseline.schemas import HEARTBEAT_COLUMNS, SESSION_METRICS


# The source of the live topic.
LIVE = "live"


def write_batch_partition(df: DataFrame, path: str, batch_id: int, source_id: str = LIVE) -> None:
    (df.withColumns({"source_id": F.lit(source_id), "batch_id": F.lit(batch_id).cast("bigint")})
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("source_id", "batch_id").parquet(path))


def write_new_events(new_events: DataFrame, path: str, batch_id: int,
                     source_id: str = LIVE) -> None:
    """Append rows the raw table did not hold (the storage projection, PRJ-1)."""
    write_batch_partition(new_events.select(*HEARTBEAT_COLUMNS), path, batch_id, source_id)


def write_session_metrics(parts: DataFrame, path: str, batch_id: int,
                          source_id: str = LIVE) -> None:
    """One KPI row per session of the batch, ratios and additive parts (SNK-3)."""
    cols = [f.name for f in SESSION_METRICS.fields if f.name not in ("source_id", "batch_id")]
    write_batch_partition(parts.select(*cols), path, batch_id, source_id)


def write_dead_letters(dead: DataFrame, path: str, batch_id: int,
                       source_id: str = LIVE) -> None:
    """Raw payload, reason and detail of every rejected record (SNK-4)."""
    write_batch_partition(dead.select("payload", "reason", "detail", "ingest_ts"), path, batch_id,
                          source_id)


def topic_frame(hb_encoded: DataFrame, num_partitions: int = TOPIC_PARTITIONS,
                record_time: str = "ts") -> DataFrame:
    """Key by session, value = encoded message, partition = Murmur2 rule (SNK-1).

    ``record_time`` names the column that becomes the record timestamp (the
    event time by default; the publish job passes the ingest time).
    """
    cols = [F.col("session_id").alias("key"), F.col("value"),
            session_partition_id("session_id", num_partitions).alias("partition")]
    if "arrival_seq" in hb_encoded.columns:
        cols.append(F.col("arrival_seq").alias("offset"))
    if record_time in hb_encoded.columns:
        cols.append(F.col(record_time).alias("timestamp"))
    return hb_encoded.select(*cols)


def write_topic(hb_encoded: DataFrame, path: str | None = None, topic: str | None = None,
                kafka_options: dict | None = None,
                num_partitions: int = TOPIC_PARTITIONS, record_time: str = "ts") -> None:
    """Publish encoded heartbeats keyed by session.

    With ``kafka_options`` the rows go to the broker (``partition`` column
    honoured by the Kafka sink); otherwise they are appended as parquet
    files under ``path`` (the offline topic).
    """
    frame = topic_frame(hb_encoded, num_partitions, record_time)
    if kafka_options:
        w = frame.select("key", "value", "partition").write.format("kafka")
        if topic:
            w = w.option("topic", topic)
        for k, v in kafka_options.items():
            w = w.option(k, v)
        w.save()
        return
    frame.write.mode("append").parquet(path)
