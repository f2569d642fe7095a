"""Table scans and the ``events`` → heartbeat adapter (SRC-4, SRC-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseline.functions.scalars import millis_to_ts, ts_to_millis
from pulseline.schemas import DEAD_LETTER, EVENTS_TABLE, SESSION_METRICS
from pulseline.sources.batch_table import read_batch_table


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver tables, ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def heartbeats_from_events(events: DataFrame, extra: dict | None = None) -> DataFrame:
    """Map the ``events`` table onto heartbeat rows.

    One event is one heartbeat of session ``session-<user_id>``; event time
    keeps millisecond precision (the wire precision). ``arrival_seq`` is the
    delivery order (the event id). Columns: the 12 heartbeat columns,
    ``timestamp_ms`` and ``arrival_seq``, plus ``extra`` (name → expression
    over ``events``). Narrow projection only: no shuffle, and only the
    referenced columns are scanned.
    """
    eid = F.col("event_id")
    ms = ts_to_millis("ts")
    return events.select(
        eid.cast("string").alias("event_id"),
        eid.alias("arrival_seq"),
        F.concat(F.lit("session-"), F.col("user_id").cast("string")).alias("session_id"),
        F.concat(F.lit("client-"), F.col("user_id").cast("string")).alias("client_id"),
        F.concat(F.lit("content-"), (eid % 5).cast("string")).alias("content_id"),
        ms.alias("timestamp_ms"),
        millis_to_ts(ms).alias("ts"),
        F.col("value").alias("video_start_time_ms"),
        (F.col("event_type") == "error").alias("playback_failed"),
        F.get_json_object("props", "$.k").cast("double").alias("rebuffer_duration_ms"),
        F.when(F.col("event_type") == "signup", F.lit(0.0))
         .otherwise(F.col("value") * 1000).alias("playback_duration_ms"),
        F.when(eid % 7 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("5."), (eid % 4).cast("string"))).alias("player_version"),
        F.concat(F.lit("os-"), (eid % 6).cast("string")).alias("os"),
        F.concat(F.lit("cdn-"), (eid % 3).cast("string")).alias("cdn"),
        *[expr.alias(name) for name, expr in (extra or {}).items()],
    )


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Scan of the stored raw event table (SRC-4) with its partition columns.

    The declared schema spares reading every footer; files written before a
    column was added give null for it (SNK-6). Merged batches are read from
    their segments.
    """
    return read_batch_table(spark, path, EVENTS_TABLE)


def read_session_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Scan of the stored per-batch session KPI table (SRC-5)."""
    return read_batch_table(spark, path, SESSION_METRICS)


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    """Scan of the stored dead letters, without expired ones (STR-8)."""
    return read_batch_table(spark, path, DEAD_LETTER)
