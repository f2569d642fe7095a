"""Backlog replay after an outage and dead-letter retention/replay (ORD-2, STR-8, STR-9).

A backlog is a folder of topic records written in drain-sized files (the
reference drains 500 events per call); ``replay`` streams it with
``availableNow`` through the same ``process_batch`` as the live topic, into
the same tables, under a source and checkpoint of its own, so duplicates are
absorbed by the store-once rule on both sides, any number of backlogs can be
replayed, and a replay can be re-run. Recovered dead letters take the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseline.functions.codec import decode_binary
from pulseline.operators.backlog import REPLAY_SLICE
from pulseline.sources.topic import heartbeat_stream
from pulseline.schemas import TOPIC
from pulseline.session import count_files
from pulseline.streaming.processor import Layout, process_batch, run_stream

# Fixed value — dead-letter retention (days).
DEAD_LETTER_RETENTION_DAYS = 7

# Slices of one replay micro-batch, at most (two million records).
MOST_SLICES = 4_096


def write_backlog(records: DataFrame, path: str, slice_size: int = REPLAY_SLICE) -> None:
    """Append topic records to a backlog folder in files of at most ``slice_size`` records."""
    records.write.mode("append").option("maxRecordsPerFile", slice_size).parquet(path)


def replay(spark: SparkSession, backlog_path: str, layout: Layout,
           backlog_id: str, slices_per_trigger: int = 4, checkpoint: str | None = None,
           batches: int | None = None):
    """Replay a backlog folder into the tables of ``layout``; returns the finished query.

    ``backlog_id`` names this backlog: each has its own checkpoint and its own
    partitions (source ``replay-<id>``), so backlogs never overwrite each
    other and running one again only adds what it has not drained yet.
    Replayed counts per micro-batch are in the query's ``observedMetrics``.

    A micro-batch takes ``slices_per_trigger`` slices. What it costs besides
    its records is the same for few and for many, so with ``batches`` a
    backlog that would need more micro-batches than that takes more slices at
    a time (``MOST_SLICES`` at most): the slices stay as they were drained.
    """
    if batches:
        slices_per_trigger = max(slices_per_trigger, min(MOST_SLICES, -(-count_files(spark, backlog_path) // batches)))
    q = run_stream(heartbeat_stream(spark, backlog_path, max_files_per_trigger=slices_per_trigger),
                   layout, checkpoint=checkpoint or f"{layout.root}/_replay_checkpoint/{backlog_id}",
                   source_id=f"replay-{backlog_id}")
    q.awaitTermination()
    return q


def retained_dead_letters(dead: DataFrame,
                          retention_days: int = DEAD_LETTER_RETENTION_DAYS,
                          now=None) -> DataFrame:
    """Dead letters younger than the retention period.

    ``now`` defaults to the newest ``ingest_ts`` in the table (a scalar
    subquery), which makes the result reproducible for a given table.
    """
    if now is None:
        ref = dead.agg(F.max("ingest_ts")).scalar()  # scalar subquery
    else:  # a datetime or text, read as UTC wall clock without zone conversion
        text = now.isoformat(sep=" ") if hasattr(now, "isoformat") else str(now)
        ref = F.lit(text).cast("timestamp_ntz")
    return dead.filter(F.col("ingest_ts") >= ref - F.expr(f"INTERVAL {retention_days} DAYS"))


def replay_dead_letters(dead: DataFrame,
                        retention_days: int = DEAD_LETTER_RETENTION_DAYS,
                        now=None) -> tuple[DataFrame, DataFrame]:
    """Re-decode retained dead letters (STR-8).

    Returns ``(recovered, report)``: rows that decode now (topic-record shape
    plus decoded columns, ready for ``append_new_events``) and a per-reason
    report ``reason, retained, recovered, still_failing``.
    """
    retained = retained_dead_letters(dead, retention_days, now)
    again = decode_binary(retained.select("reason", F.col("payload").alias("value"),
                                          F.col("ingest_ts").alias("timestamp")), "value")
    report = again.groupBy("reason").agg(
        F.count(F.lit(1)).alias("retained"),
        F.count_if(F.col("decode_error").isNull()).alias("recovered"),
        F.count_if(F.col("decode_error").isNotNull()).alias("still_failing"))
    return again.filter(F.col("decode_error").isNull()), report


def recover_dead_letters(dead: DataFrame, layout: Layout, run_id: str,
                         retention_days: int = DEAD_LETTER_RETENTION_DAYS, now=None,
                         kpi_on: str = "decoded") -> DataFrame:
    """Store the retained dead letters that decode now in the tables of ``layout`` (STR-8).

    They are one batch of source ``dead-letters-<run_id>``: a run that is
    repeated replaces its own output, ids already stored are skipped. Returns
    the report of ``replay_dead_letters``; letters that still fail stay where
    they are.
    """
    recovered, report = replay_dead_letters(dead, retention_days, now)
    absent = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in TOPIC.fields}
    records = recovered.select("*", *[c for name, c in absent.items() if name not in recovered.columns])
    process_batch(records, 0, layout, kpi_on, source_id=f"dead-letters-{run_id}")
    return report
