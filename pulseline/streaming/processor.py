"""Micro-batch processing of the heartbeat topic (STR-1…STR-5, STR-7).

``run_stream`` drives ``process_batch`` through ``foreachBatch``. Each
micro-batch (one poll batch of the reference) is decoded once and persisted,
then split into dead letters and good rows; good rows are deduplicated
(first arrival per ``event_id``), compared with what is stored, and appended;
KPI rows per session are written next to them. All outputs are keyed by source
and ``batch_id``, so a retried batch overwrites itself, and the comparison
covers every stored row except that batch's own earlier output, so a retry
never hides its own rows and no source misses what another one stored. Sources
that may hold the same ids write one after the other (two running at once
could each store an id before seeing the other's).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from pulseline.functions.codec import decode_binary, split_decoded
from pulseline.functions.validation import violations
from pulseline.operators.dedup import append_new_events, dedup_events
from pulseline.operators.kpi import session_kpi_parts
from pulseline.operators.quarantine import storage_split
from pulseline.schemas import HEARTBEAT_COLUMNS, REASON_INVALID, REASON_UNDECODABLE
from pulseline.sources.events import read_events
from pulseline.streaming.id_index import IdIndex, seen_before
from pulseline.streaming.sinks import (
    LIVE, write_dead_letters, write_new_events, write_session_metrics,
)


@dataclass(frozen=True)
class Layout:
    """Output folders of one processing job (all on the shared file system)."""
    root: str

    @property
    def events(self) -> str:
        return f"{self.root}/heartbeat_events"

    @property
    def metrics(self) -> str:
        return f"{self.root}/session_metrics"

    @property
    def dead_letters(self) -> str:
        return f"{self.root}/dead_letters"

    @property
    def ids(self) -> str:
        return f"{self.root}/_event_ids"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/_checkpoint"


def read_table_if_exists(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The parquet table at ``path``, or None before its first write.

    A declared ``schema`` spares the footer-reading schema inference.
    """
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException:  # PATH_NOT_FOUND / UNABLE_TO_INFER_SCHEMA
        return None


def stored_elsewhere(spark: SparkSession, path: str, batch_id: int,
                     source_id: str = LIVE) -> DataFrame | None:
    """All stored rows but those of this batch itself (a partition filter)."""
    try:
        stored = read_events(spark, path)
    except AnalysisException:  # before the first write
        return None
    return stored.filter((F.col("source_id") != F.lit(source_id)) | (F.col("batch_id") != F.lit(batch_id)))


def process_batch(batch: DataFrame, batch_id: int, layout: Layout,
                  kpi_on: str = "decoded", lookup_horizon: str | None = None,
                  source_id: str = LIVE, validate_binary: bool = False) -> None:
    """Process one micro-batch of topic records (``key, value, partition, offset, timestamp``).

    The batch may arrive already decoded (``decode_error`` present, as
    ``run_stream`` does it) or raw. ``kpi_on="decoded"`` (default, parity)
    computes KPIs over every decoded event of the batch, duplicates
    included; ``"accepted"`` only over the rows newly stored. A row
    quarantined for the raw table's bounds still counts under ``"decoded"``
    (the reference would instead fail the whole batch and compute no KPIs),
    not under ``"accepted"``.

    ``validate_binary`` applies the request constraints (ids not blank, time
    positive) to decoded messages too: rows that break one become dead letters
    with every violation. Off by default (parity: the binary path stores them).

    Every stored id is checked, as a unique constraint would, through the id
    index (``IdIndex``), whose reads do not grow with what is stored.
    ``lookup_horizon`` (e.g. ``"2 days"``) does without the index: when the
    caller knows an event id never recurs further apart in event time, only
    stored rows within the batch's event-time range ± horizon are read; the
    ``ts`` range filter reaches the parquet scan and skips row groups by their
    statistics (each batch's files are time-clustered).
    """
    decoded = batch if "decode_error" in batch.columns else decode_binary(batch, "value")
    decoded = decoded.persist(StorageLevel.MEMORY_AND_DISK)
    index = None
    try:
        if decoded.count() == 0:  # empty poll: nothing is written (FLT-9)
            return
        spark = batch.sparkSession
        good, failed = split_decoded(decoded)
        good = good.withColumn("__v", violations("timestamp_ms") if validate_binary
                               else F.array().cast("array<string>"))
        invalid = good.filter(F.size("__v") > 0)
        good = good.filter(F.size("__v") == 0)
        hb = good.select("value", F.col("offset").alias("arrival_seq"), *HEARTBEAT_COLUMNS)
        storable, over_long = storage_split(hb)
        dead = failed.select(
            F.col("value").alias("payload"), F.lit(REASON_UNDECODABLE).alias("reason"),
            F.col("decode_error").alias("detail"), F.col("timestamp").alias("ingest_ts"))
        dead = dead.unionByName(invalid.select(
            F.col("value").alias("payload"), F.lit(REASON_INVALID).alias("reason"),
            F.array_join("__v", "; ").alias("detail"), F.col("timestamp").alias("ingest_ts")))
        dead = dead.unionByName(over_long.select(
            F.col("value").alias("payload"), "reason", "detail", F.col("ts").alias("ingest_ts")))

        storable = storable.drop("value")
        if lookup_horizon:
            stored = stored_elsewhere(spark, layout.events, batch_id, source_id)
            lo, hi = storable.agg(F.min("ts"), F.max("ts")).first() if stored is not None else (None, None)
            if lo is not None:
                h = F.expr(f"INTERVAL {lookup_horizon}")
                # literals as TIMESTAMP_NTZ text: no zone conversion on the way back
                lo_c = F.lit(lo.isoformat(sep=" ")).cast("timestamp_ntz")
                hi_c = F.lit(hi.isoformat(sep=" ")).cast("timestamp_ntz")
                stored = stored.filter((F.col("ts") >= lo_c - h) & (F.col("ts") <= hi_c + h))
            new = append_new_events(storable, stored)
        else:
            index = IdIndex(spark, layout.events, layout.ids)
            new = dedup_events(storable).join(seen_before(index, storable, (source_id, batch_id)), "event_id", "left_anti")
        kpi_input = hb if kpi_on == "decoded" else new

        # The three sinks depend only on the persisted batch and on what was
        # stored before, never on each other: submit them as concurrent jobs.
        writes = [(write_dead_letters, dead, layout.dead_letters),
                  (write_new_events, new, layout.events),
                  (write_session_metrics, session_kpi_parts(kpi_input), layout.metrics)]
        with ThreadPoolExecutor(max_workers=len(writes)) as pool:
            futures = [pool.submit(fn, df, path, batch_id, source_id) for fn, df, path in writes]
            for f in futures:
                f.result()  # re-raise the first failure; the batch is then retried
    finally:
        decoded.unpersist()
        if index is not None:
            index.release()


def observe_ingest(decoded: DataFrame, name: str = "ingest") -> DataFrame:
    """Per-batch consumed / ok / dead-lettered counts as observed metrics (AGG-10).

    They appear in ``StreamingQueryProgress.observedMetrics[name]`` of every
    micro-batch, next to the input rate and durations.
    """
    err = F.col("decode_error")
    return decoded.observe(name, F.count(F.lit(1)).alias("consumed"),
                           F.count_if(err.isNull()).alias("ok"),
                           F.count_if(err.isNotNull()).alias("dead_lettered"))


def run_stream(stream: DataFrame, layout: Layout, available_now: bool = True,
               processing_time: str | None = None, kpi_on: str = "decoded",
               query_name: str | None = None, checkpoint: str | None = None,
               source_id: str = LIVE, lookup_horizon: str | None = None,
               validate_binary: bool = False):
    """Start the processing query; returns the ``StreamingQuery``.

    ``available_now`` drains what is there in bounded micro-batches and
    stops (batch-style runs, replays); otherwise ``processing_time`` (e.g.
    ``"5 seconds"``, the reference's flush interval) runs continuously.
    Offsets are committed to the checkpoint only after ``process_batch``
    returns (at-least-once delivery, idempotent sinks). A second source
    writing into the same tables (e.g. a backlog replay) uses its own
    ``checkpoint`` and ``source_id``.
    """
    # only what process_batch uses is carried through the decoder and kept
    decoded = observe_ingest(decode_binary(stream.select("value", "offset", "timestamp"), "value"))
    writer = (decoded.writeStream
              .foreachBatch(lambda df, bid: process_batch(df, bid, layout, kpi_on, lookup_horizon, source_id,
                                                          validate_binary))
              .option("checkpointLocation", checkpoint or layout.checkpoint))
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
