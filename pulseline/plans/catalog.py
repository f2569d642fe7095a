"""Registered queries: name → ``fn(spark, sf_dir) -> DataFrame``.

Each query reads the driver tables of ``sf_dir`` (whole tables; derived
inputs come from ``fixtures``). The DataFrame it returns is lazy; building it
may write derived tables and run streaming jobs first. Doubles are rounded at the end (``fixtures.ROUND``) so the result compares exactly with
the SQL oracle, whose summation order differs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseline.functions.codec import decode_binary, split_decoded
from pulseline.operators import backlog as bl
from pulseline.operators import dedup, kpi, partitioning, quarantine, reports, series
from pulseline.plans import fixtures as fx
from pulseline.plans.streams import STREAM_QUERIES
from pulseline.schemas import HEARTBEAT_COLUMNS
from pulseline.session import scratch_path
from pulseline.sources.json_source import decode_json, read_json_heartbeats

ROUND = fx.ROUND
KPI_ROUNDING = {"avg_vst_ms": ROUND["ms"], "pfr": ROUND["rate"],
                "rebuffering_ratio": ROUND["ratio"]}


def _round(df: DataFrame, spec: dict) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), d) for c, d in spec.items() if c in df.columns})


def _hb(spark, sf_dir, with_key=False):
    return fx.heartbeats(spark, sf_dir, with_key)


# ---------------------------------------------------------------- KPIs
def q_session_kpis(spark, sf_dir):
    return _round(kpi.session_kpis(_hb(spark, sf_dir)), KPI_ROUNDING)


def q_global_kpis(spark, sf_dir):
    return _round(kpi.global_kpis(_hb(spark, sf_dir)), KPI_ROUNDING)


def q_headline_kpis(spark, sf_dir):
    return _round(kpi.headline_kpis(_hb(spark, sf_dir)), KPI_ROUNDING)


def q_kpi_timeseries(spark, sf_dir):
    return _round(kpi.kpi_timeseries(_hb(spark, sf_dir), "1 hour"), KPI_ROUNDING)


# ---------------------------------------------------------------- duplicates
_DEDUP_COLS = ["arrival_seq", "timestamp_ms", *HEARTBEAT_COLUMNS]


def q_dedup_events(spark, sf_dir):
    hb = _hb(spark, sf_dir).select(*_DEDUP_COLS)
    return dedup.merge_replay(hb, fx.redelivered(hb))


def q_append_new_events(spark, sf_dir):
    batch = fx.new_events(spark, sf_dir).select(*_DEDUP_COLS)
    batch = batch.unionByName(fx.redelivered(batch))
    return dedup.append_new_events(batch, fx.stored_events(spark, sf_dir))


def q_save_one_event(spark, sf_dir):
    """The stored events after the newest event was saved on its own, twice (SNK-5)."""
    stored = fx.stored_events(spark, sf_dir).select(*HEARTBEAT_COLUMNS, "arrival_seq")
    hb = _hb(spark, sf_dir).select(*HEARTBEAT_COLUMNS, "arrival_seq")
    event = hb.filter(F.col("arrival_seq") == hb.agg(F.max("arrival_seq")).scalar())
    once = dedup.save_event(event, stored)
    return dedup.save_event(event, once).select(*HEARTBEAT_COLUMNS)


def q_exists_by_event_id(spark, sf_dir):
    probe = _hb(spark, sf_dir).select("event_id", "arrival_seq")
    return dedup.exists_by_event_id(probe, fx.stored_events(spark, sf_dir))


def _json_decoded(spark, sf_dir):
    return decode_json(fx.request_table(spark, sf_dir), spread=True)


def q_events_by_id(spark, sf_dir):
    """Stored rows of every event whose JSON request was rejected on ingest."""
    _, rejected = quarantine.split_valid(_json_decoded(spark, sf_dir))
    ids = rejected.select(F.col("request_id").cast("string").alias("event_id"))
    return dedup.events_by_id(_hb(spark, sf_dir).select(*HEARTBEAT_COLUMNS), ids)


# ---------------------------------------------------------------- validation
def q_validate_accept(spark, sf_dir):
    accepted, _ = quarantine.split_valid(_json_decoded(spark, sf_dir))
    return accepted.select("request_id", "timestamp_ms", *HEARTBEAT_COLUMNS)


def q_json_files(spark, sf_dir):
    """Accepted requests of the log as JSON text files, one document per line (SRC-1)."""
    path = scratch_path(spark, "json-files")
    fx.request_table(spark, sf_dir).select("body").write.text(path)
    accepted, _ = quarantine.split_valid(decode_json(read_json_heartbeats(spark, path)))
    return accepted.select("timestamp_ms", *HEARTBEAT_COLUMNS)


def q_validate_reject(spark, sf_dir):
    _, rejected = quarantine.split_valid(_json_decoded(spark, sf_dir))
    return rejected.select("request_id", "event_id", "reason", "violations")


# ---------------------------------------------------------------- binary path
def _topic_decoded(spark, sf_dir):
    return decode_binary(fx.topic_table(spark, sf_dir), spread=True)


def q_decode_roundtrip(spark, sf_dir):
    good, _ = split_decoded(_topic_decoded(spark, sf_dir))
    return good.select("offset", "timestamp_ms", *HEARTBEAT_COLUMNS)


def q_dead_letters_by_reason(spark, sf_dir):
    # the payload alone goes through the decoder: no other column is asked for
    _, failed = split_decoded(decode_binary(fx.topic_table(spark, sf_dir).select("value"), spread=True))
    _, rejected = quarantine.split_valid(_json_decoded(spark, sf_dir))
    dead = failed.select(F.lit("deserialization-failure").alias("reason")).unionByName(
        rejected.select("reason"))
    return reports.dead_letters_by_reason(dead)


def q_session_kpis_accepted(spark, sf_dir):
    """KPIs over stored events only (``kpi_on="accepted"``): decoded topic rows after keep-first."""
    good, _ = split_decoded(_topic_decoded(spark, sf_dir))
    kept = dedup.dedup_events(good.select(F.col("offset").alias("arrival_seq"), *HEARTBEAT_COLUMNS))
    return _round(kpi.session_kpis(kept), KPI_ROUNDING)


def q_ingest_summary(spark, sf_dir):
    return reports.ingest_summary(_topic_decoded(spark, sf_dir), with_stored=True)


# ---------------------------------------------------------------- partitioning
def q_session_partition_id(spark, sf_dir):
    return partitioning.session_hashes(_hb(spark, sf_dir))


def q_partition_load(spark, sf_dir):
    return partitioning.partition_load(_hb(spark, sf_dir))


def q_session_order(spark, sf_dir):
    """Events by topic partition, session and publish order (ORD-1)."""
    ordered = partitioning.order_by_session(_hb(spark, sf_dir))
    return ordered.select("partition_id", "session_id", "event_id", "ts", "arrival_seq")


# ---------------------------------------------------------------- operational reports
def q_ingestion_rate(spark, sf_dir):
    return _round(reports.ingestion_rate(_hb(spark, sf_dir), "ts", "1 minute"),
                  {"events_per_s": ROUND["rate"]})


def q_ingestion_rate_sliding(spark, sf_dir):
    return _round(reports.ingestion_rate(_hb(spark, sf_dir), "ts", "1 minute", "15 seconds"),
                  {"events_per_s": ROUND["rate"]})


def q_throughput_compare(spark, sf_dir):
    accepted, _ = quarantine.split_valid(_json_decoded(spark, sf_dir))
    ingested = accepted.select(F.col("received_at").alias("ts"))
    consumed = fx.topic_timestamps(_hb(spark, sf_dir)).select(F.col("timestamp").alias("ts"))
    out = reports.throughput_compare(ingested, consumed, "ts", "1 minute")
    return _round(out, {"ingested_per_s": ROUND["rate"], "consumed_per_s": ROUND["rate"]})


def q_throughput_series(spark, sf_dir):
    """Ingested and consumed events per second over the last minute, every 15 seconds, zeros included."""
    accepted, _ = quarantine.split_valid(_json_decoded(spark, sf_dir))
    ingested = accepted.select(F.col("received_at").alias("ts"), F.lit(True).alias("ingested"))
    consumed = fx.topic_timestamps(_hb(spark, sf_dir)).select(F.col("timestamp").alias("ts"), F.lit(False).alias("ingested"))
    counts = {"ingested": F.col("ingested"), "consumed": ~F.col("ingested")}
    out = series.rate_series(ingested.unionByName(consumed), counts)
    return _round(out, {"ingested_per_s": ROUND["rate"], "consumed_per_s": ROUND["rate"]})


def q_kpi_series(spark, sf_dir):
    """KPI gauges of every minute; minutes without events show the last ones."""
    # a minute holds few events, so ratios can end on a rounding tie
    out = series.kpi_series(_hb(spark, sf_dir))
    return _round(out.withColumn("rebuffering_ratio", F.col("rebuffering_ratio") + F.lit(fx.TIE_SHIFT)), KPI_ROUNDING)


def q_counter_increase(spark, sf_dir):
    """Hourly increase of a counter sampled from three processes that restart daily."""
    return series.counter_increase(fx.counter_samples(_hb(spark, sf_dir)), window="1 hour")


def _log(spark, sf_dir):
    return fx.latency_log(_hb(spark, sf_dir))


def q_latency_report(spark, sf_dir):
    return _round(reports.latency_report(_log(spark, sf_dir), "1 minute"),
                  {"avg_latency_ms": ROUND["ms"], "max_latency_ms": ROUND["ms"]})


def q_sla_breaches(spark, sf_dir):
    return reports.sla_breaches(_log(spark, sf_dir))


def q_sla_report(spark, sf_dir):
    return _round(reports.sla_report(_log(spark, sf_dir), "1 day"),
                  {"error_rate": ROUND["rate"], "p99_latency_ms": ROUND["ms"],
                   "sent_per_s": ROUND["rate"], "ok_per_s": ROUND["rate"]})


def q_overflow_alerts(spark, sf_dir):
    """Days with more than 25 rejected requests.

    The operator's defaults are the reference's alert (more than 50 per
    minute). The test data holds about 14 (sf0.01) to 140 (sf0.1) requests
    per hour, ~8 % of them rejected, so that rule can never fire; a daily
    window with a threshold near the sf0.01 daily mean makes the alert path
    produce rows and exercises both sides of the threshold.
    """
    _, rejected = quarantine.split_valid(_json_decoded(spark, sf_dir))
    return reports.overflow_alerts(rejected, "received_at", "1 day", 25)


def q_publish_summary(spark, sf_dir):
    classified = quarantine.classify_requests(_json_decoded(spark, sf_dir))
    return reports.publish_summary(classified, fx.outage_backlog(spark, sf_dir))


# ---------------------------------------------------------------- backlog
def q_backlog_slice(spark, sf_dir):
    backlog = fx.outage_backlog(spark, sf_dir).select(*_DEDUP_COLS)
    return bl.backlog_slice(backlog, bl.REPLAY_SLICE)


def q_backlog_report(spark, sf_dir):
    return bl.backlog_report(fx.outage_backlog(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "session_kpis": q_session_kpis,
    "global_kpis": q_global_kpis,
    "headline_kpis": q_headline_kpis,
    "kpi_timeseries": q_kpi_timeseries,
    "dedup_events": q_dedup_events,
    "append_new_events": q_append_new_events,
    "save_one_event": q_save_one_event,
    "exists_by_event_id": q_exists_by_event_id,
    "events_by_id": q_events_by_id,
    "validate_accept": q_validate_accept,
    "validate_reject": q_validate_reject,
    "json_files": q_json_files,
    "decode_roundtrip": q_decode_roundtrip,
    "dead_letters_by_reason": q_dead_letters_by_reason,
    "ingest_summary": q_ingest_summary,
    "session_kpis_accepted": q_session_kpis_accepted,
    "session_partition_id": q_session_partition_id,
    "partition_load": q_partition_load,
    "session_order": q_session_order,
    "ingestion_rate": q_ingestion_rate,
    "ingestion_rate_sliding": q_ingestion_rate_sliding,
    "throughput_compare": q_throughput_compare,
    "throughput_series": q_throughput_series,
    "kpi_series": q_kpi_series,
    "counter_increase": q_counter_increase,
    "latency_report": q_latency_report,
    "sla_breaches": q_sla_breaches,
    "sla_report": q_sla_report,
    "overflow_alerts": q_overflow_alerts,
    "publish_summary": q_publish_summary,
    "backlog_slice": q_backlog_slice,
    "backlog_report": q_backlog_report,
}

QUERIES.update(STREAM_QUERIES)
