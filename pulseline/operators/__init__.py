"""Relational operators over heartbeat tables and streams."""

from pulseline.operators.backlog import backlog_report, backlog_slice
from pulseline.operators.dedup import (
    append_new_events, dedup_events, events_by_id, exists_by_event_id, merge_replay, save_event,
)
from pulseline.operators.kpi import (
    global_kpis, headline_kpis, kpi_timeseries, rollup_kpis, session_kpi_parts,
    session_kpis,
)
from pulseline.operators.partitioning import (
    order_by_session, partition_load, session_hashes, with_partition_id,
)
from pulseline.operators.quarantine import (
    classify_requests, split_valid, storage_split, to_event_table,
)
from pulseline.operators.reports import (
    dead_letters_by_reason, ingest_summary, ingestion_rate, latency_report,
    overflow_alerts, publish_summary, sla_breaches, sla_report, throughput_compare,
)

__all__ = [
    "backlog_report", "backlog_slice", "append_new_events", "dedup_events",
    "events_by_id", "exists_by_event_id", "merge_replay", "global_kpis",
    "headline_kpis", "kpi_timeseries", "rollup_kpis", "session_kpi_parts",
    "session_kpis", "order_by_session", "partition_load", "session_hashes",
    "with_partition_id", "classify_requests", "split_valid", "storage_split",
    "to_event_table", "dead_letters_by_reason", "ingest_summary", "ingestion_rate",
    "latency_report", "overflow_alerts", "publish_summary", "sla_breaches",
    "sla_report", "throughput_compare",
]
