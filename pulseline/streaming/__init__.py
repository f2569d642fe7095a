"""Structured Streaming jobs: per-batch processing, event-time KPIs, replay, publish."""

from pulseline.streaming.id_index import IdIndex
from pulseline.streaming.late import WindowLayout, fold_late, late_events, run_windows, window_kpis
from pulseline.streaming.latency import latency_parts, latency_quantiles, run_latency
from pulseline.streaming.ledger import BatchLedger, read_ledger
from pulseline.streaming.processor import (
    Layout, process_batch, run_stream, stored_elsewhere,
)
from pulseline.streaming.publish import publish_batch, publish_job
from pulseline.streaming.replay import (
    recover_dead_letters, replay, replay_dead_letters, retained_dead_letters, write_backlog,
)
from pulseline.streaming.sinks import (
    write_batch_partition, write_dead_letters, write_new_events,
    write_session_metrics, write_topic,
)
from pulseline.streaming.windows import dedup_stream, drop_repeats_in_task, split_identified, stream_kpis

__all__ = [
    "Layout", "process_batch", "run_stream", "stored_elsewhere", "write_batch_partition",
    "write_dead_letters", "write_new_events", "write_session_metrics", "write_topic",
    "BatchLedger", "read_ledger", "latency_parts", "latency_quantiles", "run_latency",
    "IdIndex", "WindowLayout", "fold_late", "late_events", "run_windows", "window_kpis",
    "dedup_stream", "drop_repeats_in_task", "split_identified", "stream_kpis", "publish_batch", "publish_job", "replay",
    "recover_dead_letters", "replay_dead_letters", "retained_dead_letters", "write_backlog",
]
