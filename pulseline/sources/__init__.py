"""Sources: the driver tables, heartbeat JSON / binary / topic inputs, stored tables."""

from pulseline.sources.events import (
    heartbeats_from_events, read_events, read_session_metrics, read_table,
)
from pulseline.sources.json_source import decode_json, read_json_heartbeats
from pulseline.sources.topic import heartbeat_stream, read_binary_heartbeats, read_topic
from pulseline.sources.topic_log import append_log, drain, log_stream

__all__ = [
    "heartbeats_from_events", "read_events", "read_session_metrics", "read_table",
    "decode_json", "read_json_heartbeats", "heartbeat_stream",
    "read_binary_heartbeats", "read_topic", "append_log", "drain", "log_stream",
]
