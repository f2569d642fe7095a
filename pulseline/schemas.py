"""Declared schemas (no inference anywhere) and the fixed values they carry."""

from __future__ import annotations

from pyspark.sql import types as T

# Heartbeat event as stored (storage names, snake_case). ``ts`` is the event
# time with millisecond precision, UTC wall clock, TIMESTAMP_NTZ.
HEARTBEAT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("client_id", T.StringType()),
    T.StructField("content_id", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("video_start_time_ms", T.DoubleType()),
    T.StructField("playback_failed", T.BooleanType()),
    T.StructField("rebuffer_duration_ms", T.DoubleType()),
    T.StructField("playback_duration_ms", T.DoubleType()),
    T.StructField("player_version", T.StringType()),
    T.StructField("os", T.StringType()),
    T.StructField("cdn", T.StringType()),
])
HEARTBEAT_COLUMNS = [f.name for f in HEARTBEAT.fields]

# The stored raw event table: heartbeat columns, partitioned by source and batch.
BATCH_KEY = [T.StructField("source_id", T.StringType()), T.StructField("batch_id", T.LongType())]
EVENTS_TABLE = T.StructType(list(HEARTBEAT.fields) + BATCH_KEY)

# Wire form of the same event (field numbers of the binary message, in
# declaration order): name, field number, scalar kind.
# Fixed values — must equal the wire format of the published heartbeat message.
WIRE_FIELDS = [
    ("event_id", 1, "string"),
    ("session_id", 2, "string"),
    ("client_id", 3, "string"),
    ("content_id", 4, "string"),
    ("timestamp_ms", 5, "int64"),
    ("video_start_time_ms", 6, "double"),
    ("playback_failed", 7, "bool"),
    ("rebuffer_duration_ms", 8, "double"),
    ("playback_duration_ms", 9, "double"),
    ("player_version", 10, "string"),
    ("os", 11, "string"),
    ("cdn", 12, "string"),
]
WIRE_MESSAGE_NAME = "HeartbeatEvent"
WIRE_PACKAGE = "pulseline.wire"

# JSON request field names (camelCase) → storage names.
# Fixed values — the JSON document keys accepted on ingest.
JSON_FIELDS = [
    ("eventId", "event_id"),
    ("sessionId", "session_id"),
    ("clientId", "client_id"),
    ("contentId", "content_id"),
    ("timestampMs", "timestamp_ms"),
    ("videoStartTimeMs", "video_start_time_ms"),
    ("playbackFailed", "playback_failed"),
    ("rebufferDurationMs", "rebuffer_duration_ms"),
    ("playbackDurationMs", "playback_duration_ms"),
    ("playerVersion", "player_version"),
    ("os", "os"),
    ("cdn", "cdn"),
]

# Storage bounds of the raw event table: column → (not null, max length).
# Fixed values — the declared column limits of the raw event table.
STORAGE_LIMITS = {
    "event_id": (True, 64),
    "session_id": (True, 64),
    "client_id": (True, 64),
    "content_id": (True, 128),
    "ts": (True, None),
    "player_version": (False, 32),
    "os": (False, 32),
    "cdn": (False, 64),
}

# Validation messages. Fixed values — the default constraint messages.
MSG_NOT_BLANK = "must not be blank"
MSG_POSITIVE = "must be greater than 0"

# Dead-letter reasons. Fixed value — the reason tag for undecodable payloads.
REASON_UNDECODABLE = "deserialization-failure"
REASON_INVALID = "validation-failure"
REASON_STORAGE = "storage-bounds-violation"

# Topic record (offline form of the heartbeat topic).
TOPIC = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])

# Raised by a job that could not store an event it had decoded.
REASON_UNSTORED = "processing-failure"

# One KPI row per (source, batch, session). The additive parts are stored next to the
# ratios so that batches can be rolled up exactly.
SESSION_METRICS = T.StructType([
    T.StructField("source_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("window_start", T.TimestampNTZType()),
    T.StructField("window_end", T.TimestampNTZType()),
    T.StructField("avg_vst_ms", T.DoubleType()),
    T.StructField("pfr", T.DoubleType()),
    T.StructField("rebuffering_ratio", T.DoubleType()),
    T.StructField("event_count", T.LongType()),
    T.StructField("sum_vst_ms", T.DoubleType()),
    T.StructField("failures", T.LongType()),
    T.StructField("total_playback_ms", T.DoubleType()),
    T.StructField("total_rebuffer_ms", T.DoubleType()),
])

DEAD_LETTER = T.StructType([
    T.StructField("payload", T.BinaryType()),
    T.StructField("reason", T.StringType()),
    T.StructField("detail", T.StringType()),
    T.StructField("ingest_ts", T.TimestampNTZType()),
    T.StructField("source_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])
