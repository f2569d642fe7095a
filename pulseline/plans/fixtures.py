"""Inputs derived by Spark from the driver's ``events`` table.

The driver tables hold no heartbeat stream, so each registered query maps
``events`` onto heartbeats (``sources.events.heartbeats_from_events``) and
derives the request log, topic records, backlog and stored-table splits from
it. Every derivation covers the WHOLE table: narrow projections, unions (the
redelivered copy), and event-time cut-offs that split it into parts which
together cover it (stored vs. new batch, live vs. outage backlog). Faulty
records are produced by rewriting rows chosen by the event's ``k`` property
(0…99), never by dropping rows, so each fault class is about 1 % of the rows
and grows with the data. The topic and request-log tables are written once
per session and input files under the shared checkpoint folder and read back,
as stored data would be.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseline.functions.codec import encode_binary
from pulseline.functions.murmur import session_partition_id
from pulseline.functions.parallel import spread_small_input
from pulseline.functions.scalars import ts_to_millis
from pulseline.operators.partitioning import TOPIC_PARTITIONS
from pulseline.session import scratch_path
from pulseline.sources.events import heartbeats_from_events, read_table

# Fixed values — fault classes by the event's k property.
K_BLANK_SESSION = 0       # JSON: sessionId is three spaces
K_ZERO_TIMESTAMP = 1      # JSON: timestampMs is 0
K_MISSING_CLIENT = 2      # JSON: clientId omitted
K_LONG_CONTENT = 3        # JSON: contentId is 200 characters
K_TRUNCATED_PAYLOAD = 4   # binary: payload cut by one byte
K_QUOTED_TIMESTAMP = 5    # JSON: timestampMs sent as a string (accepted)
K_BAD_NUMBER = 6          # JSON: videoStartTimeMs is "zz"
K_CONTROL_BLANK = 7       # JSON: sessionId is a tab and a newline
K_TWO_VIOLATIONS = 8      # JSON: eventId "" and timestampMs -5
K_MALFORMED_JSON = 9      # JSON: document cut short
K_UNKNOWN_FIELD = 10      # JSON: extra key, playerVersion omitted (accepted)
K_NULL_PAYLOAD = 11       # binary: null payload
K_EMPTY_PAYLOAD = 12      # binary: empty payload (a valid all-default message)
K_UNSTORED = 13           # dead-letter run only: decoded, but the store failed

# Fixed values — decimal places of doubles in registered query results (ms
# values, rates, ratios). Inputs carry 2 decimals, so a mean over n events
# ends exactly on a rounding tie at d places when n has a factor 2^(d-1) or
# 5^(d-1); 9 places keeps ties out for sessions below 256 events, while
# summation-order noise (~1e-14) stays far below the last place kept.
ROUND = {"ms": 9, "rate": 9, "ratio": 12}
# Added before rounding ratios of very small groups, where ties at 12 places do
# occur: far above the summation noise, far below the last place kept.
TIE_SHIFT = 1e-15

EPOCH = dt.datetime(1970, 1, 1)

# Fixed values — replay copy and stored/new split.
REDELIVERY_VST_DELTA = 1.0          # the copy carries a refreshed reading
COUNTER_TICK = 10                   # seconds between two counts of a sampled counter
# Moments as percent of the time from the first to the last event.
BATCH_FROM = 30
STORED_BEFORE = 50
OUTAGE = (63, 73)
SECOND_OUTAGE = (83, 90)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


_RANGES: dict = {}


def moment(spark: SparkSession, sf_dir: str, percent: int) -> str:
    """The whole second after ``percent`` of the time that the events span, as text."""
    key = (spark.sparkContext.applicationId, _input_files(spark, sf_dir))
    if key not in _RANGES:
        second = lambda c: F.floor(ts_to_millis(c.cast("timestamp_ntz")) / 1000)
        _RANGES[key] = tuple(events(spark, sf_dir).agg(second(F.min("ts")), second(F.max("ts"))).first())
    first, last = _RANGES[key]
    if first is None:
        first = last = 0
    return str(EPOCH + dt.timedelta(seconds=first + (last - first) * percent // 100))


def fault_key(ev: DataFrame) -> Column:
    return F.get_json_object(ev["props"], "$.k").cast("int")


def heartbeats(spark: SparkSession, sf_dir: str, with_key: bool = False,
               since: str | None = None, until: str | None = None) -> DataFrame:
    """Heartbeat rows of the ``events`` table (optionally with ``fault_key``).

    ``since`` / ``until`` (exclusive) bound the event time in whole seconds;
    they filter the table's own column, so they reach the scan.
    """
    ev = events(spark, sf_dir)
    bound = lambda text: F.lit(text).cast(ev.schema["ts"].dataType)
    if since:
        ev = ev.filter(F.col("ts") >= bound(since))
    if until:
        ev = ev.filter(F.col("ts") < bound(until))
    return heartbeats_from_events(ev, {"fault_key": fault_key(ev)} if with_key else None)


def stored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of the events that is stored already."""
    return heartbeats(spark, sf_dir, until=moment(spark, sf_dir, STORED_BEFORE))


def new_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new batch; it overlaps the stored part."""
    return heartbeats(spark, sf_dir, since=moment(spark, sf_dir, BATCH_FROM))


def redelivered(hb: DataFrame) -> DataFrame:
    """A second delivery of every event: offsets after all first ones, refreshed VST."""
    last = hb.agg(F.max("arrival_seq")).scalar()  # scalar subquery
    return hb.withColumns({
        "arrival_seq": F.col("arrival_seq") + F.lit(1) + last,
        "video_start_time_ms": F.col("video_start_time_ms") + F.lit(REDELIVERY_VST_DELTA),
    })


def closing_record(hb: DataFrame) -> DataFrame:
    """One record a month after the last event, which lets the watermark close all windows."""
    after = hb.agg(F.max("ts")).scalar() + F.expr("INTERVAL 30 DAYS")
    row = hb.sparkSession.range(1).select(
        *[F.lit("closing-record").alias(c) for c in ("event_id", "session_id", "client_id", "content_id")],
        *[F.lit(0.0).alias(c) for c in ("video_start_time_ms", "rebuffer_duration_ms", "playback_duration_ms")],
        F.lit(False).alias("playback_failed"), after.alias("ts"),
        *[F.lit("").alias(c) for c in ("player_version", "os", "cdn")],
        F.lit(None).cast("bigint").alias("arrival_seq"), F.lit(-1).alias("fault_key"))
    return topic_records(row, with_redelivery=False, with_faults=False)


def json_requests(hbk: DataFrame) -> DataFrame:
    """JSON request log ``request_id, received_at, body`` with the JSON fault classes."""
    k = F.col("fault_key")
    doc = F.struct(
        F.when(k == K_TWO_VIOLATIONS, F.lit("")).otherwise(F.col("event_id")).alias("eventId"),
        F.when(k == K_BLANK_SESSION, F.lit("   "))
         .when(k == K_CONTROL_BLANK, F.lit("\t\n"))
         .otherwise(F.col("session_id")).alias("sessionId"),
        F.when(k == K_MISSING_CLIENT, F.lit(None).cast("string"))
         .otherwise(F.col("client_id")).alias("clientId"),
        F.when(k == K_LONG_CONTENT, F.repeat(F.lit("x"), 200))
         .otherwise(F.col("content_id")).alias("contentId"),
        F.when(k == K_ZERO_TIMESTAMP, F.lit(0).cast("bigint"))
         .when(k == K_TWO_VIOLATIONS, F.lit(-5).cast("bigint"))
         .otherwise(F.col("timestamp_ms")).alias("timestampMs"),
        F.col("video_start_time_ms").alias("videoStartTimeMs"),
        F.col("playback_failed").alias("playbackFailed"),
        F.col("rebuffer_duration_ms").alias("rebufferDurationMs"),
        F.col("playback_duration_ms").alias("playbackDurationMs"),
        F.when(k == K_UNKNOWN_FIELD, F.lit(None).cast("string"))
         .otherwise(F.col("player_version")).alias("playerVersion"),
        F.col("os").alias("os"),
        F.col("cdn").alias("cdn"),
    )
    raw = F.col("__body")
    body = (F.when(k == K_QUOTED_TIMESTAMP,
                   F.regexp_replace(raw, r'"timestampMs":(-?[0-9]+)', '"timestampMs":"$1"'))
             .when(k == K_BAD_NUMBER,
                   F.regexp_replace(raw, r'"videoStartTimeMs":[^,}]*', '"videoStartTimeMs":"zz"'))
             .when(k == K_MALFORMED_JSON, F.expr("substr(__body, 1, length(__body) - 5)"))
             .when(k == K_UNKNOWN_FIELD, F.concat(F.lit('{"foo":1,'), F.expr("substr(__body, 2)")))
             .otherwise(raw))
    return (hbk.withColumn("__body", F.to_json(doc))
               .select(F.col("arrival_seq").alias("request_id"),
                       F.col("ts").alias("received_at"), body.alias("body")))


def topic_records(hbk: DataFrame, with_redelivery: bool = True,
                  with_faults: bool = True, keep=()) -> DataFrame:
    """Topic records (key, value, partition, offset, timestamp) with the binary faults.

    ``offset`` is the global delivery sequence. With ``with_redelivery`` every
    event is delivered a second time at a later offset (at-least-once replay);
    ``delivery`` tells the first (0) from the second (1).
    """
    src = hbk.withColumn("delivery", F.lit(0))
    if with_redelivery:
        src = src.unionByName(redelivered(hbk).withColumn("delivery", F.lit(1)))
    # scans of the events table: spreading is free
    enc = encode_binary(src, spread=True, keep=list(dict.fromkeys(
        ["session_id", "arrival_seq", "ts", "delivery", "fault_key", *keep])))
    k = F.col("fault_key") if with_faults else F.lit(-1)
    value = (F.when(k == K_TRUNCATED_PAYLOAD,
                    F.expr("substr(value, 1, octet_length(value) - 1)"))
              .when(k == K_NULL_PAYLOAD, F.lit(None).cast("binary"))
              .when(k == K_EMPTY_PAYLOAD, F.unhex(F.lit("")))
              .otherwise(F.col("value")))
    return enc.select(
        F.col("session_id").alias("key"), value.alias("value"),
        session_partition_id("session_id", TOPIC_PARTITIONS).alias("partition"),
        F.col("arrival_seq").alias("offset"), F.col("ts").alias("timestamp"), "delivery", *keep)


def topic_timestamps(hbk: DataFrame, with_redelivery: bool = True) -> DataFrame:
    """Record timestamps of ``topic_records`` (same rows), without encoding payloads."""
    src = hbk.unionByName(redelivered(hbk)) if with_redelivery else hbk
    return src.select(F.col("ts").alias("timestamp"))


def latency_log(hb: DataFrame) -> DataFrame:
    """Request log: latency = the event's start time (ms → ns), error = failed playback."""
    return hb.select(
        F.col("arrival_seq").alias("request_id"), F.col("ts").alias("received_at"),
        F.round(F.col("video_start_time_ms") * F.lit(1_000_000)).cast("bigint").alias("latency_ns"),
        F.col("playback_failed").alias("error"))


def counter_samples(hb: DataFrame) -> DataFrame:
    """Readings of one counter per delivery network: every event is a sample.

    A counter grows by one every ``COUNTER_TICK`` seconds and begins at 0 again
    once a day, as its process restarts, each network at its own hour.
    """
    network = F.substring_index("cdn", "-", -1).cast("bigint")
    since_restart = F.pmod(F.floor(F.col("timestamp_ms") / 1000) + network * 5 * 3600, F.lit(86_400))
    return hb.select(F.col("cdn").alias("series"), "ts", F.floor(since_restart / COUNTER_TICK).cast("bigint").alias("value"))


def outage_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events produced while the topic was unavailable (the outage period)."""
    since, until = (moment(spark, sf_dir, x) for x in OUTAGE)
    return heartbeats(spark, sf_dir, since=since, until=until)


_TABLES: dict = {}


def _input_files(spark: SparkSession, sf_dir: str) -> tuple:
    """Path, size and time of the files of the events table."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/events.parquet")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path))


def materialized_path(spark: SparkSession, sf_dir: str, name: str, build) -> str:
    """Folder of a derived input written once per session and input files under
    the shared checkpoint folder, as data at rest (a topic, a request log) would be."""
    key = (spark.sparkContext.applicationId, _input_files(spark, sf_dir), name)
    if key not in _TABLES:
        path = scratch_path(spark, f"table-{name}")
        build().write.parquet(path)
        _TABLES[key] = path
    return _TABLES[key]


def materialized(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    return spark.read.parquet(materialized_path(spark, sf_dir, name, build))


def topic_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faulty, redelivered topic as a stored table."""
    return materialized(spark, sf_dir, "topic",
                        lambda: topic_records(heartbeats(spark, sf_dir, with_key=True)))


def clean_topic_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One delivery of every event, no faults, as a stored table."""
    return materialized(spark, sf_dir, "topic-clean",
                        lambda: topic_records(heartbeats(spark, sf_dir, with_key=True),
                                              with_redelivery=False, with_faults=False))


def lettered_topic_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One faulty delivery of every event, with its fault class, as a stored table."""
    return materialized(spark, sf_dir, "topic-lettered",
                        lambda: topic_records(heartbeats(spark, sf_dir, with_key=True),
                                              with_redelivery=False, keep=("fault_key",)))


def request_table_path(spark: SparkSession, sf_dir: str) -> str:
    # written as one file per core (built from a scan, so spreading is free)
    return materialized_path(spark, sf_dir, "requests", lambda: spread_small_input(
        json_requests(heartbeats(spark, sf_dir, with_key=True))))


def request_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON request log as a stored table."""
    return spark.read.parquet(request_table_path(spark, sf_dir))
