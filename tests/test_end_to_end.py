"""Single requests through publish job → topic → stream processor."""

import json

from pyspark.sql import functions as F

from pulseline.operators.dedup import exists_by_event_id
from pulseline.session import scratch_path
from pulseline.sources.topic import heartbeat_stream
from pulseline.streaming.processor import Layout, run_stream
from pulseline.streaming.publish import publish_job

BASE = {"sessionId": "living-room", "clientId": "tv-17",
        "contentId": "nature-film", "timestampMs": 1718450123456, "videoStartTimeMs": 871.25,
        "playbackFailed": False, "rebufferDurationMs": 40.5, "playbackDurationMs": 7210.0}


def _round_trip(spark, docs, name):
    root = scratch_path(spark, name)
    rows = [(i, json.dumps(d)) for i, d in enumerate(docs)]
    (spark.createDataFrame(rows, "request_id long, body string")
          .withColumn("received_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
          .write.parquet(f"{root}/requests"))
    schema = "request_id long, body string, received_at timestamp_ntz"
    publish_job(spark.readStream.schema(schema).parquet(f"{root}/requests"),
                f"{root}/topic", f"{root}/dead", f"{root}/_pub").awaitTermination()
    layout = Layout(f"{root}/out")
    run_stream(heartbeat_stream(spark, f"{root}/topic"), layout).awaitTermination()
    return layout


def test_event_without_device_fields_is_stored(spark):
    layout = _round_trip(spark, [dict(BASE, eventId="first-play")], "e2e-persist")
    stored = spark.read.parquet(layout.events)
    probe = spark.createDataFrame([("first-play",)], "event_id string")
    assert exists_by_event_id(probe, stored).collect()[0]["exists"] is True
    row = stored.collect()[0]
    assert (row["os"], row["cdn"], row["player_version"]) == ("", "", "")
    kpis = spark.read.parquet(layout.metrics).collect()
    assert len(kpis) == 1 and kpis[0]["avg_vst_ms"] == 871.25


def test_same_event_twice_is_stored_once(spark):
    layout = _round_trip(spark, [dict(BASE, eventId="sent-twice")] * 2, "e2e-dup")
    assert spark.read.parquet(layout.events).filter("event_id = 'sent-twice'").count() == 1
    # KPIs are computed over what was decoded, the duplicate included (parity)
    assert spark.read.parquet(layout.metrics).collect()[0]["event_count"] == 2
