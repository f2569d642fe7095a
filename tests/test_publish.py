import json

from pyspark.sql import functions as F

from pulseline.functions.codec import decode_binary
from pulseline.functions.murmur import session_partition_id
from pulseline.session import scratch_path
from pulseline.sources.json_source import decode_json, read_json_heartbeats
from pulseline.sources.topic import read_topic
from pulseline.streaming.publish import publish_batch, publish_job

DOC = {"eventId": "e1", "sessionId": "session-abc", "clientId": "c1", "contentId": "m1",
       "timestampMs": 1704067200000, "videoStartTimeMs": 250.0}


def _write_lines(spark, path, docs):
    spark.createDataFrame([(d,) for d in docs], "value string").coalesce(1).write.text(path)


def test_text_source_and_publish_batch(spark):
    root = scratch_path(spark, "test-publish")
    docs = [json.dumps(dict(DOC, eventId=f"e{i}")) for i in range(5)] + [json.dumps(dict(DOC, sessionId=""))]
    _write_lines(spark, f"{root}/in", docs)
    req = (read_json_heartbeats(spark, f"{root}/in")
           .withColumn("request_id", F.monotonically_increasing_id())
           .withColumn("received_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")))
    publish_batch(req, 0, f"{root}/topic", f"{root}/dead")
    topic = read_topic(spark, f"{root}/topic")
    rows = topic.select("key", "partition").distinct().collect()
    assert [(r["key"], r["partition"]) for r in rows] == [("session-abc", 12)]   # Murmur2 rule, 24 partitions
    dec = decode_binary(topic)
    assert dec.filter("decode_error IS NULL").count() == 5
    assert dec.filter("os = '' AND cdn = '' AND player_version = ''").count() == 5   # nulls become ""
    dead = spark.read.parquet(f"{root}/dead").collect()
    assert len(dead) == 1 and dead[0]["reason"] == "validation-failure"
    assert bytes(dead[0]["payload"]).decode() == docs[-1]


def test_publish_job_streams_text_files(spark):
    root = scratch_path(spark, "test-publish-stream")
    for i in range(3):
        _write_lines(spark, f"{root}/in/part{i}", [json.dumps(dict(DOC, eventId=f"s{i}-{j}")) for j in range(4)])
    stream = (read_json_heartbeats(spark, f"{root}/in/*", streaming=True, max_files_per_trigger=1)
              .withColumn("request_id", F.lit(0).cast("bigint"))
              .withColumn("received_at", F.current_timestamp().cast("timestamp_ntz")))
    publish_job(stream, f"{root}/topic", f"{root}/dead", f"{root}/_ckpt").awaitTermination()
    assert read_topic(spark, f"{root}/topic").count() == 12


def test_partition_column_matches_rule(spark):
    root = scratch_path(spark, "test-publish-rule")
    docs = [json.dumps(dict(DOC, eventId=f"e{i}", sessionId=f"session-{i}")) for i in range(50)]
    _write_lines(spark, f"{root}/in", docs)
    req = (read_json_heartbeats(spark, f"{root}/in").withColumn("request_id", F.lit(1).cast("bigint"))
           .withColumn("received_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")))
    publish_batch(req, 0, f"{root}/topic", f"{root}/dead")
    t = read_topic(spark, f"{root}/topic")
    assert t.filter(F.col("partition") != session_partition_id("key", 24)).count() == 0
    assert decode_json(req).count() == 50


def test_message_keeps_event_time_record_keeps_ingest_time(spark):
    root = scratch_path(spark, "test-publish-times")
    _write_lines(spark, f"{root}/in", [json.dumps(dict(DOC, timestampMs=1704067200123))])
    req = (read_json_heartbeats(spark, f"{root}/in").withColumn("request_id", F.lit(1).cast("bigint"))
           .withColumn("received_at", F.lit("2024-02-01 10:00:00").cast("timestamp_ntz")))
    publish_batch(req, 0, f"{root}/topic", f"{root}/dead")
    r = decode_binary(read_topic(spark, f"{root}/topic")).collect()[0]
    assert r["timestamp_ms"] == 1704067200123
    assert str(r["timestamp"]) == "2024-02-01 10:00:00"


def test_arrival_numbers_go_on_without_gaps(spark):
    root = scratch_path(spark, "test-arrivals")
    total = 0
    for batch in (0, 1, 1, 1 << 40):                     # one retried, one after very many batches
        rows = [(f"2024-01-01 00:00:{i:02d}", f"file{i % 3}", f"{batch}-{i}") for i in range(40)]
        req = spark.createDataFrame(rows, "file_time string, file_path string, event string").repartition(5)
        body = F.to_json(F.struct(F.col("event").alias("eventId"), F.lit("s").alias("sessionId"), F.lit("c").alias("clientId"),
                                  F.lit("m").alias("contentId"), F.lit(1704067200000).alias("timestampMs")))
        req = req.select("file_time", "file_path", body.alias("body"), F.lit("2024-01-01").cast("timestamp_ntz").alias("received_at"))
        publish_batch(req, batch, f"{root}/topic-{total}", f"{root}/dead", arrivals=f"{root}/arrivals")
        got = decode_binary(read_topic(spark, f"{root}/topic-{total}")).select("offset", "event_id").collect()
        first = {0: 0, 1: 40, 1 << 40: 80}[batch]
        assert {r.event_id: r.offset for r in got} == {f"{batch}-{i}": first + i for i in range(40)}
        total += 1
