import datetime as dt
import json

from pulseline.cli import main
from pulseline.session import scratch_path


def test_publish_then_process_jobs(spark):
    root = scratch_path(spark, "test-cli")
    docs = [json.dumps({"eventId": f"e{i}", "sessionId": f"s{i % 3}", "clientId": "c",
                        "contentId": "m", "timestampMs": 1704067200000 + i,
                        "videoStartTimeMs": 100.0 + i}) for i in range(9)]
    docs.append(json.dumps({"eventId": "bad", "sessionId": " ", "clientId": "c",
                            "contentId": "m", "timestampMs": 5}))
    spark.createDataFrame([(d,) for d in docs], "value string").write.text(f"{root}/requests")
    main(["publish", "--requests", f"{root}/requests", "--topic", f"{root}/topic",
          "--dead-letters", f"{root}/dead", "--checkpoint", f"{root}/_pub", "--once"])
    main(["process", "--topic", f"{root}/topic", "--out", f"{root}/out", "--once"])
    assert spark.read.parquet(f"{root}/out/heartbeat_events").count() == 9
    assert spark.read.parquet(f"{root}/out/session_metrics").count() == 3
    assert spark.read.parquet(f"{root}/dead").count() == 1


def test_first_arrival_wins_through_both_jobs(spark):
    root = scratch_path(spark, "test-cli-order")
    for n in range(3):  # the first file brings every id twice, later files bring them again
        docs = [json.dumps({"eventId": f"e{i % 40}", "sessionId": "s", "clientId": "c", "contentId": "m",
                            "timestampMs": 1704067200000, "videoStartTimeMs": 1000.0 * n + 500 - i}) for i in range(80)]
        spark.createDataFrame([(d,) for d in docs], "value string").coalesce(1).write.mode("append").text(f"{root}/requests")
    main(["publish", "--requests", f"{root}/requests", "--topic", f"{root}/topic",
          "--dead-letters", f"{root}/dead", "--checkpoint", f"{root}/_pub", "--once", "--max-files", "2"])
    main(["process", "--topic", f"{root}/topic", "--out", f"{root}/out", "--once"])
    rows = spark.read.parquet(f"{root}/out/heartbeat_events").collect()
    assert {r["event_id"]: r["video_start_time_ms"] for r in rows} == {f"e{i}": 500.0 - i for i in range(40)}
    offsets = [r["offset"] for r in spark.read.parquet(f"{root}/topic").collect()]
    assert sorted(offsets) == list(range(240))


def test_replay_job_absorbs_a_backlog_of_seen_events(spark):
    root = scratch_path(spark, "test-cli-replay")
    docs = [json.dumps({"eventId": f"r{i}", "sessionId": "s", "clientId": "c",
                        "contentId": "m", "timestampMs": 1704067200000 + i}) for i in range(6)]
    spark.createDataFrame([(d,) for d in docs], "value string").write.text(f"{root}/requests")
    main(["publish", "--requests", f"{root}/requests", "--topic", f"{root}/topic",
          "--dead-letters", f"{root}/dead", "--checkpoint", f"{root}/_pub", "--once"])
    main(["process", "--topic", f"{root}/topic", "--out", f"{root}/out", "--once"])
    # the same records come back as an outage backlog: nothing new is stored
    spark.read.parquet(f"{root}/topic").write.option("maxRecordsPerFile", 2).parquet(f"{root}/backlog")
    main(["replay", "--backlog", f"{root}/backlog", "--out", f"{root}/out",
          "--backlog-id", "june", "--max-files", "1"])
    events = spark.read.parquet(f"{root}/out/heartbeat_events")
    assert events.count() == 6
    assert events.filter("source_id <> 'live'").count() == 0
    assert spark.read.parquet(f"{root}/out/session_metrics").filter("source_id = 'replay-june'").count() > 0
    # a letter that decodes now is stored, the publish job's rejects stay letters
    payload = spark.read.parquet(f"{root}/topic").limit(1).collect()[0]["value"]
    bytes_of = bytearray(payload)
    at = bytes_of.index(b"r")
    bytes_of[at] = ord("q")  # another event id
    spark.createDataFrame([(bytes(bytes_of), "processing-failure", None, dt.datetime(2024, 1, 1)),
                           (b"\xff", "deserialization-failure", "cut", dt.datetime(2024, 1, 1))],
                          "payload binary, reason string, detail string, ingest_ts timestamp_ntz").write.parquet(f"{root}/letters")
    for _ in range(2):  # repeating a recovery changes nothing
        main(["recover", "--out", f"{root}/out", "--dead-letters", f"{root}/letters", "--run-id", "one"])
        events = spark.read.parquet(f"{root}/out/heartbeat_events")
        assert events.count() == 7 and events.filter("source_id = 'dead-letters-one'").count() == 1
