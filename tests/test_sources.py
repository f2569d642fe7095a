import datetime as dt

from pulseline.sources.events import heartbeats_from_events


def test_events_to_heartbeats_mapping(spark):
    ev = spark.createDataFrame(
        [(7, dt.datetime(2024, 1, 2, 3, 4, 5, 678999), 42, "signup", 12.5, '{"k": 3}'),
         (8, dt.datetime(2024, 1, 2, 3, 4, 6), 42, "error", 0.25, '{"k": 0}')],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    rows = {r["event_id"]: r for r in heartbeats_from_events(ev).collect()}
    a, b = rows["7"], rows["8"]
    assert (a["session_id"], a["client_id"], a["content_id"]) == ("session-42", "client-42", "content-2")
    assert a["ts"] == dt.datetime(2024, 1, 2, 3, 4, 5, 678000)          # millisecond precision
    assert a["timestamp_ms"] == 1704164645678 and a["arrival_seq"] == 7
    assert a["playback_duration_ms"] == 0.0 and a["rebuffer_duration_ms"] == 3.0   # signup: no playback
    assert a["player_version"] is None and b["player_version"] == "5.0"             # id % 7 == 0 -> absent
    assert b["playback_failed"] is True and b["playback_duration_ms"] == 250.0
    assert (b["os"], b["cdn"]) == ("os-2", "cdn-2")
