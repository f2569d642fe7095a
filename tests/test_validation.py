import json

from pulseline.operators.quarantine import classify_requests, split_valid
from pulseline.sources.json_source import decode_json

GOOD = {"eventId": "e1", "sessionId": "s1", "clientId": "c1", "contentId": "m1",
        "timestampMs": 1704067200123, "videoStartTimeMs": 250.0, "playbackFailed": False,
        "rebufferDurationMs": 0.0, "playbackDurationMs": 60000.0}


def _classify(spark, bodies):
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "request_id long, body string")
    return {r["request_id"]: r for r in classify_requests(decode_json(df)).collect()}


def _doc(**over):
    d = dict(GOOD)
    for k, v in over.items():
        if v is ...:
            d.pop(k, None)
        else:
            d[k] = v
    return json.dumps(d)


def test_valid_request_without_device_fields(spark):
    r = _classify(spark, [_doc()])[0]
    assert r["reason"] is None
    assert r["player_version"] is None and r["os"] is None and r["cdn"] is None
    assert str(r["ts"]) == "2024-01-01 00:00:00.123000"


def test_blank_includes_control_characters(spark):
    got = _classify(spark, [_doc(sessionId="   "), _doc(sessionId="\t\n"), _doc(sessionId=" x ")])
    assert got[0]["violations"] == "sessionId: must not be blank"
    assert got[1]["violations"] == "sessionId: must not be blank"
    assert got[2]["reason"] is None


def test_all_violations_are_listed(spark):
    r = _classify(spark, [_doc(eventId="", clientId=..., timestampMs=-5)])[0]
    assert r["reason"] == "validation-failure"
    assert r["violations"] == ("eventId: must not be blank; clientId: must not be blank; "
                               "timestampMs: must be greater than 0")


def test_lenient_binding(spark):
    got = _classify(spark, [
        _doc(timestampMs="1704067200123"),      # number as text
        _doc(playbackFailed="true"),            # boolean as text
        _doc(videoStartTimeMs=...),             # absent primitive -> 0.0
        _doc(extra=1),                          # unknown field ignored
        _doc(videoStartTimeMs=None),            # null primitive -> 0.0
    ])
    frac = _classify(spark, [_doc(timestampMs=1.7040672001239e12)])[0]
    assert frac["reason"] is None and frac["timestamp_ms"] == 1704067200123
    assert all(r["reason"] is None for r in got.values())
    assert got[0]["timestamp_ms"] == 1704067200123
    assert got[1]["playback_failed"] is True
    assert got[2]["video_start_time_ms"] == 0.0
    assert got[4]["video_start_time_ms"] == 0.0


def test_booleans_bind_from_true_false_and_whole_numbers_only(spark):
    good = {"true": True, "FALSE": False, "True": True, 1: True, 0: False, "": False}
    got = _classify(spark, [_doc(playbackFailed=v) for v in good])
    assert [got[i]["playback_failed"] for i in range(len(good))] == list(good.values())
    bad = _classify(spark, [_doc(playbackFailed=v) for v in ("yes", "y", "t", "1.5", "no")])
    assert {r["violations"] for r in bad.values()} == {"playbackFailed: type mismatch"}


def test_empty_text_for_a_number_is_absent(spark):
    got = _classify(spark, [_doc(videoStartTimeMs=""), _doc(timestampMs=" ")])
    assert got[0]["reason"] is None and got[0]["video_start_time_ms"] == 0.0
    assert got[1]["violations"] == "timestampMs: must be greater than 0"


def test_absent_timestamp_is_not_positive(spark):
    r = _classify(spark, [_doc(timestampMs=...)])[0]
    assert r["violations"] == "timestampMs: must be greater than 0"


def test_undecodable_documents(spark):
    got = _classify(spark, [_doc(videoStartTimeMs="zz"), _doc()[:-4], "", "[1, 2]"])
    assert got[0]["reason"] == "deserialization-failure"
    assert got[0]["violations"] == "videoStartTimeMs: type mismatch"
    for i in (1, 2, 3):
        assert got[i]["reason"] == "deserialization-failure", i


def test_storage_bounds_quarantine(spark):
    got = _classify(spark, [_doc(contentId="x" * 128), _doc(contentId="x" * 129),
                            _doc(eventId="e" * 65), _doc(os="o" * 33)])
    assert got[0]["reason"] is None
    assert got[1]["violations"] == "content_id: longer than 128"
    assert got[2]["violations"] == "event_id: longer than 64"
    assert got[3]["violations"] == "os: longer than 32"
    assert {got[i]["reason"] for i in (1, 2, 3)} == {"storage-bounds-violation"}


def test_split_is_disjoint_and_complete(spark):
    bodies = [_doc(), _doc(sessionId=""), _doc()[:10], _doc(contentId="y" * 300)]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "request_id long, body string")
    ok, bad = split_valid(decode_json(df))
    assert ok.count() == 1 and bad.count() == 3


def test_out_of_range_timestamp_is_quarantined_not_fatal(spark):
    r = _classify(spark, [_doc(timestampMs=9223372036854775807)])[0]
    assert r["ts"] is None
    assert r["reason"] == "storage-bounds-violation"
    assert r["violations"] == "ts: must not be null"


def test_text_fields_bind_scalars_only(spark):
    got = _classify(spark, [_doc(eventId={"x": 1}), _doc(sessionId=[1, 2]),
                            _doc(eventId=123), _doc(os=True)])
    assert got[0]["reason"] == "deserialization-failure"
    assert got[0]["violations"] == "eventId: type mismatch"
    assert got[1]["violations"] == "sessionId: type mismatch"
    assert got[2]["reason"] is None and got[2]["event_id"] == "123"
    assert got[3]["reason"] is None and got[3]["os"] == "true"
