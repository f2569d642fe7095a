import datetime as dt

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import hb_rows
from pulseline.functions import wire
from pulseline.schemas import WIRE_FIELDS
from pulseline.functions.codec import decode_binary, encode_binary, message_class, split_decoded


def test_round_trip_and_device_defaults(spark):
    ts = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    df = hb_rows(spark, [{"ts": ts, "video_start_time_ms": 12.5, "playback_failed": True,
                          "os": None, "cdn": "cdn-1", "player_version": "5.2.1"}])
    dec = decode_binary(encode_binary(df).select("event_id", F.col("value")).withColumnRenamed(
        "event_id", "orig_id"), "value")
    r = dec.collect()[0]
    assert r["decode_error"] is None
    assert r["event_id"] == r["orig_id"]
    assert r["os"] == "" and r["cdn"] == "cdn-1" and r["player_version"] == "5.2.1"
    assert r["timestamp_ms"] == 1704164645678           # floored to whole ms
    assert r["ts"] == dt.datetime(2024, 1, 2, 3, 4, 5, 678000)
    assert r["playback_failed"] is True and r["video_start_time_ms"] == 12.5


def test_truncated_null_and_empty_payloads(spark):
    good = message_class()(event_id="e1", session_id="s1", cdn="cdn-1").SerializeToString()
    rows = [(1, good), (2, good[:-1]), (3, None), (4, b"")]
    df = spark.createDataFrame(rows, "id long, value binary")
    got = {r["id"]: r for r in decode_binary(df).collect()}
    assert got[1]["decode_error"] is None and got[1]["cdn"] == "cdn-1"
    assert got[2]["decode_error"] is not None
    assert got[3]["decode_error"] == "null payload"
    # an empty payload is a valid message with every field at its default
    assert got[4]["decode_error"] is None and got[4]["event_id"] == "" and got[4]["timestamp_ms"] == 0
    ok, bad = split_decoded(decode_binary(df))
    assert ok.count() == 2 and bad.count() == 2


TEXT = st.text(max_size=200)
DOUBLE = st.one_of(st.floats(width=64), st.sampled_from([0.0, -0.0, 1e308, float("nan")]))
MESSAGE = st.fixed_dictionaries({
    name: {"string": TEXT, "int64": st.integers(-2**63, 2**63 - 1), "double": DOUBLE, "bool": st.booleans()}[kind]
    for name, _, kind in WIRE_FIELDS})


def _columns(rows):
    types = {"string": pa.string(), "int64": pa.int64(), "double": pa.float64(), "bool": pa.bool_()}
    return [pa.array([r[name] for r in rows], types[kind]) for name, _, kind in WIRE_FIELDS]


@settings(max_examples=80, deadline=None)
@given(st.lists(MESSAGE, max_size=6))
def test_written_messages_equal_the_runtime(rows):
    cls = message_class()
    want = [cls(**r).SerializeToString() for r in rows]
    if rows:
        assert wire.write(_columns(rows)).to_pylist() == want
    columns, odd = wire.parse(pa.array(want, pa.binary()))
    assert not odd.any()
    for column, (name, _, _) in zip(columns, WIRE_FIELDS):
        assert [repr(v) for v in column.to_pylist()] == [repr(r[name]) for r in rows]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.binary(max_size=40), MESSAGE.map(lambda r: message_class()(**r).SerializeToString())),
                min_size=1, max_size=5), st.data())
def test_parsed_messages_equal_the_runtime(payloads, data):
    cls = message_class()
    cut = [p[:data.draw(st.integers(0, len(p)))] if data.draw(st.booleans()) else p for p in payloads]
    columns, odd = wire.parse(pa.array(cut, pa.binary()))
    for i, payload in enumerate(cut):
        try:
            message = cls.FromString(payload)
        except Exception:
            assert odd[i]
            continue
        if not odd[i]:
            assert [repr(c[i].as_py()) for c in columns] == [repr(getattr(message, name)) for name, _, _ in WIRE_FIELDS]


def test_undeclared_forms_are_left_to_the_runtime(spark):
    plain = message_class()(event_id="a", timestamp_ms=-7).SerializeToString()
    unknown = plain + bytes([13 << 3, 1])                     # field 13
    twice = plain + message_class()(event_id="b").SerializeToString()
    wrong = plain + bytes([1 << 3, 5])                        # event_id as a number
    text = bytes([1 << 3 | 2, 2, 0xC3, 0x28])                 # not UTF-8
    df = spark.createDataFrame(list(enumerate([plain, unknown, twice, wrong, text])), "id long, value binary")
    got = {r["id"]: r for r in decode_binary(df).collect()}
    assert [got[i]["event_id"] for i in range(4)] == ["a", "a", "b", "a"]
    assert all(got[i]["decode_error"] is None and got[i]["timestamp_ms"] == -7 for i in range(4))
    assert got[4]["decode_error"] is not None
