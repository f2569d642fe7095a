from pyspark.sql import functions as F

from conftest import hb_rows
from pulseline.operators import dedup


def _with_arrival(df):
    return df.withColumn("arrival_seq", F.monotonically_increasing_id())


def test_same_event_twice_stored_once_first_wins(spark):
    df = hb_rows(spark, [{"event_id": "dup", "video_start_time_ms": 1.0},
                         {"event_id": "dup", "video_start_time_ms": 2.0},
                         {"event_id": "other"}])
    df = df.withColumn("arrival_seq", F.when(F.col("video_start_time_ms") == 2.0, 5).otherwise(1))
    out = {r["event_id"]: r for r in dedup.dedup_events(df).collect()}
    assert set(out) == {"dup", "other"}
    assert out["dup"]["video_start_time_ms"] == 1.0


def test_append_skips_stored_ids(spark):
    stored = hb_rows(spark, [{"event_id": "a"}, {"event_id": "b"}])
    batch = _with_arrival(hb_rows(spark, [{"event_id": "b"}, {"event_id": "c"}, {"event_id": "c"}]))
    new = dedup.append_new_events(batch, stored)
    assert sorted(r["event_id"] for r in new.collect()) == ["c"]
    # the shuffle path (no broadcast) gives the same answer
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(r["event_id"] for r in dedup.append_new_events(batch, stored).collect()) == ["c"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_blank_ids_collapse_to_one_row(spark):
    batch = _with_arrival(hb_rows(spark, [{"event_id": ""} for _ in range(50)]))
    assert dedup.append_new_events(batch, None).count() == 1


def test_exists_and_lookup(spark):
    stored = hb_rows(spark, [{"event_id": "a"}, {"event_id": "b"}])
    probe = spark.createDataFrame([("a",), ("z",)], "event_id string")
    got = {r["event_id"]: r["exists"] for r in dedup.exists_by_event_id(probe, stored).collect()}
    assert got == {"a": True, "z": False}
    assert [r["event_id"] for r in dedup.events_by_id(stored, ["b"]).collect()] == ["b"]
    assert dedup.events_by_id(stored, probe).count() == 1


def test_merge_replay_keeps_live_copy(spark):
    live = hb_rows(spark, [{"event_id": "x", "video_start_time_ms": 1.0}]).withColumn("arrival_seq", F.lit(1))
    back = hb_rows(spark, [{"event_id": "x", "video_start_time_ms": 9.0},
                           {"event_id": "y"}]).withColumn("arrival_seq", F.lit(7))
    out = {r["event_id"]: r["video_start_time_ms"] for r in dedup.merge_replay(live, back).collect()}
    assert out == {"x": 1.0, "y": 0.0}
