import datetime as dt

from pyspark.sql import functions as F

from pulseline.functions.scalars import (
    apply_defaults, millis_to_ts, normalize_device_fields, safe_ratio, seconds_to_ms, ts_to_millis,
)


def test_defaults_and_device_fields(spark):
    df = spark.createDataFrame(
        [(None, None, None, None, None, None, "x")],
        "timestamp_ms long, video_start_time_ms double, playback_failed boolean, "
        "rebuffer_duration_ms double, playback_duration_ms double, os string, cdn string")
    r = normalize_device_fields(apply_defaults(df), cols=("os", "cdn")).collect()[0]
    assert (r["timestamp_ms"], r["video_start_time_ms"], r["playback_failed"]) == (0, 0.0, False)
    assert (r["os"], r["cdn"]) == ("", "x")


def test_safe_ratio_java_semantics(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0), (1.0, float("nan")), (1.0, -2.0), (None, 2.0)],
                               "n double, d double")
    got = [r[0] for r in df.select(safe_ratio("n", "d")).collect()]
    assert got[:4] == [0.25, 0.0, 0.0, 0.0] and got[4] is None


def test_millis_round_trip_floors(spark):
    df = spark.createDataFrame([(dt.datetime(1969, 12, 31, 23, 59, 59, 999500),),
                                (dt.datetime(2024, 1, 1, 0, 0, 0, 1999),)], "ts timestamp_ntz")
    rows = df.select(ts_to_millis("ts").alias("ms")).withColumn("back", millis_to_ts("ms")).collect()
    assert rows[0]["ms"] == -1 and rows[0]["back"] == dt.datetime(1969, 12, 31, 23, 59, 59, 999000)
    assert rows[1]["ms"] == 1704067200001
    assert df.select(seconds_to_ms(F.lit(1.5))).collect()[0][0] == 1500.0
