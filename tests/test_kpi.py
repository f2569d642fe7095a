import datetime as dt
import math

from pyspark.sql import functions as F

from conftest import hb_rows
from pulseline.operators import kpi


def test_vst_is_mean_of_all_events(spark):
    df = hb_rows(spark, [{"video_start_time_ms": v} for v in (90.0, 130.0, 1010.0)])
    rows = kpi.session_kpis(df).collect()
    assert len(rows) == 1
    assert rows[0]["avg_vst_ms"] == 410.0
    assert rows[0]["event_count"] == 3


def test_pfr_is_the_share_of_failed_starts(spark):
    df = hb_rows(spark, [{"playback_failed": i in (2, 5, 6)} for i in range(8)])
    assert kpi.session_kpis(df).collect()[0]["pfr"] == 0.375


def test_rebuffering_ratio_is_ratio_of_sums(spark):
    df = hb_rows(spark, [
        {"rebuffer_duration_ms": 300.0, "playback_duration_ms": 400.0},
        {"rebuffer_duration_ms": 100.0, "playback_duration_ms": 2800.0}])
    assert kpi.session_kpis(df).collect()[0]["rebuffering_ratio"] == 0.125


def test_empty_batch_yields_no_rows(spark):
    df = hb_rows(spark, [{"video_start_time_ms": 1.0}]).limit(0)
    assert kpi.session_kpis(df).count() == 0


def test_zero_and_nan_playback_give_zero_ratio(spark):
    df = hb_rows(spark, [
        {"session_id": "zero", "rebuffer_duration_ms": 10.0, "playback_duration_ms": 0.0},
        {"session_id": "nan", "rebuffer_duration_ms": 10.0, "playback_duration_ms": float("nan")}])
    got = {r["session_id"]: r["rebuffering_ratio"] for r in kpi.session_kpis(df).collect()}
    assert got == {"zero": 0.0, "nan": 0.0}


def test_failed_starts_count_in_vst(spark):
    df = hb_rows(spark, [{"video_start_time_ms": 300.0},
                         {"video_start_time_ms": 0.0, "playback_failed": True}])
    r = kpi.session_kpis(df).collect()[0]
    assert r["avg_vst_ms"] == 150.0 and r["pfr"] == 0.5


def test_window_bounds_are_min_and_max_time(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    df = hb_rows(spark, [{"ts": t0 + dt.timedelta(seconds=s)} for s in (30, 5, 17)])
    r = kpi.session_kpis(df).collect()[0]
    assert r["window_start"] == t0 + dt.timedelta(seconds=5)
    assert r["window_end"] == t0 + dt.timedelta(seconds=30)


def test_rollup_of_batch_parts_equals_direct(spark):
    rows = [{"session_id": f"s{i % 3}", "video_start_time_ms": float(i),
             "playback_failed": i % 4 == 0, "rebuffer_duration_ms": float(i % 5),
             "playback_duration_ms": float(100 + i)} for i in range(40)]
    df = hb_rows(spark, rows).withColumn("batch", F.col("video_start_time_ms") % 3)
    parts = kpi.session_kpi_parts(df, keys=("batch", "session_id"))
    rolled = {r["session_id"]: r for r in kpi.rollup_kpis(parts).collect()}
    direct = {r["session_id"]: r for r in kpi.session_kpis(df).collect()}
    for s, d in direct.items():
        for c in ("avg_vst_ms", "pfr", "rebuffering_ratio"):
            assert math.isclose(rolled[s][c], d[c], rel_tol=1e-12)
        assert rolled[s]["event_count"] == d["event_count"]


def test_headline_is_latest_session(spark):
    t0 = dt.datetime(2024, 1, 1)
    df = hb_rows(spark, [
        {"session_id": "a", "ts": t0, "video_start_time_ms": 1.0},
        {"session_id": "b", "ts": t0 + dt.timedelta(hours=1), "video_start_time_ms": 2.0},
        {"session_id": "c", "ts": t0 + dt.timedelta(hours=1), "video_start_time_ms": 3.0}])
    r = kpi.headline_kpis(df).collect()
    assert len(r) == 1 and r[0]["session_id"] == "c" and r[0]["avg_vst_ms"] == 3.0


def test_global_kpis_single_row(spark):
    df = hb_rows(spark, [{"session_id": f"s{i}", "video_start_time_ms": 10.0 * i} for i in range(5)])
    r = kpi.global_kpis(df).collect()
    assert len(r) == 1 and r[0]["avg_vst_ms"] == 20.0 and r[0]["event_count"] == 5


def test_timeseries_by_key_and_sliding(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = [{"session_id": s, "ts": t0 + dt.timedelta(minutes=m), "video_start_time_ms": 10.0 * m}
            for s, m in [("a", 0), ("a", 30), ("b", 61), ("a", 90)]]
    df = hb_rows(spark, rows)
    per = {(r["session_id"], r["window_start"]): r["event_count"]
           for r in kpi.kpi_timeseries(df, "1 hour", keys=("session_id",)).collect()}
    assert per == {("a", t0): 2, ("b", t0 + dt.timedelta(hours=1)): 1,
                   ("a", t0 + dt.timedelta(hours=1)): 1}
    sliding = kpi.kpi_timeseries(df, "1 hour", "30 minutes")
    assert sliding.agg(F.sum("event_count")).collect()[0][0] == 2 * len(rows)


def test_empty_input_global_and_headline(spark):
    empty = hb_rows(spark, [{"video_start_time_ms": 1.0}]).limit(0)
    assert kpi.headline_kpis(empty).count() == 0
    g = kpi.global_kpis(empty).collect()
    assert len(g) == 1 and g[0]["event_count"] == 0 and g[0]["avg_vst_ms"] == 0.0
