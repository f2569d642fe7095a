"""Windows that lose no late event."""

import datetime as dt

from conftest import hb_rows
from pyspark.sql import functions as F

from pulseline.functions.codec import encode_binary
from pulseline.operators import kpi
from pulseline.plans import fixtures as fx
from pulseline.session import scratch_path
from pulseline.sources.topic import heartbeat_stream
from pulseline.streaming.late import (
    WindowLayout, duration_ms, fold_late, late_events, process_window_batch, run_windows, seen_until, window_kpis,
)

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def batch(spark, *minutes, session="s"):
    return hb_rows(spark, [{"session_id": session, "ts": T0 + dt.timedelta(minutes=m), "video_start_time_ms": 10.0 * m,
                            "playback_duration_ms": 100.0, "rebuffer_duration_ms": 5.0} for m in minutes])


def counts(df):
    return sorted((r.session_id, str(r.window_start)[11:16], r.event_count) for r in df.collect())


def test_late_events_go_aside_and_are_folded_once(spark):
    layout = WindowLayout(scratch_path(spark, "late"))
    args = (layout, "30 minutes", "10 minutes")
    assert window_kpis(spark, layout).count() == 0 and fold_late(spark, layout, "30 minutes") == 0
    process_window_batch(batch(spark, 0, 5, 61), 0, *args)
    process_window_batch(batch(spark, 1, 29, 35, 62), 1, *args)     # the line is 51 minutes: the first window has ended
    assert seen_until(spark, layout, 1) == 1704103200000 + 61 * 60_000
    assert sorted(r.ts.minute for r in late_events(spark, layout).collect()) == [1, 29]
    assert counts(window_kpis(spark, layout)) == [("s", "10:00", 2), ("s", "10:30", 1), ("s", "11:00", 2)]
    assert counts(window_kpis(spark, layout, watermark="10 minutes")) == [("s", "10:00", 2)]
    process_window_batch(batch(spark, 1, 29, 35, 62), 1, *args)     # a retry
    assert late_events(spark, layout).count() == 2
    assert fold_late(spark, layout, "30 minutes") == 1 and fold_late(spark, layout, "30 minutes") == 0
    assert counts(window_kpis(spark, layout)) == [("s", "10:00", 4), ("s", "10:30", 1), ("s", "11:00", 2)]
    process_window_batch(batch(spark, 2, 200, session="t"), 2, *args)
    process_window_batch(batch(spark).limit(0), 3, *args)
    process_window_batch(batch(spark, 3), 4, *args)
    assert fold_late(spark, layout, "30 minutes") == 2
    want = kpi.kpi_timeseries(batch(spark, 0, 5, 61, 1, 29, 35, 62, 3).unionByName(batch(spark, 2, 200, session="t")),
                              "30 minutes", keys=("session_id",))
    got = window_kpis(spark, layout).select(*want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_random_delivery_equals_batch_and_has_late_rows(spark, sf_small):
    root = scratch_path(spark, "late-stream")
    (fx.clean_topic_table(spark, sf_small).repartition(6, F.xxhash64("offset")).write.parquet(f"{root}/topic"))
    layout = WindowLayout(f"{root}/out")
    q = run_windows(heartbeat_stream(spark, f"{root}/topic", max_files_per_trigger=2), layout, "1 day", "10 minutes")
    q.awaitTermination()
    assert q.lastProgress["batchId"] >= 2 and late_events(spark, layout).count() > 100
    want = kpi.kpi_timeseries(fx.heartbeats(spark, sf_small), "1 day", keys=("session_id",))
    cols = ["session_id", "window_start", "window_end", "event_count"]
    before = window_kpis(spark, layout).agg(F.sum("event_count")).first()[0]
    assert before < fx.heartbeats(spark, sf_small).count()
    fold_late(spark, layout, "1 day")
    got = window_kpis(spark, layout)
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0
    assert want.select(*cols).exceptAll(got.select(*cols)).count() == 0


def test_durations():
    assert [duration_ms(x) for x in ("1 second", "10 minutes", "2 hours", "1 day")] == [1000, 600_000, 7_200_000, 86_400_000]


def test_hot_id_is_reduced_before_the_shuffle(spark):
    from pulseline.streaming.windows import dedup_stream, drop_repeats_in_task
    root = scratch_path(spark, "hot-id")
    rows = [{"event_id": "hot" if i % 3 == 0 else f"e{i}", "ts": T0 + dt.timedelta(seconds=i)} for i in range(900)]
    df = hb_rows(spark, rows).repartition(4)
    left = drop_repeats_in_task(df)
    assert left.filter("event_id = 'hot'").count() <= 4 and left.count() <= 604
    assert drop_repeats_in_task(df, held=10).select("event_id").distinct().count() == 601
    df.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{root}/in")
    q = dedup_stream(stream, "1 hour").writeStream.format("memory").queryName("hot_id").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("hot_id").count() == 601
    plan = q._jsq.explainInternal(False) if hasattr(q._jsq, "explainInternal") else ""
    assert plan.index("Exchange") < plan.index("MapInArrow")       # children come after their parents
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] == 601


def test_encoded_rows_without_time_are_left_out(spark):
    layout = WindowLayout(scratch_path(spark, "late-null"))
    rows = batch(spark, 1).unionByName(hb_rows(spark, [{"ts": None, "session_id": "s"}]))
    process_window_batch(rows, 0, layout, "30 minutes", "10 minutes")
    assert counts(window_kpis(spark, layout)) == [("s", "10:00", 1)]
    assert encode_binary(batch(spark, 1)).count() == 1
