import math

from pyspark.sql import functions as F

from pulseline.functions.codec import decode_binary, split_decoded
from pulseline.operators import dedup, kpi
from pulseline.plans import fixtures as fx
from pulseline.plans import streams as S
from pulseline.schemas import HEARTBEAT_COLUMNS
from pulseline.session import scratch_path
from pulseline.sources.topic import heartbeat_stream, read_topic
from pulseline.streaming.processor import Layout, process_batch, read_table_if_exists, run_stream
from pulseline.streaming.windows import dedup_stream, stream_kpis


def _staged(spark, sf_small):
    root = scratch_path(spark, "test-stream")
    return root, S.stage(fx.topic_table(spark, sf_small), f"{root}/topic", S.record_segments(spark, sf_small))


def test_stream_equals_batch(spark, sf_small):
    root, src = _staged(spark, sf_small)
    layout = Layout(f"{root}/out")
    q = run_stream(heartbeat_stream(spark, src, max_files_per_trigger=S.FILES_PER_TRIGGER), layout)
    q.awaitTermination()
    assert len(q.recentProgress) >= 3          # several micro-batches really ran

    decoded = decode_binary(read_topic(spark, src))
    good, bad = split_decoded(decoded)
    hb = good.select(F.col("offset").alias("arrival_seq"), *HEARTBEAT_COLUMNS)
    want = dedup.dedup_events(hb).select(*HEARTBEAT_COLUMNS)
    got = spark.read.parquet(layout.events).select(*HEARTBEAT_COLUMNS)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0

    # KPIs see every decoded event, duplicates included (parity)
    rolled = {r["session_id"]: r for r in kpi.rollup_kpis(spark.read.parquet(layout.metrics)).collect()}
    direct = {r["session_id"]: r for r in kpi.session_kpis(hb).collect()}
    assert rolled.keys() == direct.keys()
    for s, d in direct.items():
        assert rolled[s]["event_count"] == d["event_count"]
        assert math.isclose(rolled[s]["avg_vst_ms"], d["avg_vst_ms"], rel_tol=1e-9)
        assert math.isclose(rolled[s]["rebuffering_ratio"], d["rebuffering_ratio"], rel_tol=1e-9)

    assert spark.read.parquet(layout.dead_letters).count() == bad.count()


def test_rerun_of_a_batch_is_idempotent(spark, sf_small):
    root, src = _staged(spark, sf_small)
    layout = Layout(f"{root}/out")
    batch = read_topic(spark, src)
    process_batch(batch, 0, layout)
    first = spark.read.parquet(layout.events).count(), spark.read.parquet(layout.metrics).count()
    process_batch(batch, 0, layout)             # retry of the same batch
    again = spark.read.parquet(layout.events).count(), spark.read.parquet(layout.metrics).count()
    assert first == again
    # the next batch with the same records stores nothing new
    process_batch(batch, 1, layout)
    assert spark.read.parquet(layout.events).filter("batch_id = 1").count() == 0


def test_empty_batch_writes_nothing(spark, sf_small):
    root, src = _staged(spark, sf_small)
    layout = Layout(f"{root}/out")
    process_batch(read_topic(spark, src).limit(0), 0, layout)
    assert read_table_if_exists(spark, layout.events) is None
    assert read_table_if_exists(spark, layout.metrics) is None


def test_window_kpis_equal_batch(spark, sf_small):
    got = S.q_stream_window_kpis(spark, sf_small)
    want = kpi.kpi_timeseries(fx.heartbeats(spark, sf_small), "1 day", keys=("session_id",))
    assert want.count() > 0
    cols = ["session_id", "window_start", "window_end", "event_count"]
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0
    assert want.select(*cols).exceptAll(got.select(*cols)).count() == 0


def test_dedup_stream_drops_redeliveries(spark, sf_small):
    root, src = _staged(spark, sf_small)
    good, _ = split_decoded(decode_binary(heartbeat_stream(spark, src, max_files_per_trigger=S.FILES_PER_TRIGGER)))
    q = (dedup_stream(good, "365 days").writeStream.format("memory").queryName("dedup_test")
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table("dedup_test")
    assert got.count() == got.select("event_id").distinct().count()


def test_lookup_horizon_keeps_results_when_ids_are_recent(spark, sf_small):
    root, src = _staged(spark, sf_small)
    full, bounded = Layout(f"{root}/full"), Layout(f"{root}/bounded")
    run_stream(heartbeat_stream(spark, src, max_files_per_trigger=S.FILES_PER_TRIGGER), full).awaitTermination()
    # redeliveries arrive within the same 31-day span, so a 40-day horizon is exact
    run_stream(heartbeat_stream(spark, src, max_files_per_trigger=S.FILES_PER_TRIGGER), bounded,
               lookup_horizon="40 days").awaitTermination()
    a = spark.read.parquet(full.events).drop("source_id", "batch_id")
    b = spark.read.parquet(bounded.events).drop("source_id", "batch_id")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_observed_ingest_metrics(spark, sf_small):
    root, src = _staged(spark, sf_small)
    q = run_stream(heartbeat_stream(spark, src, max_files_per_trigger=2), Layout(f"{root}/out"))
    q.awaitTermination()
    total = read_topic(spark, src).count()
    seen = sum(p["observedMetrics"]["ingest"]["consumed"] for p in q.recentProgress
               if p.get("observedMetrics"))
    assert seen == total


def test_replay_library_absorbs_duplicates(spark, sf_small):
    from pulseline.streaming.replay import replay, replay_dead_letters, write_backlog
    root, src = _staged(spark, sf_small)
    layout = Layout(f"{root}/out")
    run_stream(heartbeat_stream(spark, src, max_files_per_trigger=S.FILES_PER_TRIGGER), layout).awaitTermination()
    before = spark.read.parquet(layout.events).count()
    # replay part of the already consumed topic as a backlog: nothing new is stored
    write_backlog(read_topic(spark, src).limit(700), f"{root}/backlog", 250)
    q = replay(spark, f"{root}/backlog", layout, "seen", slices_per_trigger=1)
    assert len(q.recentProgress) >= 3
    assert spark.read.parquet(layout.events).count() == before
    recovered, report = replay_dead_letters(spark.read.parquet(layout.dead_letters))
    assert recovered.count() == 0
    assert report.filter("recovered > 0").count() == 0


def test_sources_see_each_other_and_keep_their_partitions(spark, sf_small):
    from pulseline.streaming.replay import replay, write_backlog
    root, src = _staged(spark, sf_small)
    records = read_topic(spark, src)
    layout = Layout(f"{root}/out")
    one, two = (records.filter(F.pmod(F.col("offset"), F.lit(3)) == k) for k in (0, 1))
    for name, part in (("one", one), ("two", two)):
        write_backlog(part, f"{root}/{name}", 400)
        replay(spark, f"{root}/{name}", layout, name, slices_per_trigger=2)
    stored = lambda: spark.read.parquet(layout.events)
    first = stored().filter("source_id = 'replay-one'").count()
    assert first > 0 and stored().filter("source_id = 'replay-two'").count() > 0
    process_batch(records, 0, layout)           # the live topic delivers everything again
    again = stored().count()
    process_batch(records, 0, layout)           # and retries the batch
    assert stored().count() == again == stored().select("event_id").distinct().count()
    assert stored().filter("source_id = 'replay-one'").count() == first
    # a second run of a drained backlog adds nothing
    replay(spark, f"{root}/one", layout, "one")
    assert stored().count() == again


def test_blank_ids_and_missing_times_take_the_side_output(spark):
    import datetime as dt
    from pulseline.streaming.windows import split_identified
    t0, epoch = dt.datetime(2024, 1, 1), dt.datetime(1970, 1, 1)
    df = spark.createDataFrame([("a", t0), (" ", t0), (None, t0), ("b", epoch), ("c", None)], "event_id string, ts timestamp_ntz")
    ok, rest = split_identified(df)
    assert [r["event_id"] for r in ok.collect()] == ["a"] and rest.count() == 4


def test_a_cluster_needs_a_shared_checkpoint_folder():
    from types import SimpleNamespace as N

    import pytest

    from pulseline.session import ensure_checkpoint_dir
    conf = N(get=lambda key, default=None: default)
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError):
            ensure_checkpoint_dir(N(conf=conf, sparkContext=N(getCheckpointDir=lambda: None, master=master)))


def test_session_windows_by_gap(spark):
    import datetime as dt
    root = scratch_path(spark, "test-session-window")
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = [("a", t0), ("a", t0 + dt.timedelta(minutes=5)), ("a", t0 + dt.timedelta(hours=2)),
            ("b", t0 + dt.timedelta(minutes=1)), ("z", t0 + dt.timedelta(days=2))]
    df = spark.createDataFrame(
        [(f"e{i}", s, ts, 100.0, False, 0.0, 1000.0) for i, (s, ts) in enumerate(rows)],
        "event_id string, session_id string, ts timestamp_ntz, video_start_time_ms double, "
        "playback_failed boolean, rebuffer_duration_ms double, playback_duration_ms double")
    df.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{root}/in")
    q = (stream_kpis(stream, watermark="1 hour", session_gap="30 minutes").writeStream
         .format("memory").queryName("sess_test").outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r["session_id"], r["event_count"], str(r["window_start"]))
                 for r in spark.table("sess_test").collect())
    # "z" (two days later) moves the watermark past every earlier session window
    assert got == [("a", 1, "2024-01-01 12:00:00"), ("a", 2, "2024-01-01 10:00:00"),
                   ("b", 1, "2024-01-01 10:01:00")]


def test_kpis_on_accepted_rows_only(spark, sf_small):
    root, src = _staged(spark, sf_small)
    layout = Layout(f"{root}/out")
    run_stream(heartbeat_stream(spark, src, max_files_per_trigger=S.FILES_PER_TRIGGER), layout,
               kpi_on="accepted").awaitTermination()
    stored = spark.read.parquet(layout.events).count()
    kpi_events = spark.read.parquet(layout.metrics).agg(F.sum("event_count")).collect()[0][0]
    assert kpi_events == stored


def test_dead_letter_retention_window(spark):
    import datetime as dt
    from pulseline.streaming.replay import retained_dead_letters
    t0 = dt.datetime(2024, 1, 20)
    dead = spark.createDataFrame(
        [(b"x", "r", None, t0 - dt.timedelta(days=d)) for d in (0, 3, 7, 8)],
        "payload binary, reason string, detail string, ingest_ts timestamp_ntz")
    assert retained_dead_letters(dead).count() == 3                       # newest-relative
    assert retained_dead_letters(dead, now=t0 + dt.timedelta(days=2)).count() == 2


def test_processing_time_trigger_runs_until_stopped(spark, sf_small):
    root, src = _staged(spark, sf_small)
    layout = Layout(f"{root}/out")
    q = run_stream(heartbeat_stream(spark, src), layout, available_now=False, processing_time="1 second")
    try:
        q.processAllAvailable()
        assert q.isActive
        first = spark.read.parquet(layout.events).count()
        read_topic(spark, src).limit(50).write.mode("append").parquet(src)  # more of the same: nothing new
        q.processAllAvailable()
        assert spark.read.parquet(layout.events).count() == first > 0
        assert spark.read.parquet(layout.metrics).select("batch_id").distinct().count() >= 2
    finally:
        q.stop()


def test_binary_rows_that_break_a_constraint_become_letters(spark, sf_small):
    root, src = _staged(spark, sf_small)
    loose, strict = Layout(f"{root}/loose"), Layout(f"{root}/strict")
    process_batch(read_topic(spark, src), 0, loose)
    process_batch(read_topic(spark, src), 0, strict, validate_binary=True)
    blank = spark.read.parquet(loose.events).filter("event_id = ''").count()
    assert blank == 1 and spark.read.parquet(strict.events).filter("event_id = ''").count() == 0
    letters = spark.read.parquet(strict.dead_letters).filter("reason = 'validation-failure'").collect()
    assert letters and all("eventId: must not be blank" in r["detail"] and "timestampMs" in r["detail"] for r in letters)


def test_older_files_give_null_for_newer_columns(spark):
    from pulseline.sources.events import read_events
    path = scratch_path(spark, "test-widen")
    (spark.range(3).selectExpr("cast(id as string) event_id", "'s' session_id", "'live' source_id", "0L batch_id")
          .write.partitionBy("source_id", "batch_id").parquet(path))
    rows = read_events(spark, path).collect()
    assert len(rows) == 3 and {r["cdn"] for r in rows} == {None} and {r["source_id"] for r in rows} == {"live"}
