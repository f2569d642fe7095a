"""Merging of micro-batch folders and expiry, beside readers and a running stream."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from pulseline.plans import fixtures as fx
from pulseline.plans import streams as S
from pulseline.schemas import DEAD_LETTER, EVENTS_TABLE
from pulseline.session import scratch_path
from pulseline.sources.batch_table import batch_partitions, load_manifest, read_batch_table
from pulseline.sources.events import read_events
from pulseline.streaming import maintenance as M
from pulseline.streaming.processor import Layout, run_stream, stored_elsewhere
from pulseline.streaming.sinks import write_dead_letters

T0 = dt.datetime(2024, 1, 1)


def letters(spark, path, batch, days, source="live"):
    rows = [(f"{source}-{batch}-{i}".encode(), "r", None, None if d is None else T0 + dt.timedelta(days=d))
            for i, d in enumerate(days)]
    df = spark.createDataFrame(rows, "payload binary, reason string, detail string, ingest_ts timestamp_ntz")
    write_dead_letters(df.repartition(3), path, batch, source)


def table(spark, path):
    return sorted(bytes(r.payload) for r in read_batch_table(spark, path, DEAD_LETTER).collect())


def data_files(*roots):
    return sum(f.endswith(".parquet") for root in roots
               for _, _, files in os.walk(root.removeprefix("file:")) for f in files)


def maintain(spark, path, **kw):
    return M.maintain(spark, path, DEAD_LETTER, "ingest_ts", merge_at=2, fanout=2, **kw)


def test_rows_stay_and_files_fall(spark):
    path = scratch_path(spark, "merge-test")
    for n in range(9):
        letters(spark, path, n, [n, n, None, n + 0.5], "a=b" if n % 4 == 0 else "live")
    whole, files = table(spark, path), data_files(path)
    running = read_batch_table(spark, path, DEAD_LETTER)          # planned before the merge
    maintain(spark, path)
    assert table(spark, path) == whole                            # folders beside their segments
    assert running.count() == len(whole)
    assert M.vacuum(spark, path) == 0 and running.count() == len(whole)   # within the grace period
    assert M.vacuum(spark, path, grace_seconds=0) == 7
    assert table(spark, path) == whole
    assert data_files(path, f"{path}-segments") < files / 2
    assert batch_partitions(spark, path) == {("a=b", 8), ("live", 7)}     # the newest of each source
    letters(spark, path, 7, [7], "live")                          # that one is written again
    assert len(table(spark, path)) == len(whole) - 3


def test_levels_keep_segments_few(spark):
    path = scratch_path(spark, "levels-test")
    for n in range(17):
        letters(spark, path, n, [n])
        maintain(spark, path)
    manifest = load_manifest(spark, path)
    assert len(manifest.segments) <= 4 and sum(s.rows for s in manifest.segments) + 1 + (16 - len(manifest.covered)) == 17
    assert len(table(spark, path)) == 17
    version = manifest.version
    assert maintain(spark, path).version == version               # nothing to do: no new manifest


def test_old_rows_expire_and_undated_ones_stay(spark):
    path = scratch_path(spark, "expiry-test")
    letters(spark, path, 0, [0, 1, 2])
    letters(spark, path, 1, [3])
    letters(spark, path, 2, [12])
    maintain(spark, path)                                         # one segment of days 0 to 3
    maintain(spark, path, keep_days=10)
    assert table(spark, path) == [b"live-0-2", b"live-1-0", b"live-2-0"]
    letters(spark, path, 3, [None, 14, 4])
    letters(spark, path, 4, [15])
    manifest = maintain(spark, path, keep_days=7)
    assert table(spark, path) == [b"live-2-0", b"live-3-0", b"live-3-1", b"live-4-0"]
    assert sum(s.rows for s in manifest.segments) == 3            # the first segment is gone, the second holds what is kept
    assert maintain(spark, path, keep_days=100).horizon == manifest.horizon   # never back
    maintain(spark, path, keep_days=7, now="2025-01-01 00:00:00")
    assert table(spark, path) == [b"live-3-0"]


def test_empty_table(spark):
    path = scratch_path(spark, "empty-test")
    letters(spark, path, 0, [1])
    assert maintain(spark, path, keep_days=7).segments == []
    M.maintain_layout(spark, Layout(scratch_path(spark, "nothing")))


def test_crash_before_the_manifest_changes_nothing(spark, monkeypatch):
    path = scratch_path(spark, "crash-test")
    for n in range(4):
        letters(spark, path, n, [n])
    monkeypatch.setattr(M, "save_manifest", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        maintain(spark, path)
    assert len(table(spark, path)) == 4 and not load_manifest(spark, path).version
    monkeypatch.undo()
    maintain(spark, path)
    assert len(table(spark, path)) == 4


def test_store_once_holds_after_merging(spark, sf_small):
    layout = S.maintained_run(spark, sf_small)
    assert load_manifest(spark, layout.events).segments
    ids = [r.event_id for r in read_events(spark, layout.events).select("event_id").collect()]
    assert len(ids) == len(set(ids))
    topic = S.stage(fx.topic_table(spark, sf_small), scratch_path(spark, "again"), [F.lit(True)])
    stream = S._topic_stream(spark, topic)
    run_stream(stream, layout, checkpoint=f"{layout.root}/_again", source_id="again").awaitTermination()
    assert read_events(spark, layout.events).count() == len(ids)
    assert stored_elsewhere(spark, layout.events, 0, "again").count() == len(ids)


def test_time_filters_reach_the_segments(spark, sf_small):
    layout = S.maintained_run(spark, sf_small)
    plan = (read_batch_table(spark, layout.events, EVENTS_TABLE).filter("ts >= timestamp_ntz'2024-01-20'")
            .select("event_id")._jdf.queryExecution().executedPlan().toString())
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2 and all("GreaterThanOrEqual(ts" in line and "client_id" not in line for line in scans)
