"""The record-bounded log source."""

import datetime as dt
import time

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pulseline.plans import fixtures as fx
from pulseline.session import list_names, scratch_path
from pulseline.sources.topic_log import TopicLogReader, append_log, drain, log_stream, share_out
from pulseline.streaming.processor import Layout, run_stream
from pulseline.streaming.sinks import write_batch_partition


def records(spark, lo, hi, partitions=3):
    n = F.col("id")
    return spark.range(lo, hi).select(
        F.concat(F.lit("session-"), n).alias("key"), F.encode(n.cast("string"), "UTF-8").alias("value"),
        F.when(n % 4 < 2, 0).otherwise(n % partitions).cast("int").alias("partition"), n.alias("offset"),
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("timestamp"))


def run(spark, root, most, linger=0.0):
    stream = log_stream(spark, f"{root}/log", f"{root}/ckpt", most, linger)
    keep = lambda df, n: write_batch_partition(df, f"{root}/out", n)
    return stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{root}/ckpt").start()


def sizes(spark, root):
    rows = spark.read.parquet(f"{root}/out").groupBy("batch_id").count().collect()
    return [r["count"] for r in sorted(rows, key=lambda r: r.batch_id)]


def test_batches_are_bounded_and_a_restart_loses_and_repeats_nothing(spark):
    root = scratch_path(spark, "log")
    append_log(records(spark, 0, 500), f"{root}/log")
    drain(run(spark, root, 120))
    assert sizes(spark, root) == [120, 120, 120, 120, 20]
    append_log(records(spark, 500, 730), f"{root}/log")
    append_log(records(spark, 730, 740, 5), f"{root}/log")      # a new topic partition appears
    drain(run(spark, root, 120))
    assert sizes(spark, root) == [120, 120, 120, 120, 20, 120, 120]
    drain(run(spark, root, 120))                                # nothing left
    out = spark.read.parquet(f"{root}/out")
    assert sorted(r.offset for r in out.collect()) == list(range(740))
    want = records(spark, 0, 730).unionByName(records(spark, 730, 740, 5))
    got = out.select(*want.columns)
    assert got.exceptAll(want).count() == 0
    # within a topic partition batches follow the offsets
    spans = out.groupBy("partition", "batch_id").agg(F.min("offset").alias("lo"), F.max("offset").alias("hi")).collect()
    for a in spans:
        assert all(a.hi < b.lo for b in spans if b.partition == a.partition and b.batch_id > a.batch_id)


def test_a_failed_batch_is_read_again_alike(spark):
    root = scratch_path(spark, "log-fail")
    append_log(records(spark, 0, 100), f"{root}/log")

    def fail(df, n):
        if n == 1:
            raise RuntimeError("lost")
        write_batch_partition(df, f"{root}/out", n)

    stream = log_stream(spark, f"{root}/log", f"{root}/ckpt", 30)
    query = stream.writeStream.foreachBatch(fail).option("checkpointLocation", f"{root}/ckpt").start()
    with pytest.raises(Exception):
        query.processAllAvailable()
    drain(run(spark, root, 30))
    assert sizes(spark, root) == [30, 30, 30, 10]
    assert sorted(r.offset for r in spark.read.parquet(f"{root}/out").collect()) == list(range(100))


def test_ingest_from_the_log_equals_the_file_stream(spark, sf_small):
    root = scratch_path(spark, "log-ingest")
    topic = fx.clean_topic_table(spark, sf_small)
    append_log(topic, f"{root}/log")
    layout = Layout(f"{root}/out")
    drain(run_stream(log_stream(spark, f"{root}/log", layout.checkpoint, 400), layout, available_now=False))
    ids = spark.read.parquet(layout.events).select("event_id")
    want = fx.heartbeats(spark, sf_small).select("event_id")
    assert ids.exceptAll(want).count() == 0 and want.exceptAll(ids).count() == 0
    assert len(list_names(spark, f"{layout.events}/source_id=live")) >= -(-want.count() // 400)


@given(st.dictionaries(st.integers(0, 30), st.integers(1, 500), min_size=1, max_size=12), st.integers(1, 1500))
def test_shares_fill_the_batch(lag, most):
    take = share_out(lag, most)
    assert sum(take.values()) == min(most, sum(lag.values()))
    assert all(0 <= take[p] <= lag[p] for p in lag)


def test_a_batch_closes_when_full_or_after_the_linger(spark):
    root = scratch_path(spark, "log-linger")
    append_log(records(spark, 0, 25, 1), f"{root}/log")
    reader = TopicLogReader(f"{root}/log", 10, 0.4, None)
    assert [sum(reader.latestOffset().values()) for _ in range(3)] == [10, 20, 20]     # five wait for more
    time.sleep(0.5)
    assert sum(reader.latestOffset().values()) == 25
    assert sum(reader.latestOffset().values()) == 25
    append_log(records(spark, 25, 60, 1), f"{root}/log")
    assert sum(reader.latestOffset().values()) == 35                                   # full at once
    assert TopicLogReader(f"{root}/none", 10, 0, None).latestOffset() == {}
    slices = reader.partitions({"0": 8}, {"0": 30})
    assert sum(high - low for s in slices for _, low, high in s.files) == 22 and reader.partitions({"0": 5}, {"0": 5}) == []


def test_a_segment_is_read_when_it_is_complete(spark):
    root = scratch_path(spark, "log-partial")
    append_log(records(spark, 0, 5, 1), f"{root}/log")
    records(spark, 5, 9, 1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false") \
        .partitionBy("partition").parquet(f"{root}/log/segment-000000000001")
    assert sum(TopicLogReader(f"{root}/log", 100, 0, None).latestOffset().values()) == 5
