"""Work per row and per micro-batch that must not grow with the input."""

import importlib
import json
from concurrent.futures import ThreadPoolExecutor
from threading import Lock
from time import sleep

import pytest
from pyspark.sql import functions as F

from pulseline.functions.codec import decode_binary, encode_binary
from pulseline.operators.quarantine import classify_requests, split_valid
from pulseline.plans import fixtures as fx
from pulseline.plans import streams
from pulseline.session import count_files, scratch_path
from pulseline.sources import topic_log
from pulseline.sources.json_source import decode_json
from pulseline.sources.topic_log import TopicLogReader, append_log, drain_group, log_stream
from pulseline.streaming.processor import Layout
from tests.conftest import hb_rows

R = importlib.import_module("pulseline.streaming.replay")     # the package exports its function by that name


def topic(spark, n):
    rows = hb_rows(spark, [{"session_id": f"s{i % 7}"} for i in range(n)])
    return encode_binary(rows).select(
        F.col("session_id").alias("key"), "value", F.pmod(F.hash("session_id"), F.lit(5)).alias("partition"),
        F.expr("CAST(substr(event_id, 2) AS BIGINT)").alias("offset"), F.col("ts").alias("timestamp"))


def batches_of(query):
    return [p.numInputRows for p in query.recentProgress if p.numInputRows]


def test_a_long_backlog_takes_more_slices_a_batch(spark, monkeypatch):
    root = scratch_path(spark, "test-long-backlog")
    R.write_backlog(topic(spark, 120).coalesce(1), f"{root}/backlog", 10)
    files = count_files(spark, f"{root}/backlog")
    assert files >= 12 and count_files(spark, f"{root}/none") == 0
    layout = Layout(f"{root}/out")
    few = R.replay(spark, f"{root}/backlog", layout, "few", slices_per_trigger=1, batches=3)
    assert len(batches_of(few)) <= 3 and sum(batches_of(few)) == 120
    assert spark.read.parquet(layout.events).select("event_id").distinct().count() == 120
    monkeypatch.setattr(R, "MOST_SLICES", 2)        # a batch stays bounded however long the backlog is
    bounded = R.replay(spark, f"{root}/backlog", Layout(f"{root}/bounded"), "bounded", slices_per_trigger=1, batches=3)
    assert max(batches_of(bounded)) <= 20 and sum(batches_of(bounded)) == 120


def test_consumers_share_the_partitions_of_a_log(spark):
    root = scratch_path(spark, "test-consumers")
    append_log(topic(spark, 100), f"{root}/log")
    whole = TopicLogReader(f"{root}/log", 1000, 0, None).latestOffset()
    shares = [TopicLogReader(f"{root}/log", 1000, 0, None, k, 3).latestOffset() for k in range(3)]
    assert sum(map(len, shares)) == len(whole) and {p: n for s in shares for p, n in s.items()} == whole
    assert all(int(p) % 3 == k for k, s in enumerate(shares) for p in s)
    assert sum(TopicLogReader(f"{root}/log", 7, 0, None, 0, 1).latestOffset().values()) == 7


def test_few_consumers_run_at_a_time(spark, sf_small, monkeypatch):
    started, begin = [], streams._consume

    def consume(session, root, k):
        query = begin(session, root, k)
        started.append((k, len(session.streams.active)))
        return query

    monkeypatch.setattr(streams, "_consume", consume)
    monkeypatch.setattr(streams, "CONSUMERS", 7)
    rows = streams.q_bounded_ingest(spark, sf_small).collect()
    assert sorted(k for k, _ in started) == sorted([*range(7)] * 2)
    assert max(n for _, n in started) <= topic_log.AT_ONCE and not spark.streams.active
    assert all(r.within_bound for r in rows)
    want = fx.clean_topic_table(spark, sf_small).select("key", "partition", "offset").collect()
    assert sorted((r.key, r.partition, r.offset) for r in rows) == sorted(map(tuple, want))


class Consumer:
    """A query that is up after a moment, and what its group did."""

    def __init__(self, group, k):
        self.group, self.k, self.isActive, self.asked = group, k, True, 0
        with group.lock:
            group.running += 1
            group.begun.append(k)

    @property
    def status(self):
        self.asked += 1
        with self.group.lock:
            self.group.waiting = {*self.group.waiting, self.k} if self.asked < 3 else self.group.waiting - {self.k}
            self.group.most_waiting = max(self.group.most_waiting, len(self.group.waiting))
            self.group.most = max(self.group.most, self.group.running)
        return {"message": "Initializing sources" if self.asked < 3 else "Waiting for data to arrive"}

    def processAllAvailable(self):
        if self.k == self.group.lost:
            raise RuntimeError("lost")
        sleep(0.02)

    def stop(self):
        with self.group.lock:
            self.group.running -= 1


class Group:
    def __init__(self, lost=None):
        self.lost, self.lock, self.begun, self.waiting = lost, Lock(), [], set()
        self.running = self.most = self.most_waiting = 0


def test_a_group_is_drained_a_few_at_a_time():
    group = Group()
    drain_group(lambda k: Consumer(group, k), 12, 4)
    assert sorted(group.begun) == list(range(12)) and group.running == 0
    assert 1 < group.most <= 4 and group.most_waiting <= topic_log.STARTING
    group = Group(lost=1)
    with pytest.raises(RuntimeError, match="lost"):
        drain_group(lambda k: Consumer(group, k), 40, 4)
    assert group.running == 0 and len(group.begun) < 40       # what ran was stopped, the rest not begun


def test_streams_are_made_in_several_threads(spark):
    root = scratch_path(spark, "test-threads")
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda k: log_stream(spark, f"{root}/log", f"{root}/ckpt-{k}", consumer=k, consumers=8), range(8)))
    assert all(s.isStreaming for s in made)


def test_a_task_reads_several_topic_partitions(spark, monkeypatch):
    root = scratch_path(spark, "test-tasks")
    records = topic(spark, 100)
    append_log(records, f"{root}/log")
    reader = TopicLogReader(f"{root}/log", 60, 0, None)
    end = reader.latestOffset()
    assert len(end) > 1 and sum(end.values()) == 60
    (task,) = reader.partitions({}, end)
    read = [r for b in reader.read(task) for r in b.to_pylist()]
    want = {(r.partition, r.offset) for r in records.collect()}
    assert len(read) == 60 and {(r["partition"], r["offset"]) for r in read} <= want
    assert {str(r["partition"]) for r in read} == {p for p, n in end.items() if n}
    monkeypatch.setattr(topic_log, "TASK_RECORDS", 20)      # many records still go to many tasks
    tasks = reader.partitions({}, end)
    assert len(tasks) >= 3
    assert sorted(r["offset"] for t in tasks for b in reader.read(t) for r in b.to_pylist()) == sorted(r["offset"] for r in read)


def test_requests_are_read_once_per_field(spark):
    doc = {"eventId": "e", "sessionId": "s", "clientId": "c", "contentId": "x", "timestampMs": 5}
    df = spark.createDataFrame([(1, json.dumps(doc)), (2, json.dumps({**doc, "eventId": "{no object"})),
                                (3, json.dumps({**doc, "os": ["a"]})), (4, json.dumps({**doc, "eventId": " "}))],
                               "request_id int, body string")
    got = {r.request_id: (r.event_id, r.reason) for r in classify_requests(decode_json(df)).collect()}
    assert got[1] == ("e", None) and got[2] == ("{no object", None)
    assert got[3][1] == "deserialization-failure" and got[4][1] == "validation-failure"
    rejected = split_valid(decode_json(df))[1].select("reason")
    plan = rejected._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get") <= 7


def test_encoding_returns_the_columns_asked_for(spark):
    rows = hb_rows(spark, [{"session_id": "s", "video_start_time_ms": 1.5}, {}]).withColumn("extra", F.lit(3))
    few = encode_binary(rows, keep=["extra", "event_id"])
    assert few.columns == ["extra", "event_id", "value"]
    assert sorted(map(tuple, few.collect())) == sorted(
        map(tuple, encode_binary(rows).select("extra", "event_id", "value").collect()))
    assert decode_binary(few.select("value")).filter("decode_error IS NULL").count() == 2
