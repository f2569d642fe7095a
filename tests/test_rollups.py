"""Percentile parts and the batch ledger."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from pulseline.operators import reports
from pulseline.plans import fixtures as fx
from pulseline.plans import streams as S
from pulseline.session import scratch_path
from pulseline.sources.topic import heartbeat_stream
from pulseline.streaming.latency import bucket, latency_parts, latency_quantiles
from pulseline.streaming.ledger import BatchLedger, read_ledger
from pulseline.streaming.processor import Layout, run_stream

T0 = dt.datetime(2024, 1, 1)


def test_buckets_keep_eight_bits(spark):
    rng = random.Random(2)
    values = [-5, 0, 1, 255, 256, 257, 511, 512, (1 << 62) + 12345, *[rng.randrange(1 << rng.randrange(1, 60)) for _ in range(300)]]
    rows = spark.createDataFrame([(v,) for v in values], "v bigint").select("v", bucket(F.col("v")).alias("b")).collect()
    for r in rows:
        v = max(r.v, 0)
        shift = max(v.bit_length() - 8, 0)
        assert r.b == (v >> shift) << shift and v - r.b <= v / 128


def test_parts_add_up_for_any_cut_and_stay_within_the_bound(spark):
    rng = random.Random(4)
    rows = [(i, T0 + dt.timedelta(hours=rng.randrange(72)), int(rng.expovariate(1e-7)), False) for i in range(3000)]
    rows += [(9001, T0, None, False)]
    log = spark.createDataFrame(rows, "request_id long, received_at timestamp_ntz, latency_ns long, error boolean")
    whole = sorted(map(tuple, latency_quantiles(latency_parts(log)).collect()))
    cut = [latency_parts(log.filter(F.pmod("request_id", F.lit(7)) == k)) for k in range(7)]
    parts = cut[0]
    for c in cut[1:]:
        parts = parts.unionByName(c)
    assert sorted(map(tuple, latency_quantiles(parts).collect())) == whole and len(whole) == 3
    for day, n, *found in whole:
        held = sorted(v for _, t, v, _ in rows if v is not None and t.date() == day.date())
        assert n == len(held)
        for percent, got in zip((50, 95, 99), found):
            exact = held[math.ceil(n * percent / 100) - 1]
            assert got <= exact <= got * (1 + 1 / 128) + 1
    exact = {r.period_start: r.p99_latency_ms for r in reports.sla_report(log.filter("latency_ns is not null")).collect()}
    for day, n, _, _, p99 in whole:   # the service-level report interpolates between neighbours
        assert abs(p99 / 1e6 - exact[day]) < 0.1 * exact[day]


def test_ledger_holds_every_batch_once(spark, sf_small):
    root = scratch_path(spark, "ledger-test")
    src = S.stage(fx.topic_table(spark, sf_small), f"{root}/topic", S.record_segments(spark, sf_small))
    ledger = BatchLedger(spark, f"{root}/ledger")
    spark.streams.addListener(ledger)
    try:
        layout, failed = Layout(f"{root}/out"), []

        def run():
            q = run_stream(heartbeat_stream(spark, src, max_files_per_trigger=16), layout)
            q.awaitTermination()
            ledger.settle(q)
            return q
        first = run()
        before = read_ledger(spark, f"{root}/ledger").collect()
        assert len(before) == len([p for p in first.recentProgress if p.numInputRows]) >= 2 and not failed
        run()                                                     # nothing new: no entry
        assert len(read_ledger(spark, f"{root}/ledger").collect()) == len(before)
        fx.topic_table(spark, sf_small).limit(40).write.mode("append").parquet(src)
        run()
        after = read_ledger(spark, f"{root}/ledger").collect()
        assert len(after) == len(before) + 1 and sum(r.consumed for r in after) - sum(r.consumed for r in before) == 40
        assert len({(r.query_id, r.batch_id) for r in after}) == len(after)
        assert all(r.consumed == r.ok + r.dead_lettered for r in after)
    finally:
        spark.streams.removeListener(ledger)
