import datetime as dt
import random

from pyspark.sql import functions as F

from pulseline.operators import reports
from pulseline.plans import fixtures as fx


def _log(spark, sf_small):
    return fx.latency_log(fx.heartbeats(spark, sf_small))


def test_sla_report_p99_equals_percentile(spark, sf_small):
    log = _log(spark, sf_small)
    got = {r["period_start"]: r for r in reports.sla_report(log).collect()}
    want = (log.groupBy(F.window("received_at", "1 day").alias("w"))
               .agg(F.percentile(F.col("latency_ns") / F.lit(1e6), 0.99).alias("p"), F.count(F.lit(1)).alias("n")).collect())
    assert len(got) == len(want)
    for r in want:
        mine = got[r["w"]["start"]]
        assert abs(mine["p99_latency_ms"] - r["p"]) < 1e-9 and mine["requests"] == r["n"]


def test_exact_quantile_over_the_whole_value_range(spark):
    rng = random.Random(5)
    groups = {
        "ties": [7] * 500, "one": [123_456_789_012], "two": [1, 2], "zero": [0, 0, 5],
        "wide": [rng.randrange(2**40) for _ in range(400)] + [2**55, 3],
        "near": [10**9 + rng.randrange(3) for _ in range(1000)],
        "negative": [-5, -4, 2**33, 9],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("one", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v long")
    for q in (0.0, 0.5, 0.99, 1.0):
        got = {r["g"]: r for r in reports.exact_quantile(df, "g", "v", q).collect()}
        assert set(got) == set(groups)
        for g, vs in groups.items():
            vs = sorted(vs)
            place = (len(vs) - 1) * q
            low = int(place)
            assert (got[g]["low"], got[g]["high"]) == (vs[low], vs[min(low + 1, len(vs) - 1)])
            assert abs(got[g]["weight"] - (place - low)) < 1e-9


def test_whole_milliseconds_truncate_and_far_dates_keep_their_millisecond(spark):
    from pulseline.functions.scalars import millis_to_ts, nanos_to_whole_ms, ts_to_millis
    far = [253402300799999 - i for i in range(50)] + [-62135596800000, -1, 0, 1]
    df = spark.createDataFrame([(m,) for m in far], "ms long").select("ms", ts_to_millis(millis_to_ts("ms")).alias("again"))
    assert all(r["ms"] == r["again"] for r in df.collect())
    ns = spark.createDataFrame([(-1_500_000,), (1_999_999,), (2**62,)], "n long").select("n", nanos_to_whole_ms("n").alias("m"))
    assert [r["m"] for r in ns.collect()] == [-1, 1, 2**62 // 10**6]


def test_breaches_use_whole_milliseconds(spark):
    log = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1), 5_999_999, False), (2, dt.datetime(2024, 1, 1), 6_000_000, False)],
        "request_id long, received_at timestamp_ntz, latency_ns long, error boolean")
    assert [r["request_id"] for r in reports.sla_breaches(log).collect()] == [2]


def test_rates_and_throughput(spark, sf_small):
    hb = fx.heartbeats(spark, sf_small)
    rate = reports.ingestion_rate(hb, "ts", "1 hour")
    assert rate.agg(F.sum("events")).collect()[0][0] == hb.count()
    sliding = reports.ingestion_rate(hb, "ts", "1 minute", "15 seconds")
    assert sliding.agg(F.sum("events")).collect()[0][0] == 4 * hb.count()
    both = reports.throughput_compare(hb, hb.unionByName(hb), "ts", "1 hour").agg(
        F.sum("ingested"), F.sum("consumed")).collect()[0]
    assert (both[0], both[1]) == (hb.count(), 2 * hb.count())


def test_overflow_alert_threshold(spark, sf_small):
    hb = fx.heartbeats(spark, sf_small).withColumnRenamed("ts", "received_at")
    per_day = reports.overflow_alerts(hb, "received_at", "1 day", 0)
    assert per_day.agg(F.sum("rejected")).collect()[0][0] == hb.count()
    assert reports.overflow_alerts(hb, "received_at", "1 day", 10**9).count() == 0
