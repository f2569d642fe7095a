"""Continuous series and counter increases against plain evaluations."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import hb_rows
from pulseline.operators import series

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


@pytest.mark.parametrize("block", [2, 5, 4096])
def test_grid_has_every_step_once(spark, block):
    rows = spark.createDataFrame([(-7,), (3,), (3,), (19,)], "n long")
    assert sorted(r.n for r in series.time_grid(rows, "n", block).collect()) == list(range(-7, 20))
    assert series.time_grid(rows.limit(0), "n", block).count() == 0


@pytest.mark.parametrize("inclusive", [False, True])
def test_values_are_carried_over_blocks(spark, inclusive):
    rng = random.Random(3)
    rows = [(k, p, rng.choice([None, None, rng.randrange(99)]))
            for k in (None, "a", "b") for p in rng.sample(range(-300, 300), 120)]
    df = spark.createDataFrame(rows, "k string, p long, v long")
    got = {(r.k, r.p): r.was for r in series.last_before(df, "p", "v", "was", ["k"], inclusive, block=4).collect()}
    assert len(got) == len(rows)
    for k, p, _ in rows:
        earlier = [(q, v) for j, q, v in rows if j == k and v is not None and (q < p or inclusive and q == p)]
        assert got[k, p] == (max(earlier)[1] if earlier else None)


def test_rates_are_zero_where_nothing_happened(spark):
    rows = [(at(s), s % 2 == 0) for s in (0, 1, 14, 59, 600)] + [(None, True)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, even boolean")
    out = series.rate_series(df, {"even": F.col("even"), "odd": ~F.col("even")}).orderBy("window_start").collect()
    assert [r.window_start for r in out] == [at(s) for s in range(-45, 601, 15)]
    for r in out:
        inside = [e for t, e in rows if t is not None and r.window_start <= t < r.window_end]
        assert (r.even, r.odd) == (inside.count(True), inside.count(False)) and r.even_per_s == r.even / 60
    assert sum(r.even + r.odd == 0 for r in out) > 30
    assert series.rate_series(df.limit(0), {"even": F.col("even")}).count() == 0
    with pytest.raises(ValueError):
        series.rate_series(df, {}, window="1 minute", step="25 seconds")


def test_gauges_hold_their_last_reading(spark):
    hb = hb_rows(spark, [dict(ts=at(10), video_start_time_ms=4.0), dict(ts=at(20), video_start_time_ms=6.0),
                         dict(ts=at(200), video_start_time_ms=8.0, playback_failed=True), dict(ts=None)])
    out = [(r.step_start, r.avg_vst_ms, r.pfr, r.fresh) for r in series.kpi_series(hb).orderBy("step_start").collect()]
    assert out == [(at(0), 5.0, 0.0, True), (at(60), 5.0, 0.0, False), (at(120), 5.0, 0.0, False), (at(180), 8.0, 1.0, True)]
    assert series.kpi_series(hb.limit(0)).count() == 0


def plain_increase(rows, width):
    held, out = {}, {}
    best = {}
    for s, t, v in rows:
        if t is not None and v is not None:
            best[s, t] = max(v, best.get((s, t), v))
    for s, t in sorted(best, key=lambda x: (str(x[0]), x[1])):
        v, before = best[s, t], held.get(s)
        held[s] = v
        of = out.setdefault((t - T0) // dt.timedelta(seconds=width), [0, 0, 0])
        of[0] += 0 if before is None else v if v < before else v - before
        of[1] += before is not None and v < before
        of[2] += 1
    return {T0 + dt.timedelta(seconds=width) * k: tuple(v) for k, v in out.items()}


@pytest.mark.parametrize("window,width", [("1 minute", 60), ("1 hour", 3600)])
def test_increase_counts_resets_in_full(spark, window, width):
    rng = random.Random(11)
    rows = []
    for s in ("a", "b", None):
        value = 0
        for _ in range(400):
            value = 0 if rng.random() < 0.05 else value + rng.randrange(30)
            rows.append((s, at(rng.randrange(9000)), value))
    rows += [("a", None, 5), ("a", at(50), None), rows[0], rows[1], ("c", at(8999), 7)]
    df = spark.createDataFrame(rows, "series string, ts timestamp_ntz, value long").withColumn("__v", F.lit(1))
    out = series.counter_increase(df.drop("__v"), window=window)
    assert {r.window_start: (r.increase, r.resets, r.samples) for r in out.collect()} == plain_increase(rows, width)
    alerts = series.increase_alerts(out, 100).collect()
    assert len(alerts) == sum(v[0] > 100 for v in plain_increase(rows, width).values())


def test_a_hot_series_is_split_by_time(spark):
    """Every window below the topmost is keyed by a block as well."""
    df = spark.createDataFrame([("a", at(s), s) for s in range(10)], "series string, ts timestamp_ntz, value long")
    plan = series.counter_increase(df)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 3 and sum("__block" in line.split("AS ")[-1] for line in windows) >= 2
