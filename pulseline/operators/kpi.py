"""Playback KPIs (AGG-2…AGG-9, AGG-15).

All KPIs come from five additive parts — event count, Σ video start time,
failure count, Σ playback, Σ rebuffer — plus min/max event time. One hash
aggregate computes them (partial aggregation map-side, final after the
shuffle on the grouping key), so a session holding a third of all rows is
combined per input partition before it is shuffled; the ratios are derived
afterwards, and the same parts roll up exactly across batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulseline.functions.scalars import safe_ratio

PART_COLUMNS = ["event_count", "sum_vst_ms", "failures", "total_playback_ms",
                "total_rebuffer_ms"]
KPI_COLUMNS = ["window_start", "window_end", "avg_vst_ms", "pfr",
               "rebuffering_ratio", "event_count"]


def _part_aggs() -> list[Column]:
    return [
        F.min("ts").alias("window_start"),
        F.max("ts").alias("window_end"),
        F.count(F.lit(1)).alias("event_count"),
        F.sum("video_start_time_ms").alias("sum_vst_ms"),
        F.count_if(F.col("playback_failed")).alias("failures"),
        F.sum("playback_duration_ms").alias("total_playback_ms"),
        F.sum("rebuffer_duration_ms").alias("total_rebuffer_ms"),
    ]


def _with_ratios(parts: DataFrame) -> DataFrame:
    """Ratios from the parts: mean VST, failures / events, Σrebuffer / Σplayback."""
    n = F.col("event_count").cast("double")
    return parts.withColumns({
        # every event counts in the mean, failed starts with 0 ms included (Q19)
        "avg_vst_ms": F.when(n > 0, F.col("sum_vst_ms") / n).otherwise(F.lit(0.0)),
        "pfr": F.when(n > 0, F.col("failures").cast("double") / n).otherwise(F.lit(0.0)),
        # ratio of sums, 0.0 when Σplayback is 0 or NaN (AGG-7, Q4)
        "rebuffering_ratio": safe_ratio("total_rebuffer_ms", "total_playback_ms"),
    })


def session_kpi_parts(hb: DataFrame, keys=("session_id",)) -> DataFrame:
    """Per-key additive parts, window bounds and ratios."""
    return _with_ratios(hb.groupBy(*keys).agg(*_part_aggs()))


def session_kpis(hb: DataFrame, keys=("session_id",)) -> DataFrame:
    """One KPI row per session (AGG-2…AGG-8).

    ``window_start``/``window_end`` are the min/max event time of the
    session's events in the input; an empty input yields no rows (FLT-9).
    """
    return session_kpi_parts(hb, keys).select(*keys, *KPI_COLUMNS)


def rollup_kpis(parts: DataFrame, keys=("session_id",)) -> DataFrame:
    """Combine stored KPI parts (e.g. one row per batch and session) exactly."""
    agg = parts.groupBy(*keys).agg(
        F.min("window_start").alias("window_start"),
        F.max("window_end").alias("window_end"),
        *[F.sum(c).alias(c) for c in PART_COLUMNS])
    return _with_ratios(agg)


def global_kpis(hb: DataFrame) -> DataFrame:
    """KPIs over the whole input as one row, no grouping (AGG-9, global form)."""
    return _with_ratios(hb.agg(*_part_aggs())).select(*KPI_COLUMNS)


def headline_kpis(hb: DataFrame, keys=("session_id",)) -> DataFrame:
    """KPIs of one session chosen deterministically: greatest (window_end, session_id).

    The reference reports whichever session its hash map iterated last; here
    the rule is explicit (AGG-9). ``max_by`` is an aggregate with a partial
    step, so choosing the row needs no sort and no single-task collect.
    """
    per = session_kpis(hb, keys)
    payload = F.struct(*[F.col(c) for c in (*keys, *KPI_COLUMNS)])
    order = F.struct(F.col("window_end"), *[F.col(k) for k in keys])
    best = per.agg(F.max_by(payload, order).alias("best"))
    return best.select("best.*").filter(F.col(keys[0]).isNotNull())


def kpi_timeseries(hb: DataFrame, window: str = "1 hour", slide: str | None = None,
                   keys=()) -> DataFrame:
    """KPIs per event-time window (AGG-15), optionally per extra keys."""
    w = F.window("ts", window, slide) if slide else F.window("ts", window)
    agg = hb.groupBy(w.alias("w"), *keys).agg(*_part_aggs()[2:])
    return _with_ratios(agg).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
        *keys, "avg_vst_ms", "pfr", "rebuffering_ratio", "event_count")
