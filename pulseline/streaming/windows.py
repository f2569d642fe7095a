"""Event-time KPIs and bounded-state dedup over streams (STR-4, STR-6)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseline.functions.scalars import millis_to_ts, ts_to_millis
from pulseline.functions.validation import is_blank
from pulseline.operators.kpi import _part_aggs, _with_ratios

HELD_IDS = 1 << 18      # ids a task remembers at once


def with_event_instant(df: DataFrame, ts: str = "ts") -> DataFrame:
    """``event_time`` (TIMESTAMP) for watermarks, built from epoch millis.

    Watermarks need TIMESTAMP; building it from epoch millis (not a cast of
    the NTZ column) keeps the instant independent of the session zone.
    """
    return df.withColumn("event_time", F.timestamp_millis(ts_to_millis(ts)))


def _ntz(col):
    return millis_to_ts(F.unix_millis(col))


def stream_kpis(decoded: DataFrame, window: str = "1 hour", watermark: str = "10 minutes",
                keys=("session_id",), session_gap: str | None = None) -> DataFrame:
    """KPIs per (event-time window, keys), independent of micro-batch boundaries (STR-6).

    Tumbling ``window`` (or ``session_window`` with ``session_gap``) with a
    watermark; in append mode a window is emitted once the watermark passes
    its end, and events older than the watermark are dropped as late. A run
    that drains stored records and stops must end with a record far enough
    ahead in time to close the last windows (its own stays open).
    State is one aggregation buffer per open (window, key).
    """
    w = (F.session_window("event_time", session_gap) if session_gap
         else F.window("event_time", window))
    agg = (with_event_instant(decoded).withWatermark("event_time", watermark)
           .groupBy(w.alias("w"), *keys).agg(*_part_aggs()[2:]))
    return _with_ratios(agg).select(
        _ntz(F.col("w.start")).alias("window_start"), _ntz(F.col("w.end")).alias("window_end"),
        *keys,
        "avg_vst_ms", "pfr", "rebuffering_ratio", "event_count",
        "sum_vst_ms", "failures", "total_playback_ms", "total_rebuffer_ms")


def split_identified(decoded: DataFrame, key: str = "event_id", ts: str = "ts"):
    """(identified, others): rows a bounded-state dedup can hold, and the rest (STR-4).

    Rows without an id would all meet in one state entry, and rows without an
    event time (0, the epoch) are behind every watermark and would be dropped
    as late. They go to a side output instead, where a batch keeps the first
    of each id.
    """
    timed = F.col(ts) > F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    ok = F.coalesce(timed & ~is_blank(key), F.lit(False))
    return decoded.filter(ok), decoded.filter(~ok)


def drop_repeats_in_task(df: DataFrame, key: str = "event_id", held: int = HELD_IDS) -> DataFrame:
    """Rows whose ``key`` the same task has not met before in this micro-batch.

    No shuffle: a task forgets its ids when it holds ``held`` of them, so it
    stays small and may let a repeat through, which the state then removes.
    What is left of an id that fills a third of the rows is one row a task.
    """
    def first(batches):
        seen: set = set()
        for batch in batches:
            keep = []
            for value in batch.column(key).to_pylist():
                keep.append(value not in seen)
                if len(seen) >= held:
                    seen.clear()
                seen.add(value)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return df.mapInArrow(first, df.schema)


def dedup_stream(decoded: DataFrame, watermark: str = "1 hour",
                 key: str = "event_id") -> DataFrame:
    """Drop redelivered events seen within the watermark (STR-4, bounded state).

    Rows older than the watermark are dropped as late: choose it above the
    disorder of the source, and pass ``split_identified``'s first half. Repeats
    inside a task go before the shuffle, so a hot id does not fill one state
    partition; the state forgets an id when the watermark has passed it.
    """
    return (with_event_instant(drop_repeats_in_task(decoded, key)).withWatermark("event_time", watermark)
            .dropDuplicatesWithinWatermark([key]).drop("event_time"))
