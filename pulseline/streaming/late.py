"""Windowed KPIs that lose no late event (STR-6).

A window's KPIs come from additive parts, so they need no operator state: each
micro-batch writes one row of parts per (window, key), and a window's result is
the sum over the batches. The watermark only decides what is late: an event
whose window had ended by the greatest event time of earlier batches less the
delay. Such events go to a side output as they are; ``fold_late`` turns them
into parts of their own source, so sums include them once, whenever they come.
A delay of minutes is enough for results that are almost always final at once,
and after folding they equal the batch result for any order of delivery.

All outputs are keyed by source and batch: a retried batch replaces its own
rows, and the watermark of a batch depends on earlier batches only, so the
retry draws the same line. A hot key costs one row of parts per map task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulseline.functions.codec import decode_binary, split_decoded
from pulseline.functions.scalars import millis_to_ts, ts_to_millis
from pulseline.operators.kpi import PART_COLUMNS, _part_aggs, _with_ratios
from pulseline.session import list_names, read_text, write_text
from pulseline.streaming.sinks import LIVE, write_batch_partition

FOLDED = "folded-"     # prefix of the sources that late rows are folded under
MEASURES = ["video_start_time_ms", "playback_failed", "playback_duration_ms", "rebuffer_duration_ms"]


@dataclass(frozen=True)
class WindowLayout:
    """Folders of one windowed job (all on the shared file system)."""
    root: str

    @property
    def parts(self) -> str:
        return f"{self.root}/window_parts"

    @property
    def late(self) -> str:
        return f"{self.root}/late_events"

    @property
    def times(self) -> str:
        return f"{self.root}/_event_times"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/_checkpoint"


def duration_ms(text: str) -> int:
    """Milliseconds of ``"10 minutes"`` and the like."""
    count, unit = text.split()
    return int(count) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")] * 1000


def seen_until(spark: SparkSession, layout: WindowLayout, batch_id: int | None = None) -> int | None:
    """Greatest event time (ms) of all batches before ``batch_id`` (of all batches without it)."""
    numbers = [int(n.removesuffix(".txt")) for n in list_names(spark, layout.times) if n.endswith(".txt")]
    earlier = [n for n in numbers if batch_id is None or n < batch_id]
    return int(read_text(spark, f"{layout.times}/{max(earlier)}.txt")) if earlier else None


def _start(ms: Column, window_ms: int) -> Column:
    return ms - F.pmod(ms, F.lit(window_ms))


def window_parts(rows: DataFrame, window: str, keys=("session_id",)) -> DataFrame:
    """Additive KPI parts per (tumbling event-time window, keys), with a partial step."""
    width = duration_ms(window)
    start = _start(ts_to_millis("ts"), width)
    agg = rows.groupBy(start.alias("w"), *keys).agg(*_part_aggs()[2:])
    return agg.select(millis_to_ts(F.col("w")).alias("window_start"),
                      millis_to_ts(F.col("w") + width).alias("window_end"), *keys, *PART_COLUMNS)


def process_window_batch(batch: DataFrame, batch_id: int, layout: WindowLayout, window: str,
                         watermark: str, keys=("session_id",)) -> None:
    """Add the on-time events of one micro-batch to the windows, and put late ones aside."""
    spark = batch.sparkSession
    rows = batch.filter(F.col("ts").isNotNull()).select("ts", *keys, *MEASURES).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        newest = rows.agg(F.max(ts_to_millis("ts"))).first()[0]
        if newest is None:
            return
        before = seen_until(spark, layout, batch_id)
        line = None if before is None else before - duration_ms(watermark)
        width = duration_ms(window)
        late = F.lit(False) if line is None else _start(ts_to_millis("ts"), width) + width <= F.lit(line)
        write_batch_partition(window_parts(rows.filter(~late), window, keys), layout.parts, batch_id)
        if line is not None:
            write_batch_partition(rows.filter(late), layout.late, batch_id)
        path = f"{layout.times}/{batch_id}.txt"
        if f"{batch_id}.txt" not in list_names(spark, layout.times):
            write_text(spark, path, str(max(newest, before if before is not None else newest)))
    finally:
        rows.unpersist()


def run_windows(stream: DataFrame, layout: WindowLayout, window: str = "1 hour", watermark: str = "10 minutes",
                keys=("session_id",), available_now: bool = True, processing_time: str | None = None):
    """Start the windowed job over topic records; returns the ``StreamingQuery``."""
    good, _ = split_decoded(decode_binary(stream, "value"))
    writer = (good.writeStream
              .foreachBatch(lambda df, n: process_window_batch(df, n, layout, window, watermark, keys))
              .option("checkpointLocation", layout.checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def _batches(spark: SparkSession, path: str, source: str) -> set[int]:
    names = list_names(spark, f"{path}/source_id={source}")
    return {int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id=")}


def _table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    if not list_names(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _late_schema(keys) -> StructType:
    kinds = {"ts": "timestamp_ntz", **{k: "string" for k in keys}, "video_start_time_ms": "double",
             "playback_failed": "boolean", "playback_duration_ms": "double", "rebuffer_duration_ms": "double"}
    return StructType.fromDDL(", ".join(f"{c} {t}" for c, t in kinds.items()) + ", source_id string, batch_id bigint")


def _parts_schema(keys) -> StructType:
    return StructType.fromDDL(
        "window_start timestamp_ntz, window_end timestamp_ntz, " + ", ".join(f"{k} string" for k in keys)
        + ", event_count bigint, sum_vst_ms double, failures bigint, total_playback_ms double, "
          "total_rebuffer_ms double, source_id string, batch_id bigint")


def fold_late(spark: SparkSession, layout: WindowLayout, window: str = "1 hour", keys=("session_id",),
              source: str = LIVE) -> int:
    """Fold late rows of batches that are not folded yet into the stored parts; returns how many batches.

    Each late batch becomes a partition of source ``folded-<source>`` with the
    same number, so folding again, or after a crash, adds nothing twice.
    """
    pending = sorted(_batches(spark, layout.late, source) - _batches(spark, layout.parts, FOLDED + source))
    if not pending:
        return 0
    rows = (_table(spark, layout.late, _late_schema(keys))
            .filter((F.col("source_id") == source) & F.col("batch_id").isin(pending)))
    parts = window_parts(rows, window, (*keys, "batch_id")).withColumn("source_id", F.lit(FOLDED + source))
    (parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy("source_id", "batch_id").parquet(layout.parts))
    return len(pending)


def late_events(spark: SparkSession, layout: WindowLayout, keys=("session_id",)) -> DataFrame:
    """The side output: events that came after their window had closed."""
    return _table(spark, layout.late, _late_schema(keys))


def window_kpis(spark: SparkSession, layout: WindowLayout, keys=("session_id",), watermark: str | None = None) -> DataFrame:
    """KPIs per (window, keys) from all stored parts.

    With ``watermark`` only windows that have ended by it are returned.
    """
    parts = _table(spark, layout.parts, _parts_schema(keys))
    if watermark is not None:
        until = seen_until(spark, layout)
        line = F.lit(until - duration_ms(watermark) if until is not None else None).cast("long")
        parts = parts.filter(ts_to_millis("window_end") <= line)
    sums = parts.groupBy("window_start", "window_end", *keys).agg(*[F.sum(c).alias(c) for c in PART_COLUMNS])
    return _with_ratios(sums).select("window_start", "window_end", *keys, "avg_vst_ms", "pfr",
                                     "rebuffering_ratio", "event_count")
