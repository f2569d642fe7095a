"""Latency percentiles that add up over micro-batches (AGG-13, AGG-17).

A latency counts in a bucket that keeps its eight leading bits: the bucket's
value is at most one part in 128 below the latency, for any size, in integer
arithmetic. Counts per (period, bucket) are additive, so the parts that each
micro-batch writes roll up to the same percentiles for any cut into batches.
A period has at most about 7,300 buckets, so a running sum over them is small
however many requests it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulseline.streaming.sinks import write_batch_partition

LEADING_BITS = 8
PARTS = ("period_start timestamp_ntz, period_end timestamp_ntz, bucket bigint, requests bigint, "
         "source_id string, batch_id bigint")


def bucket(value: Column) -> Column:
    """The smallest value with the same eight leading bits; negative values count as 0."""
    whole = F.greatest(value.cast("bigint"), F.lit(0).cast("bigint"))
    shift = F.greatest(F.length(F.bin(whole)) - LEADING_BITS, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", whole, shift), shift)


def latency_parts(log: DataFrame, period: str = "1 day", ts: str = "received_at", value: str = "latency_ns") -> DataFrame:
    """Requests per (period, bucket); requests without latency do not count."""
    w = F.window(ts, period)
    agg = (log.filter(F.col(value).isNotNull()).groupBy(w.alias("w"), bucket(F.col(value)).alias("bucket"))
              .agg(F.count(F.lit(1)).alias("requests")))
    return agg.select(F.col("w.start").alias("period_start"), F.col("w.end").alias("period_end"), "bucket", "requests")


def run_latency(stream: DataFrame, path: str, checkpoint: str, period: str = "1 day"):
    """Drain a request-log stream into parts, one partition a micro-batch; returns the ``StreamingQuery``."""
    return (stream.writeStream
            .foreachBatch(lambda df, n: write_batch_partition(latency_parts(df, period), path, n))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PARTS).parquet(path)


def latency_quantiles(parts: DataFrame, percents=(50, 95, 99)) -> DataFrame:
    """``period_start, requests, p<percent>_ns`` per period, by nearest rank from the summed parts."""
    sums = parts.groupBy("period_start", "bucket").agg(F.sum("requests").alias("n"))
    whole = Window.partitionBy("period_start")
    upto = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = sums.withColumns({"upto": F.sum("n").over(upto), "requests": F.sum("n").over(whole)})
    at = lambda p: F.min(F.when(F.col("upto") * 100 >= F.col("requests") * p, F.col("bucket")))
    return ranked.groupBy("period_start", "requests").agg(*[at(p).alias(f"p{p}_ns") for p in percents])
