"""Parallelism guard for per-row CPU-heavy stages (parsing, codec)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread_small_input(df: DataFrame) -> DataFrame:
    """Give a CPU-heavy per-row stage at least one partition per core.

    Large inputs already have many more partitions than cores and are left
    alone (no shuffle). A small input read as one or two partitions (one
    parquet row group, one micro-batch file) would run the whole stage on
    one core, so it is redistributed round-robin over ``defaultParallelism``
    partitions. Streaming DataFrames are returned unchanged.

    Counting partitions plans the input: use it on scans (free), not after a
    shuffle, where under AQE the count would run the shuffle's map stage.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df
