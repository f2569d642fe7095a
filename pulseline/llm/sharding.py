"""Sharding by jump consistent hashing (operator 5).

A row's shard is a function of its key and the number of shards alone: no
ring table, no state, no shuffle. When shards are appended, a key either
stays or moves into one of the new shards, and only the necessary fraction
moves.

Defined results: a null key behaves like key -1, so all null keys share a
shard. A null text has size 1 and CRC 0, like an empty one. Repeated rows
share a shard and get slots of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulseline.llm.common import arrow_udf, mix64, ship_package, staged

JUMP_MULTIPLIER = np.uint64(2862933555777941757)  # fixed by the published method


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard 0..shards-1 of every 64-bit key (Lamping and Veach, 2014)."""
    key = keys.astype(np.uint64, copy=True)
    last = np.full(len(key), -1, np.int64)
    jump = np.zeros(len(key), np.int64)
    going = np.arange(len(key))
    while len(going):
        last[going] = jump[going]
        key[going] = key[going] * JUMP_MULTIPLIER + np.uint64(1)
        step = float(1 << 31) / ((key[going] >> np.uint64(33)).astype(np.float64) + 1.0)
        jump[going] = ((last[going] + 1) * step).astype(np.int64)
        going = going[jump[going] < shards]
    return last.astype(np.int32)


def _shards_of(keys: pa.Array, shards: int) -> np.ndarray:
    ids = keys.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    return jump_hash(mix64(ids.view(np.uint64)), shards)


def with_shard(df: DataFrame, key: str, shards: int, out: str = "shard") -> DataFrame:
    """``df`` with the shard of its integer ``key``; every other column stays as it is."""

    def shard(keys: pa.Array) -> pa.Array:
        return pa.array(_shards_of(keys, shards), pa.int32())

    return df.withColumn(out, arrow_udf(shard, "int")(F.col(key).cast("long")))


def write_shards(df: DataFrame, key: str, shards: int, path: str) -> None:
    """Write ``df`` as one Parquet folder per shard (``shard=<n>``)."""
    with_shard(df, key, shards).write.partitionBy("shard").parquet(path)


MANIFEST = ("doc_id long, size long, text_crc32 long, law string, shard int, "
            "grown_shard int, part long, place long")


def shard_manifest(df: DataFrame, key: str = "doc_id", text: str = "text",
                   shards: int = 16) -> DataFrame:
    """One narrow row per document: size, CRC, shard, slot and the shard after growth.

    ``slot`` counts 0, 1, … within a shard. Each input partition numbers its
    own rows per shard while it streams through; the partition's first slot
    is a running sum over the (partition, shard) counts, so no task ever
    holds or sorts a whole shard.
    """
    ship_package(df.sparkSession)
    narrow = df.select(F.col(key).cast("long").alias("doc_id"),
                       (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(1)).cast("long").alias("size"),
                       F.coalesce(F.crc32(F.encode(F.col(text), "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"),
                       F.spark_partition_id().cast("long").alias("part"))

    def number(batches):
        taken = np.zeros(shards, np.int64)
        for batch in batches:
            shard = _shards_of(batch.column("doc_id"), shards)
            place = np.empty(len(shard), np.int64)
            for s in np.unique(shard):
                at = np.flatnonzero(shard == s)
                place[at] = taken[s] + np.arange(len(at))
                taken[s] += len(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("size"), batch.column("text_crc32"),
                 pa.array(["key"] * len(shard), pa.string()), pa.array(shard, pa.int32()),
                 pa.array(_shards_of(batch.column("doc_id"), shards + 1), pa.int32()),
                 batch.column("part"), pa.array(place, pa.int64())],
                names=["doc_id", "size", "text_crc32", "law", "shard", "grown_shard", "part", "place"])

    rows = staged(narrow.mapInArrow(number, MANIFEST), "shards")
    counts = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = (Window.partitionBy("shard").orderBy("part")
               .rowsBetween(Window.unboundedPreceding, -1))
    first = counts.select("shard", "part",
                          F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    return (rows.join(first, ["shard", "part"])
                .select("doc_id", "size", "text_crc32", "law", "shard",
                        (F.col("first") + F.col("place")).alias("slot"), "grown_shard"))
