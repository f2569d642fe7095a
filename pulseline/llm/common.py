"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import pulseline
from pulseline.session import scratch_path


# Arrow batches handed to Python: whole rows, at most so many and about so many bytes
BATCH_ROWS, BATCH_BYTES = "1000", "4m"


def small_batches(spark: SparkSession) -> None:
    """Bound the texts that a Python worker holds at once, unless the session bounds them lower."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > int(BATCH_ROWS):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Tasks import it by name, so what a Python worker has loaded (vocabularies,
    automata, dictionaries) stays loaded for its later tasks.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(pulseline.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="pulseline-"), "pulseline_tasks.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    out.write(file, os.path.relpath(file, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def arrow_udf(function, returns: str):
    """An Arrow UDF whose tasks find this package and hand unused memory back after each batch."""
    ship_package(SparkSession.getActiveSession() or SparkSession.builder.getOrCreate())

    def run(*columns):
        out = function(*columns)
        pa.default_memory_pool().release_unused()
        return out

    return F.arrow_udf(run, returns)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, to be read in small Arrow batches."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Cuts the lineage with files that every executor can read, so losing an
    executor costs only its running tasks. Columns are those of ``df``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# keys that hold a share of 1/HEAVY of all rows or more: at most HEAVY of them
HEAVY = 1_000


def join_counted(left: DataFrame, right: DataFrame, on: list[str], weight: str, total: int) -> DataFrame:
    """Inner join with a ``right`` that is unique on ``on`` and counts the left rows of each key in ``weight``.

    ``total`` is the number of left rows. Keys with a ``HEAVY``-th of them or
    more are few by that bound alone; they are broadcast, so their left rows
    stay where they are. All other keys meet by shuffle. Both inputs are read
    twice: pass staged tables.
    """
    hot = F.col(weight) * F.lit(HEAVY) >= F.lit(total)
    heavy, light = F.broadcast(right.filter(hot)), right.filter(~hot)
    rest = left.join(heavy.select(*on), on, "left_anti")
    return left.join(heavy, on).unionByName(rest.join(light, on))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string array end to end, and the n+1 row offsets.

    Null rows have no bytes. The bytes are those of the Arrow buffer (no copy
    unless the array holds nulls with bytes behind them).
    """
    if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type):
        width = np.int64
    else:
        width = np.int32
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, width)[texts.offset:texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising mixer of splitmix64 on uint64 (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def row_slices(n_bytes: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Cut rows 0..n into runs of about ``limit`` bytes (at least one row each)."""
    out, start, total = [], 0, 0
    for i, n in enumerate(n_bytes.tolist()):
        if total and total + n > limit:
            out.append((start, i))
            start, total = i, 0
        total += n
    if start < len(n_bytes):
        out.append((start, len(n_bytes)))
    return out
