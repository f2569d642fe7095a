"""Accept / reject splits and dead letters (FLT-3, FLT-4, FLT-6, SNK-4 shape)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseline.functions.validation import storage_violations, violations
from pulseline.schemas import (
    HEARTBEAT_COLUMNS, REASON_INVALID, REASON_STORAGE, REASON_UNDECODABLE,
)


def classify_requests(decoded: DataFrame, check_storage: bool = True) -> DataFrame:
    """Add ``reason`` (null = accepted) and ``violations`` (text) to decoded requests.

    Order of the checks: undecodable document (Q8) → request constraints,
    every failed one listed (FLT-1…3) → storage bounds (FLT-6, the raw table's
    column limits, quarantined per row instead of failing the batch).
    """
    s = storage_violations() if check_storage else F.array().cast("array<string>")
    tagged = decoded.withColumns({"__v": violations("timestamp_ms"), "__s": s})
    v, s = F.col("__v"), F.col("__s")
    err = F.col("decode_error")
    reason = (F.when(err.isNotNull(), F.lit(REASON_UNDECODABLE))
               .when(F.size(v) > 0, F.lit(REASON_INVALID))
               .when(F.size(s) > 0, F.lit(REASON_STORAGE)))
    detail = (F.when(err.isNotNull(), err)
               .when(F.size(v) > 0, F.array_join(v, "; "))
               .when(F.size(s) > 0, F.array_join(s, "; ")))
    return tagged.withColumns({"reason": reason, "violations": detail}).drop("__v", "__s")


def split_valid(decoded: DataFrame, check_storage: bool = True):
    """(accepted, rejected) — disjoint and complete (FLT-3)."""
    c = classify_requests(decoded, check_storage)
    return c.filter(F.col("reason").isNull()), c.filter(F.col("reason").isNotNull())


def storage_split(hb: DataFrame):
    """(storable, quarantined) halves by the raw table's column limits (FLT-6)."""
    s = storage_violations()
    tagged = hb.withColumn("__sv", s)
    ok = tagged.filter(F.size("__sv") == 0).drop("__sv")
    bad = (tagged.filter(F.size("__sv") > 0)
                 .withColumn("reason", F.lit(REASON_STORAGE))
                 .withColumn("detail", F.array_join("__sv", "; ")).drop("__sv"))
    return ok, bad


def to_event_table(df: DataFrame) -> DataFrame:
    """Storage projection of heartbeat rows (PRJ-1)."""
    return df.select(*HEARTBEAT_COLUMNS)
