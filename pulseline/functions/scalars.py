"""Scalar conversions (FN-1…FN-4, FN-8, FN-9) as Catalyst expressions.

Event time is TIMESTAMP_NTZ holding UTC wall clock. Conversions between epoch
milliseconds and event time therefore use NTZ arithmetic against the epoch,
which does not read the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# Epoch milliseconds of 0001-01-01 00:00:00 and 9999-12-31 23:59:59.999, the
# range of Spark timestamps.
_MIN_MS = -62135596800000
_MAX_MS = 253402300799999


def millis_to_ts(col) -> Column:
    """Epoch milliseconds (bigint) → event time (FN-1).

    Values outside the timestamp range give null instead of an overflow
    error (ANSI), so one absurd record cannot fail a job; a null event time
    is then quarantined by the storage rules.
    """
    c = _c(col)
    return F.when(c.between(F.lit(_MIN_MS), F.lit(_MAX_MS)),
                  F.timestamp_add("MILLISECOND", c, F.expr(_EPOCH)))


def ts_to_millis(col) -> Column:
    """Event time → epoch milliseconds, flooring sub-millisecond parts (FN-2)."""
    micros = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), _c(col))
    return F.call_function("div", micros - F.pmod(micros, F.lit(1000)), F.lit(1000).cast("bigint"))


def normalize_device_fields(df: DataFrame,
                            cols=("player_version", "os", "cdn")) -> DataFrame:
    """Absent device strings become "" (FN-3), as on the wire."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in cols})


# Default of each primitive field when it is absent (FN-4).
PRIMITIVE_DEFAULTS = {
    "timestamp_ms": (0, "bigint"),
    "video_start_time_ms": (0.0, "double"),
    "playback_failed": (False, "boolean"),
    "rebuffer_duration_ms": (0.0, "double"),
    "playback_duration_ms": (0.0, "double"),
}


def apply_defaults(df: DataFrame) -> DataFrame:
    """Fill absent primitive fields with 0 / 0.0 / false (FN-4)."""
    present = {c: F.coalesce(F.col(c), F.lit(v).cast(t))
               for c, (v, t) in PRIMITIVE_DEFAULTS.items() if c in df.columns}
    return df.withColumns(present)


def safe_ratio(num, den) -> Column:
    """``den > 0 ? num / den : 0.0`` with Java semantics (FN-8).

    In Spark ``NaN > 0`` is true, in Java it is false, hence the NaN test;
    the division only runs inside the guard (ANSI raises on x / 0).
    """
    n, d = _c(num), _c(den)
    return F.when(~F.isnan(d) & (d > 0), n / d).otherwise(F.lit(0.0))


def seconds_to_ms(col) -> Column:
    """Seconds → milliseconds (FN-9)."""
    return _c(col) * F.lit(1000.0)


def nanos_to_whole_ms(col) -> Column:
    """Nanoseconds → whole milliseconds, truncating (as a duration is read)."""
    return F.call_function("div", _c(col), F.lit(1_000_000).cast("bigint"))
