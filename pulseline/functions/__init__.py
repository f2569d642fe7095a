"""Column-level functions: conversions, hashing, validation, wire codec."""

from pulseline.functions.scalars import (
    apply_defaults, millis_to_ts, normalize_device_fields, safe_ratio,
    seconds_to_ms, ts_to_millis,
)
from pulseline.functions.murmur import murmur2, session_partition_id
from pulseline.functions.validation import (
    is_blank, storage_violations, violations,
)

__all__ = [
    "apply_defaults", "millis_to_ts", "normalize_device_fields", "safe_ratio",
    "seconds_to_ms", "ts_to_millis", "murmur2", "session_partition_id",
    "is_blank", "storage_violations", "violations",
]
