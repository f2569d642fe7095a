"""Request validation and storage bounds as array<string> columns (FN-7, FLT-1/2/6).

Each rule is a ``when(bad, message)``; the array keeps the messages that
fired, in field declaration order, so one pass yields every violation of a
row (not only the first).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulseline.schemas import MSG_NOT_BLANK, MSG_POSITIVE, STORAGE_LIMITS

# ``@NotBlank`` trims every char <= U+0020; Spark's trim only removes spaces,
# so "not blank" is "has a char outside \x00-\x20".
_NON_BLANK_RE = "[^\\x00-\\x20]"

# Required text fields of a request, as (reported name, column).
REQUIRED_TEXT = [
    ("eventId", "event_id"),
    ("sessionId", "session_id"),
    ("clientId", "client_id"),
    ("contentId", "content_id"),
]


def is_blank(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.isNull() | ~c.rlike(_NON_BLANK_RE)


def _collect(rules) -> Column:
    """Messages of the rules that fire; the list is built only for rows that break one."""
    listed = F.filter(F.array(*[F.when(cond, F.lit(msg)) for cond, msg in rules]),
                      lambda m: m.isNotNull())
    broken = reduce(lambda a, b: a | b, [cond for cond, _ in rules])
    return F.when(broken, listed).otherwise(F.array().cast("array<string>"))


def violations(ts_millis_col: str = "timestamp_ms") -> Column:
    """``"field: message"`` for each failed request constraint (FLT-1, FLT-2, FN-7)."""
    rules = [(is_blank(col), f"{name}: {MSG_NOT_BLANK}") for name, col in REQUIRED_TEXT]
    rules.append((~(F.col(ts_millis_col) > 0), f"timestampMs: {MSG_POSITIVE}"))
    return _collect(rules)


def storage_violations() -> Column:
    """Rows the raw table cannot hold: null required column or value too long (FLT-6)."""
    rules = []
    for col, (required, max_len) in STORAGE_LIMITS.items():
        if required:
            rules.append((F.col(col).isNull(), f"{col}: must not be null"))
        if max_len is not None:
            rules.append((F.length(F.col(col)) > max_len,
                          f"{col}: longer than {max_len}"))
    return _collect(rules)
