"""Column expressions: value predicates, conversions, time buckets, rules."""

from .rules import RULE_NAMES, passes_all, rule_label, violation
from .timeops import (
    TIME_OF_DAY_PATTERN,
    duration_seconds,
    hour_bucket,
    local_hour_bucket,
    timestamp_from_date_time,
    timestamp_from_parts,
)
from .values import (
    blank_text,
    blank_to_null,
    cast_value,
    finite_or_null,
    is_finite,
    is_missing,
    normalize_label,
)

__all__ = [
    "RULE_NAMES", "TIME_OF_DAY_PATTERN", "blank_text", "blank_to_null", "cast_value",
    "duration_seconds", "finite_or_null", "hour_bucket", "is_finite", "is_missing",
    "local_hour_bucket",
    "normalize_label", "passes_all", "rule_label", "timestamp_from_date_time",
    "timestamp_from_parts", "violation",
]
