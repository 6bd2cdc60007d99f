"""DataFrame -> DataFrame operators (usable with ``DataFrame.transform``)."""

from .conform import (
    apply_null_policy,
    check_closed_schema,
    conform,
    conform_rejects,
    drop_unwanted,
    rename_columns,
)
from .dedup import count_copies, drop_copies
from .derive import (
    BOROUGH_COUNTY,
    BOROUGH_STATE,
    apply_transforms,
    flag_negative,
    get_transform,
    map_lookup,
    register_transform,
    timestamp_from_parts,
    timestamps_from_pairs,
)
from .enrich import (
    JoinSpec,
    broadcast_fits,
    enrich,
    hourly_summary,
    join_context,
    match_rates,
    restrict_to,
)
from .keys import (
    add_generated_key,
    assert_primary_key,
    assert_unique_context_key,
    key_stats,
    key_violations,
    observed_key_stats,
)
from .quality import apply_rules, explain_rejects
from .report import (
    avg_duration_by_day,
    avg_finite_by,
    compare_results,
    count_by,
    diff_results,
    label_column,
    profile,
    sorted_result,
)

__all__ = [
    "BOROUGH_COUNTY", "BOROUGH_STATE", "JoinSpec", "add_generated_key", "apply_null_policy",
    "apply_rules", "apply_transforms", "assert_primary_key", "assert_unique_context_key",
    "avg_duration_by_day", "avg_finite_by", "broadcast_fits", "check_closed_schema",
    "compare_results", "conform", "conform_rejects", "count_by", "count_copies", "diff_results", "drop_copies", "drop_unwanted",
    "enrich", "explain_rejects", "flag_negative", "get_transform", "hourly_summary",
    "join_context", "key_stats", "key_violations", "label_column", "map_lookup", "match_rates",
    "observed_key_stats", "profile", "register_transform", "rename_columns", "restrict_to",
    "sorted_result", "timestamp_from_parts", "timestamps_from_pairs",
]
