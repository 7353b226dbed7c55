"""DataFrame operators."""

from tallyframe.operators.counts import (
    changes_histogram,
    histogram,
    hourly_counts,
    hourly_counts_of_top,
    hourly_median,
    most_frequent,
    most_frequent_each,
    numbered,
    top_values,
    top_values_per_top_key,
    value_counts,
)
from tallyframe.operators.elections import (
    battleground_comparison,
    canonical_party,
    clean_results,
    did_effect,
    did_group_means,
    turnout_pre_post,
    turnout_rate,
)
from tallyframe.operators.profile import (
    profile_categories,
    profile_columns,
    profile_duplicates,
    profile_missing,
    profile_numeric,
    profile_row_count,
    profile_schema,
    profile_top_groups,
    profile_top_rows,
)
from tallyframe.operators.suspects import (
    hourly_activity_in_regions,
    most_active_users,
    suspicious_users,
    top_coordinates_of,
    total_users,
    user_activity,
)
from tallyframe.operators.users import (
    average_session_seconds,
    encode_user_ids,
    first_time_user_count,
    placement_percentiles,
    rank_by_distinct_users,
    sessions,
)

__all__ = [
    "average_session_seconds",
    "battleground_comparison",
    "canonical_party",
    "changes_histogram",
    "clean_results",
    "did_effect",
    "did_group_means",
    "encode_user_ids",
    "first_time_user_count",
    "histogram",
    "hourly_activity_in_regions",
    "hourly_counts",
    "hourly_counts_of_top",
    "hourly_median",
    "most_active_users",
    "most_frequent",
    "most_frequent_each",
    "numbered",
    "placement_percentiles",
    "profile_categories",
    "profile_columns",
    "profile_duplicates",
    "profile_missing",
    "profile_numeric",
    "profile_row_count",
    "profile_schema",
    "profile_top_groups",
    "profile_top_rows",
    "rank_by_distinct_users",
    "sessions",
    "suspicious_users",
    "top_coordinates_of",
    "top_values",
    "top_values_per_top_key",
    "total_users",
    "turnout_pre_post",
    "turnout_rate",
    "user_activity",
    "value_counts",
]
