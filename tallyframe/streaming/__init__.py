"""Incremental forms of the placement ingest, the counts and the per-user results."""

from tallyframe.streaming.batches import BatchTable, ForeignCheckpoint
from tallyframe.streaming.placements import (
    append_to_table,
    compact_hour_counts,
    count_hours_in_batches,
    read_hour_counts,
    read_placements_stream,
)
from tallyframe.streaming.users import (
    UserIds,
    distinct_users_in_batches,
    encode_users_in_batches,
    first_time_users_so_far,
    first_times_in_batches,
    rank_by_distinct_users_so_far,
    read_first_times,
    read_sessions,
    sessions_in_batches,
)

__all__ = [
    "BatchTable",
    "ForeignCheckpoint",
    "UserIds",
    "append_to_table",
    "compact_hour_counts",
    "count_hours_in_batches",
    "distinct_users_in_batches",
    "encode_users_in_batches",
    "first_time_users_so_far",
    "first_times_in_batches",
    "rank_by_distinct_users_so_far",
    "read_first_times",
    "read_hour_counts",
    "read_placements_stream",
    "read_sessions",
    "sessions_in_batches",
]
