"""Plan-shaping helpers: staged tables, size-checked joins, global row numbers."""

from tallyframe.plans.joins import count_members, lookup, without_members
from tallyframe.plans.ranking import first_rows, with_row_index
from tallyframe.plans.staging import new_staging_path, stage

__all__ = [
    "count_members",
    "first_rows",
    "lookup",
    "new_staging_path",
    "stage",
    "with_row_index",
    "without_members",
]
