"""Column-level helpers: event time, text keys and coordinates."""

from tallyframe.functions.coords import Box, in_any_box, split_coordinate
from tallyframe.functions.nulls import with_values
from tallyframe.functions.text import normalized
from tallyframe.functions.timewin import (
    as_hour,
    check_range,
    gap_seconds,
    hour_bucket,
    parse_event_time,
    time_window,
)

__all__ = [
    "Box",
    "as_hour",
    "check_range",
    "gap_seconds",
    "hour_bucket",
    "in_any_box",
    "normalized",
    "parse_event_time",
    "split_coordinate",
    "time_window",
    "with_values",
]
