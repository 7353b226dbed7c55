"""Finding very regular, very active users and where they act."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.functions.coords import Box, in_any_box, split_coordinate
from tallyframe.functions.nulls import with_values
from tallyframe.functions.timewin import gap_seconds, hour_bucket
from tallyframe.plans.joins import count_members
from tallyframe.plans.ranking import TAKE_ROWS, first_rows
from tallyframe.plans.staging import stage

# The active share, the bot threshold and the two watched regions.
TOP_PERCENT = 1
MAX_MEAN_GAP_SECONDS = 420
TOP_COORDINATES = 20
REGIONS = (Box(892, 961, 1830, 1886), Box(1611, 1691, 212, 277))


def total_users(events: DataFrame, *, user: str = "user_id") -> DataFrame:
    """Number of distinct non-null users, as one row."""
    return events.agg(F.count_distinct(user).alias("total_users"))


def user_activity(events: DataFrame, *, user: str = "user_id", ts: str = "ts") -> DataFrame:
    """Events, first and last time of every user; events without a time count as none."""
    return with_values(events, user).groupBy(user).agg(
        F.count(ts).alias("pixel_placements"),
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"))


def _most_active(events: DataFrame, top_percent: float, user: str, ts: str,
                 take_rows: int) -> DataFrame:
    activity = stage(user_activity(events, user=user, ts=ts), "activity")
    k = max(1, int(activity.count() * (top_percent / 100)))
    seen = activity.filter(F.col("pixel_placements") > 0)
    order = [F.desc("pixel_placements"), F.asc(user)]
    return first_rows(seen, order, k, take_rows=take_rows)


def most_active_users(events: DataFrame, top_percent: float = TOP_PERCENT, *,
                      user: str = "user_id", ts: str = "ts",
                      take_rows: int = TAKE_ROWS) -> DataFrame:
    """The ``top_percent`` of users with most events, at least one user.

    The percentage is of all users. Only their number passes the driver.
    """
    return _most_active(events, top_percent, user, ts, take_rows).select(user, "pixel_placements")


def suspicious_users(events: DataFrame, users: DataFrame | None = None, *,
                     top_percent: float = TOP_PERCENT,
                     max_mean_gap: float = MAX_MEAN_GAP_SECONDS, user: str = "user_id",
                     ts: str = "ts", take_rows: int = TAKE_ROWS) -> DataFrame:
    """Users with a mean time between events below ``max_mean_gap`` seconds.

    Looks at ``users``, or else at the most active ones. The gaps of a user add
    up to last minus first time, so no event needs its neighbour: one count,
    minimum and maximum per user are enough.
    """
    if users is None:
        stats = _most_active(events, top_percent, user, ts, take_rows)
    else:
        stats = user_activity(events, user=user, ts=ts).join(
            users.select(user).distinct(), user, "left_semi")
    gaps = F.col("pixel_placements") - 1
    mean = gap_seconds(F.col("first_ts"), F.col("last_ts")) / gaps
    return (
        stats.filter(gaps > 0)
        .select(user, mean.alias("avg_interval"))
        .filter(F.col("avg_interval") < max_mean_gap)
        .orderBy("avg_interval", user)
    )


def top_coordinates_of(events: DataFrame, users: DataFrame, k: int = TOP_COORDINATES, *,
                       user: str = "user_id", ts: str = "ts", key: str = "coordinate",
                       **join_limits: int) -> DataFrame:
    """The ``k`` coordinates where ``users`` placed most."""
    rows = with_values(events, ts, user).select(user, key)
    counts = count_members(rows, users, user, [key], name="placements", **join_limits)
    return first_rows(counts, [F.desc("placements"), F.asc_nulls_last(key)], k)


def hourly_activity_in_regions(events: DataFrame, users: DataFrame,
                               boxes: Iterable[Box] = REGIONS, *, user: str = "user_id",
                               ts: str = "ts", key: str = "coordinate",
                               **join_limits: int) -> DataFrame:
    """Events of ``users`` inside the boxes per hour, busiest hour first."""
    x, y = split_coordinate(key)
    rows = with_values(events, ts, user).filter(in_any_box(x, y, boxes))
    rows = rows.select(user, hour_bucket(ts).alias("hour"))
    counts = count_members(rows, users, user, ["hour"], name="bot_changes", **join_limits)
    return counts.orderBy(F.desc("bot_changes"), "hour")
