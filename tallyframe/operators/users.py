"""Per-user operators: distinct-user ranking, sessions, percentiles, dense ids."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.nulls import with_values
from tallyframe.functions.timewin import gap_seconds, time_window
from tallyframe.plans.joins import lookup
from tallyframe.plans.ranking import with_row_index

Bound = str | datetime | None

SESSION_GAP_SECONDS = 15 * 60
# A year has some 100,000 cells of this length, a bearable number of rows for one task.
BLOCKS_BELOW_SECONDS = 5 * 60
BLOCK_CELLS = 1 << 14
PERCENTILES = (0.5, 0.75, 0.9, 0.99)


def rank_by_distinct_users(events: DataFrame, key: str = "pixel_color", start: Bound = None,
                           end: Bound = None, *, user: str = "user_id", ts: str = "ts",
                           closed: str = "left", approximate: bool = False) -> DataFrame:
    """Values of ``key``, raw and with NULL as its own group, by distinct users."""
    rows = time_window(events, start, end, ts=ts, closed=closed)
    users = F.approx_count_distinct(user) if approximate else F.count_distinct(user)
    ranked = rows.groupBy(key).agg(users.alias("distinct_users"))
    return ranked.orderBy(F.desc("distinct_users"), F.asc_nulls_last(key))


def sessions(events: DataFrame, start: Bound = None, end: Bound = None, *,
             user: str = "user_id", ts: str = "ts",
             gap_seconds_max: int = SESSION_GAP_SECONDS, closed: str = "both",
             block_cells: int | None = None) -> DataFrame:
    """One row per user and session; a gap above ``gap_seconds_max`` starts a session.

    Events of one user in the same gap-long cell of the time axis are always in
    one session, so they are first reduced to the cell's first and last time and
    count. A user with a third of all events then brings at most one row per
    cell to the window, which joins cells whose gap is small enough.

    Where the gap is short a user may have very many cells. Then sessions are found inside
    blocks of ``block_cells`` cells of a user's time, and the blocks of a user, one row each,
    are joined at their edges. By default blocks are for gaps below ``BLOCKS_BELOW_SECONDS``.
    """
    rows = with_values(time_window(events, start, end, ts=ts, closed=closed), ts)
    cell = F.window(ts, f"{gap_seconds_max} seconds")["start"]
    cells = rows.groupBy(F.col(user), cell.alias("_cell")).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count("*").alias("_n"))
    if block_cells is None and gap_seconds_max < BLOCKS_BELOW_SECONDS:
        block_cells = BLOCK_CELLS
    if block_cells is None:
        numbered = _numbered(cells, [user], "_cell", gap_seconds_max, "session")
    else:
        block = F.window("_cell", f"{gap_seconds_max * block_cells} seconds")["start"]
        numbered = _numbered_by_blocks(cells.withColumn("_block", block), user, gap_seconds_max)
    joined = numbered.groupBy(user, "session").agg(
        F.min("_first").alias("first_ts"), F.max("_last").alias("last_ts"), F.sum("_n").alias("events"))
    return joined.withColumn("seconds", gap_seconds(F.col("first_ts"), F.col("last_ts")))


def _numbered(spans: DataFrame, by: Sequence[str], order: str, gap: int, name: str) -> DataFrame:
    """Number the sessions of each group of ``by`` from 0 on; spans are in order and apart."""
    in_order = Window.partitionBy(*by).orderBy(order)
    wait = F.col("_first") - F.lag("_last").over(in_order)
    opens = F.when(wait > F.make_dt_interval(secs=F.lit(gap)), 1).otherwise(0)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return spans.withColumn("_opens", opens).withColumn(name, F.sum("_opens").over(so_far))


def _numbered_by_blocks(cells: DataFrame, user: str, gap: int) -> DataFrame:
    """Spans with their ``session``, without a window over all cells of a user."""
    inner = _numbered(cells, [user, "_block"], "_cell", gap, "_local").groupBy(user, "_block", "_local").agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.sum("_n").alias("_n"))
    blocks = inner.groupBy(user, "_block").agg(
        F.min("_first").alias("_first"), F.max("_last").alias("_last"), F.max("_local").alias("_more"))
    # Sessions begun at the edges of blocks up to here, and inside the blocks before.
    edges = _numbered(blocks, [user], "_block", gap, "_edges")
    before = Window.partitionBy(user).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.col("_edges") + F.coalesce(F.sum("_more").over(before), F.lit(0))
    offsets = edges.select(F.col(user).alias("_user"), F.col("_block").alias("_at"), offset.alias("_offset"))
    same = F.col(user).eqNullSafe(F.col("_user")) & (F.col("_block") == F.col("_at"))
    return inner.join(offsets, same).withColumn("session", F.col("_offset") + F.col("_local"))


def average_session_seconds(events: DataFrame, start: Bound = None, end: Bound = None,
                            **options) -> DataFrame:
    """Mean length of the sessions with at least two events, as one row."""
    longer = sessions(events, start, end, **options).filter(F.col("events") > 1)
    return longer.agg(F.avg("seconds").alias("avg_session_length"))


def placement_percentiles(events: DataFrame, start: Bound = None, end: Bound = None, *,
                          user: str = "user_id", ts: str = "ts",
                          points: Sequence[float] = PERCENTILES, closed: str = "left",
                          approximate: bool = False) -> DataFrame:
    """Interpolated percentiles of the events per user, as one row ``p50, p75, ...``.

    Users with equal counts are tallied first, so the exact percentile holds one
    entry per distinct count and not one per user.
    """
    rows = time_window(events, start, end, ts=ts, closed=closed)
    per_user = rows.groupBy(user).agg(F.count("*").alias("_count"))
    names = [f"p{round(p * 100, 4):g}" for p in points]
    if approximate:
        marks = F.percentile_approx("_count", list(points), 100_000)
        found = per_user.agg(marks.alias("_p"))
    else:
        tally = per_user.groupBy("_count").agg(F.count("*").alias("_users"))
        marks = F.percentile("_count", F.array(*map(F.lit, points)), F.col("_users"))
        found = tally.agg(marks.alias("_p"))
    return found.select(*(F.col("_p")[i].alias(n) for i, n in enumerate(names)))


def first_time_user_count(events: DataFrame, start: Bound, end: Bound, *,
                          user: str = "user_id", ts: str = "ts") -> DataFrame:
    """Number of users whose first event of all is in ``[start, end]``, as one row."""
    first = (
        time_window(events, None, end, ts=ts, closed="both")
        .groupBy(user).agg(F.min(ts).alias(ts))
    )
    inside = time_window(first, start, end, ts=ts, closed="both")
    return inside.agg(F.count("*").alias("first_time_user_count"))


def encode_user_ids(events: DataFrame, *, user: str = "user_id", ts: str = "ts",
                    **join_limits: int) -> tuple[DataFrame, DataFrame]:
    """Events with dense ids 0..n-1 for users, and the mapping ``(user, dense_id)``.

    Ids follow the users' first event time, then the user itself; NULL is a user.
    """
    users = events.groupBy(user).agg(F.min(ts).alias("_first"), F.count("*").alias("_events"))
    order = [F.asc_nulls_last("_first"), F.asc_nulls_last(user)]
    mapping = with_row_index(users, order, "dense_id")
    encoded = lookup(events, mapping.drop("_first"), user, "_events", **join_limits)
    others = [c for c in events.columns if c != user]
    return (
        encoded.select(*others, F.col("dense_id").alias(user)),
        mapping.select(user, "dense_id"),
    )
