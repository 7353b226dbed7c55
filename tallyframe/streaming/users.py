"""Per-user results that grow with what arrives: sessions, first times, distinct users, dense ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyframe.functions.nulls import with_values
from tallyframe.functions.timewin import as_hour, gap_seconds, time_window
from tallyframe.operators.users import SESSION_GAP_SECONDS, Bound
from tallyframe.plans.joins import lookup
from tallyframe.plans.ranking import with_row_index
from tallyframe.plans.staging import stage
from tallyframe.streaming.batches import BatchTable, checkpoint_id
from tallyframe.streaming.placements import append_to_table

# Lets a task merge its events into sessions before the shuffle.
_MERGE_EARLY = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
SKETCH_BITS = 14  # standard error 0.65 %; up to some thousand users nearly exact


# Sessions.


def sessions_in_batches(events: DataFrame, path: str, checkpoint: str, *, user: str = "user_id",
                        ts: str = "ts", gap_seconds_max: int = SESSION_GAP_SECONDS,
                        lateness: str = "1 hour") -> StreamingQuery:
    """Add the sessions that ended in what has arrived to a table, and stop.

    Open sessions are keyed state. A late event joins the sessions around it. A session is
    over, leaves the state and is appended to the table when the watermark, the latest time so
    far less ``lateness``, passes its last event by the gap; an event that is later than that
    is dropped. Events without a time are dropped, those without a user are one user's.

    Each task merges its events into sessions before the shuffle, so a user with a third of
    all events brings a row per session and task, not one per event.
    """
    spark = events.sparkSession
    rows = with_values(events.select(user, ts), ts).withWatermark(ts, lateness)
    # A gap that is exactly the longest one stays in the session, here as in `sessions`.
    spans = rows.groupBy(user, F.session_window(ts, f"{gap_seconds_max} seconds").alias("_span")).agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count("*").alias("events"))
    before = spark.conf.get(_MERGE_EARLY)
    spark.conf.set(_MERGE_EARLY, "true")  # a query keeps the settings that it starts with
    try:
        return append_to_table(spans.select(user, "first_ts", "last_ts", "events"), path, checkpoint)
    finally:
        spark.conf.set(_MERGE_EARLY, before)


def read_sessions(spark: SparkSession, path: str, checkpoint: str | None = None, *,
                  user: str = "user_id") -> DataFrame:
    """One row per user and session, as ``sessions`` gives them.

    With the ``checkpoint`` the sessions that are still open are read from its state.
    """
    rows = spark.read.parquet(path).select(user, "first_ts", "last_ts", "events")
    if checkpoint is not None:
        state = spark.read.format("statestore").load(checkpoint)
        rows = rows.unionByName(state.select(
            F.col("value")[user].alias(user), F.col("value.min").alias("first_ts"),
            F.col("value.max").alias("last_ts"), F.col("value.count").alias("events")))
    in_order = Window.partitionBy(user).orderBy("first_ts")
    return rows.select(
        user, (F.row_number().over(in_order) - 1).cast("long").alias("session"), "first_ts", "last_ts",
        "events", gap_seconds(F.col("first_ts"), F.col("last_ts")).alias("seconds"))


# First times.


def _first_times(spark: SparkSession, path: str, user: str, ts: str) -> BatchTable:
    return BatchTable(spark, path, [user], {ts: F.min})


def first_times_in_batches(events: DataFrame, path: str, checkpoint: str, *, user: str = "user_id",
                           ts: str = "ts", replace: bool = False) -> StreamingQuery:
    """Keep each user's first time over all that has arrived, and stop.

    A batch adds the users that are new and those whose first time an earlier event moves; the
    others leave no row. Nothing is too late.
    """
    spark = events.sparkSession
    table = _first_times(spark, path, user, ts)

    def news(batch: DataFrame) -> DataFrame:
        first = batch.groupBy(user).agg(F.min(ts).alias(ts))
        if not table.commits():
            return first
        known = table.read().select(F.col(user).alias("_user"), F.col(ts).alias("_first"))
        # One row per user on both sides.
        joined = first.join(known, F.col(user).eqNullSafe(F.col("_user")), "left")
        return joined.filter(F.col("_first").isNull() | (F.col(ts) < F.col("_first"))).select(user, ts)

    return table.feed(with_values(events.select(user, ts), ts), news, checkpoint, replace=replace)


def read_first_times(spark: SparkSession, path: str, *, user: str = "user_id", ts: str = "ts") -> DataFrame:
    """Each user with the first time so far."""
    return _first_times(spark, path, user, ts).read()


def first_time_users_so_far(spark: SparkSession, path: str, start: Bound, end: Bound, *,
                            user: str = "user_id", ts: str = "ts") -> DataFrame:
    """Number of users whose first event of all so far is in ``[start, end]``, as one row."""
    inside = time_window(read_first_times(spark, path, user=user, ts=ts), start, end, ts=ts, closed="both")
    return inside.agg(F.count("*").alias("first_time_user_count"))


# Distinct users by sketches.


def _union(name: str) -> Column:
    return F.hll_union_agg(name)


def _sketches(spark: SparkSession, path: str, key: str) -> BatchTable:
    return BatchTable(spark, path, ["hour", key], {"users": _union})


def distinct_users_in_batches(events: DataFrame, key: str, path: str, checkpoint: str, *,
                              user: str = "user_id", ts: str = "ts", bits: int = SKETCH_BITS,
                              replace: bool = False) -> StreamingQuery:
    """Keep a mergeable sketch of the distinct users per hour and value of ``key``, and stop.

    Values of ``key`` are taken as they are, NULL is one of them; NULL is no user.
    """
    table = _sketches(events.sparkSession, path, key)
    rows = with_values(events, ts).select(F.date_trunc("hour", ts).alias("hour"), key, user)

    def sketched(batch: DataFrame) -> DataFrame:
        return batch.groupBy("hour", key).agg(F.hll_sketch_agg(user, F.lit(bits)).alias("users"))

    return table.feed(rows, sketched, checkpoint, replace=replace)


def rank_by_distinct_users_so_far(spark: SparkSession, path: str, key: str, start: Bound = None,
                                  end: Bound = None) -> DataFrame:
    """Values of ``key`` by the estimated distinct users in ``[start, end)``, from sketches alone.

    The bounds are whole hours, of which the sketches are. The standard error is that of the
    sketches, 0.65 % with the default bits.
    """
    for bound in (start, end):
        at = as_hour(bound) if bound is not None else None
        if at is not None and (at.minute or at.second or at.microsecond):
            raise ValueError(f"sketches are kept by whole hours, {bound!r} is none")
    rows = time_window(_sketches(spark, path, key).read(), start, end, ts="hour", closed="left")
    ranked = rows.groupBy(key).agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("distinct_users"))
    return ranked.orderBy(F.desc("distinct_users"), F.asc_nulls_last(key))


# Dense ids.


class UserIds:
    """A stored dictionary of dense ids that grows by batches; given ids stay.

    Ids are 0, 1, 2, ... without holes: a batch numbers its new users from the number of known
    ones on, in the order of their first time in the batch, then of the user. NULL is a user.
    """

    def __init__(self, spark: SparkSession, path: str, *, user: str = "user_id", ts: str = "ts") -> None:
        self._table = BatchTable(spark, path)
        self._user, self._ts = user, ts

    def mapping(self) -> DataFrame:
        return self._table.read()

    def compact(self) -> bool:
        """Put the batches of the dictionary into one folder."""
        return self._table.compact()

    def _known(self, users: DataFrame) -> DataFrame:
        """``users``, one row each, with their ids, null for new ones."""
        if not self._table.commits():
            return users.withColumn("dense_id", F.lit(None).cast("long"))
        known = self.mapping().withColumnRenamed(self._user, "_known")
        return users.join(known, F.col(self._user).eqNullSafe(F.col("_known")), "left").drop("_known")

    def add(self, events: DataFrame, batch: int, owner: str = "caller", *, replace: bool = False) -> DataFrame:
        """Give ids to the new users of a batch and return the users of the batch, staged, with
        their ids and their numbers of events, ``_events``.

        A batch that is run again adds nobody.
        """
        users = stage(events.groupBy(self._user).agg(
            F.min(self._ts).alias("_first"), F.count("*").alias("_events")), "batch-users")
        joined = stage(self._known(users), "known-users")
        new = joined.filter("dense_id is null").select(self._user, "_first")
        size = self.mapping().count() if self._table.commits() else 0
        order = [F.asc_nulls_last("_first"), F.asc_nulls_last(self._user)]
        numbered = with_row_index(new, order, "dense_id").select(
            self._user, (F.col("dense_id") + F.lit(size)).alias("dense_id"))
        self._table.add(numbered, batch, owner, replace=replace)
        return stage(self._known(users), "batch-ids")

    def encode(self, events: DataFrame, batch: int, owner: str = "caller", *, replace: bool = False,
               **join_limits: int) -> DataFrame:
        """The events of a batch with their users' ids in place of the users."""
        ids = self.add(events, batch, owner, replace=replace)
        encoded = lookup(events, ids.drop("_first"), self._user, "_events", **join_limits)
        others = [c for c in events.columns if c != self._user]
        return encoded.select(*others, F.col("dense_id").alias(self._user))


def encode_users_in_batches(events: DataFrame, ids: UserIds, path: str, checkpoint: str, *,
                            replace: bool = False) -> StreamingQuery:
    """Add what has arrived, with dense user ids, to the table of batches at ``path``, and stop.

    ``BatchTable(spark, path).read()`` has the rows.
    """
    spark = events.sparkSession
    table = BatchTable(spark, path)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        owner = checkpoint_id(batch.sparkSession, checkpoint)
        # First the dictionary: if the rows are lost, the batch finds its users known.
        table.add(ids.encode(batch, batch_id, owner, replace=replace), batch_id, owner, replace=replace)

    return (
        events.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
