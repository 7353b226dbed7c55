import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyframe import operators as ops
from tallyframe.fixtures import arrivals
from tallyframe.streaming import (
    BatchTable,
    ForeignCheckpoint,
    UserIds,
    append_to_table,
    compact_hour_counts,
    count_hours_in_batches,
    distinct_users_in_batches,
    encode_users_in_batches,
    first_time_users_so_far,
    first_times_in_batches,
    rank_by_distinct_users_so_far,
    read_first_times,
    read_hour_counts,
    read_sessions,
    sessions_in_batches,
)

EVENT = "ts timestamp, user_id string, pixel_color string"
DAY = datetime(2022, 4, 1)


class Feed:
    """A folder of files that keep arriving, and all events so far."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.rows = spark, str(folder), []

    def put(self, *rows):
        rows = [(DAY + timedelta(seconds=t) if t is not None else None, *rest) for t, *rest in rows]
        self.rows += rows
        self.frame(rows).coalesce(1).write.mode("append").parquet(self.folder)

    def frame(self, rows=None):
        return self.spark.createDataFrame(self.rows if rows is None else rows, EVENT)

    def stream(self):
        return self.spark.readStream.schema(EVENT).parquet(self.folder)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path / "in")


def same(left, right):
    return sorted(map(str, left.collect())) == sorted(map(str, right.select(left.columns).collect()))


# Batch tables.


def counted(feed, path, checkpoint, **options):
    count_hours_in_batches(feed.stream(), "pixel_color", path, checkpoint, **options).awaitTermination()
    return {r["hour"].hour: r["changes"] for r in read_hour_counts(feed.spark, path, "pixel_color").collect()}


def test_another_checkpoint_does_not_count_twice(feed, tmp_path):
    path = str(tmp_path / "t")
    feed.put((3600, "u", "a"))
    counted(feed, path, str(tmp_path / "c1"))
    feed.put((7200, "u", "a"))
    assert counted(feed, path, str(tmp_path / "c1")) == {1: 1, 2: 1}
    with pytest.raises(Exception, match="was fed by checkpoint"):
        counted(feed, path, str(tmp_path / "c2"))
    assert counted(feed, path, str(tmp_path / "c1")) == {1: 1, 2: 1}
    # A new checkpoint reads both files as its first batch, in place of all before.
    assert counted(feed, path, str(tmp_path / "c3"), replace=True) == {1: 1, 2: 1}
    feed.put((7300, "u", "a"))
    assert counted(feed, path, str(tmp_path / "c3"), replace=True) == {1: 1, 2: 2}


def test_a_batch_that_is_run_again_is_left_out(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), ["k"], {"n": F.sum})
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n long")
    assert table.add(rows, 0, "c")
    assert not table.add(rows, 0, "c")
    assert table.add(rows, 1, "c")
    assert sorted(map(tuple, table.read().collect())) == [("a", 2), ("b", 4)]
    with pytest.raises(ForeignCheckpoint):
        table.add(rows, 2, "d")


def test_readers_see_committed_folders_only(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), ["k"], {"n": F.sum})
    with pytest.raises(FileNotFoundError):
        table.read()
    rows = spark.createDataFrame([("a", 1)], "k string, n long")
    table.add(rows, 0, "c")
    rows.write.parquet(str(tmp_path / "t" / "batch_id=1" / "run=lost"))
    (tmp_path / "t" / "_commits" / "000000-000000000001").write_text('{"generation": 0')
    assert table.read().collect() == [("a", 1)]


def test_compaction_keeps_the_rows(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), ["k"], {"n": F.sum})
    rows = spark.createDataFrame([("a", 1), (None, 2)], "k string, n long")
    table.add(rows, 0, "c")
    assert not table.compact()
    table.add(rows, 1, "c")
    before = table.read()
    assert table.compact()
    assert len(table.commits()) == 1
    assert same(before, table.read())
    assert not table.add(rows, 1, "c")
    assert table.add(rows, 2, "c")
    assert sorted(map(str, table.read().collect())) == sorted(["Row(k='a', n=3)", "Row(k=None, n=6)"])
    assert table.vacuum() == 2
    assert table.read().count() == 2


def test_hour_counts_after_compaction(feed, tmp_path):
    path, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    for hour in (2, 1, 2):
        feed.put((hour * 3600, "u", "a"), (None, "u", "a"), (hour * 3600 + 1, None, None))
        counted(feed, path, checkpoint)
        compact_hour_counts(feed.spark, path, "pixel_color")
    assert counted(feed, path, checkpoint) == {1: 1, 2: 2}


# Sessions.


def streamed(feed, tmp_path, lateness="1 hour"):
    path, checkpoint = str(tmp_path / "sessions"), str(tmp_path / "c")
    sessions_in_batches(feed.stream(), path, checkpoint, lateness=lateness).awaitTermination()
    return path, checkpoint


def test_sessions_take_late_events_and_leave_the_state(feed, spark, tmp_path):
    feed.put((0, "a", "x"), (900, "a", "x"), (1900, "a", "x"), (0, "b", "x"), (None, "b", "x"), (5, None, "x"))
    path, checkpoint = streamed(feed, tmp_path)
    assert same(read_sessions(spark, path, checkpoint), ops.sessions(feed.frame()))
    feed.put((1400, "a", "x"), (4000, "b", "x"))  # joins two sessions of a
    path, checkpoint = streamed(feed, tmp_path)
    assert same(read_sessions(spark, path, checkpoint), ops.sessions(feed.frame()))
    assert read_sessions(spark, path, checkpoint).filter("user_id = 'a'").count() == 1
    feed.put((90_000, "c", "x"))
    path, checkpoint = streamed(feed, tmp_path)
    # All others are over, no longer in the state, and in the table.
    state = spark.read.format("statestore").load(checkpoint)
    assert [r["user"] for r in state.select(F.col("value.user_id").alias("user")).collect()] == ["c"]
    assert same(read_sessions(spark, path), ops.sessions(feed.frame().filter("user_id is null or user_id != 'c'")))
    assert same(read_sessions(spark, path, checkpoint), ops.sessions(feed.frame()))
    feed.put((10, "a", "x"))  # too late
    path, checkpoint = streamed(feed, tmp_path)
    assert read_sessions(spark, path, checkpoint).count() == 5


def test_sessions_of_random_users(feed, spark, tmp_path):
    rng = random.Random(2)
    rows = sorted((rng.randrange(40_000), "hot" if rng.random() < 0.4 else f"u{rng.randrange(40)}", "x")
                  for _ in range(3000))
    parts = [[], [], []]
    for row in rows:
        part = row[0] * 3 // 40_000
        parts[min(part + (rng.random() < 0.1 and row[0] % 13_333 > 10_000), 2)].append(row)
    for part in parts:
        feed.put(*part)
        path, checkpoint = streamed(feed, tmp_path)
        assert same(read_sessions(spark, path, checkpoint), ops.sessions(feed.frame()))


def test_a_session_setting_is_left_as_it_was(feed, spark, tmp_path):
    name = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    before = spark.conf.get(name)
    feed.put((0, "a", "x"))
    streamed(feed, tmp_path)
    assert spark.conf.get(name) == before


# First times.


def test_first_times_after_each_batch(feed, spark, tmp_path):
    path, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    window = ("2022-04-01 01", "2022-04-01 03")
    batches = [[(4000, "a", "x"), (8000, "b", "x"), (8100, "b", "x"), (None, "z", "x")],
               [(100, "a", "x"), (9000, "b", "x"), (5000, None, "x")],  # a is earlier than known
               [(20_000, "c", "x")], [(7200, "c", "x"), (10_800, "d", "x")]]
    for batch in batches:
        feed.put(*batch)
        first_times_in_batches(feed.stream(), path, checkpoint).awaitTermination()
        exact = ops.first_time_user_count(feed.frame(), *window)
        assert same(first_time_users_so_far(spark, path, *window), exact)
    # A batch stores what it changes: b came again, later, and left no row.
    stored = spark.read.parquet(path)
    assert stored.filter("user_id = 'b'").count() == 1
    assert stored.filter("user_id = 'a'").count() == 2
    assert read_first_times(spark, path).count() == 5


# Distinct users.


def test_sketches_are_within_their_error(feed, spark, tmp_path, plan):
    path, checkpoint = str(tmp_path / "t"), str(tmp_path / "c")
    rng = random.Random(5)
    for hour in range(4):
        feed.put(*[(hour * 3600 + rng.randrange(3600), f"u{rng.randrange(6000)}" if rng.random() < 0.99 else None,
                    rng.choice(["a", "b", None])) for _ in range(6000)])
        distinct_users_in_batches(feed.stream(), "pixel_color", path, checkpoint).awaitTermination()
    window = ("2022-04-01 01", "2022-04-01 03")
    ranked = rank_by_distinct_users_so_far(spark, path, "pixel_color", *window)
    found = {r["pixel_color"]: r["distinct_users"] for r in ranked.collect()}
    exact = {r["pixel_color"]: r["distinct_users"] for r in ops.rank_by_distinct_users(
        feed.frame(), "pixel_color", *window).collect()}
    assert found.keys() == exact.keys()
    for color, users in exact.items():
        assert abs(found[color] - users) <= 4 * 0.0065 * users
    assert feed.folder not in plan(ranked)
    with pytest.raises(ValueError, match="whole hours"):
        rank_by_distinct_users_so_far(spark, path, "pixel_color", datetime(2022, 4, 1, 1, 30))


# Dense ids.


def test_given_ids_stay_and_new_ones_follow(feed, spark, tmp_path):
    path = str(tmp_path / "ids")
    batches = [[(5, "b", "x"), (7, "a", "x"), (9, "b", "x"), (None, "n", "x")], [(1, "c", "x"), (2, "a", "x")],
               [(3, None, "x"), (4, "a", "x")], [(6, "b", "x")]]
    wanted = {}
    for i, batch in enumerate(batches):
        feed.put(*batch)
        ids = UserIds(spark, path)
        rows = feed.frame(feed.rows[-len(batch):])
        encoded = ids.encode(rows, i)
        assert encoded.count() == len(batch)
        found = {r["user_id"]: r["dense_id"] for r in ids.mapping().collect()}
        assert sorted(found.values()) == list(range(len(found)))
        assert wanted.items() <= found.items()
        wanted = found
        # Again, as after a failure.
        assert same(encoded, ids.encode(rows, i))
        assert ids.mapping().count() == len(found)
    assert wanted == {"b": 0, "a": 1, "n": 2, "c": 3, None: 4}
    assert ids.compact()
    assert {r["user_id"]: r["dense_id"] for r in ids.mapping().collect()} == wanted


def test_events_are_encoded_as_they_arrive(feed, spark, tmp_path):
    ids = UserIds(spark, str(tmp_path / "ids"))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")
    for part in range(3):
        feed.put(*[(part * 50 + i, f"u{(i * 7 + part) % 30}" if i % 3 else "hot", "x") for i in range(50)])
        encode_users_in_batches(feed.stream(), ids, out, checkpoint).awaitTermination()
    found = BatchTable(spark, out).read()
    wanted = feed.frame().join(ids.mapping(), "user_id").select("ts", "pixel_color", F.col("dense_id").alias("user_id"))
    assert same(found, wanted)


def test_parts_arrive_late_but_whole(spark, events):
    rows = events(*[(f"2022-04-{d:02d} {h:02d}:00:00", f"u{h % 5}") for d in range(1, 10) for h in range(24)])
    parts = arrivals(rows)
    assert sum(p.count() for p in parts) == rows.count()
    assert parts[1].agg(F.min("ts")).first()[0] < parts[0].agg(F.max("ts")).first()[0]
