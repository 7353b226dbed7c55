import random
from datetime import datetime, timedelta

import numpy as np
import pytest

from tallyframe import operators as ops
from tallyframe.fixtures import placements

START = datetime(2022, 4, 1)


def brute_sessions(rows, gap=900):
    by_user = {}
    for ts, user in rows:
        by_user.setdefault(user, []).append(ts)
    out = []
    for user, times in by_user.items():
        times.sort()
        run = [times[0]]
        for t in times[1:]:
            if (t - run[-1]).total_seconds() > gap:
                out.append((user, run))
                run = []
            run.append(t)
        out.append((user, run))
    return out


def test_sessions_gap_rule(events):
    df = events(("2022-04-01 00:07:00", "a"), ("2022-04-01 00:22:00", "a"),
                ("2022-04-01 00:37:00.000001", "a"),
                ("2022-04-01 05:00:00", "b"), ("2022-04-01 05:00:00", "b"))
    got = sorted((r.user_id, r.session, r.events, r.seconds) for r in ops.sessions(df).collect())
    assert got == [("a", 0, 2, 900.0), ("a", 1, 1, 0.0), ("b", 0, 2, 0.0)]
    assert ops.average_session_seconds(df).first()[0] == 450.0


@pytest.mark.parametrize("gap", [60, 900, 5400])
def test_sessions_against_brute_force(spark, gap):
    rng = random.Random(gap)
    rows = []
    for i in range(900):
        # One user has a third of all events; one user is NULL.
        user = 0 if i % 3 == 0 else rng.choice([None, 1, 2, 3, 4])
        rows.append((START + timedelta(seconds=rng.randrange(0, 86400, 30)), user))
    df = spark.createDataFrame(rows, "ts timestamp_ntz, user_id int")
    got = sorted((str(r.user_id), r.first_ts, r.last_ts, r.events)
                 for r in ops.sessions(df, gap_seconds_max=gap).collect())
    assert got == sorted((str(u), run[0], run[-1], len(run)) for u, run in brute_sessions(rows, gap))


def test_session_window_is_closed(events):
    df = events(("2022-04-01 00:55:00", "a"), ("2022-04-01 01:00:00", "a"))
    assert ops.average_session_seconds(df, "2022-04-01 00", "2022-04-01 01").first()[0] == 300.0
    assert ops.average_session_seconds(df, "2022-04-02 00", "2022-04-02 01").first()[0] is None


def test_session_golden(spark, medium):
    got = ops.sessions(placements(spark, medium)).filter("events > 1")
    assert got.count() == 222
    assert got.agg({"seconds": "avg"}).first()[0] == pytest.approx(461.0801, abs=1e-4)


def test_distinct_users_keep_the_null_value(events):
    df = events(("2022-04-01 00:00:00", "a", "x"), ("2022-04-01 00:00:01", "a", "x"),
                ("2022-04-01 00:00:02", "b", "X"), ("2022-04-01 00:00:03", "b", None),
                ("2022-04-01 00:00:04", None, None), ("2022-04-01 01:00:00", "c", "x"))
    got = ops.rank_by_distinct_users(df, "pixel_color", "2022-04-01 00", "2022-04-01 01").collect()
    assert [tuple(r) for r in got] == [("X", 1), ("x", 1), (None, 1)]


def test_percentiles_interpolate(events):
    counts = [1, 2, 3, 10, 40]
    df = events(*[("2022-04-01 00:00:00", f"u{n}") for n in counts for _ in range(n)])
    row = ops.placement_percentiles(df).first()
    assert row.asDict() == {
        f"p{p}": pytest.approx(np.percentile(counts, p)) for p in (50, 75, 90, 99)}
    assert ops.placement_percentiles(df, points=[0.999]).columns == ["p99.9"]


def test_first_time_users(events):
    df = events(("2022-04-01 00:00:00", "old"), ("2022-04-01 02:30:00", "old"),
                ("2022-04-01 02:00:00", "at start"), ("2022-04-01 03:00:00", "at end"),
                ("2022-04-01 03:00:00.000001", "late"), ("2022-04-01 02:10:00", None))
    got = ops.first_time_user_count(df, "2022-04-01 02", "2022-04-01 03").first()[0]
    assert got == 3


@pytest.mark.parametrize("limits", [{}, {"max_rows": 0}])
def test_encoding_is_a_bijection(spark, events, plan, limits):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rng = random.Random(3)
    rows = []
    for i in range(6000):
        user = "hot" if i % 3 == 0 else rng.choice([None, *(f"u{n}" for n in range(2000))])
        rows.append((f"2022-04-01 {rng.randrange(24):02d}:{rng.randrange(60):02d}:00", user, "c", str(i)))
    df = events(*rows)
    encoded, mapping = ops.encode_user_ids(df, **limits)
    users = {r[1] for r in rows}
    ids = {r.user_id: r.dense_id for r in mapping.collect()}
    assert ids.keys() == users and sorted(ids.values()) == list(range(len(users)))
    first = {}
    for ts, user, *_ in rows:
        first[user] = min(first.get(user, ts), ts)
    want = sorted(users, key=lambda u: (first[u], u is None, u or ""))
    assert sorted(users, key=ids.get) == want
    by_place = {r.coordinate: r.user_id for r in encoded.collect()}
    assert by_place == {r[3]: ids[r[1]] for r in rows}
    assert ("Union" in plan(encoded)) == bool(limits)
    assert ("SortMergeJoin" in plan(encoded)) == bool(limits)


def test_encoding_of_no_rows(spark):
    df = spark.createDataFrame([], "ts timestamp, user_id string")
    encoded, mapping = ops.encode_user_ids(df)
    assert (encoded.count(), mapping.count()) == (0, 0)


def test_sketches_are_close(spark, medium):
    df = placements(spark, medium)
    exact = {r.pixel_color: r.distinct_users for r in ops.rank_by_distinct_users(df).collect()}
    for r in ops.rank_by_distinct_users(df, approximate=True).collect():
        assert abs(r.distinct_users - exact[r.pixel_color]) <= 0.15 * exact[r.pixel_color]
    whole, sketch = (ops.placement_percentiles(df, approximate=a).first() for a in (False, True))
    assert all(abs(a - b) <= 2 for a, b in zip(whole, sketch))
