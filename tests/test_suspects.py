import random
from collections import Counter

import pytest

from tallyframe import operators as ops
from tallyframe.fixtures import placements
from tallyframe.functions import Box


def test_top_percent_is_cut_down_and_at_least_one(events):
    rows = [("2022-04-01 00:00:00", f"u{n:03d}") for n in range(150) for _ in range(1 + n % 7)]
    rows += [(None, "no time"), ("2022-04-01 00:00:00", None)]
    df = events(*rows)
    # 151 users, 1.99 % of them is 3.0049.
    got = ops.most_active_users(df, 1.99).collect()
    want = sorted(Counter(u for t, u in rows if t and u).items(), key=lambda kv: (-kv[1], kv[0]))
    assert [tuple(r) for r in got] == want[:3]
    assert ops.most_active_users(df, 0.0001).count() == 1
    assert ops.total_users(df).first()[0] == 151
    everyone = ops.most_active_users(df, 100, take_rows=10)
    assert sorted(map(tuple, everyone.collect())) == sorted(want)
    long = ops.most_active_users(df, 40, take_rows=10)
    assert sorted(map(tuple, long.collect())) == sorted(want[:60])


def test_mean_gap_equals_mean_of_gaps(events):
    rng = random.Random(5)
    rows = [(f"2022-04-01 {rng.randrange(24):02d}:{rng.randrange(60):02d}:{rng.random() * 59:09.6f}",
             f"u{rng.randrange(9)}") for _ in range(300)]
    rows.append(("2022-04-01 00:00:00", "once"))
    df = events(*rows)
    got = {r.user_id: r.avg_interval
           for r in ops.suspicious_users(df, top_percent=100, max_mean_gap=1e9).collect()}
    times = {}
    for t, u in rows:
        h, m, s = t[11:].split(":")
        times.setdefault(u, []).append(int(h) * 3600 + int(m) * 60 + float(s))
    want = {}
    for u, ts in times.items():
        ts.sort()
        gaps = [b - a for a, b in zip(ts, ts[1:])]
        if gaps:
            want[u] = pytest.approx(sum(gaps) / len(gaps), abs=1e-6)
    assert got == want


def test_suspicious_among_given_users(events):
    df = events(*[(f"2022-04-01 00:0{i}:00", u) for i in range(5) for u in ("a", "b")],
                ("2022-04-01 00:00:00", "c"), ("2022-04-01 00:07:00", "c"),
                ("2022-04-01 00:00:00", "d"), ("2022-04-01 00:06:59", "d"))
    given = df.select("user_id").filter("user_id in ('a', 'c', 'd')").distinct()
    got = [tuple(r) for r in ops.suspicious_users(df, given).collect()]
    assert got == [("a", 60.0), ("d", 419.0)]
    assert ops.suspicious_users(df, given.limit(0)).collect() == []


@pytest.mark.parametrize("limits", [{}, {"max_rows": 0}])
def test_where_suspects_act(events, limits):
    rng = random.Random(11)
    rows = []
    for i in range(900):
        user = "bot" if i % 3 == 0 else f"u{rng.randrange(30)}"
        place = rng.choice([None, "5", "", *(f"{rng.randrange(12)},{rng.randrange(12)}" for _ in range(9))])
        rows.append((f"2022-04-01 {rng.randrange(6):02d}:{rng.randrange(60):02d}:00", user, "c", place))
    df = events(*rows)
    suspects = df.filter("user_id in ('bot', 'u1', 'u2')").select("user_id").distinct()
    mine = [r for r in rows if r[1] in ("bot", "u1", "u2")]
    top = sorted(Counter(r[3] for r in mine).items(), key=lambda kv: (-kv[1], kv[0] is None, kv[0] or ""))
    got = ops.top_coordinates_of(df, suspects, 20, **limits).collect()
    assert [tuple(r) for r in got] == top[:20]
    boxes = [Box(0, 3, 0, 3), Box(2, 9, 2, 5)]

    def inside(place):
        parts = (place or "").split(",")
        if len(parts) != 2:
            return False
        x, y = map(int, parts)
        return any(b.x_min <= x <= b.x_max and b.y_min <= y <= b.y_max for b in boxes)

    want = sorted(Counter(int(r[0][11:13]) for r in mine if inside(r[3])).items(), key=lambda kv: (-kv[1], kv[0]))
    got = ops.hourly_activity_in_regions(df, suspects, boxes, **limits).collect()
    assert [(r.hour.hour, r.bot_changes) for r in got] == want


def test_no_suspects_no_activity(spark, medium):
    df = placements(spark, medium)
    nobody = ops.suspicious_users(df)  # the fixed threshold selects nobody here
    assert nobody.count() == 0
    assert ops.top_coordinates_of(df, nobody).count() == 0
    assert ops.hourly_activity_in_regions(df, nobody).count() == 0


def test_suspects_need_no_window(spark, medium, plan):
    text = plan(ops.suspicious_users(placements(spark, medium)))
    assert "Window" not in text and "Join" not in text
