import random
from collections import Counter, defaultdict
from statistics import median

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe import operators as ops
from tallyframe.fixtures import placements
from tallyframe.plans import count_members


@pytest.fixture
def canvas(events):
    rng = random.Random(7)
    rows = []
    for i in range(600):
        # A third of all events is one colour on one coordinate in one hour.
        hot = i % 3 == 0
        hour = 5 if hot else rng.randrange(12)
        color = "#FF" if hot else rng.choice([" #ff ", "#00", "#0A", "#0a"])
        place = "1,1" if hot else f"{rng.randrange(6)},{rng.randrange(4)}"
        rows.append((f"2022-04-01 {hour:02d}:{rng.randrange(60):02d}:00", f"u{i % 40}", color, place))
    return events(*rows), [(r[0][11:13], r[2].strip().lower(), r[3]) for r in rows]


def test_counts_merge_spellings_and_skip_nulls_per_key(events):
    df = events(("2022-04-01 00:00:00", "a", " #FF ", "1,1"), ("2022-04-01 00:00:01", "a", "#ff", None),
                ("2022-04-01 00:00:02", "a", None, "1,1"), (None, "a", "#ff", "1,1"))
    assert [tuple(r) for r in ops.value_counts(df, "pixel_color").collect()] == [("#ff", 2)]
    assert [tuple(r) for r in ops.value_counts(df, "coordinate").collect()] == [("1,1", 2)]
    raw = ops.value_counts(df, "pixel_color", normalize=False)
    assert sorted(map(tuple, raw.collect())) == [(" #FF ", 1), ("#ff", 1)]


def test_most_frequent_of_several_keys_scans_once(events):
    df = events(("2022-04-01 00:00:00", "a", "b", "1,1"), ("2022-04-01 00:00:01", "a", "A", None),
                ("2022-04-01 00:00:02", "a", None, "2,1"), ("2022-04-01 00:00:03", "a", None, "1,1"))
    top = ops.most_frequent_each(df, ("pixel_color", "coordinate"))
    assert [tuple(r) for r in top.collect()] == [("coordinate", "1,1", 2), ("pixel_color", "a", 1)]
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Union" not in plan


def test_ties_go_to_the_smaller_key(events):
    df = events(*[("2022-04-01 00:00:00", "a", c, "0,0") for c in ("b", "a", "c", "c", "b", "a", "d")])
    assert [tuple(r) for r in ops.most_frequent(df, "pixel_color").collect()] == [("a", 2)]
    three = ops.top_values(df, "pixel_color", 3)
    top = ops.numbered(three, "pixel_color", row_bound=3)
    assert sorted(map(tuple, ops.numbered(three, "pixel_color").collect())) == sorted(map(tuple, top.collect()))
    assert sorted(map(tuple, top.collect())) == [("a", 2, 1), ("b", 2, 2), ("c", 2, 3)]


def test_empty_window_gives_no_rows(events):
    df = events(("2022-04-01 00:00:00", "a", "x", "0,0"))
    far = ("2023-01-01 00", "2023-01-02 00")
    assert ops.most_frequent(df, "pixel_color", *far).collect() == []
    assert ops.hourly_counts_of_top(df, "coordinate", 3, *far).collect() == []
    assert ops.changes_histogram(df, "coordinate", *far).collect() == []


def test_hourly_against_brute_force(canvas):
    df, rows = canvas
    per = Counter((h, c) for h, _, c in rows)
    got = {(f"{r.hour:%H}", r.coordinate): r.changes for r in ops.hourly_counts(df, "coordinate").collect()}
    assert got == per
    by_hour = defaultdict(list)
    for (h, _), n in per.items():
        by_hour[h].append(n)
    got = {f"{r.hour:%H}": r.median_changes for r in ops.hourly_median(df, "coordinate").collect()}
    assert got == {h: median(v) for h, v in by_hour.items()}
    totals = sorted(Counter(c for _, _, c in rows).items(), key=lambda kv: (-kv[1], kv[0]))[:3]
    top = {c for c, _ in totals}
    got = {(f"{r.hour:%H}", r.coordinate): r.changes
           for r in ops.hourly_counts_of_top(df, "coordinate", 3).collect()}
    assert got == {k: n for k, n in per.items() if k[1] in top}


def test_top_values_per_top_key(canvas):
    df, rows = canvas
    top = [c for c, _ in sorted(Counter(c for _, _, c in rows).items(), key=lambda kv: (-kv[1], kv[0]))[:3]]
    want = []
    for c in top:
        colors = Counter(color for _, color, place in rows if place == c)
        best = sorted(colors.items(), key=lambda kv: (-kv[1], kv[0]))[:2]
        want += [(c, color, n, i + 1) for i, (color, n) in enumerate(best)]
    got = ops.top_values_per_top_key(df, "coordinate", "pixel_color", 3, 2).collect()
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("values", [[1, 1, 2, 5, 101], [4], [4, 4, 4], list(range(1, 52)), [0, 50, 25, 49]])
def test_histogram_matches_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = ops.histogram(df, "v").collect()
    counts, edges = np.histogram(values, bins=50)
    assert [r.n for r in got] == counts.tolist()
    assert np.allclose([r.bin_start for r in got], edges[:-1])
    assert np.allclose([r.bin_end for r in got], edges[1:])


def test_counts_add_up(spark, medium):
    df = placements(spark, medium)
    whole = ops.value_counts(df, "pixel_color", "2024-01-05 00", "2024-01-12 00")
    assert whole.agg(F.sum("n")).first()[0] == 2285
    halves = [ops.value_counts(df, "pixel_color", *w)
              for w in (("2024-01-05 00", "2024-01-08 07"), ("2024-01-08 07", "2024-01-12 00"))]
    both = halves[0].union(halves[1]).groupBy("pixel_color").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, whole.collect()))


def test_large_member_sets_are_salted_and_equal(canvas, plan):
    df, _ = canvas
    members = df.select("coordinate").distinct().orderBy("coordinate").limit(5)
    small = count_members(df, members, "coordinate", ["pixel_color"])
    large = count_members(df, members, "coordinate", ["pixel_color"], max_rows=0)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))
    assert "_salt" in plan(large)
    assert "BroadcastHashJoin" in plan(small)


def test_plans(spark, medium, plan):
    df = placements(spark, medium)
    week = ("2024-01-05 00", "2024-01-12 00")
    top = plan(ops.most_frequent(df, "coordinate", *week))
    assert "TakeOrderedAndProject" in top and "partial_count" in top
    assert "GreaterThanOrEqual(ts" in top and "LessThan(ts" in top
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in top
    per_key = plan(ops.top_values_per_top_key(df, "coordinate", "pixel_color", 3, 2, *week))
    assert "WindowGroupLimit" in per_key and "LeftSemi" in per_key
