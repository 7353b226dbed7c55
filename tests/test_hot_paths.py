"""Paths for hot users, large key sets and large files."""

import gzip
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallyframe import operators as ops
from tallyframe.operators import users
from tallyframe.plans.bloom import may_be_in
from tallyframe.plans.staging import stage
from tallyframe.sources import ingest_placements, read_placements_csv

START = datetime(2022, 4, 1)


def same(left, right):
    return sorted(map(str, left.collect())) == sorted(map(str, right.select(left.columns).collect()))


# Sessions in blocks.


def by_force(rows, gap):
    out = []
    times = {}
    for t, user in rows:
        times.setdefault(user, []).append(t)
    for user, seen in times.items():
        seen.sort()
        session, spans = 0, [[seen[0], seen[0], 0]]
        for t in seen:
            if t - spans[-1][1] > gap:
                spans.append([t, t, 0])
            spans[-1][1] = t
            spans[-1][2] += 1
        out += [(user, i, a, b, n) for i, (a, b, n) in enumerate(spans)]
    return sorted(out, key=str)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("gap, block", [(1, None), (1, 2), (3, 5), (7, 1), (400, 2), (400, None)])
def test_sessions_in_blocks(spark, kind, gap, block):
    rng = random.Random(gap)
    rows = [(rng.randrange(3000), rng.choice(["hot", "hot", f"u{rng.randrange(30)}", None])) for _ in range(2500)]
    events = spark.createDataFrame([(START + timedelta(seconds=t), u) for t, u in rows], "ts timestamp, user_id string")
    events = events.withColumn("ts", F.col("ts").cast(kind))
    found = ops.sessions(events, gap_seconds_max=gap, block_cells=block)
    got = sorted(((r.user_id, r.session, int((r.first_ts - START).total_seconds()),
                   int((r.last_ts - START).total_seconds()), r.events) for r in found.collect()), key=str)
    assert got == by_force(rows, gap)


def test_a_hot_user_is_many_groups(spark):
    """Half of all rows are one user's; the cells meet by user and block."""
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("user_id"),
        F.timestamp_seconds(F.col("id") * 2).alias("ts"))
    cells = rows.groupBy("user_id", F.window("ts", "1 second")["start"].alias("_cell")).agg(
        F.min("ts").alias("_first"), F.max("ts").alias("_last"), F.count("*").alias("_n"))
    block = F.window("_cell", "256 seconds")["start"]
    inner = users._numbered(cells.withColumn("_block", block), ["user_id", "_block"], "_cell", 1, "_local")
    tasks = Counter(r[0] for r in inner.repartition(8, "user_id", "_block").select(F.spark_partition_id()).collect())
    sizes = sorted(tasks.values())
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]
    assert ops.sessions(rows, gap_seconds_max=1).count() == 200_000


# Key sets beyond a broadcast.


def test_no_member_is_lost_and_few_others_stay(spark):
    keys = stage(spark.range(0, 40_000, 2).select(F.col("id").alias("user_id")), "keys")
    rows = spark.range(200_000).select(F.col("id").alias("user_id"))
    kept = rows.filter(may_be_in(keys, "user_id", F.col("user_id")))
    assert kept.join(keys, "user_id").count() == 20_000
    assert kept.count() < 20_000 + 0.05 * 180_000
    words = stage(keys.select(F.col("user_id").cast("string").alias("name")), "names")
    named = rows.select(F.col("user_id").cast("string").alias("name"))
    assert named.filter(may_be_in(words, "name", F.col("name"))).join(words, "name").count() == 20_000
    assert may_be_in(keys, "user_id", F.col("user_id"), max_words=64) is None


def test_no_keys(spark):
    keys = stage(spark.range(0).select(F.col("id").alias("user_id")), "keys")
    rows = spark.range(10).select(F.col("id").alias("user_id"))
    assert rows.filter(may_be_in(keys, "user_id", F.col("user_id"))).count() == 0


def test_the_filter_comes_before_the_shuffle(spark, plan):
    rows = [(f"2022-04-01 00:{i % 60:02d}:00", f"u{i % 500}", "#FFF", f"{i % 7},1") for i in range(3000)]
    events = spark.createDataFrame(rows, "ts string, user_id string, pixel_color string, coordinate string")
    events = stage(events.withColumn("ts", F.col("ts").cast("timestamp")), "events")
    members = events.filter("user_id < 'u2'").select("user_id").distinct()
    large = ops.top_coordinates_of(events, members, max_rows=0)
    assert same(ops.top_coordinates_of(events, members), large)
    steps = plan(large).splitlines()
    scan = next(i for i, line in reversed(list(enumerate(steps))) if "getbit" in line and "Filter" in line)
    assert "Exchange" not in "".join(steps[scan:scan + 4])


# One large gzip file.

HEADER = "timestamp,user_id,pixel_color,coordinate\n"


def write(path, lines, header=HEADER):
    path.write_bytes(gzip.compress((header + "".join(lines)).encode()))


def test_lines_are_dealt_out_before_the_parse(spark, tmp_path, plan):
    lines = [f'2022-04-01 {i % 24:02d}:00:00 UTC,"u ""{i}""",#FFF,"{i},2"\n' for i in range(500)]
    write(tmp_path / "a.csv.gz", [*lines, "\n", 'junk,u,#FFF,"1,2"\n'])
    path = str(tmp_path / "a.csv.gz")
    spread = read_placements_csv(spark, path, spread=True)
    assert same(read_placements_csv(spark, path), spread)
    steps = plan(spread.select("ts", "coordinate")).splitlines()
    parse = next(i for i, line in enumerate(steps) if "from_csv" in line)
    dealt = next(i for i, line in enumerate(steps) if "Exchange" in line)
    assert parse < dealt  # plans are printed from the end
    table = ingest_placements(spark, path, str(tmp_path / "t"), spread=True)
    assert table.count() == 500


def test_files_of_one_header(spark, tmp_path):
    write(tmp_path / "a [1].csv.gz", ['2022-04-01 00:00:00 UTC,u,#FFF,"1,2"\n'])
    write(tmp_path / "b.csv.gz", ['2022-04-01 00:00:00 UTC,v,#FFF,"1,2"\n'])
    rows = read_placements_csv(spark, str(tmp_path), spread=True)
    assert sorted(r.user_id for r in rows.collect()) == ["u", "v"]
    write(tmp_path / "c.csv.gz", ['u,2022-04-01 00:00:00 UTC,#FFF,"1,2"\n'], "user_id,timestamp,pixel_color,coordinate\n")
    with pytest.raises(ValueError, match="different headers"):
        read_placements_csv(spark, str(tmp_path), spread=True)
