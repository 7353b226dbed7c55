from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from tallyframe.functions import (
    as_hour,
    check_range,
    gap_seconds,
    hour_bucket,
    normalized,
    parse_event_time,
    split_coordinate,
    time_window,
)
from tallyframe.functions.coords import Box, in_any_box


def test_parse_takes_both_formats_only(spark):
    texts = ["2022-04-01 12:44:10.315 UTC", "2022-04-01 12:44:10 UTC", "2022", "2022-04-01",
             "2022-04-01 12:44:10", "2022-04-01 12:44:10+02:00", "2022-13-01 00:00:00 UTC", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", parse_event_time("t").cast("string").alias("ts")).orderBy("i").collect()
    assert [r.ts for r in got] == ["2022-04-01 12:44:10.315", "2022-04-01 12:44:10"] + [None] * 7


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_window_bounds(events, kind):
    df = events(("2022-04-01 00:00:00", "start"), ("2022-04-01 00:59:59.999999", "inside"),
                ("2022-04-01 01:00:00", "end"), ("2022-03-31 23:59:59", "before"),
                (None, "null"), kind=kind)
    users = lambda d: sorted(r.user_id for r in d.collect())
    left = time_window(df, "2022-04-01 00", "2022-04-01 01")
    both = time_window(df, "2022-04-01 00", "2022-04-01 01", closed="both")
    upper = time_window(df, None, "2022-04-01 01", closed="both")
    assert users(left) == ["inside", "start"]
    assert users(both) == ["end", "inside", "start"]
    assert users(upper) == ["before", "end", "inside", "start"]


def test_window_needs_hours_in_order(events):
    with pytest.raises(ValueError):
        check_range("2022-04-01 05", "2022-04-01 05")
    with pytest.raises(ValueError):
        as_hour("2022-04-01")
    with pytest.raises(ValueError):
        time_window(events(("2022-04-01 00:00:00", "a")), None, None, closed="right")
    assert as_hour(datetime(2022, 4, 1, 3, tzinfo=timezone.utc)) == datetime(2022, 4, 1, 3)


def test_window_refuses_text(spark):
    with pytest.raises(TypeError):
        time_window(spark.createDataFrame([("x",)], "ts string"), "2022-04-01 00", None)


def test_window_prunes_date_partitions(spark, events, tmp_path, plan):
    df = events(*[(f"2022-04-0{d} 10:00:00", f"u{d}") for d in range(1, 6)])
    path = str(tmp_path / "t")
    df.withColumn("event_date", F.to_date("ts")).write.partitionBy("event_date").parquet(path)
    kept = time_window(spark.read.parquet(path), "2022-04-02 00", "2022-04-03 12")
    assert sorted(r.event_date for r in kept.collect()) == [date(2022, 4, 2), date(2022, 4, 3)]
    text = plan(kept)
    assert "PartitionFilters: [isnotnull(event_date" in text
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in text


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_hour_and_gap_ignore_the_session_zone(spark, events, zone, kind):
    # 02:30 does not exist in New York on this day.
    df = events(("2022-03-13 02:30:00", "2022-03-13 02:30:00.25"), kind=kind)
    old = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame(df.select(F.expr("cast(ts as string)").alias("t")).collect())
    cast = F.col("t").cast("timestamp_ntz") if kind == "timestamp_ntz" else F.to_timestamp(
        F.concat("t", F.lit(" UTC")))
    df = df.withColumn("ts", cast)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = df.select(
            (gap_seconds(hour_bucket(), F.col("ts"))).alias("into"),
            gap_seconds(F.col("ts"), F.col("ts") + F.expr("interval 250 milliseconds")).alias("gap"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert (row.into, row.gap) == (1800.0, 0.25)


def test_gap_over_a_clock_change(spark, events):
    df = events(("2022-03-12 23:59:59.5",)).withColumn(
        "later", F.lit("2022-03-14 01:00:00.25").cast("timestamp_ntz"))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        gap = df.select(gap_seconds(F.col("ts"), F.col("later")), gap_seconds(F.col("later"), F.col("ts")))
        assert tuple(gap.first()) == (90_000.75, -90_000.75)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_normalized_strips_spaces_not_tabs(spark):
    df = spark.createDataFrame([("  #FFF ",), ("\t#FFF",)], "c string")
    assert [r[0] for r in df.select(normalized("c")).collect()] == ["#fff", "\t#fff"]


def test_coordinates(spark):
    df = spark.createDataFrame(
        [("5,29",), ("5",), ("",), ("a,b",), (None,), ("10,40",), ("11,40",)], "c string")
    x, y = split_coordinate("c")
    assert [(r[0], r[1]) for r in df.select(x, y).collect()] == [
        (5, 29), (5, None), (None, None), (None, None), (None, None), (10, 40), (11, 40)]
    boxes = [Box(5, 10, 29, 40)]
    assert [r[0] for r in df.filter(in_any_box(x, y, boxes)).collect()] == ["5,29", "10,40"]
    assert df.filter(in_any_box(x, y, [])).count() == 0
