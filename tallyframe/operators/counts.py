"""Counting operators: most frequent values, hourly activity and its spread."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.functions.nulls import with_values
from tallyframe.functions.text import normalized
from tallyframe.functions.timewin import hour_bucket, time_window
from tallyframe.plans.joins import count_members
from tallyframe.plans.ranking import TAKE_ROWS, first_rows, with_row_index
from tallyframe.plans.staging import stage

Bound = str | datetime | None

HISTOGRAM_BINS = 50


def _in_window(events: DataFrame, keys: list[str], start: Bound, end: Bound, ts: str,
               normalize: bool) -> DataFrame:
    """``ts`` and the non-null keys of the events in ``[start, end)``."""
    rows = time_window(events, start, end, ts=ts)
    rows = with_values(rows, ts, *keys)
    return rows.select(ts, *((normalized(k) if normalize else F.col(k)).alias(k) for k in keys))


def _by_count(name: str, key: str) -> list[Column]:
    """Most frequent first; equal counts in the order of the key."""
    return [F.desc(name), F.asc_nulls_last(key)]


def value_counts(events: DataFrame, key: str, start: Bound = None, end: Bound = None, *,
                 ts: str = "ts", normalize: bool = True, name: str = "n",
                 ordered: bool = True) -> DataFrame:
    """Count of every value of ``key`` in the window, most frequent first."""
    rows = _in_window(events, [key], start, end, ts, normalize)
    counts = rows.groupBy(key).agg(F.count("*").alias(name))
    return counts.orderBy(*_by_count(name, key)) if ordered else counts


def most_frequent(events: DataFrame, key: str, start: Bound = None, end: Bound = None, *,
                  ts: str = "ts", normalize: bool = True, name: str = "n") -> DataFrame:
    """The most frequent value of ``key``: one row, or none for an empty window."""
    counts = value_counts(events, key, start, end, ts=ts, normalize=normalize, name=name,
                          ordered=False)
    return counts.orderBy(*_by_count(name, key)).limit(1)


def top_values(events: DataFrame, key: str, k: int = 3, start: Bound = None, end: Bound = None,
               *, ts: str = "ts", normalize: bool = True, name: str = "n") -> DataFrame:
    """The ``k`` most frequent values of ``key``."""
    counts = value_counts(events, key, start, end, ts=ts, normalize=normalize, name=name,
                          ordered=False)
    return first_rows(counts, _by_count(name, key), k)


def most_frequent_each(events: DataFrame, keys: Sequence[str], start: Bound = None, end: Bound = None,
                       *, ts: str = "ts", normalize: bool = True, name: str = "n") -> DataFrame:
    """The most frequent value of each of ``keys``, from one scan: ``key``, ``value``, ``name``.

    A key without values in the window has no row. Values are text.
    """
    rows = with_values(time_window(events, start, end, ts=ts), ts)
    pairs = F.array(*(
        F.struct(F.lit(k).alias("key"),
                 (normalized(k) if normalize else F.col(k)).cast("string").alias("value")) for k in keys))
    counts = (
        with_values(rows.select(F.inline(pairs)), "value")
        .groupBy("key", "value").agg(F.count("*").alias(name))
    )
    # Equal counts in the order of the value; one row a key and task is shuffled.
    best = F.min(F.struct((-F.col(name)).alias("less"), "value"))
    return (
        counts.groupBy("key").agg(best.alias("_best"))
        .select("key", "_best.value", (-F.col("_best.less")).alias(name)).orderBy("key")
    )


def numbered(top: DataFrame, key: str, *, name: str = "n", rank: str = "rank",
             row_bound: int | None = None) -> DataFrame:
    """Add the place 1, 2, 3, ... to the rows, most frequent first.

    ``row_bound`` is a bound on the rows that holds by construction (a ``limit``); with a
    small one they are numbered in one task.
    """
    if row_bound is None or row_bound > TAKE_ROWS:
        counted = with_row_index(top, _by_count(name, key), rank)
        return counted.withColumn(rank, (F.col(rank) + 1).cast("int"))
    return top.withColumn(rank, F.row_number().over(Window.orderBy(*_by_count(name, key))))


def hourly_counts(events: DataFrame, key: str, start: Bound = None, end: Bound = None, *,
                  ts: str = "ts", normalize: bool = True, name: str = "changes") -> DataFrame:
    """Count per hour and value of ``key``."""
    rows = _in_window(events, [key], start, end, ts, normalize)
    return rows.groupBy(hour_bucket(ts).alias("hour"), key).agg(F.count("*").alias(name))


def hourly_counts_of_top(events: DataFrame, key: str, k: int = 3, start: Bound = None,
                         end: Bound = None, *, ts: str = "ts", normalize: bool = True,
                         name: str = "changes") -> DataFrame:
    """Hourly counts of the ``k`` most frequent values of ``key``."""
    top = top_values(events, key, k, start, end, ts=ts, normalize=normalize)
    rows = _in_window(events, [key], start, end, ts, normalize)
    rows = rows.select(hour_bucket(ts).alias("hour"), key)
    counts = count_members(rows, top, key, ["hour", key], name=name, row_bound=k)
    return counts.orderBy("hour", key)


def hourly_median(events: DataFrame, key: str, start: Bound = None, end: Bound = None, *,
                  ts: str = "ts", normalize: bool = True) -> DataFrame:
    """Per hour, the median over the values seen in it of their counts.

    The counts are tallied before the median, which then sees each distinct
    count of an hour once, however many values the hour has.
    """
    counts = hourly_counts(events, key, start, end, ts=ts, normalize=normalize)
    tally = counts.groupBy("hour", "changes").agg(F.count("*").alias("n"))
    median = F.percentile("changes", F.lit(0.5), F.col("n"))
    return tally.groupBy("hour").agg(median.alias("median_changes")).orderBy("hour")


def histogram(values: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins from the least to the greatest integer of ``column``.

    Every bin is returned, empty ones too; the last one includes its right edge.
    A single distinct value is put in the middle of a range of width one. The
    tally of equal values is staged; its least and greatest pass the driver.
    """
    tally = stage(with_values(values, column).groupBy(column).agg(F.count("*").alias("_n")), "tally")
    lo, hi = tally.agg(F.min(column), F.max(column)).first()
    if lo == hi:
        place, left, width = F.lit(bins // 2), (lo or 0) - 0.5, 1.0
    else:
        # Integer division places a value on a bin edge exactly.
        scaled = F.call_function("div", (F.col(column) - lo) * bins, F.lit(hi - lo))
        place, left, width = F.least(scaled, F.lit(bins - 1)), float(lo), float(hi - lo)
    filled = tally.groupBy(place.cast("int").alias("bin")).agg(F.sum("_n").alias("n"))
    axis = values.sparkSession.range(0 if lo is None else bins)
    axis = axis.select(F.col("id").cast("int").alias("bin"))
    return (
        axis.join(F.broadcast(filled), "bin", "left")
        .select("bin", (F.lit(left) + F.lit(width) * F.col("bin") / bins).alias("bin_start"),
                (F.lit(left) + F.lit(width) * (F.col("bin") + 1) / bins).alias("bin_end"),
                F.coalesce("n", F.lit(0)).alias("n"))
        .orderBy("bin")
    )


def changes_histogram(events: DataFrame, key: str, start: Bound = None, end: Bound = None, *,
                      bins: int = HISTOGRAM_BINS, ts: str = "ts",
                      normalize: bool = True) -> DataFrame:
    """Histogram of the counts per hour and value of ``key``."""
    counts = hourly_counts(events, key, start, end, ts=ts, normalize=normalize)
    return histogram(counts, "changes", bins)


def top_values_per_top_key(events: DataFrame, key: str, value: str, k: int = 3, n: int = 2,
                           start: Bound = None, end: Bound = None, *, ts: str = "ts",
                           normalize: bool = True, name: str = "n") -> DataFrame:
    """For each of the ``k`` most frequent keys its ``n`` most frequent values."""
    top = top_values(events, key, k, start, end, ts=ts, normalize=normalize)
    rows = _in_window(events, [key, value], start, end, ts, normalize)
    counts = count_members(rows.select(key, value), top, key, [key, value], name=name,
                           row_bound=k)
    place = F.row_number().over(Window.partitionBy(key).orderBy(*_by_count(name, value)))
    return (
        counts.withColumn("place", place)
        .filter(F.col("place") <= n)
        .orderBy(key, "place")
    )
