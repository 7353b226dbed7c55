"""Placement files that keep arriving, in place of one pass over one large file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyframe.functions.nulls import with_values
from tallyframe.functions.text import normalized
from tallyframe.sources.placements import CSV_SCHEMA, typed_placements
from tallyframe.streaming.batches import BatchTable


def read_placements_stream(spark: SparkSession, folder: str, *,
                           on_bad_time: str = "drop") -> DataFrame:
    """Typed placements from the CSV files of a folder, new ones included.

    A file whose header does not name the columns in their order stops the query.
    """
    raw = (
        spark.readStream.schema(CSV_SCHEMA)
        .options(header=True, enforceSchema=False, escape='"').csv(folder)
    )
    return typed_placements(raw, on_bad_time=on_bad_time)


def _hour_counts(spark: SparkSession, path: str, key: str, name: str) -> BatchTable:
    return BatchTable(spark, path, ["hour", key], {name: F.sum})


def count_hours_in_batches(events: DataFrame, key: str, path: str, checkpoint: str, *, ts: str = "ts",
                           normalize: bool = True, name: str = "changes",
                           replace: bool = False) -> StreamingQuery:
    """Add the counts per hour and value of ``key`` of what has arrived, and stop.

    Nothing is kept between batches and nothing is late: an event of any hour counts when it
    arrives, and once, also if its batch is run again. ``read_hour_counts`` sums the
    batches. Another checkpoint than the one that fed the table so far is an error, or with
    ``replace`` begins anew.
    """
    rows = with_values(events, ts, key)
    rows = rows.select(F.date_trunc("hour", ts).alias("hour"),
                       (normalized(key) if normalize else F.col(key)).alias(key))
    table = _hour_counts(events.sparkSession, path, key, name)
    return table.feed(rows, lambda batch: batch.groupBy("hour", key).agg(F.count("*").alias(name)),
                      checkpoint, replace=replace)


def read_hour_counts(spark: SparkSession, path: str, key: str, *, name: str = "changes") -> DataFrame:
    """Counts per hour and value over all committed batches."""
    return _hour_counts(spark, path, key, name).read()


def compact_hour_counts(spark: SparkSession, path: str, key: str, *, name: str = "changes") -> bool:
    """Merge the batches into one, for the next readers."""
    return _hour_counts(spark, path, key, name).compact()


def append_to_table(stream: DataFrame, path: str, checkpoint: str,
                    partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Add what has arrived to a Parquet table and stop; the next call goes on from there."""
    return (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .trigger(availableNow=True)
        .start(path)
    )
