"""Global row numbers and long top-k without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.plans.staging import stage

# Up to this k a top-k is one TakeOrderedAndProject, whose last step, one task,
# gets k rows of each partition: at 10,000 partitions ten million narrow rows at most.
TAKE_ROWS = 1_000

_IN_PARTITION = 33  # bits that monotonically_increasing_id keeps for the row


def with_row_index(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add 0, 1, 2, ... in the given order, which must be total.

    The sort is range-partitioned. Each row's place in its partition is stored
    with it, so the offsets, one per sort partition, are summed from what was
    written and not from a second sort.
    """
    placed = df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    stored = stage(placed, "ordered")
    part = F.shiftright("_place", _IN_PARTITION)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_off"))
    row = F.col("_place").bitwiseAND((1 << _IN_PARTITION) - 1)
    return (
        stored.withColumn("_part", part)
        # As many rows as the sort had partitions.
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_off") + row)
        .drop("_part", "_off", "_place")
    )


def first_rows(df: DataFrame, order: Sequence[Column], k: int, *,
               take_rows: int = TAKE_ROWS) -> DataFrame:
    """The first ``k`` rows in a total order, for a ``k`` of any size."""
    if k <= take_rows:
        return df.orderBy(*order).limit(k)
    return with_row_index(df, order, "_index").filter(F.col("_index") < k).drop("_index")
