"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.plans.joins import fits_broadcast
from tallyframe.plans.staging import Scratch, stage

BROADCAST_LABELS = 100_000  # rows of 16 bytes that go to every task


def _near(labels: DataFrame) -> DataFrame:
    """The stored labels, with a hint to broadcast them if they are few."""
    return F.broadcast(labels) if fits_broadcast(labels, max_rows=BROADCAST_LABELS) else labels


def with_ends(links: DataFrame, labels: DataFrame) -> DataFrame:
    """``links`` with the components ``c_a`` and ``c_b`` of their ends, where these differ.

    A node without a label is a component of its own.
    """
    labels = _near(labels)
    for side in ("a", "b"):
        links = links.join(
            labels.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}")), side, "left"
        ).withColumn(f"c_{side}", F.coalesce(f"c_{side}", side))
    return links.filter("c_a != c_b")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for every node of ``links``.

    ``links`` has the columns ``a`` and ``b``. In a round, of two linked nodes with different
    labels the one with the larger label takes the smaller and hands it to the node that its
    own label names, and every node follows its label once; so labels halve their distance to
    the smallest one. A node with very many links costs no more than its links: minima are
    combined before the shuffle, and the joins are inner joins that Spark splits where a key
    is hot. A round is one table, written, so it survives lost executors. No links give no rows.
    """
    with Scratch(links.sparkSession) as scratch:
        links = scratch.stage(
            links.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
            "links")
        labels = scratch.stage(
            links.select(F.expr("stack(2, a, a, b, a) as (node, component)"))
            .groupBy("node").agg(F.min("component").alias("component")), "labels")
        few = fits_broadcast(labels, max_rows=BROADCAST_LABELS)
        while True:
            known = F.broadcast(labels) if few else labels
            ends = links
            for side in ("a", "b"):
                ends = ends.join(
                    known.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}")), side)
            least, most = F.least("c_a", "c_b"), F.greatest("c_a", "c_b")
            larger = F.when(F.col("c_a") > F.col("c_b"), F.col("a")).otherwise(F.col("b"))
            taken = (
                ends.filter("c_a != c_b").select(least.alias("least"), most.alias("most"), larger.alias("larger"))
                .select(F.expr("stack(2, larger, least, most, least) as (node, component)"))
                .withColumn("before", F.lit(None).cast(labels.schema["component"].dataType))
            )
            follow = known.select(F.col("node").alias("before"), F.col("component").alias("_next"))
            followed = (
                labels.withColumnRenamed("component", "before").join(follow, "before")
                .select("node", F.col("_next").alias("component"), "before")
            )
            labels = scratch.stage(
                followed.unionByName(taken)
                .groupBy("node").agg(F.min("component").alias("component"), F.max("before").alias("before")), "labels")
            settled = labels.filter("component < before").isEmpty()
            labels = labels.select("node", "component")
            if settled:
                return stage(labels, "components")


def joined_components(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels of ``components`` when ``links`` are added to those that gave ``labels``.

    Both are stored. Only the components that the links join are looked at, not the links
    inside them.
    """
    if links.isEmpty():
        return labels
    ends = with_ends(links.select("a", "b"), labels)
    merged = components(ends.select(F.col("c_a").alias("a"), F.col("c_b").alias("b")))
    renamed = _near(merged).select(F.col("node").alias("component"), F.col("component").alias("_now"))
    moved = labels.join(renamed, "component", "left").select(
        "node", F.coalesce("_now", "component").alias("component"))
    first = merged.join(_near(labels).select("node"), "node", "left_anti")
    return stage(moved.unionByName(first), "components")
