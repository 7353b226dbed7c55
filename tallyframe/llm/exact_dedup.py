"""Exact deduplication by sorting the content (native).

Sampled splitters deal the rows out in ranges of the normalised text, an external
sort puts equal texts next to each other, and a window compares neighbours by their
whole normalised text. The splitters are drawn by Spark's range partitioner over
``(first characters, hash)``, so a sample never holds whole texts and texts with a
common beginning are still split.

A text with a large share of all rows is found in a bounded sample. Its rows get
salts, so that it spreads over many ranges; its count and the row that stays come
from an aggregate that is combined before the shuffle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import SPACES, as_rows, partitions, whole_text

# Rows sampled for each range to find texts with many copies, and how many sampled
# copies (a quarter of a mean range) make a text hot. So at most 4 texts are hot for
# each range, and a hot text gets a salt for each quarter of a range.
SAMPLED = 40
HOT = 10
HEAD = 16


def normalised(text: Column) -> Column:
    return F.translate(text, SPACES, "")


def _hot_texts(keyed: DataFrame, ranges: int, seed: int) -> list[tuple[int, int]]:
    """``(hash, salts)`` of texts with many copies, at most 4 for each range."""
    rows = keyed.count()
    if not rows:
        return []
    sample = keyed.sample(min(1.0, SAMPLED * ranges / rows), seed=seed)
    counts = sample.groupBy(F.xxhash64(normalised(F.col("_text"))).alias("_h")).count()
    # With few rows a sample is the table itself, and ten copies are no hot text.
    least = HOT if rows > SAMPLED * ranges else max(HOT, math.ceil(rows / ranges / 4))
    return [(r["_h"], math.ceil(r["count"] / least))
            for r in counts.filter(F.col("count") > least).collect()]


def exact_dedup(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id",
                ranges: int | None = None, seed: int = 7) -> DataFrame:
    """One row per document: ``row``, ``norm``, ``keep_id``, ``group_size``, ``kept``.

    Texts are equal when identical without white space. Of equal texts the row with
    the longest original text, then the smallest identifier stays; exactly one row of
    a group has ``kept``, also when whole rows or identifiers repeat. A null text is an
    empty one, all empty texts are one group. A null identifier comes last. An empty
    table gives an empty result. Texts of any length are compared whole.
    """
    spark = docs.sparkSession
    ranges = ranges or partitions(spark)
    keyed = as_rows(docs).select(
        "row", F.col(f"row.{doc_id}").alias("_id"), whole_text(f"row.{text}").alias("_text"))
    hot = _hot_texts(keyed, ranges, seed)
    norm = normalised(F.col("_text"))
    coded = keyed.withColumn("_h", F.xxhash64(norm)).withColumn("_head", F.substring(norm, 1, HEAD))
    if hot:
        salts = spark.createDataFrame(hot, "_h long, _salts int")
        # At most 4 rows for each range.
        coded = coded.join(F.broadcast(salts), "_h", "left")
        salt = F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64("_id"), F.col("_salts")))
        coded = coded.withColumn("_salt", F.coalesce(salt, F.lit(0)))
    else:
        coded = coded.withColumn("_salts", F.lit(None).cast("int"))

    # Only columns that the window has too, or it would shuffle again: no constant salt.
    range_key = ["_head", "_h", "_salt"] if hot else ["_head", "_h"]
    better = [F.col("_size").desc(), F.col("_id").asc_nulls_last()]
    # The text travels once, in its row.
    dealt = (
        coded.drop("_text").repartitionByRange(ranges, *range_key)
        .withColumn("_text", whole_text(f"row.{text}"))
        .withColumn("norm", norm)
        .withColumn("_size", F.char_length("_text"))
    )
    # The window needs the rows of a range key together, which they are: no further
    # exchange. The last part of its key is the text itself.
    equal = Window.partitionBy(*range_key, "norm")
    ranked = dealt.select(
        "row", "norm", "_h", "_salts", "_id", "_size",
        F.row_number().over(equal.orderBy(*better)).alias("_place"),
        F.first("_id").over(equal.orderBy(*better)).alias("_first"),
        F.count("*").over(equal).alias("_copies"),
    )
    if not hot:
        return ranked.select("row", "norm", F.col("_first").alias("keep_id"),
                             F.col("_copies").alias("group_size"),
                             (F.col("_place") == 1).alias("kept"))

    best = F.min(F.struct((-F.col("_size")).alias("size"), F.col("_id").isNull().alias("no_id"),
                          F.col("_id").alias("id")))
    groups = (
        coded.filter("_salts is not null")
        .select("_h", norm.alias("_norm"), F.char_length("_text").alias("_size"), "_id")
        .groupBy("_h", "_norm").agg(F.count("*").alias("_all"), best.alias("_best"))
        .select("_h", F.sha2("_norm", 256).alias("_sha"), "_all", "_best")
    )
    # As many rows as hot texts.
    joined = ranked.withColumn(
        "_sha", F.when(F.col("_salts").isNotNull(), F.sha2("norm", 256))
    ).join(F.broadcast(groups), ["_h", "_sha"], "left")
    is_hot = F.col("_best").isNotNull()
    stays = ((F.col("_place") == 1) & F.col("_id").eqNullSafe(F.col("_best.id"))
             & (F.col("_size") == -F.col("_best.size")))
    return joined.select(
        "row", "norm",
        F.when(is_hot, F.col("_best.id")).otherwise(F.col("_first")).alias("keep_id"),
        F.when(is_hot, F.col("_all")).otherwise(F.col("_copies")).alias("group_size"),
        F.when(is_hot, stays).otherwise(F.col("_place") == 1).alias("kept"),
    )
