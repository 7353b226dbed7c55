"""A corpus from raw documents to packed sequences, one operator of ``tallyframe.llm`` a stage.

Every stage gets the documents that its predecessor kept, with all their columns, and
works on all of them; its decisions take effect. The last stage returns the pieces.

No stage fails on nulls, repeated rows or an empty table. A null text is an empty one: it is
scored, one empty text of all stays in exact dedup, it has no near copies, no words for the
mix, and is one end token in packing. Repeated rows are exact copies, of which one stays.
Null identifiers come last where identifiers decide. An empty table gives empty results,
but for the first stage, which needs labelled documents to learn from.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import compression, mixing, packing
from tallyframe.llm.common import table
from tallyframe.llm.exact_dedup import exact_dedup
from tallyframe.llm.ngram_join import ngram_join
from tallyframe.llm.registry import QUALITY_CUT, quality_model
from tallyframe.plans.joins import fits_broadcast
from tallyframe.plans.staging import Scratch, stage

# A near duplicate shares four fifths of its five-word shingles.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the cut. The score is learnt from those in ``docs``
    that have labels and are not held out; without any of both classes this stops."""
    model = quality_model(spark, docs, sf_dir)
    return docs.filter(compression.score(model, F.col("text")) >= QUALITY_CUT)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row that stays."""
    return exact_dedup(docs).filter("kept").select("row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest identifier of every group, the missing ones last. Rows are
    told apart by their stored number, so identifiers may be missing or repeat."""
    rows = mixing.numbered(docs)
    joined = ngram_join(rows.select("key", F.col("row.text").alias("text")), doc_id="key",
                        words=NEAR_WORDS, percent=NEAR_PERCENT)
    # All rows of groups of two and more.
    others = stage(joined.filter("component_id != doc_id").select(
        F.col("doc_id").alias("key"), "component_id"), "others")
    leaders = others.select(F.col("component_id").alias("key"), "component_id").distinct()
    linked = stage(others.union(leaders), "linked")
    side = F.broadcast(linked) if fits_broadcast(linked) else linked
    order = F.struct(F.col("row.doc_id").isNull(), F.col("row.doc_id"), F.col("key"))
    first = rows.join(side, "key").groupBy("component_id").agg(F.min_by("key", order).alias("key"))
    copies = stage(linked.join(first.select("key"), "key", "left_anti").select("key"), "copies")
    if fits_broadcast(copies):
        copies = F.broadcast(copies)
    return rows.join(copies, "key", "left_anti").select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it. One without words is taken as often as its
    source is taken whole."""
    rows = mixing.numbered(docs)
    return mixing.repeated(rows, mixing.mix_rows(rows))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in the sequences. Documents that the mix
    repeats are pieces of their own."""
    return packing.pack(packing.stored_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality", keep_good),
    ("exact dedup", drop_exact_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix),
    ("packing", pack),
]

# Compression, set similarity and tokens are beyond SQL: the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. The documents that a stage kept are stored until the next one is done."""
    docs, before = table(spark, sf_dir, "documents"), Scratch(spark)
    for name, step in STAGES[:-1]:
        kept = Scratch(spark)
        with before:
            docs = kept.stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
        before = kept
    with before:
        return STAGES[-1][1](spark, docs, sf_dir)
