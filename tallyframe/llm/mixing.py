"""Mixing sources to target weights by capped water-filling.

Every source gets a share of the budget in proportion to its weight. A source whose
share is above ``epochs`` times its size is clamped there, and what is left goes to the
others by weight, until none is above. Targets are met with whole repetitions of all
documents of a source, and one more of a seeded selection of its documents.

The selection goes through the documents of a shard from the largest size class to the
smallest, in seeded order within a class, and takes a document when this brings the
words taken so far nearer to the wanted fraction of the words seen so far. What large
documents leave over is so evened out by the smaller ones. A shard has a bounded number
of documents, so a source of any size is selected from in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import NOT_SPACE, as_rows, whole_text
from tallyframe.plans.joins import lookup
from tallyframe.plans.ranking import with_row_index
from tallyframe.plans.staging import stage

WEIGHTS = (3.0, 1.0, 2.0)
BUDGET = 1.5
EPOCHS = 2.0
SHARD = 4096
# Decisions of so many numbers are one array, and those of so many rows, a byte each, go to all tasks.
CHUNK = 4096
DECIDED_ROWS = 32 << 20


def water_fill(sources: DataFrame, *, budget: float, epochs: float) -> DataFrame:
    """Add ``target`` to rows of ``size`` and ``weight``, as ``budget`` times all sizes.

    Each round clamps the sources above their cap. The driver holds two sums a round and
    no list of sources. Sources of size 0 get 0.
    """
    cap = F.col("size") * F.lit(epochs)
    total = sources.agg(F.sum("size").alias("s")).first()["s"] or 0
    wanted = min(budget, epochs) * float(total)
    # The level is the target for a weight of 1; it only rises, so it is found when no
    # further source is clamped by it.
    level, clamped_before = 0.0, -1
    while True:
        above = cap <= F.lit(level) * F.col("weight")
        row = sources.agg(
            F.sum(F.when(above, cap).otherwise(0.0)).alias("clamped"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.sum(F.when(above, 1).otherwise(0)).alias("n"),
        ).first()
        if not row["open"] or row["n"] == clamped_before:
            break
        clamped_before = row["n"]
        level = max(level, (wanted - row["clamped"]) / row["open"])
    if row["open"]:
        target = F.least(cap, F.lit(level) * F.col("weight"))
    else:
        target = cap
    return sources.withColumn("target", target.cast("double"))


def _select(shard: pd.DataFrame) -> pd.DataFrame:
    """Flag the documents of one shard that get one more repetition."""
    shard = shard.sort_values(["size_class", "place", "key"], ascending=[False, True, True])
    fraction = float(shard["fraction"].iloc[0])
    seen = taken = 0.0
    extra = np.zeros(len(shard), dtype="int64")
    for i, size in enumerate(shard["size"].to_numpy(dtype="float64")):
        seen += size
        missing = fraction * seen - taken
        if missing > 0 and 2 * missing >= size:
            extra[i] = 1
            taken += size
    return pd.DataFrame({"key": shard["key"].to_numpy(), "extra": extra})


def numbered(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as ``row``, stored with their number ``key``.

    A number holds for one scan only: another may split its files otherwise. Whoever goes
    back from a ``key`` to its row reads both from here.
    """
    return stage(_with_keys(docs), "numbered")


def _with_keys(docs: DataFrame) -> DataFrame:
    return as_rows(docs).withColumn("key", F.monotonically_increasing_id())


def _with_places(sized: DataFrame, seed: int) -> DataFrame:
    """Add ``place``, a seeded hash of the ``content`` and of the number among its copies.

    The row number ``key`` depends on how the files were split; it only orders wholly equal
    rows here, where any order gives the same documents. Copies get numbers of their own, so
    that many of them spread over the shards.
    """
    copied = stage(sized.groupBy("content").agg(F.count("*").alias("n")).filter("n > 1"), "copied")
    if copied.isEmpty():
        return sized.withColumn("place", F.xxhash64(F.lit(seed), "content", F.lit(0).cast("long")))
    ordered = stage(
        with_row_index(lookup(sized.select("key", "content"), copied, "content", "n"),
                       [F.col("content"), F.col("key")], "at"), "copies")
    firsts = stage(ordered.groupBy("content").agg(F.min("at").alias("first"), F.count("*").alias("n")), "firsts")
    copies = lookup(ordered, firsts, "content", "n").select("key", (F.col("at") - F.col("first")).alias("copy"))
    copy = F.coalesce("copy", F.lit(0).cast("long"))
    return sized.join(copies, "key", "left").withColumn(
        "place", F.xxhash64(F.lit(seed), "content", copy)).drop("copy")


def mix_sources(docs: DataFrame, **parameters: object) -> DataFrame:
    """``mix_rows`` of rows that are numbered for it alone."""
    return mix_rows(_with_keys(docs), **parameters)


def mix_rows(rows: DataFrame, *, text: str = "text", source: str = "source",
             doc_id: str = "doc_id", weights: Sequence[float] = WEIGHTS,
             budget: float = BUDGET, epochs: float = EPOCHS, shard: int = SHARD,
             seed: int = 11) -> DataFrame:
    """One row per document: ``key``, ``doc_id``, ``size``, ``source_size``, ``target``, ``repeats``, ``taken``.

    ``rows`` are those of ``numbered``. A size is a number of words (null or empty text: 0).
    ``weights`` repeat over the sources in order of their code points, the null source last;
    it is a source like any other. ``taken`` is ``repeats`` times the size, at most
    ``epochs`` sizes. Repeated rows are documents of their own. Null identifiers are
    allowed, an empty table gives no rows.
    Reruns over the same table agree, also where its files are split otherwise.
    """
    words = F.regexp_count(whole_text(f"row.{text}"), F.lit(NOT_SPACE)).cast("long")
    sized = rows.select(
        "key",
        F.col(f"row.{doc_id}").alias("doc_id"),
        F.col(f"row.{source}").cast("string").alias("source"), words.alias("size"),
        F.xxhash64(F.to_json("row", {"timeZone": "UTC"})).alias("content"))
    # Numbers only: what follows never moves texts.
    sized = stage(sized, "sizes")
    sums = stage(sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")),
                 "sources")
    order = [F.col("source").asc_nulls_last()]
    at = F.pmod(F.col("rank"), F.lit(len(weights))).cast("int") + 1
    named = with_row_index(sums, order, "rank").withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), at))
    filled = stage(water_fill(named, budget=budget, epochs=epochs), "targets")
    ratio = F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(F.lit(0.0))
    per_source = filled.select(
        F.col("source").alias("_source"), F.col("size").alias("source_size"), "target",
        F.col("n"), F.floor(ratio + 1e-12).alias("whole"),
        F.greatest(ratio - F.floor(ratio + 1e-12), F.lit(0.0)).alias("fraction"))
    placed = _with_places(sized, seed)
    keyed = placed.join(per_source, F.col("source").eqNullSafe(F.col("_source"))).withColumns({
        # A document stays in its shard whatever its size; shards differ by chance only.
        "shard": F.pmod(F.shiftright("place", 20), F.ceil(F.col("n") / F.lit(shard))),
        "size_class": F.when(F.col("size") > 0, F.floor(F.log2("size"))).otherwise(F.lit(-1)),
    })
    extra = keyed.groupBy("source", "shard").applyInPandas(
        lambda pdf: _select(pdf), "key long, extra long")
    taken = stage(
        keyed.join(extra, "key").select(
            "key", "doc_id", "size", "source_size", "target", (F.col("whole") + F.col("extra")).alias("repeats")),
        "repeats")
    return taken.withColumn("taken", F.col("repeats") * F.col("size"))


def repeated(rows: DataFrame, decided: DataFrame, *, max_rows: int = DECIDED_ROWS) -> DataFrame:
    """The rows of ``numbered`` as often as ``mix_rows`` decided for them.

    The numbers of a scan follow each other, so the decisions for ``CHUNK`` of them are one
    array of bytes. As long as all arrays are small they go to the rows, which stay in place.
    """
    size = decided.agg(F.count("*").alias("n"), F.max("repeats").alias("most")).first()
    if size["n"] <= max_rows and (size["most"] or 0) <= 127:
        at = F.pmod("key", F.lit(CHUNK)).cast("int")
        chunks = decided.groupBy(F.expr(f"key div {CHUNK}").alias("_chunk")).agg(
            F.sort_array(F.collect_list(F.struct(at.alias("at"), F.col("repeats").cast("tinyint").alias("times"))))
            ["times"].alias("_times"))
        placed = (
            rows.withColumn("_chunk", F.expr(f"key div {CHUNK}"))
            .join(F.broadcast(chunks), "_chunk")
            .withColumn("repeats", F.element_at("_times", at + 1)).filter("repeats > 0")
        )
    else:
        placed = rows.join(decided.filter("repeats > 0").select("key", "repeats"), "key")
    return (
        placed.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats").cast("long"))))
        .select("row.*")
    )
