"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; a vector is in all filters whose direction it exceeds a threshold
on. The directions are products: a vector is rotated and cut in two halves, each half has a
small code of random directions, and every pair of them is a filter. So a vector is decoded
to its list of filters from two short lists of scores. Vectors that share a filter are
compared by their cosine.

The number of filters grows with the number of vectors, so a filter holds about as many at
any size. Equal vectors are one class. A dense group is not listed pair by pair: vectors
within half the linking angle of a common centre all link with each other, so they are a
ball that is counted, and only pairs from different balls are compared.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.components import components
from tallyframe.plans.staging import stage

COSINE = 0.95
CODES = 3
FILTERS = 8  # expected filters of a vector in each code
HELD = 128  # expected vectors in a filter
BLOCK = 2048
BALL = 8  # members from which a group is worth a centre
SAMPLE = 256  # rows of a part in which its centres are sought
EPS = 1e-9


@dataclass(frozen=True)
class ProductCode:
    """Two codes of ``size`` directions for the halves of rotated vectors."""

    size: int
    threshold: float
    seed: int

    def directions(self, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rng = np.random.default_rng([self.seed, dim])
        rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        half = dim - dim // 2
        return (rotation, rng.standard_normal((half, self.size)),
                rng.standard_normal((dim // 2, self.size)))

    def decode(self, unit: np.ndarray) -> Iterator[np.ndarray]:
        """Numbers of the filters that each row exceeds; its greatest one if it exceeds none."""
        rotation, first, second = self.directions(unit.shape[1])
        turned = unit @ rotation
        one, two = turned[:, :len(first)] @ first, turned[:, len(first):] @ second
        for a, b in zip(one, two, strict=True):
            order = np.argsort(-b, kind="stable")
            falling = b[order]
            rows = np.flatnonzero(a >= self.threshold - falling[0])
            found = [i * self.size + order[:np.searchsorted(-falling, a[i] - self.threshold, side="right")]
                     for i in rows]
            yield np.concatenate(found) if found else np.array([a.argmax() * self.size + order[0]])


def product_codes(vectors: int, codes: int = CODES, seed: int = 3) -> list[ProductCode]:
    """Codes for so many vectors: ``FILTERS`` of size^2 filters each, ``HELD`` vectors in one."""
    size = max(8, math.ceil(math.sqrt(FILTERS * vectors / HELD)))
    share = min(0.4, FILTERS / size**2)
    return [ProductCode(size, NormalDist().inv_cdf(1 - share), seed + i) for i in range(codes)]


def _units(column: pa.Array) -> np.ndarray:
    """Rows of unit length, in double precision."""
    rows = np.array(column.to_pylist(), dtype=np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _by_dim(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose vectors have the same length."""
    lengths = np.array([len(v) for v in batch.column(column)])
    for length in np.unique(lengths):
        yield batch.filter(pa.array(lengths == length))


def _usable() -> Column:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists("embedding", lambda x: x != 0)
    return F.coalesce((F.size("embedding") > 0) & finite & some, F.lit(False)) & F.col("vec_id").isNotNull()


def _grouped(rows: DataFrame, keys: list[str], order: list[str], each: Callable[[pa.Table], Iterator[pa.RecordBatch]],
             schema: str) -> DataFrame:
    """Rows with equal ``keys`` (whole numbers, the first columns) as one table each.

    Many small groups pass through a task one after the other, which is far cheaper than a
    pandas group each; the groups are bounded by the keys.
    """
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, *order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not len(batch):
                continue
            values = np.stack([batch.column(i).to_numpy() for i in range(len(keys))])
            cuts = [0, *(np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1), len(batch)]
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                key = tuple(values[:, low])
                if key != last and held:
                    yield from each(pa.Table.from_batches(held))
                    held = []
                last = key
                held.append(batch.slice(low, high - low))
        if held:
            yield from each(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, schema)


def _gathered(vectors: DataFrame, code: ProductCode) -> DataFrame:
    """``id``, ``embedding``, ``centre``, ``mean``: dense groups, gathered by the filter that each
    vector exceeds most. Rows in no dense group are left out.

    A filter with very many rows is taken in parts, so a group may have several centres.
    Where centres lie steers the work only.
    """
    kind = vectors.schema["embedding"].dataType.simpleString()

    def homed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _by_dim(whole, 1):
                unit = _units(batch.column(1))
                rotation, first, second = code.directions(unit.shape[1])
                turned = unit @ rotation
                home = (turned[:, :len(first)] @ first).argmax(axis=1) * code.size
                if len(second):
                    home = home + (turned[:, len(first):] @ second).argmax(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(unit), unit.shape[1])), pa.array(home), *batch.columns],
                    ["dim", "home", "id", "embedding"])

    homes = stage(vectors.select("id", "embedding").mapInArrow(
        homed, f"dim long, home long, id long, embedding {kind}"), "homes")
    sizes = homes.groupBy("dim", "home").agg(F.count("*").alias("_n")).filter(f"_n >= {BALL}")
    parted = homes.join(sizes, ["dim", "home"]).select(
        "dim", "home", F.pmod(F.xxhash64("id"), F.ceil(F.col("_n") / BLOCK)).alias("part"), "id", "embedding")

    def centred(group: pa.Table) -> Iterator[pa.RecordBatch]:
        unit, ids = _units(group["embedding"]), group["id"].to_numpy()
        open_ = np.ones(len(unit), bool)
        near = unit[:SAMPLE] @ unit[:SAMPLE].T >= COSINE
        while True:
            degree = (near & open_[:SAMPLE]).sum(axis=1) * open_[:SAMPLE]
            if not len(degree) or degree.max() < min(BALL, len(unit)) // 2:
                return
            middle = int(degree.argmax())
            mean = unit[:SAMPLE][near[middle] & open_[:SAMPLE]].mean(axis=0)
            mean /= np.sqrt(mean @ mean)
            own = open_ & (unit @ mean >= COSINE)
            own[middle] = True
            at = pa.array(np.flatnonzero(own))
            yield pa.RecordBatch.from_arrays(
                [group["id"].combine_chunks().take(at), group["embedding"].combine_chunks().take(at),
                 pa.array(np.full(len(at), ids[middle])), pa.array([mean.tolist()] * len(at), pa.list_(pa.float64()))],
                ["id", "embedding", "centre", "mean"])
            open_ &= ~own

    return _grouped(parted, ["dim", "home", "part"], ["id"], centred,
                    f"id long, embedding {kind}, centre long, mean array<double>")


def _balls(classes: DataFrame, codes: list[ProductCode], cosine: float) -> DataFrame:
    """``id``, ``ball`` for classes within half the linking angle of a centre.

    Centres of the first gathering are gathered again, so parts of one group meet. A class
    belongs to the common centre if that is near enough, else to its own.
    """
    first = stage(_gathered(classes, codes[0]), "gathered")
    centres = first.groupBy("centre").agg(F.first("mean").alias("embedding")).withColumnRenamed("centre", "id")
    common = _gathered(centres, codes[-1]).select(
        F.col("id").alias("centre"), F.col("centre").alias("common"), F.col("mean").alias("common_mean"))
    both = first.join(common, "centre", "left").select("id", "embedding", "centre", "mean", "common", "common_mean")
    # Half the angle, with a margin for rounding.
    half = math.cos(math.acos(cosine) / 2) + EPS

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _by_dim(whole, 1):
                unit = _units(batch.column(1))
                ball = np.full(len(unit), -1, np.int64)
                for key, mean, odd in (("centre", "mean", 1), ("common", "common_mean", 0)):
                    has = batch[key].is_valid().to_numpy(zero_copy_only=False)
                    if has.any():
                        to = np.array(batch[mean].filter(pa.array(has)).to_pylist(), dtype=np.float64)
                        number = batch[key].to_numpy(zero_copy_only=False)[has].astype(np.int64)
                        # Numbers of balls are even or odd, so identifiers that are negative or
                        # too large to double are no centre.
                        fit = (number >= 0) & (number < 1 << 61) & ((unit[has] * to).sum(axis=1) >= half)
                        near = np.flatnonzero(has)[fit]
                        ball[near] = 2 * number[fit] + odd
                keep = pa.array(ball >= 0)
                yield pa.RecordBatch.from_arrays(
                    [batch["id"].filter(keep), pa.array(ball).filter(keep)], ["id", "ball"])

    return both.mapInArrow(inside, "id long, ball long")


def _cross_links(known: DataFrame, codes: list[ProductCode], cosine: float) -> DataFrame:
    """Pairs ``a < b`` of classes of different balls that share a filter and reach the cosine."""
    kind = known.schema["embedding"].dataType.simpleString()

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _by_dim(whole, 1):
                unit = _units(batch.column(1))
                for number, code in enumerate(codes):
                    lists = list(code.decode(unit))
                    rows = np.repeat(np.arange(len(unit)), [len(x) for x in lists])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), unit.shape[1])), pa.array(np.full(len(rows), number)),
                         pa.array(np.concatenate(lists).astype(np.int64)),
                         *(c.take(pa.array(rows)) for c in batch.columns)],
                        ["dim", "code", "filter", "id", "embedding", "ball"])

    cell = ["dim", "code", "filter"]
    entries = stage(
        known.select("id", "embedding", "ball").mapInArrow(
            filtered, f"dim long, code long, filter long, id long, embedding {kind}, ball long"), "entries")
    # The largest ball of a filter is dealt out in blocks that are compared with all
    # blocks of the other rows, but not with each other.
    per_ball = entries.groupBy(*cell, "ball").agg(F.count("*").alias("n"))
    sizes = (
        per_ball.groupBy(*cell)
        .agg(F.sum("n").alias("_all"), F.max(F.struct(F.when(F.col("ball") >= 0, F.col("n")).otherwise(0).alias("n"), "ball")).alias("_most"))
        .select(*cell, F.col("_most.ball").alias("_ball"), F.ceil(F.col("_most.n") / BLOCK).alias("_own"),
                F.ceil((F.col("_all") - F.col("_most.n")) / BLOCK).alias("_others"), "_all")
        .filter("_all > 1 and _others > 0")
    )
    is_own = (F.col("ball") == F.col("_ball")) & (F.col("_own") > 0)
    spread = F.xxhash64("id")
    block = F.when(is_own, F.col("_others") + F.pmod(spread, F.greatest("_own", F.lit(1)))).otherwise(F.pmod(spread, F.col("_others")))
    partners = F.sequence(F.lit(0).cast("long"), F.col("_others") + F.when(is_own, F.lit(0)).otherwise(F.col("_own")) - 1)
    dealt = (
        entries.join(sizes, cell)
        .withColumn("_block", block).withColumn("_partner", F.explode(partners))
        .select(*cell, F.least("_block", "_partner").alias("low"), F.greatest("_block", "_partner").alias("high"),
                "_block", "id", "embedding", "ball")
    )

    def linked(group: pa.Table) -> Iterator[pa.RecordBatch]:
        unit, ids, ball, block = _units(group["embedding"]), *(group[c].to_numpy() for c in ("id", "ball", "_block"))
        low, high = group["low"][0].as_py(), group["high"][0].as_py()
        own = ball.copy()
        own[ball < 0] = -2 - np.arange((ball < 0).sum())  # each for itself
        left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
        if not len(left) or not len(right):
            return
        near = unit[left] @ unit[right].T >= cosine - 1e-12
        near &= own[left][:, None] != own[right][None, :]
        x, y = np.nonzero(near)
        x, y = left[x], right[y]
        # The last word is the plain sum in double precision.
        sure = (unit[x] * unit[y]).sum(axis=1) >= cosine
        a, b = ids[x[sure]], ids[y[sure]]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return _grouped(dealt, [*cell, "low", "high"], [], linked, "a long, b long").filter("a != b").distinct()


def near_vectors(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding",
                 cosine: float = COSINE, codes: int = CODES) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id``, ``kept``.

    Two vectors link when their cosine, in double precision, is at least ``cosine``; every link
    found is verified, a link below is never made. Vectors of different lengths do not link.
    A vector that is null, empty, zero, or holds a null or non-finite component, or has
    no identifier, links with nothing and is its own component. Repeated rows are vectors of
    their own that link with each other. An empty table gives no rows.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"))
    rows = stage(rows.withColumn("_usable", _usable()), "vectors")
    classes = stage(
        rows.filter("_usable").groupBy("embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")),
        "classes")
    filters = product_codes(classes.count(), codes)
    balls = stage(_balls(classes, filters, cosine), "balls")
    known = stage(
        classes.join(balls, "id", "left").withColumn("ball", F.coalesce("ball", F.lit(-1).cast("long"))), "known")
    cross = stage(_cross_links(known, filters, cosine), "cross")

    inside = known.filter("ball >= 0").groupBy("ball").agg(
        F.min("id").alias("_first"), F.sum("copies").alias("_members"))
    links = known.join(inside, "ball").select(F.col("_first").alias("a"), F.col("id").alias("b"))
    labels = components(links.unionByName(cross))
    both = cross.unionByName(cross.select(F.col("b").alias("a"), F.col("a").alias("b")))
    outside = (
        both.join(classes.select(F.col("id").alias("b"), "copies"), "b")
        .groupBy(F.col("a").alias("id")).agg(F.sum("copies").alias("_outside"))
    )
    answers = (
        known.join(inside.drop("_first"), "ball", "left").join(outside, "id", "left")
        .join(labels.withColumnRenamed("node", "id"), "id", "left")
        .select("embedding", (F.coalesce("_members", "copies") - 1 + F.coalesce("_outside", F.lit(0))).alias("n_links"),
                F.coalesce("component", "id").alias("component_id"))
    )
    usable = rows.filter("_usable").join(stage(answers, "answers"), "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.filter("not _usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return usable.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
