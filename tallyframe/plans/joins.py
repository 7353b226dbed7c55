"""Joins that choose their strategy by a checked size.

Keys of any number work. A side is broadcast only when its rows and bytes are
known to be small; beyond that the work is pre-aggregated, salted, or split into
hot and cold keys, so that one key with a third of all rows does not end up in
one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.plans.bloom import may_be_in
from tallyframe.plans.staging import stage

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 32 << 20
SALTS = 32
# A key is hot from this share of all rows, so at most 1 / HOT_SHARE keys are.
HOT_SHARE = 0.001
# Up to this known row bound a key set needs no measuring.
TINY_ROWS = 1_000


def fits_broadcast(table: DataFrame, max_rows: int = BROADCAST_ROWS,
                   max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a staged table is small, by its own row count and text lengths."""
    width = F.lit(16)
    for field in table.schema:
        text = F.col(field.name).cast("string")
        width = width + F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(8)
    size = table.agg(F.count("*").alias("n"), F.sum(width).alias("b")).first()
    return size["n"] <= max_rows and (size["b"] or 0) <= max_bytes


def _sized_keys(members: DataFrame, on: str, row_bound: int | None, max_rows: int,
                max_bytes: int) -> tuple[DataFrame, bool]:
    """The keys of ``members``, and whether they may be broadcast.

    ``row_bound`` is a bound on their rows that holds by construction (a ``limit``).
    Without a tiny one the keys are staged and measured.
    """
    keys = members.select(on)
    if row_bound is not None and row_bound <= TINY_ROWS:
        return keys, True
    keys = stage(keys.distinct(), "members")
    return keys, fits_broadcast(keys, max_rows, max_bytes)


def _per_salt(keys: DataFrame) -> DataFrame:
    salts = F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))
    return keys.withColumn("_salt", F.explode(salts))


def count_members(
    rows: DataFrame,
    members: DataFrame,
    on: str,
    by: Sequence[str],
    *,
    name: str = "n",
    row_bound: int | None = None,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``groupBy(by).count()`` over the rows whose ``on`` occurs in ``members``."""
    keys, small = _sized_keys(members, on, row_bound, max_rows, max_bytes)
    if small:
        kept = rows.join(F.broadcast(keys), on, "left_semi")
        return kept.groupBy(*by).agg(F.count("*").alias(name))
    if rows.schema[on].dataType == keys.schema[on].dataType:
        # Most rows of no member end at the scan.
        likely = may_be_in(keys, on, F.col(on))
        rows = rows if likely is None else rows.filter(likely)
    # One row per (key, group) before the shuffle join; the groups of a hot key
    # are then spread over the salts.
    partial = rows.groupBy(*dict.fromkeys([on, *by])).agg(F.count("*").alias("_n"))
    spread = partial.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)))
    kept = spread.join(_per_salt(keys), [on, "_salt"], "left_semi")
    return kept.groupBy(*by).agg(F.sum("_n").alias(name))


def without_members(
    rows: DataFrame,
    members: DataFrame,
    on: str,
    row_id: str,
    *,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The rows whose ``on`` does not occur in ``members``, which is staged.

    ``row_id`` is a stored number that differs between rows, copies included.
    """
    keys = members.select(on)
    if fits_broadcast(keys, max_rows, max_bytes):
        return rows.join(F.broadcast(keys), on, "left_anti")
    spread = rows.withColumn("_salt", F.pmod(F.col(row_id), F.lit(SALTS)))
    return spread.join(_per_salt(keys), [on, "_salt"], "left_anti").drop("_salt")


def lookup(
    rows: DataFrame,
    table: DataFrame,
    on: str,
    weight: str,
    *,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Inner join of ``rows`` to a ``table`` that is cheap to read and has one row per ``on``.

    NULL matches NULL. ``weight`` is the column of ``table`` with the number of
    rows each key has; it is dropped from the result.
    """
    values = [c for c in table.columns if c not in (on, weight)]
    match = F.col(on).eqNullSafe(F.col("_key"))
    if fits_broadcast(table, max_rows, max_bytes):
        side = table.select(F.col(on).alias("_key"), *values)
        return rows.join(F.broadcast(side), match).drop("_key")
    total = table.agg(F.sum(weight).alias("t"))
    is_hot = F.col(weight) >= total.scalar() * F.lit(HOT_SHARE)
    keyed = table.select(F.col(on).alias("_key"), weight, *values)
    # The weights sum to the total, so `hot` has at most 1 / HOT_SHARE rows.
    hot = F.broadcast(keyed.filter(is_hot).drop(weight))
    cold = keyed.filter(~is_hot).drop(weight)
    hot_rows = rows.join(hot, match)
    cold_rows = rows.join(hot.select("_key"), match, "left_anti").join(cold, match)
    return hot_rows.unionByName(cold_rows).drop("_key")
