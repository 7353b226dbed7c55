"""A Bloom filter of a key set, built and asked by built-in functions.

The filter is one array of 64-bit words, a scalar subquery of the plan, so rows are tested
where they are scanned, before any shuffle. It keeps some rows that are no members; an exact
join follows.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 10
HASHES = 4
# 8 MB go to every task at most. With fewer than LEAST_BITS per key the filter keeps most rows.
MAX_WORDS = 1 << 20
LEAST_BITS = 4


def _half(hash_: Column) -> Column:
    """Small enough that sums of a few do not overflow."""
    return F.shiftright(hash_, 8)


def _key_places(key: Column, bits: int) -> list[Column]:
    first, step = _half(F.xxhash64(key)), _half(F.xxhash64(F.lit(1), key))
    return [F.pmod(first + step * i, F.lit(bits)) for i in range(HASHES)]


def may_be_in(keys: DataFrame, on: str, key: Column, *, max_words: int = MAX_WORDS) -> Column | None:
    """Whether ``key`` may be one of the staged, distinct ``keys``; never false for one that is.

    None where a filter of the greatest size would hold too many keys. ``key`` has the type
    of the column ``on``.
    """
    size = keys.count()
    if size * LEAST_BITS > max_words * 64:
        return None
    words = min(max_words, 1 << max(6, math.ceil(math.log2(max(size, 1) * BITS_PER_KEY / 64))))
    bits = words * 64
    places = keys.select(F.explode(F.array(*_key_places(F.col(on), bits))).alias("_at"))
    filled = places.groupBy(F.shiftright("_at", 6).alias("id")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_at % 64 as int))")).alias("_bits"))
    whole = keys.sparkSession.range(words).join(filled, "id", "left").agg(
        F.sort_array(F.collect_list(F.struct("id", F.coalesce("_bits", F.lit(0).cast("long")).alias("_bits"))))["_bits"]
        .alias("words"))
    table = whole.scalar()
    tests = [
        F.getbit(F.element_at(table, (F.shiftright(place, 6) + 1).cast("int")), (place % 64).cast("int")) == 1
        for place in _key_places(key, bits)
    ]
    return reduce(and_, tests)
