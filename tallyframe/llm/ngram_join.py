"""Set-similarity join of documents on word n-grams, with skipping by set relations.

The sets are the distinct word n-grams. Two documents link when their Jaccard similarity
reaches a threshold. Equal sets are one class, compared once. The n-grams of a class
are put in one order for all, frequent ones last, and the first of them, which two
similar sets must share, are its entries in an inverted index.

The join works in three rounds that skip by relations between sets:

1. Lists of the first few entries name leaders, and every member is compared with one
   leader that its sketch does not rule out. These links make the first components.
2. An index list whose entries all lie in one component is skipped, and one without an early
   place, as the first n-gram that two similar sets share is among the early ones of the smaller.
   The lists that are left are cut by set size, and long ones into blocks of early and of late
   places, of which two late ones are skipped whole. Inside the blocks a pair is skipped by its
   places, by its sizes, by a parity sketch of its sets, or by the answers of a leader that both
   were compared with: the overlap of B with X is at most the overlap of the leader with X plus
   what B has beyond the leader. A group of entries with more pairs left than entries names
   only the closest pair of each component, so pairs never outnumber entries; its list is
   looked at again when these have been compared.
3. Of the pairs that are left, every component compares its closest one, some times over;
   the pairs whose components are then still apart are all compared.

So all links that matter for the components are found without listing the pairs of a
group of similar texts. Every comparison is of the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import releasing, small_batches, whole_text
from tallyframe.llm.components import components, joined_components, with_ends
from tallyframe.plans.bloom import may_be_in
from tallyframe.plans.joins import BROADCAST_BYTES, BROADCAST_ROWS, fits_broadcast
from tallyframe.plans.staging import Scratch, stage

# N-grams counted at a time in a task; those in LOCAL documents of them are reported.
COUNTED = 1_000_000
LOCAL = 8
# Frequent n-grams whose counts steer the order; 16 bytes each go to every task. Any
# order gives the same links, so this bounds a table and drops nothing.
FREQUENT = 1 << 20
LEADER_ENTRIES = 12
LEADER_PART = 100_000  # entries of a list under one leader
SKETCH_BITS = 1024
MEMBERS = 256  # compared with one set in one go
BLOCK = 1024  # entries of a block of an index list
LEADER_ROUNDS = 2
CLOSEST_ROUNDS = 3
LIST_ROUNDS = 2  # of lists with many pairs, before all of their pairs are named
LISTED_WORDS = 1 << 21  # of the Bloom filter of the lists' n-grams: 16 MB
MIXED_ROWS = 20_000  # of the table of lists that are broadcast to their entries
WIDE_BYTES = 8 << 20  # of the wide sketches that are broadcast to the pairs
PAIRS = 1 << 18  # of blocks that are looked at in one go, with 400 bytes each

_U = np.uint64
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Shingles:
    """Distinct n-gram hashes of texts, sorted, for many texts at a time.

    Bytes are lower-cased and split by exactly A-Z and the six ASCII spaces. A word is a
    polynomial of its bytes modulo 2**64, read off running sums; those over ``LONG`` bytes,
    where such a polynomial is weak, are hashed one by one.
    """

    LONG = 64
    TOGETHER = 1 << 18  # bytes

    def __init__(self, words: int) -> None:
        self._words = words
        self._space = np.zeros(256, bool)
        self._space[list(b"\t\n\v\f\r ")] = True
        self._byte = _mixed(np.arange(1, 257, dtype=_U) * _U(_MULTIPLIERS[0]))
        # 5 modulo 8, so its powers differ in all but their lowest bits.
        base = (_MULTIPLIERS[1] & ~7) | 5
        count = self.TOGETHER + self.LONG
        self._power = np.multiply.accumulate(np.append(_U(1), np.full(count, base, _U)))
        back = pow(base, -1, 1 << 64)
        self._back = np.multiply.accumulate(np.append(_U(1), np.full(self.TOGETHER, back, _U)))
        self._place = [_U(pow(_MULTIPLIERS[2] | 5, i + 1, 1 << 64)) for i in range(words)]

    def _hashed(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and first bytes of the words of ``data``."""
        content = np.frombuffer(data, np.uint8)
        inside = np.zeros(len(content) + 2, bool)
        np.logical_not(self._space[content], out=inside[1:-1])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        hashes = np.empty(len(starts), _U)
        # Words that begin in one stretch of bytes.
        cuts = np.flatnonzero(np.diff(starts // self.TOGETHER)) + 1
        for low, high in zip([0, *cuts], [*cuts, len(starts)], strict=True):
            if low == high:
                continue
            first = starts[low]
            begin = starts[low:high] - first
            end = np.minimum(ends[low:high] - first, begin + self.LONG)
            sums = np.zeros(end[-1] + 1, _U)
            np.cumsum(self._byte[content[first:first + end[-1]]] * self._power[:end[-1]], out=sums[1:])
            hashes[low:high] = _mixed((sums[end] - sums[begin]) * self._back[begin])
        for i in np.flatnonzero(ends - starts > self.LONG):
            hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i]:ends[i]])
        return hashes, starts

    def _grams(self, hashes: np.ndarray, words: int) -> np.ndarray:
        size = len(hashes) - words + 1
        total = np.zeros(size, _U)
        for i in range(words):
            total += hashes[i:i + size] * self._place[i]
        return _mixed(total)

    def _sets(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        hashes, starts = self._hashed(b" ".join(texts).lower())
        n = self._words
        grams = self._grams(hashes, n) if len(hashes) >= n else np.empty(0, _U)
        # Places of the words of each text.
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        bounds = np.searchsorted(starts, np.append(0, np.cumsum(lengths + 1))).tolist()
        for low, high in zip(bounds, bounds[1:], strict=False):
            if high - low >= n:
                found = np.sort(grams[low:high - n + 1])
                yield found[np.append(True, found[1:] != found[:-1])]
            elif high > low:
                yield self._grams(hashes[low:high], high - low)
            else:
                yield np.empty(0, _U)

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        group: list[bytes] = []
        held = 0
        for text in texts.cast(pa.binary()):
            group.append(text.as_py())
            held += len(group[-1])
            if held >= self.TOGETHER:
                yield from self._sets(group)
                group, held = [], 0
        if group:
            yield from self._sets(group)


_SHINGLES: dict[int, Shingles] = {}  # of this Python worker, over its tasks


def _shingles(words: int) -> Shingles:
    return _SHINGLES.get(words) or _SHINGLES.setdefault(words, Shingles(words))


def _frequent(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent n-grams, sorted, and their counts over all documents."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = _shingles(words)
        sets: list[np.ndarray] = []
        held = 0

        def report() -> pa.RecordBatch:
            values = np.sort(np.concatenate(sets or [np.empty(0, _U)]))
            firsts = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else values
            counts = np.diff(np.append(firsts, len(values)).astype("int64"))
            values, often = values[firsts.astype("int64")], counts >= LOCAL
            return pa.RecordBatch.from_arrays(
                [pa.array(values[often].view("int64")), pa.array(counts[often].astype("int64"))],
                ["gram", "n"])

        for batch in batches:
            for found in shingles(batch.column(0)):
                sets.append(found)
                held += len(found)
                if held >= COUNTED:
                    yield report()
                    sets, held = [], 0
        yield report()

    counts = (
        docs.select("text").mapInArrow(releasing(counted), "gram long, n long")
        .groupBy("gram").agg(F.sum("n").alias("n"))
        .orderBy(F.col("n").desc(), "gram").limit(FREQUENT)
    )
    rows = counts.toArrow()
    grams = rows["gram"].to_numpy().view(_U)
    order = np.argsort(grams)
    return grams[order], rows["n"].to_numpy()[order]


def _ordered_prefix(found: np.ndarray, size: int, grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first ``size`` of the sorted set, n-grams that are frequent last."""
    if not len(grams):
        return found[:size]
    for some in (found[:2 * size], found):
        at = np.minimum(np.searchsorted(grams, some), len(grams) - 1)
        often = grams[at] == some
        rare = some[~often][:size]
        if len(rare) == size:
            return rare
    rest, n = found[often], counts[at[often]]
    return np.concatenate([rare, rest[np.lexsort((rest, n))][:size - len(rare)]])


def _sketch(found: np.ndarray, size: int = SKETCH_BITS) -> bytes:
    """Bit ``i`` is the parity of the n-grams that fall on it: two sets differ in at least
    as many n-grams as their sketches do in bits."""
    bits = np.bincount((found & _U(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def _long_enough(n: int, percent: int) -> int:
    """Bits of a sketch in which unrelated sets of ``n`` differ by more than linked ones may.

    Those fill about half of the bits, so over twice as many bits as linked sets have different
    n-grams tell them apart.
    """
    differing = 2 * n - 2 * _needed(n, n, percent)
    return max(SKETCH_BITS, 1 << int(9 * differing // 4).bit_length())


def _wide_sketch(found: np.ndarray) -> bytes | None:
    """A sketch of at least two bits an n-gram for a set that fills the common size."""
    if len(found) <= SKETCH_BITS:
        return None
    return _sketch(found, 1 << int(2 * len(found) - 1).bit_length())


def _wide_differing(a: bytes, b: bytes) -> int:
    """Differing bits of two wide sketches; halves of the larger one are added up to the smaller's size."""
    x, y = sorted((np.frombuffer(v, np.uint8) for v in (a, b)), key=len)
    y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def _sets(docs: DataFrame, words: int, percent: int, grams: np.ndarray, counts: np.ndarray) -> DataFrame:
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = _shingles(words)
        for batch in batches:
            n, high, low, prefix, sketch, wide = [], [], [], [], [], []
            for found in shingles(batch.column(1)):
                digest = xxhash.xxh3_128_intdigest(found.tobytes())
                n.append(len(found))
                high.append((digest >> 64) - (1 << 63))
                low.append((digest & ((1 << 64) - 1)) - (1 << 63))
                first = len(found) - -(-percent * len(found) // 100) + 1 if len(found) else 0
                prefix.append(_ordered_prefix(found, first, grams, counts).view("int64"))
                sketch.append(_sketch(found, _long_enough(len(found), percent)))
                wide.append(_wide_sketch(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(high, pa.int64()),
                 pa.array(low, pa.int64()), pa.array(prefix, pa.list_(pa.int64())),
                 pa.array(sketch, pa.binary()), pa.array(wide, pa.binary())],
                ["doc_id", "n", "high", "low", "prefix", "sketch", "wide"])

    return docs.mapInArrow(
        releasing(made), "doc_id long, n long, high long, low long, prefix array<long>, "
        "sketch binary, wide binary")


def _needed(n_a, n_b, percent: int):
    """Smallest overlap of two sets at the threshold."""
    return -(-percent * (n_a + n_b) // (100 + percent))


def _least_overlap(n_a: str, n_b: str, percent: int) -> Column:
    """``_needed`` of columns."""
    return F.expr(f"({percent} * ({n_a} + {n_b}) + {99 + percent}) div {100 + percent}")


def _sizes_fit(n_a: Column, n_b: Column, percent: int) -> Column:
    return (100 * n_a >= percent * n_b) & (100 * n_b >= percent * n_a)


def _compared(scratch: Scratch, pairs: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """``a``, ``b``, ``n_a``, ``n_b``, ``shared`` for stored pairs of identifiers, by whole sets.

    The text of ``b`` goes to a group of ``a``, and that of ``a`` to each of its groups,
    of which there is one for every ``MEMBERS`` partners.
    """
    groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("_groups"))
    # There are at most two rows to send for a pair.
    few = fits_broadcast(pairs, max_rows=BROADCAST_ROWS // 2, max_bytes=BROADCAST_BYTES // 2)
    to_b = pairs.join(F.broadcast(groups) if few else groups, "a").select(
        F.col("b").alias("doc_id"), F.col("a").alias("key"),
        F.pmod(F.xxhash64("b"), F.col("_groups")).cast("int").alias("part"), F.lit(1).alias("role"))
    to_a = groups.select(
        F.col("a").alias("doc_id"), F.col("a").alias("key"),
        F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)).alias("part"), F.lit(0).alias("role"))
    sends = to_b.unionByName(to_a)
    sends = F.broadcast(sends) if few else scratch.stage(sends, "sends")
    dealt = (
        docs.join(sends, "doc_id")
        .repartition("key", "part").sortWithinPartitions("key", "part", "role")
        .select("key", "part", "role", "doc_id", "text")
    )

    def overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = _shingles(words)
        group, leaders = None, []
        for batch in batches:
            out = ([], [], [], [], [])
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for key, part, role, doc, found in zip(*columns, shingles(batch.column(4)), strict=True):
                if (key, part) != group:
                    group, leaders = (key, part), []
                if role == 0:
                    leaders.append(found)
                    continue
                for leader in leaders:
                    at = np.minimum(np.searchsorted(leader, found), max(len(leader) - 1, 0))
                    shared = int((leader[at] == found).sum()) if len(leader) else 0
                    for column, value in zip(out, (key, doc, len(leader), len(found), shared), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in out], ["a", "b", "n_a", "n_b", "shared"])

    return dealt.mapInArrow(releasing(overlaps), "a long, b long, n_a long, n_b long, shared long")


def _linked(percent: int) -> Column:
    union = F.col("n_a") + F.col("n_b") - F.col("shared")
    return (F.col("shared") > 0) & (100 * F.col("shared") >= percent * union)


def _star_pairs(classes: DataFrame, percent: int) -> DataFrame:
    """Pairs of a leader and a member that may link, for the first entries of every member.

    The leader of a list is drawn by a hash of list and identifier, so a similar group has
    several. A long list has a leader in each part. At most ``LEADER_ENTRIES`` pairs a member.
    """
    first = classes.select("id", F.explode(F.slice("prefix", 1, LEADER_ENTRIES)).alias("gram"))
    several = first.groupBy("gram").agg(F.count("*").alias("_n")).filter("_n > 1")
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("_n") / LEADER_PART))
    dealt = (
        first.join(several, "gram").select("gram", part.alias("part"), "id")
        .join(classes.select("id", "n", "sketch"), "id")
        .withColumn("_place", F.xxhash64("gram", "id"))
        .repartition("gram", "part").sortWithinPartitions("gram", "part", "_place", "id")
        .select("gram", "part", "id", "n", "sketch")
    )

    def led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, leader = None, None  # of the last row before a batch
        for batch in batches:
            if not len(batch):
                continue
            gram, part, ids, n = (batch.column(i).to_numpy() for i in range(4))
            bits = _bits(batch.column(4))
            starts = np.empty(len(batch), bool)
            starts[0] = group != (gram[0], part[0])
            starts[1:] = (gram[1:] != gram[:-1]) | (part[1:] != part[:-1])
            at = np.maximum.accumulate(np.where(starts, np.arange(len(batch)), -1))
            known = (ids[at], n[at], bits[at])
            if at[0] < 0:
                known = tuple(
                    np.where((at < 0).reshape(-1, *[1] * (k.ndim - 1)), value, k)
                    for k, value in zip(known, leader, strict=True))
            group, leader = (gram[-1], part[-1]), tuple(k[-1] for k in known)
            total = n + known[1]
            near = (ids != known[0]) & (100 * np.minimum(n, known[1]) >= percent * np.maximum(n, known[1]))
            apart = _differing(bits, known[2])
            near &= apart <= total - 2 * _needed(total, 0, percent)
            yield pa.RecordBatch.from_arrays(
                [pa.array(known[0][near]), pa.array(ids[near]), pa.array(apart[near])], ["a", "b", "apart"])

    return dealt.mapInArrow(releasing(led), "a long, b long, apart long").dropDuplicates(["a", "b"])


def _folded(sketches: list[bytes], bits: int = SKETCH_BITS) -> np.ndarray:
    """The sketches with ``bits`` bits each, as rows of words; longer ones are folded."""
    size = bits // 64
    rows = np.empty((len(sketches), size), _U)
    lengths = np.fromiter(map(len, sketches), np.int64, len(sketches))
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        words = np.frombuffer(b"".join(sketches[i] for i in at), _U).reshape(len(at), -1, size)
        rows[at] = np.bitwise_xor.reduce(words, axis=1)
    return rows


def _bits(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return _folded(column.to_pylist())


class _LongSketches:
    """The sketches of a table of entries that have more than the common size."""

    TOGETHER = 1 << 22  # bytes of the sketches of pairs

    def __init__(self, column: pa.ChunkedArray) -> None:
        self._sketches = column.to_pylist()
        self._length = np.fromiter(map(len, self._sketches), np.int64, len(self._sketches))
        self._rows: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # by length

    def _of(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        if length not in self._rows:
            at = np.flatnonzero(self._length >= length)
            place = np.full(len(self._sketches), -1)
            place[at] = np.arange(len(at))
            self._rows[length] = place, _folded([self._sketches[i] for i in at], 8 * length)
        return self._rows[length]

    def differing(self, x: np.ndarray, y: np.ndarray, apart: np.ndarray) -> np.ndarray:
        """``apart`` by the longest sketches that both sides of a pair have."""
        both = np.minimum(self._length[x], self._length[y])
        apart = apart.copy()
        for length in np.unique(both[both > SKETCH_BITS // 8]):
            place, rows = self._of(int(length))
            pairs = np.flatnonzero(both == length)
            step = max(1, self.TOGETHER // int(length))
            for low in range(0, len(pairs), step):
                some = pairs[low:low + step]
                apart[some] = _differing(rows[place[x[some]]], rows[place[y[some]]])
        return apart


def _closest_of_each(group: np.ndarray, component: tuple[np.ndarray, np.ndarray], apart: np.ndarray) -> np.ndarray:
    """Places of the pairs that are the closest of one of their components in their group."""
    order = np.lexsort((apart, group))
    codes = np.unique(np.concatenate(component), return_inverse=True)[1].reshape(2, -1)[:, order]
    keys = (group[order] * (codes.max(initial=0) + 1) + codes).T.ravel()
    return np.sort(order[np.unique(np.unique(keys, return_index=True)[1] // 2)])


def _differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def _cells(scratch: Scratch, classes: DataFrame, percent: int) -> DataFrame:
    """Entries of the index lists of more than one component, stored, each in its cells of sizes.

    ``classes`` has the component of each class.
    """
    # A set of the next size step up to its own may be similar, none further away.
    step = float(np.log(100 / percent)) * (1 + 1e-9)
    # The first n-gram that two similar sets share leaves each at least their overlap behind
    # its place. So the smaller set has it among its first places, `early`, whatever the other's size.
    entries = classes.select(
        "id", "n", "component", F.posexplode("prefix").alias("pos", "gram")
    ).withColumn("early", F.col("pos") <= F.col("n") - _least_overlap("n", "n", percent))
    mixed = scratch.stage(
        entries.groupBy("gram")
        .agg(F.min("component").alias("_low"), F.max("component").alias("_high"), F.max("early").alias("_early"))
        .filter("_low != _high and _early").select("gram"), "mixed")
    if fits_broadcast(mixed, max_rows=MIXED_ROWS):
        mixed = F.broadcast(mixed)
    else:
        # Most entries are of no such list and end before the shuffle.
        likely = may_be_in(mixed, "gram", F.col("gram"), max_words=LISTED_WORDS)
        entries = entries if likely is None else entries.filter(likely)
    own = F.floor(F.log(F.col("n").cast("double")) / F.lit(step)).cast("int")
    # The sets of the next step have at least so many n-grams.
    above = F.greatest("n", F.floor(F.exp(F.lit(step) * (F.col("own") + 1)) * F.lit(1 - 1e-9)).cast("long"))
    meets_above = F.col("pos") <= F.col("n") - _least_overlap("n", "above", percent)
    return scratch.stage(
        entries.join(mixed, "gram")
        .withColumn("own", own).withColumn("above", above)
        .withColumn("cell", F.explode(
            F.when(meets_above, F.array("own", F.col("own") + 1)).otherwise(F.array("own"))))
        .drop("above"), "cells")


def _cross_pairs(cells: DataFrame, classes: DataFrame, percent: int, *, all_pairs: bool) -> DataFrame:
    """Pairs of an index list whose components differ and that nothing known rules out.

    ``cells`` has the component of each class, ``classes`` its leader and the overlap with it.
    Rows with ``listed`` are pairs. A group with more of them than entries has only the closest
    one of each component, and its ``(gram, cell)`` as a row without ``listed``; with
    ``all_pairs`` every group has all.
    """
    early, late = F.count_if("early"), F.count_if(~F.col("early"))
    sized = (
        cells.groupBy("gram", "cell")
        .agg(early.alias("_early"), late.alias("_late"), F.min("component").alias("_low"),
             F.max("component").alias("_high"), F.max("own").alias("_own"))
        # Only pairs with an entry of the cell itself; the cell above has the others.
        .filter("_early > 0 and _early + _late > 1 and _low != _high and _own = cell")
        .withColumn("_cut", F.col("_early") + F.col("_late") > BLOCK)
        .select("gram", "cell", "_cut", F.ceil(F.col("_early") / BLOCK).cast("int").alias("_first"),
                F.ceil(F.col("_late") / BLOCK).cast("int").alias("_rest"))
    )
    about = classes.select("id", "sketch", "leader", "shared")
    # A long list is cut into blocks of early places and, after them, blocks of late ones. Two
    # blocks of late places have no pair and are skipped whole.
    hashed = F.xxhash64("id")
    block = F.when(~F.col("_cut"), 0).when(F.col("early"), F.pmod(hashed, F.col("_first"))).otherwise(
        F.col("_first") + F.pmod(hashed, F.col("_rest"))).cast("int")
    last = F.when(~F.col("_cut"), 0).otherwise(
        F.col("_first") + F.when(F.col("early"), F.col("_rest")).otherwise(0) - 1)
    dealt = (
        cells.join(sized, ["gram", "cell"])
        .withColumn("_block", block)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), last.cast("int"))))
        .withColumns({"_i": F.least("_block", "_other"), "_j": F.greatest("_block", "_other")})
        .join(about, "id")
        .repartition("gram", "cell", "_i", "_j").sortWithinPartitions("gram", "cell", "_i", "_j")
        .select("gram", "cell", "_i", "_j", "_block", "id", "n", "component", "pos", "own",
                F.coalesce("leader", F.lit(-1).cast("long")).alias("leader"),
                F.coalesce("shared", F.lit(0).cast("long")).alias("shared"),
                F.col("leader").isNotNull().alias("led"), "sketch")
    )
    names = dealt.columns[:-1]

    schema = ["a", "b", "apart", "listed"]

    def judged(rows: dict[str, np.ndarray], bits: np.ndarray, sketches: _LongSketches, firsts: np.ndarray,
               size: int) -> Iterator[pa.RecordBatch]:
        """Of the groups of ``size`` entries from ``firsts`` on."""
        n, pos, ids = rows["n"], rows["pos"], rows["id"]
        x, y = (firsts[:, None] + np.stack(np.triu_indices(size, 1))[:, None]).reshape(2, -1)
        group = np.repeat(np.arange(len(firsts)), size * (size - 1) // 2)
        keep = rows["component"][x] != rows["component"][y]
        # One entry at least of the cell itself, and each pair of blocks once.
        keep &= (rows["own"][x] == rows["cell"][x]) | (rows["own"][y] == rows["cell"][y])
        keep &= (rows["_i"][x] == rows["_j"][x]) | (rows["_block"][x] != rows["_block"][y])
        x, y, group = x[keep], y[keep], group[keep]
        small, large = np.minimum(n[x], n[y]), np.maximum(n[x], n[y])
        need = _needed(n[x], n[y], percent)
        # What two sets can share from their places on, where these are of their first common n-gram.
        keep = (100 * small >= percent * large) & (np.minimum(n[x] - pos[x], n[y] - pos[y]) >= need)
        # What both share is at most what one shares with the leader plus what the other
        # has beyond the leader.
        shared = rows["shared"]
        most = np.minimum(shared[x] + n[y] - shared[y], shared[y] + n[x] - shared[x])
        same = rows["led"][x] & rows["led"][y] & (rows["leader"][x] == rows["leader"][y])
        keep &= ~same | (most >= need)
        x, y, need, group = x[keep], y[keep], need[keep], group[keep]
        most = n[x] + n[y] - 2 * need
        apart = _differing(bits[x], bits[y])
        keep = (apart <= most) & (ids[x] != ids[y])
        x, y, most, group = x[keep], y[keep], most[keep], group[keep]
        apart = sketches.differing(x, y, apart[keep])
        keep = apart <= most
        x, y, apart, group = x[keep], y[keep], apart[keep], group[keep]
        if not all_pairs:
            many = np.bincount(group, minlength=len(firsts)) > size
            if many.any():
                cut = np.flatnonzero(many[group])
                closest = cut[_closest_of_each(
                    group[cut], (rows["component"][x[cut]], rows["component"][y[cut]]), apart[cut])]
                kept = np.sort(np.append(np.flatnonzero(~many[group]), closest))
                x, y, apart = x[kept], y[kept], apart[kept]
                at = firsts[many]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["gram"][at]), pa.array(rows["cell"][at].astype("int64")),
                     pa.array(np.zeros(len(at), "int64")), pa.array(np.zeros(len(at), bool))], schema)
        a, b = ids[x], ids[y]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(apart),
             pa.array(np.ones(len(a), bool))], schema)

    def pairs_of(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Pairs within each group; groups of one size are looked at together."""
        rows = {name: table[name].to_numpy() for name in names}
        bits, sketches = _bits(table["sketch"]), _LongSketches(table["sketch"])
        sizes = np.diff(np.append(starts, len(table)))
        for size in np.unique(sizes[sizes > 1]):
            firsts = starts[sizes == size]
            at_once = max(1, PAIRS // (size * (size - 1) // 2))
            for low in range(0, len(firsts), at_once):
                yield from judged(rows, bits, sketches, firsts[low:low + at_once], size)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the last group, which may go on

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            keys = np.stack([table[k].to_numpy() for k in ("gram", "cell", "_i", "_j")])
            starts = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1])
            held.clear()
            if not last:
                held.extend(table.slice(starts[-1]).to_batches())
                table, starts = table.slice(0, starts[-1]), starts[:-1]
            if len(table):
                yield from pairs_of(table, starts)

        for batch in batches:
            if len(batch):
                held.append(batch)
                yield from flush(last=False)
        if held:
            yield from flush(last=True)

    found = dealt.mapInArrow(releasing(pairs), "a long, b long, apart long, listed boolean")
    return found.groupBy("listed", "a", "b").agg(F.min("apart").alias("apart"))


def _wide_enough(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs that the wide sketches of long sets leave; ``sets`` has those. Both are stored."""
    long = sets.filter("wide is not null")
    if fits_broadcast(pairs):
        # Sketches of sets without a pair do not travel.
        ends = pairs.select(F.explode(F.array("a", "b")).alias("id"))
        long = long.join(F.broadcast(ends), "id", "left_semi")
    if fits_broadcast(long, max_bytes=WIDE_BYTES):
        long = F.broadcast(long)
    for side in ("a", "b"):
        pairs = pairs.join(
            long.select(F.col("id").alias(side), F.col("n").alias(f"n_{side}"), F.col("wide").alias(f"w_{side}")),
            side, "left")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                a is None or b is None or _wide_differing(a, b) <= n_a + n_b - 2 * _needed(n_a, n_b, percent)
                for n_a, n_b, a, b in zip(*(batch.column(i).to_pylist() for i in range(3, 7)), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).filter(pa.array(keep, pa.bool_())) for i in range(3)], ["a", "b", "apart"])

    return pairs.select("a", "b", "apart", "n_a", "n_b", "w_a", "w_b").mapInArrow(
        releasing(near), "a long, b long, apart long")


def _linked_classes(scratch: Scratch, classes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``node`` and ``component`` of all classes that link with another."""

    def compared(pairs: DataFrame) -> DataFrame:
        return scratch.stage(_compared(scratch, pairs, docs, words), "compared")

    # Members take the leader that comes first by a hash for all lists, so a group agrees on
    # few; those that this does not link take the closest that is left, some times over.
    stars = scratch.stage(_star_pairs(classes, percent), "stars")
    first = F.min(F.struct(F.xxhash64("a").alias("place"), "a")).alias("_led")
    led = compared(scratch.stage(stars.groupBy("b").agg(first).select("_led.a", "b"), "led"))
    labels = components(led.filter(_linked(percent)))
    tried = led.select("a", "b")
    for _ in range(LEADER_ROUNDS):
        stars = scratch.stage(
            with_ends(stars, labels).join(tried, ["a", "b"], "left_anti").select("a", "b", "apart"), "stars")
        closest = F.min(F.struct("apart", "a")).alias("_led")
        tried = scratch.stage(stars.groupBy("b").agg(closest).select("_led.a", "b"), "tried")
        if tried.isEmpty():
            break
        labels = joined_components(labels, compared(tried).filter(_linked(percent)))
    known = scratch.stage(
        classes.select("id", "n", "prefix", "sketch")
        .join(labels.withColumnRenamed("node", "id"), "id", "left")
        .join(led.select(F.col("b").alias("id"), F.col("a").alias("leader"), "shared"), "id", "left")
        .withColumn("component", F.coalesce("component", "id")), "known")
    cells = _cells(scratch, known, percent)
    for again in range(LIST_ROUNDS + 1):
        found = scratch.stage(_cross_pairs(cells, known, percent, all_pairs=again == LIST_ROUNDS), "pairs")
        left = scratch.stage(
            _wide_enough(found.filter("listed").drop("listed"), classes.select("id", "n", "wide"), percent), "cross")
        for turn in range(CLOSEST_ROUNDS + 1):
            left = scratch.stage(with_ends(left, labels), "left")
            if left.isEmpty():
                break
            tried = left.select("a", "b")
            if turn < CLOSEST_ROUNDS:
                sides = left.select("c_a", "apart", "a", "b").unionByName(
                    left.select(F.col("c_b").alias("c_a"), "apart", "a", "b"))
                tried = scratch.stage(
                    sides.groupBy("c_a").agg(F.min(F.struct("apart", "a", "b")).alias("_pair"))
                    .select("_pair.a", "_pair.b").distinct(), "tried")
                left = left.join(tried, ["a", "b"], "left_anti").select("a", "b", "apart")
            labels = joined_components(labels, compared(tried).filter(_linked(percent)))
        # Lists with more pairs, by what their classes belong to now.
        cut = scratch.stage(
            found.filter(~F.col("listed")).select(F.col("a").alias("gram"), F.col("b").cast("int").alias("cell")), "cut")
        if cut.isEmpty():
            break
        if fits_broadcast(cut):
            cut = F.broadcast(cut)
        now = labels.select(F.col("node").alias("id"), F.col("component").alias("_now"))
        cells = scratch.stage(
            cells.join(cut, ["gram", "cell"], "left_semi").join(now, "id", "left")
            .withColumn("component", F.coalesce("_now", "component")).drop("_now"), "cells")
    return labels


def ngram_join(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", words: int = 3,
               percent: int = 90) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id``.

    Documents link when 100 times the intersection of their sets of ``words``-word n-grams
    is at least ``percent`` times the union. A text with fewer words is one n-gram; a null,
    empty or blank text has none and links with nothing. ``component_id`` is the smallest
    identifier reachable by links. Rows that repeat an identifier are one document for the
    links, each keeps its own row. A row without an identifier links with nothing and has
    no component. An empty table gives no rows. Identifiers are integers.
    """
    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    with small_batches(docs.sparkSession), Scratch(docs.sparkSession) as scratch:
        grams, counts = _frequent(ids, words)
        sets = scratch.stage(_sets(ids, words, percent, grams, counts), "sets")
        has = F.col("doc_id").isNotNull() & (F.col("n") > 0)
        classes = scratch.stage(
            sets.filter(has).groupBy("high", "low", "n")
            .agg(F.min(F.struct("doc_id", "prefix", "sketch", "wide")).alias("_first"))
            .select("high", "low", "n", F.col("_first.doc_id").alias("id"), "_first.prefix",
                    "_first.sketch", "_first.wide"),
            "classes")
        labels = _linked_classes(scratch, classes, ids, words, percent)
        in_class = classes.select("high", "low", "n", "id").join(
            labels.withColumnRenamed("node", "id"), "id", "left"
        ).select("high", "low", "n", F.coalesce("component", "id").alias("component_id"))
        linked = sets.filter(has).select("doc_id", "n", "high", "low").join(in_class, ["high", "low", "n"])
        alone = sets.filter(~has).withColumn("component_id", F.col("doc_id"))
        columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id"]
        return stage(linked.select(*columns).unionByName(alone.select(*columns)), "joined")
