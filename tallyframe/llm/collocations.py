"""Collocations from the counts of a multikey three-way quicksort of suffix pointers.

Every word of a piece begins a suffix of at most ``longest`` words. A task sorts the suffixes
of its texts, so that equal ones become one with a number, and sends each to the bucket of
its leading words, all that a task has for a bucket in one compressed row. Leading words
that a bounded sample shows to be hot are extended by the next word until they are not, so
that a frequent word, pair or phrase is many buckets. The hot leads themselves are counted by the tasks.

In a bucket the pointers to its suffixes are parted three ways by the word at a depth, into
less, equal and greater. The equal part is a phrase and its size the phrase's count; it is
parted further at the next depth. A part that is smaller than the least count is abandoned.

Phrases and counts are then joined: each cut of a candidate with the counts of its two parts,
and each candidate with those one word longer.
"""

from __future__ import annotations

import array
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import partitions, whole_text
from tallyframe.llm.words import Numbers, byte_spans, mixed, word_hashes
from tallyframe.plans.joins import fits_broadcast, lookup
from tallyframe.plans.staging import stage

LEAST = 100
LONGEST = 5
FIRST = 2000
CHUNK = 8 << 20  # bytes of text whose suffixes a task sorts together
BUCKET_BYTES = 2 << 20  # of text; a suffix is some five times its share of it
# Suffixes sampled for each shuffle partition; leading words are hot from a quarter of a mean
# partition, so at most four are for each partition and number of words.
SAMPLED = 400
SALTS = 64  # of a language whose candidates are ranked

_U = np.uint64
_LOWER = bytes(c + 32 if 65 <= c <= 90 else 10 if c in b".,;:!?\n\v\f\r" else c for c in range(256))
_END = b"."  # no word: it parts pieces


def pieces_of(text: bytes) -> list[bytes]:
    """Lower-cased words, with ``_END`` between and after the pieces."""
    return text.translate(_LOWER).replace(b"\n", b" . ").split() + [_END]


class Suffixes:
    """The distinct suffixes of some tokens, sorted, with their numbers.

    ``ids`` has a row for each suffix, with 0 for words beyond the end of its piece.
    """

    def __init__(self, tokens: list[bytes], longest: int) -> None:
        self._tokens = tokens
        numbers = Numbers({_END: 0})
        ids = np.fromiter(map(numbers.__getitem__, tokens), np.int64, len(tokens))
        self._hashes = word_hashes(list(numbers))
        starts = np.flatnonzero(ids)
        padded = np.append(ids, np.zeros(longest, np.int64))
        columns = [ids[starts]]
        for depth in range(1, longest):
            columns.append(np.where(columns[-1] > 0, padded[starts + depth], 0))
        bits = max(len(numbers).bit_length(), 1)
        keys, room = [], 0  # as many words to a sort key as it holds
        for column in columns:
            if room < bits:
                keys.append(column.copy())
                room = 63 - bits
            else:
                keys[-1] = keys[-1] << bits | column
                room -= bits
        order = np.lexsort(keys[::-1]) if len(starts) else starts
        new = np.ones(len(order), bool)
        if len(order):
            new[1:] = np.any([key[order][1:] != key[order][:-1] for key in keys], axis=0)
        firsts = np.flatnonzero(new)
        self.number = np.diff(np.append(firsts, len(order)))
        chosen = order[firsts]
        self._start = starts[chosen]
        self.ids = np.stack([column[chosen] for column in columns], axis=1)
        self.words = (self.ids > 0).sum(axis=1)
        self.total = len(starts)

    def leads(self, language: int) -> np.ndarray:
        """For each suffix and number of words the hash of so many leading words."""
        hashed = self._hashes[self.ids]
        out = np.empty(self.ids.shape, _U)
        state = np.full(len(self.ids), language, _U)
        for depth in range(self.ids.shape[1]):
            state = mixed(state * _U(0x9E3779B97F4A7C15) + hashed[:, depth])
            out[:, depth] = state
        return out

    def texts(self, chosen: np.ndarray, words: np.ndarray) -> list[bytes]:
        content = b" ".join(self._tokens)
        begin, end = byte_spans(self._tokens)
        first = self._start[chosen]
        return [content[a:b] for a, b in zip(
            begin[first].tolist(), end[first + words - 1].tolist(), strict=True)]


def frequent_phrases(ids: np.ndarray, number: np.ndarray, depth: int, least: int) -> Iterator[tuple[int, int, int]]:
    """A suffix with the phrase, its number of words and its count, for each frequent phrase of
    more than ``depth`` words.

    The suffixes agree in nothing. Rows of ``ids`` that end early hold 0 from there on.
    """
    longest = ids.shape[1]
    parts = [(np.arange(len(ids)), depth)]
    while parts:
        pointers, depth = parts.pop()
        if number[pointers].sum() < least:
            continue
        words = ids[pointers, depth]
        pivot = words[len(words) // 2]
        equal = pointers[words == pivot]
        if len(equal) < len(pointers):
            parts.append((pointers[words < pivot], depth))
            parts.append((pointers[words > pivot], depth))
        if pivot:
            count = int(number[equal].sum())
            if count >= least:
                yield int(equal[0]), depth + 1, count
                if depth + 1 < longest:
                    parts.append((equal, depth + 1))


def _is_in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(values.shape, bool)
    return table[np.searchsorted(table, values) % len(table)] == values


def _chunks(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[tuple[str, int, Suffixes]]:
    """The language, its hash and the suffixes of batches of language and text."""
    held: dict[str, list[bytes]] = {}
    size = 0

    def sorted_suffixes() -> Iterator[tuple[str, int, Suffixes]]:
        for language, tokens in held.items():
            seed = int(word_hashes([language.encode("utf-8", "surrogatepass")])[0])
            yield language, seed, Suffixes(tokens, longest)

    for batch in batches:
        for language, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data = text.as_py()
            held.setdefault(language, []).extend(pieces_of(data))
            size += len(data)
            if size >= CHUNK:
                yield from sorted_suffixes()
                held, size = {}, 0
    yield from sorted_suffixes()


def _hot_leads(rows: DataFrame, text_bytes: int, longest: int, sampled: int, seed: int) -> np.ndarray:
    """Hashes of hot leading words, sorted."""
    parts = partitions(rows.sparkSession)
    expected = text_bytes / 6
    if not expected:
        return np.empty(0, _U)
    share = min(1.0, sampled * parts / expected)

    def leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, language, suffixes in _chunks(batches, longest):
            if not suffixes.total:
                continue
            values = suffixes.leads(language)[suffixes.ids > 0]
            numbers = np.repeat(suffixes.number, suffixes.words)
            names, at = np.unique(values, return_inverse=True)
            counts = np.bincount(at, numbers).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(counts)], ["lead", "n"])

    least = max(sampled / 4, share * expected / parts / 4)
    counts = rows.sample(share, seed=seed).mapInArrow(leads, "lead long, n long")
    counts = counts.groupBy("lead").agg(F.sum("n").alias("n")).filter(F.col("n") > least)
    return np.sort(np.array([row["lead"] for row in counts.collect()], np.int64).view(_U))


def phrase_counts(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = LEAST,
                  longest: int = LONGEST, sampled: int = SAMPLED, bucket_bytes: int = BUCKET_BYTES,
                  seed: int = 3) -> DataFrame:
    """``lang``, ``phrase``, ``words``, ``n``: all phrases of up to ``longest`` words that occur
    ``least`` times in their language, and with 0 words and a null phrase the number of all words.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       whole_text(text).cast("binary").alias("text"))
    text_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(8 * partitions(spark), math.ceil(text_bytes / bucket_bytes))
    hot = _hot_leads(rows, text_bytes, longest, sampled, seed)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=1)
        for language, coded, suffixes in _chunks(batches, longest):
            if not suffixes.total:
                continue
            # Counts of this task meet those of others in some buckets, and are summed after them.
            salt = suffixes.total % SALTS
            rows: list[tuple] = [(salt, b"", 0, suffixes.total, None)]
            leads = suffixes.leads(coded)
            # What a hot lead begins with is as frequent, so it is hot too, or counts as cold.
            known = np.cumprod(_is_in(leads, hot) & (suffixes.ids > 0), axis=1).sum(axis=1)
            for depth in range(1, int(known.max()) + 1):
                chosen = np.flatnonzero(known >= depth)
                firsts = _changes(suffixes.ids[chosen, :depth])
                counts = np.add.reduceat(suffixes.number[chosen], firsts)
                found = suffixes.texts(chosen[firsts], np.full(len(firsts), depth))
                places = (leads[chosen[firsts], depth - 1] + _U(salt)) % _U(buckets)
                rows += [(*row, None) for row in zip(
                    places.tolist(), found, [depth] * len(found), counts.tolist(), strict=True)]
            chosen = np.flatnonzero(known < suffixes.words)
            bucket = (leads[chosen, known[chosen]] % _U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            chosen, bucket = chosen[order], bucket[order]
            texts = suffixes.texts(chosen, suffixes.words[chosen])
            places, firsts = np.unique(bucket, return_index=True)
            ends = np.append(firsts[1:], len(chosen))[:len(firsts)]
            for place, low, high in zip(places.tolist(), firsts.tolist(), ends.tolist(), strict=True):
                part = chosen[low:high]
                data = _packed(suffixes.number[part], known[part], texts[low:high])
                rows.append((place, None, None, None, compressor.compress(data)))
            columns = zip(*rows, strict=True)
            kinds = pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.binary()
            yield pa.RecordBatch.from_arrays(
                [pa.array([language] * len(rows), pa.string()),
                 *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                ["lang", "bucket", "phrase", "words", "n", "packed"])

    def parted(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        given = table.filter(pc.is_valid(table["phrase"])).group_by(["phrase", "words"]).aggregate([("n", "sum")])
        phrases = given["phrase"].to_pylist()
        words = given["words"].to_pylist()
        counts = given["n_sum"].to_pylist()
        suffixes = Unpacked(table["packed"].drop_null(), longest)
        # Suffixes that were routed by one word more than ``depth``. What they share with others
        # up to there is hot and counted by the tasks.
        for depth in np.unique(suffixes.known).tolist():
            for part in _same_leads(suffixes.ids, np.flatnonzero(suffixes.known == depth), depth):
                for place, size, count in frequent_phrases(
                        suffixes.ids[part], suffixes.number[part], depth, least):
                    phrases.append(suffixes.phrase(part[place], size))
                    words.append(size)
                    counts.append(count)
        return pa.table([pa.array([key[0].as_py()] * len(phrases), pa.string()),
                         pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(words, pa.int32()),
                         pa.array(counts, pa.int64())], names=["lang", "phrase", "words", "n"])

    sorted_out = rows.mapInArrow(
        dealt, "lang string, bucket long, phrase binary, words int, n long, packed binary"
    ).groupBy("lang", "bucket").applyInArrow(parted, "lang string, phrase string, words int, n long")
    summed = sorted_out.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))
    return summed.filter((F.col("words") == 0) | (F.col("n") >= least))


def _packed(number: np.ndarray, known: np.ndarray, texts: list[bytes]) -> bytes:
    entries = np.stack([number, known]).astype(np.int64)
    return b"".join([np.int64(len(texts)).tobytes(), entries.tobytes(), b" . ".join(texts)])


class Unpacked:
    """The suffixes of a bucket, with words numbered anew."""

    def __init__(self, packed: pa.ChunkedArray, longest: int) -> None:
        decompressor = zstandard.ZstdDecompressor()
        numbers = Numbers({_END: 0})
        entries = [np.empty((2, 0), np.int64)]
        flat = array.array("q")
        for value in packed:
            data = decompressor.decompress(value.as_py())
            size = int(np.frombuffer(data, np.int64, 1)[0])
            end = 8 * (1 + 2 * size)
            entries.append(np.frombuffer(data[8:end], np.int64).reshape(2, size))
            flat.extend(map(numbers.__getitem__, data[end:].split(b" ")))
            flat.append(0)
        self.number, self.known = np.concatenate(entries, axis=1)
        self._names = list(numbers)
        tokens = np.array(flat, np.int64)
        ends = np.flatnonzero(tokens == 0)
        starts = np.append(0, ends + 1)[:len(ends)]
        self.ids = np.zeros((len(ends), longest), np.int64)
        at = np.repeat(np.arange(len(ends)), ends - starts)
        inside = np.flatnonzero(tokens)
        self.ids[at, inside - starts[at]] = tokens[inside]

    def phrase(self, place: int, size: int) -> bytes:
        return b" ".join(self._names[i] for i in self.ids[place, :size])


def _changes(rows: np.ndarray) -> np.ndarray:
    """Where rows differ from the one before."""
    return np.append(0, np.flatnonzero(np.any(rows[1:] != rows[:-1], axis=1)) + 1)


def _same_leads(ids: np.ndarray, chosen: np.ndarray, depth: int) -> Iterator[np.ndarray]:
    """The chosen suffixes in groups that agree in their first ``depth`` words."""
    if not depth or not len(chosen):
        yield chosen
        return
    order = chosen[np.lexsort(ids[chosen, :depth].T)]
    yield from np.split(order, _changes(ids[order, :depth])[1:])


def _with_count(cuts: DataFrame, phrases: DataFrame, side: str, name: str) -> DataFrame:
    """Add the count of the part ``side`` of each cut as ``name``."""
    if fits_broadcast(phrases):
        counts = phrases.select("lang", F.col("phrase").alias(side), F.col("n").alias(name))
        return cuts.join(F.broadcast(counts), ["lang", side])
    # A word that begins many candidates is a hot key.
    part = F.struct("lang", F.col(side).alias("phrase"))
    keyed = cuts.withColumn("_part", part)
    used = keyed.groupBy("_part").agg(F.count("*").alias("_used"))
    counts = phrases.select(F.struct("lang", "phrase").alias("_part"), F.col("n").alias(name))
    return lookup(keyed, stage(counts.join(used, "_part"), "parts"), "_part", "_used")


def _score(a: str, n: str, left: str, right: str) -> str:
    """``floor(1000 * a * n / (left * right))`` in exact decimals."""
    def exact(name: str) -> str:
        return f"cast({name} as decimal(19, 0))"

    return (f"cast(cast(1000 as decimal(4, 0)) * {exact(a)} as decimal(22, 0)) * cast({n} as decimal(16, 0)) "
            f"div ({exact(left)} * {exact(right)})")


def mine_phrases(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = LEAST,
                 longest: int = LONGEST, first: int = FIRST, **parameters: int) -> DataFrame:
    """The best phrases of each language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``,
    ``n``, ``score``, ``cut``.

    A phrase is 2 to ``longest`` contiguous words of a piece that occur ``a >= least`` times,
    overlaps included. Texts are cut into pieces at ``.,;:!?`` and line ends, words are what
    blanks and tabs part, with A-Z in lower case. The score is the least over the cuts of
    ``floor(1000 * a * n / (l * r))``, where ``l`` and ``r`` count the two parts and ``n`` all
    words; of equal cuts the earliest counts. A phrase within a longer one that is as frequent
    goes. The ``first`` of each language stay, by score, ``a`` and the phrase's bytes.

    Null and empty texts have no words, a null language is ``und``. Repeated rows count each.
    An empty table gives no rows. Other columns are not read, whatever their names. Texts are
    read whole; the suffixes of one text, with some 150 bytes each, are in a task's memory together.
    """
    counts = stage(phrase_counts(docs, text=text, lang=lang, least=least, longest=longest, **parameters), "phrases")
    phrases = counts.filter("words > 0").select("lang", "phrase", "words", "n")
    totals = counts.filter("words = 0").select("lang", F.col("n").alias("n"))
    split = F.split("phrase", " ")
    candidates = phrases.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), split.alias("w"))

    # Of a longer phrase with the same count, one word more is as frequent too.
    inner = candidates.filter("words > 2").select(
        "lang", F.col("a"), F.explode(F.array(
            F.array_join(F.expr("slice(w, 1, words - 1)"), " "),
            F.array_join(F.expr("slice(w, 2, words - 1)"), " "))).alias("phrase"))
    kept = candidates.join(inner, ["lang", "phrase", "a"], "left_anti")

    cuts = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "a", "cut", F.array_join(F.expr("slice(w, 1, cut)"), " ").alias("left"),
        F.array_join(F.expr("slice(w, cut + 1, words - cut)"), " ").alias("right"))

    counted = _with_count(_with_count(cuts, phrases, "left", "l"), phrases, "right", "r")
    if fits_broadcast(totals):  # a row per language
        totals = F.broadcast(totals)
    scored = (
        counted.join(totals, "lang").withColumn("score", F.expr(_score("a", "n", "l", "r")))
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
        .select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score", "best.cut")
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    ranked = Window.partitionBy("lang").orderBy(*order)
    # At most `first` rows of each salt meet in the task of a language.
    best = scored.withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= first)
    best = best.withColumn("rank", F.row_number().over(ranked).cast("long")).filter(F.col("rank") <= first)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut")
