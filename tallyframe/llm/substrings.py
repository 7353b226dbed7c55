"""Substring deduplication by super-k-mers: runs of windows that share a minimiser.

A window is a number of consecutive words of one document. Its minimiser is the least hash
of the shorter word runs in it; equal windows have equal minimisers. Consecutive windows
with one minimiser are a super-k-mer: their words travel once, as one packed string, to the
bucket of the minimiser, with the other super-k-mers that a task has for it in one
compressed row. A bucket sorts its windows by hash, compares equal hashes by their whole
words, and so knows for each window the smallest document that it starts in.

Every window that also starts in a smaller document goes back as a span of words, and the
spans of a document are cut out of its text.

Minimisers with a large share of all super-k-mers are found in a bounded sample. Their
windows are no bucket: they are rows of their own that Spark combines before the shuffle,
and that join back with hot windows broadcast (``plans.joins.lookup``).
"""

from __future__ import annotations

import array
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import as_rows, partitions, whole_text
from tallyframe.llm.words import Numbers, byte_spans, run_hashes, sliding_least, word_hashes
from tallyframe.plans.joins import fits_broadcast, lookup
from tallyframe.plans.staging import stage

WINDOW = 13
MINIMISER = 3  # words of the runs whose least hash is the minimiser
CHUNK = 4 << 20  # bytes of text that a task cuts into super-k-mers at a time
BUCKET_BYTES = 8 << 20  # of text, so some three times as much packed
BUCKETS = 4  # for each shuffle partition, at least
SPAN_BYTES = 2 << 20  # of all spans, up to which they are broadcast to the texts
LEVEL = 3
LONGEST = 256  # windows of one packed string
# Super-k-mers sampled for each shuffle partition; a minimiser is hot from a quarter of a
# mean partition, so at most four are for each partition.
SAMPLED = 200

_NO_ID = (1 << 63) - 1  # a missing identifier is the largest
_SPACE = re.compile(rb"[ \t-\r]")

SPAN = "_id long, _hash long, start long, end long"


@dataclass(frozen=True)
class Stretch:
    """Words of a document from its word ``base`` on."""

    doc: int
    key: int
    base: int
    words: list[bytes]


def stretches(doc: int, key: int, text: bytes, window: int) -> Iterator[Stretch]:
    """A text cut so that each window starts in exactly one stretch."""
    at = base = 0
    carried: list[bytes] = []
    while at < len(text):
        end = len(text)
        if end - at > CHUNK:
            space = _SPACE.search(text, at + CHUNK)
            end = space.start() if space else end
        words = carried + text[at:end].split()
        yield Stretch(doc, key, base, words)
        carried = words[max(len(words) - window + 1, 0):]
        base += len(words) - len(carried)
        at = end


class SuperKmers:
    """The super-k-mers of some stretches: arrays of one entry each."""

    def __init__(self, held: list[Stretch], window: int, minimiser: int) -> None:
        self._words = [word for stretch in held for word in stretch.words]
        sizes = np.array([len(stretch.words) for stretch in held], np.int64)
        firsts = np.cumsum(sizes) - sizes
        runs = run_hashes(word_hashes(self._words), minimiser)
        least = sliding_least(runs, window - minimiser + 1)
        owner = np.repeat(np.arange(len(held)), sizes)[:len(least)]
        places = np.flatnonzero(np.arange(len(least)) + window <= (firsts + sizes)[owner])
        least, owner = least[places], owner[places]
        new = np.ones(len(places), bool)
        new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
        run = np.cumsum(new) - 1
        new |= (places - places[new][run]) % LONGEST == 0
        starts = np.flatnonzero(new)
        self.minimiser = least[starts]
        self.first = places[starts]
        self.windows = np.diff(np.append(starts, len(places)))
        self.size = self.windows + window - 1
        at = owner[starts]
        self.doc = np.array([stretch.doc for stretch in held], np.int64)[at]
        self.key = np.array([stretch.key for stretch in held], np.int64)[at]
        base = np.array([stretch.base for stretch in held], np.int64)
        self.start = base[at] + self.first - firsts[at]

    def __len__(self) -> int:
        return len(self.first)

    def packed(self, chosen: np.ndarray, windows: int | None = None) -> list[bytes]:
        """The words of the chosen super-k-mers, or of ``windows`` words from places on."""
        content = b" ".join(self._words)
        begin, end = byte_spans(self._words)
        first = self.first[chosen] if windows is None else chosen
        last = first + (self.size[chosen] if windows is None else windows) - 1
        return [content[a:b] for a, b in zip(begin[first].tolist(), end[last].tolist(), strict=True)]


def _chunks(batches: Iterator[pa.RecordBatch], window: int, minimiser: int) -> Iterator[SuperKmers]:
    """Of batches of ``_id``, ``_hash`` and text."""
    held: list[Stretch] = []
    size = 0
    for batch in batches:
        columns = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
        for doc, key, text in zip(*columns, strict=True):
            data = text.as_py()
            for stretch in stretches(doc, key, data, window):
                if len(stretch.words) < window:
                    continue
                held.append(stretch)
                size += min(len(data), CHUNK)
                if size >= CHUNK:
                    yield SuperKmers(held, window, minimiser)
                    held, size = [], 0
    if held:
        yield SuperKmers(held, window, minimiser)


def pack(kmers: SuperKmers, chosen: np.ndarray, texts: list[bytes]) -> bytes:
    # In order of the documents, so that differences are small.
    numbers = np.stack([np.diff(kmers.doc[chosen], prepend=0), kmers.key[chosen],
                        kmers.start[chosen], kmers.size[chosen]])
    return b"".join([np.int64(len(chosen)).tobytes(), numbers.tobytes(), b" ".join(texts)])


def unpack(data: bytes) -> tuple[np.ndarray, bytes]:
    """Identifiers, keys, starts and sizes as four rows, and the words."""
    count = int(np.frombuffer(data, np.int64, 1)[0])
    end = 8 * (1 + 4 * count)
    numbers = np.frombuffer(data[8:end], np.int64).reshape(4, count).copy()
    numbers[0] = np.cumsum(numbers[0])
    return numbers, data[end:]


def _is_hot(values: np.ndarray, hot: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(values), bool)
    return hot[np.searchsorted(hot, values) % len(hot)] == values


def repeated_windows(numbers: np.ndarray, ids: np.ndarray, hashes: np.ndarray, window: int) -> np.ndarray:
    """Spans of the windows that also start in a smaller document, as rows of ``SPAN``.

    ``numbers`` has four rows as ``unpack`` gives them. ``ids`` are all words in their order,
    the same number for the same word, and ``hashes`` those of the words by number.
    """
    doc, key, start, size = numbers
    firsts = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(size)), size)
    hashed = run_hashes(hashes[ids], window)
    places = np.flatnonzero(np.arange(len(hashed)) + window <= (firsts + size)[owner[:len(hashed)]])
    order = places[np.argsort(hashed[places], kind="stable")]
    ordered = hashed[order]
    same = ordered[1:] == ordered[:-1]
    several = np.append(same, False) | np.append(False, same)
    order, ordered = order[several], ordered[several]
    if not len(order):
        return np.empty((4, 0), np.int64)
    new = np.append(True, ordered[1:] != ordered[:-1])
    unequal = np.zeros(len(order), bool)
    for i in range(window):
        word = ids[order + i]
        unequal[1:] |= word[1:] != word[:-1]
    if (unequal & ~new).any():  # two windows with one hash
        words = [tuple(ids[place:place + window].tolist()) for place in order]
        by_words = sorted(range(len(order)), key=lambda i: (ordered[i], words[i]))
        order = order[by_words]
        new = np.append(True, [words[a] != words[b] for a, b in zip(by_words, by_words[1:], strict=False)])
    groups = np.flatnonzero(new)
    least = np.minimum.reduceat(doc[owner[order]], groups)
    later = doc[owner[order]] > least[np.cumsum(new) - 1]
    found = np.sort(order[later])
    if not len(found):
        return np.empty((4, 0), np.int64)
    # Neighbouring windows are one span; super-k-mers are apart by the words that end them.
    breaks = np.append(True, np.diff(found) != 1)
    low = found[breaks]
    high = found[np.append(breaks[1:], True)]
    at = owner[low]
    return np.stack([doc[at], key[at], start[at] + low - firsts[at],
                     start[at] + high - firsts[at] + window])


def _hot_minimisers(keyed: DataFrame, text_bytes: int, window: int, minimiser: int,
                    sampled: int, seed: int) -> np.ndarray:
    """Sorted; at most four for each shuffle partition."""
    parts = partitions(keyed.sparkSession)
    # Words have some six bytes, super-k-mers half as many windows as their minimisers' span.
    expected = text_bytes / 6 / ((window - minimiser + 2) / 2)
    if not expected:
        return np.empty(0, np.uint64)
    share = min(1.0, sampled * parts / expected)

    def minimisers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kmers in _chunks(batches, window, minimiser):
            yield pa.RecordBatch.from_arrays([pa.array(kmers.minimiser.view(np.int64))], ["m"])

    least = max(sampled / 4, share * expected / parts / 4)
    counts = keyed.sample(share, seed=seed).mapInArrow(minimisers, "m long").groupBy("m").count()
    hot = [row["m"] for row in counts.filter(F.col("count") > least).collect()]
    return np.sort(np.array(hot, np.int64).view(np.uint64))


def _cold_spans(keyed: DataFrame, hot: np.ndarray, buckets: int, window: int, minimiser: int) -> DataFrame:
    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for kmers in _chunks(batches, window, minimiser):
            bucket = (kmers.minimiser % np.uint64(buckets)).astype(np.int64)
            chosen = np.flatnonzero(~_is_hot(kmers.minimiser, hot))
            chosen = chosen[np.argsort(bucket[chosen], kind="stable")]
            texts = kmers.packed(chosen)
            names, firsts = np.unique(bucket[chosen], return_index=True)
            ends = np.append(firsts[1:], len(chosen))[:len(firsts)]
            rows = [compressor.compress(pack(kmers, chosen[a:b], texts[a:b]))
                    for a, b in zip(firsts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(rows, pa.binary())], ["bucket", "packed"])

    def sorted_out(table: pa.Table) -> pa.Table:
        decompressor = zstandard.ZstdDecompressor()
        numbers, vocabulary, ids = [], Numbers(), array.array("q")
        for data in table.column("packed"):
            entries, text = unpack(decompressor.decompress(data.as_py()))
            numbers.append(entries)
            ids.extend(map(vocabulary.__getitem__, text.split(b" ")))
        spans = repeated_windows(np.concatenate(numbers, axis=1), np.frombuffer(ids, np.int64),
                                 word_hashes(list(vocabulary)), window)
        return pa.table([pa.array(row) for row in spans], names=["_id", "_hash", "start", "end"])

    return keyed.mapInArrow(dealt, "bucket long, packed binary").groupBy("bucket").applyInArrow(sorted_out, SPAN)


def _hot_spans(keyed: DataFrame, hot: np.ndarray, window: int, minimiser: int) -> DataFrame:
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kmers in _chunks(batches, window, minimiser):
            chosen = np.flatnonzero(_is_hot(kmers.minimiser, hot))
            of = np.repeat(chosen, kmers.windows[chosen])
            firsts = np.cumsum(kmers.windows[chosen]) - kmers.windows[chosen]
            step = np.arange(len(of)) - np.repeat(firsts, kmers.windows[chosen])
            texts = kmers.packed(kmers.first[of] + step, window)
            for low in range(0, len(of), 10_000):
                part = slice(low, low + 10_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kmers.doc[of[part]]), pa.array(kmers.key[of[part]]),
                     pa.array(kmers.start[of[part]] + step[part]), pa.array(texts[part], pa.binary())],
                    ["_id", "_hash", "start", "words"])

    rows = keyed.mapInArrow(windows, "_id long, _hash long, start long, words binary")
    several = rows.groupBy("words").agg(F.min("_id").alias("least"), F.max("_id").alias("most"),
                                        F.count("*").alias("n"))
    several = stage(several.filter("least < most").drop("most"), "hot-windows")
    found = lookup(rows, several, "words", "n").filter("_id > least")
    return found.select("_id", "_hash", "start", (F.col("start") + window).alias("end"))


def _cut(text: Column, spans: Column) -> Column:
    @F.arrow_udf("n_words long, n_removed long, kept string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        sizes, removed, kept = [], [], []
        for text, found in zip(texts, spans, strict=True):
            words = text.as_py().split()
            sizes.append(len(words))
            if found.is_valid:
                stay, at = [], 0
                for span in sorted((s["start"], s["end"]) for s in found.as_py()):
                    if span[0] > at:
                        stay += words[at:span[0]]
                    at = max(at, span[1])
                words = stay + words[at:]
            removed.append(sizes[-1] - len(words))
            kept.append(b" ".join(words))
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(kept, pa.binary()).cast(pa.string())], ["n_words", "n_removed", "kept"])

    return cut(text, spans)


def dedup_substrings(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id",
                     window: int = WINDOW, minimiser: int = MINIMISER, sampled: int = SAMPLED,
                     bucket_bytes: int = BUCKET_BYTES, seed: int = 5) -> DataFrame:
    """One row per document: ``row``, ``n_words``, ``n_removed``, ``kept``.

    A word is removed when a window of ``window`` words covers it whose words, in their
    order, also start in a document with a smaller identifier; all windows are those of the
    input. ``kept`` are the other words, joined by one space. Words are runs of characters
    other than the six ASCII spaces, unchanged. Null and empty texts have no words; texts
    with fewer words than a window lose none.

    Identifiers are integers. Documents with one identifier, repeated rows among them, never
    remove from each other, but all of them lose what a smaller one has. A missing
    identifier is larger than all others. An empty table gives no rows. Texts of any length
    are read whole, in stretches of bounded size that overlap.
    """
    spark = docs.sparkSession
    whole = whole_text(f"row.{text}")
    rows = as_rows(docs).select(
        "row", F.coalesce(F.col(f"row.{doc_id}").cast("long"), F.lit(_NO_ID)).alias("_id"),
        whole.cast("binary").alias("_text"))
    text_bytes = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    # Rows that agree in identifier and text also agree in what they lose. Where no identifier
    # repeats, the text need not tell rows apart, and no hash of it travels.
    repeats = not rows.groupBy("_id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
    rows = rows.withColumn("_hash", F.xxhash64(whole) if repeats else F.lit(0).cast("long"))
    keyed = rows.select("_id", "_hash", "_text")
    hot = _hot_minimisers(keyed, text_bytes, window, minimiser, sampled, seed)
    buckets = max(BUCKETS * partitions(spark), math.ceil(text_bytes / bucket_bytes))
    spans = _cold_spans(keyed, hot, buckets, window, minimiser)
    if len(hot):
        spans = spans.unionByName(_hot_spans(keyed, hot, window, minimiser))
    per_doc = stage(spans.groupBy("_id", "_hash").agg(
        F.collect_list(F.struct("start", "end")).alias("_spans")), "spans")
    if fits_broadcast(per_doc, max_bytes=SPAN_BYTES):
        per_doc = F.broadcast(per_doc)
    cut = rows.join(per_doc, ["_id", "_hash"], "left").select(
        "row", _cut(F.col("_text"), F.col("_spans")).alias("_cut"))
    return cut.select("row", "_cut.n_words", "_cut.n_removed", "_cut.kept")
