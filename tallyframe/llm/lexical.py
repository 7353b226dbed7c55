"""Ranked lexical search, term-at-a-time over short lists and document-at-a-time over long ones.

One pass over the texts writes an index of the query terms: a row per document with its
length and, for each query term in it, the occurrences. Counts over all documents come from
the index. The second job reads the index in segments of documents. In a segment every query
sums its short posting lists into accumulators first (term at a time). The accumulators then
act as one more list with a bound for each block of documents, next to the long lists: the
blocks are visited in document order, and a block whose bounds together stay below the
query's tenth best score is skipped (document at a time). The best of all segments meet in
one window, which gets ``k`` rows of each query and task.

Queries are dealt out in blocks of bounded size; each block is one such pair of jobs over
all documents. All sums are 64-bit integers, so a score does not depend on the order.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import whole_text
from tallyframe.plans.staging import stage

# Bytes of query text that go to every task at a time; more queries are more blocks.
QUERY_BYTES = 8 << 20
BLOCK = 64  # documents that are skipped or scored together
SHORT = 16  # a list is short when it holds at most one document in so many

_TERM_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256))

_NO_ID = -1 << 63  # behind all negated identifiers

INDEX = "doc_id long, n long, terms array<int>, tfs array<int>"


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits, and of any characters beyond ASCII; A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


@dataclass(frozen=True)
class Query:
    """Terms of one query, by their numbers, with how often it has them."""

    terms: tuple[int, ...]
    repeats: tuple[int, ...]


@dataclass(frozen=True)
class Corpus:
    """What scores need of all documents: documents and terms in them, and a weight per term."""

    documents: int
    length: int
    weights: tuple[int, ...]


def _numbered_queries(texts: list[str | None]) -> tuple[dict[bytes, int], list[Query]]:
    numbers: dict[bytes, int] = {}
    queries = []
    for text in texts:
        counts = Counter(terms_of(text))
        queries.append(Query(tuple(numbers.setdefault(t, len(numbers)) for t in counts),
                             tuple(counts.values())))
    return numbers, queries


def _index(docs: DataFrame, text: str, doc_id: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """``INDEX`` of the documents that have a term, query terms or not."""

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for batch in batches:
            ids, lengths, sizes, numbers, tfs = [], [], [0], [], []
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = terms_of(value.as_py())
                if not found:
                    continue
                counts = Counter(found)
                for term in counts.keys() & known:
                    numbers.append(vocabulary[term])
                    tfs.append(counts[term])
                ids.append(name)
                lengths.append(len(found))
                sizes.append(len(numbers))
            offsets = pa.array(sizes, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(numbers, pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32()))],
                ["doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col(doc_id).cast("long").alias("id"), whole_text(text).alias("text"))
    return rows.mapInArrow(indexed, INDEX)


def _corpus(index: DataFrame, vocabulary: int) -> Corpus:
    total = index.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    # As many rows as the block of queries has terms.
    having = dict(index.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
    n = total["documents"]
    weights = tuple(
        math.floor(1000 * math.log((2 * n + 2) / (2 * having.get(t, 0) + 1))) for t in range(vocabulary))
    return Corpus(n, total["length"], weights)


class Segment:
    """Postings of the query terms in some documents, with bounds by blocks."""

    def __init__(self, batch: pa.RecordBatch, corpus: Corpus) -> None:
        ids, n, terms, tfs = (batch.column(name) for name in ("doc_id", "n", "terms", "tfs"))
        self.size = len(ids)
        self.ids = ids.to_pylist()
        self.blocks = -(-self.size // BLOCK)
        places = np.repeat(np.arange(self.size), terms.value_lengths().to_numpy())
        numbers = terms.flatten().to_numpy()
        tf = tfs.flatten().to_numpy().astype(np.int64)
        measure = 25 + 75 * n.to_numpy() * corpus.documents // max(corpus.length, 1)
        impact = 1_000_000_000 * tf // (1000 * tf + 8 * measure[places])
        order = np.argsort(numbers, kind="stable")
        numbers, self._places, self._impact = numbers[order], places[order], impact[order]
        held, starts = np.unique(numbers, return_index=True)
        ends = np.append(starts[1:], len(numbers))[:len(starts)]
        self._range = {int(t): (int(a), int(b)) for t, a, b in zip(held, starts, ends, strict=True)}
        self._weights = corpus.weights
        self._long: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _list(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        start, end = self._range[term]
        return self._places[start:end], self._impact[start:end]

    def _spread(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """A long list by document, and its bound for each block."""
        if term not in self._long:
            places, impact = self._list(term)
            dense = np.zeros(self.blocks * BLOCK, np.int64)
            dense[places] = impact
            self._long[term] = dense, dense.reshape(-1, BLOCK).max(axis=1)
        return self._long[term]

    def search(self, query: Query, k: int, best: list[tuple[int, int]]) -> None:
        """Raise ``best``, a heap of ``(score, -doc_id)``, by the documents here."""
        short, long = [], []
        for term, times in zip(query.terms, query.repeats, strict=True):
            factor = times * self._weights[term]
            if factor and term in self._range:
                start, end = self._range[term]
                (short if (end - start) * SHORT <= self.size else long).append((term, factor))
        if not short and not long:
            return
        sums = np.zeros(self.blocks * BLOCK, np.int64)
        for term, factor in short:  # term at a time
            places, impact = self._list(term)
            sums[places] += factor * impact
        bound = sums.reshape(-1, BLOCK).max(axis=1)
        least = 1
        if len(best) == k:
            least = best[0][0]
        if self.size > k:
            # A document's sum so far is below its score, so k documents reach the k-th sum.
            least = max(least, int(np.partition(sums, -k)[-k]))
        lists = []
        for term, factor in long:
            dense, most = self._spread(term)
            lists.append((dense, factor))
            bound = bound + factor * most
        for block in np.flatnonzero(bound >= least).tolist():  # document at a time
            if bound[block] < least:
                continue
            here = slice(block * BLOCK, (block + 1) * BLOCK)
            scores = sums[here].copy()
            for dense, factor in lists:
                scores += factor * dense[here]
            for place in np.flatnonzero(scores >= least).tolist():
                name = self.ids[block * BLOCK + place]
                entry = (int(scores[place]), _NO_ID if name is None else -name)
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == k:
                least = max(least, best[0][0])


def _best(index: DataFrame, queries: list[Query], corpus: Corpus, k: int) -> DataFrame:
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in queries]
        for batch in batches:
            if batch.num_rows:
                segment = Segment(batch, corpus)
                for query, found in zip(queries, best, strict=True):
                    segment.search(query, k, found)
        rows = [(place, None if name == _NO_ID else -name, score)
                for place, found in enumerate(best) for score, name in found]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()),
             pa.array(columns[2], pa.int64())], ["_place", "doc_id", "score"])

    found = index.mapInArrow(searched, "_place int, doc_id long, score long")
    first = Window.partitionBy("_place").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)


def search(docs: DataFrame, queries: DataFrame, *, text: str = "text", doc_id: str = "doc_id",
           query_text: str = "text", item_id: str = "item_id", k: int = 10,
           query_bytes: int = QUERY_BYTES) -> DataFrame:
    """The ``k`` best documents of every query: ``item_id``, ``rank``, ``doc_id``, ``score``.

    Only documents with a score above 0 are ranked, equal scores by ascending identifier, a
    null one last. Identifiers are integers. A null or empty text has no terms, neither as
    document nor as query, and counts nowhere. Repeated documents are ranked each for itself,
    repeated queries get a list each. Empty tables give no rows. Texts are read whole, of any
    length. Other columns are not read, whatever their names.

    The queries are cut into blocks of about ``query_bytes`` of text by a hash.
    """
    spark = docs.sparkSession
    asked = stage(queries.select(F.col(item_id).alias("item_id"), whole_text(query_text).alias("text")), "queries")
    held = asked.agg(F.sum(F.octet_length("text") + 16).alias("bytes")).first()["bytes"] or 0
    blocks = max(1, math.ceil(held / query_bytes))
    results = []
    for block in range(blocks):
        part = asked if blocks == 1 else asked.filter(
            F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        items = part.collect()  # about `query_bytes`
        vocabulary, terms = _numbered_queries([item["text"] for item in items])
        index = stage(_index(docs, text, doc_id, vocabulary), "lexical")
        best = _best(index, terms, _corpus(index, len(vocabulary)), k)
        names = spark.createDataFrame(
            [(place, item["item_id"]) for place, item in enumerate(items)],
            f"_place int, item_id {asked.schema['item_id'].dataType.simpleString()}")
        results.append(best.join(F.broadcast(names), "_place").select("item_id", "rank", "doc_id", "score"))
    whole = results[0]
    for result in results[1:]:
        whole = whole.unionByName(result)
    return whole
