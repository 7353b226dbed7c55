"""Packing token pieces into sequences, shortest pack first over the length histogram.

Documents are tokenised and cut at the sequence length. The lengths of the pieces are
one histogram, which has at most as many rows as a sequence has tokens. Lengths are
placed longest first, each into the open pack with the fewest tokens if it fits there;
packs of equal content are one pattern with a count. The pieces are then numbered within
their length and take the places of that length in the patterns by that number.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyframe.llm.common import partitions, releasing, small_batches, whole_text
from tallyframe.plans.staging import stage

SEQUENCE = 2048
END_ID = 1
# Longest run of letters or marks that goes to the quick encoder, whose work on one run
# grows with the square of its length.
LONGEST_RUN = 200
# Characters of a text that are encoded at a time, up to the next white space.
TOGETHER = 1 << 20

PIECES = "start long, length long, ids_crc32 long, doc_tokens long"

# Latin letters, digits and signs and the usual dashes and quotes: composed already, and
# their lower case does not depend on their neighbours.
_OTHER = re.compile("[^\x00-\u024f\u2010-\u2027]")
_WORDS_ASCII = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-z]+|[0-9]|[^\t-\r a-z0-9]+")
_WORDS = regex.compile(
    r"'(?:s|t|re|ve|m|ll|d)|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
# The splitting and cleaning rules of the files that the patterns above stand for.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_CLEANING = ["NFC", "Replace", "Lowercase"]
_WORD_END = "</w>"


def _byte_names() -> list[str]:
    """The character by which byte-level vocabularies write each byte."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def _merged(word: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """The parts of a word after all merges, the lowest rank first."""
    while len(word) > 1:
        rank, at = min((ranks.get(pair, len(ranks)), i) for i, pair in enumerate(zip(word, word[1:])))
        if rank == len(ranks):
            break
        word = [*word[:at], word[at] + word[at + 1], *word[at + 2:]]
    return word


@lru_cache(maxsize=4)
def word_ranks(content: str) -> tuple[dict[bytes, int], np.ndarray] | None:
    """Ranks of byte strings, and the id of each rank, that give a tokeniser file's ids.

    A word's bytes are followed by a space, whose merges with every byte come first and
    make the symbols that end a word. Merging by the rank of what comes out, instead of by
    pair, is the same when each entry is made by one merge and the merges of its own
    symbols end in it: then no other pair for it can occur. That is tried for every entry.
    None for a file of another kind, or one where that fails.
    """
    file = json.loads(content)
    model, split = file["model"], file.get("pre_tokenizer") or {}
    rules = split.get("pretokenizers", [{}])
    cleaning = [n.get("type") for n in (file.get("normalizer") or {}).get("normalizers", [])]
    fits = (
        model.get("type") == "BPE" and model.get("end_of_word_suffix") == _WORD_END
        and not any(model.get(k) for k in (
            "dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        and cleaning == _CLEANING and [r.get("type") for r in rules] == ["Split", "ByteLevel"]
        and rules[0].get("pattern") == {"Regex": _SPLIT} and rules[0].get("invert")
        and not rules[1].get("add_prefix_space") and not rules[1].get("use_regex")
    )
    if not fits:
        return None
    names, vocabulary = _byte_names(), model["vocab"]
    place = {name: b for b, name in enumerate(names)}
    merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    by_pair = {pair: i for i, pair in enumerate(merges)}
    ranks: dict[bytes, int] = {}
    ids: list[int] = []

    def add(entry: str) -> None:
        bare = entry.removesuffix(_WORD_END)
        ranks[bytes(place[c] for c in bare) + (b" " if bare != entry else b"")] = len(ids)
        ids.append(vocabulary[entry])

    for name in names:
        add(name + _WORD_END)
    for a, b in merges:
        bare = (a + b).removesuffix(_WORD_END)
        symbols = list(bare) if bare == a + b else [*bare[:-1], bare[-1] + _WORD_END]
        if _merged(symbols, by_pair) != [a + b]:
            return None
        add(a + b)
    for name in names:
        add(name)
    if len(ranks) != len(ids):
        return None
    return ranks, np.array(ids, "<u4")


class WordTokens:
    """Token ids of texts as little-endian bytes, by a quick encoder where it gives the same.

    The texts it does not take go to the tokeniser itself: those with characters whose
    cleaning depends on their neighbours, with what may be a special token, or with a very
    long word, and all texts when the file is of another kind.
    """

    def __init__(self, tokenizer: str, ranks: tuple[dict[bytes, int], np.ndarray] | None) -> None:
        self._content = tokenizer
        self._tokenizer: Tokenizer | None = None  # not before a text needs it, for its memory
        self._ids = ranks and ranks[1]
        self._quick = ranks and tiktoken.Encoding(
            "words", pat_str="[^ ]+ ", mergeable_ranks=ranks[0], special_tokens={})

    def __call__(self, text: str) -> bytes:
        if not self._quick or "<|" in text or _OTHER.search(text):
            return self._whole(text)
        pattern = _WORDS_ASCII if text.isascii() else _WORDS
        found = []
        at = 0
        while at < len(text):
            end = text.find(" ", at + TOGETHER)
            end = len(text) if end < 0 else end
            words = pattern.findall(text[at:end].lower())
            if words and max(map(len, words)) > LONGEST_RUN:
                return self._whole(text)
            if words:
                ranks = self._quick.encode_ordinary(" ".join(words) + " ")
                found.append(self._ids[ranks].tobytes())
            at = end
        return b"".join(found)

    def _whole(self, text: str) -> bytes:
        if self._tokenizer is None:
            self._tokenizer = Tokenizer.from_str(self._content)
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_WORD_TOKENS: dict[int, WordTokens] = {}  # of this Python worker, over its tasks


def token_pieces(docs: DataFrame, tokenizer: str, *, text: str = "text", doc_id: str = "doc_id",
                 length: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """One row per piece of at most ``length`` tokens, with the checksum of its ids.

    ``tokenizer`` is the path of a tokeniser file on the driver. A null text is empty: its
    document is the one id ``end_id``. Identifiers may be null or repeat.
    """
    content = Path(tokenizer).read_text(encoding="utf-8")
    ids = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))
    end = end_id.to_bytes(4, "little")
    ranks = word_ranks(content)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = zlib.crc32(content.encode())
        tokens = _WORD_TOKENS.get(key) or _WORD_TOKENS.setdefault(key, WordTokens(content, ranks))
        step = 4 * length
        for batch in batches:
            rows, out = [], ([], [], [], [])
            for i, value in enumerate(batch.column(1)):
                data = tokens(value.as_py()) + end
                for at in range(0, len(data), step):
                    piece = data[at:at + step]
                    rows.append(i)
                    for column, number in zip(out, (at // 4, len(piece) // 4, zlib.crc32(piece),
                                                    len(data) // 4), strict=True):
                        column.append(number)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())),
                 *(pa.array(c, pa.int64()) for c in out)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    kind = ids.schema["doc_id"].dataType.simpleString()
    return ids.mapInArrow(releasing(cut), f"doc_id {kind}, {PIECES}")


def stored_pieces(docs: DataFrame, tokenizer: str, **options: str | int) -> DataFrame:
    """``token_pieces`` for ``pack``, worked out from a few texts at a time."""
    with small_batches(docs.sparkSession):
        return stage(token_pieces(docs, tokenizer, **options), "pieces")


def shortest_pack_first(histogram: dict[int, int], length: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths with how often each occurs; every piece is in exactly one.

    Work and result grow with the number of distinct lengths, not with the counts.
    """
    packs: list[tuple[int, int, tuple[int, ...]]] = []  # tokens, tie, lengths
    counts: Counter[tuple[int, ...]] = Counter()
    tie = 0
    for size in sorted((n for n, c in histogram.items() if c > 0), reverse=True):
        left = histogram[size]
        changed = []
        while left and packs and packs[0][0] + size <= length:
            _, _, pack = heapq.heappop(packs)
            n = counts.pop(pack)
            used = min(n, left)
            changed.append(((*pack, size), used))
            if n > used:
                counts[pack] = n - used
                heapq.heappush(packs, (sum(pack), tie := tie + 1, pack))
            left -= used
            if left and not (packs and packs[0][0] + size <= length):
                # All open packs have one of this size: go on with those.
                for grown, times in changed:
                    if grown not in counts:
                        heapq.heappush(packs, (sum(grown), tie := tie + 1, grown))
                    counts[grown] += times
                changed = []
        for grown, times in changed:
            if grown not in counts:
                heapq.heappush(packs, (sum(grown), tie := tie + 1, grown))
            counts[grown] += times
        if left:
            # As many of this size as fit make up the new packs.
            each = length // size
            full, rest = divmod(left, each)
            for times, content in ((full, (size,) * each), (min(rest, 1), (size,) * rest)):
                if times:
                    if content not in counts:
                        heapq.heappush(packs, (sum(content), tie := tie + 1, content))
                    counts[content] += times
    return sorted(counts.items(), reverse=True)


_PLACES = "_length long, _first long, _until long, _sequence long, _offset long"


def _places(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """``_PLACES`` rows: pieces of a length with numbers from ``_first`` to before ``_until`` lie at
    one offset in sequences that follow each other."""
    places = []
    given: Counter[int] = Counter()
    sequence = 0
    for lengths, times in patterns:
        offset = 0
        for size in lengths:
            places.append((size, given[size], given[size] + times, sequence, offset))
            given[size] += times
            offset += size
        sequence += times
    return places


def pack(pieces: DataFrame, *, length: int = SEQUENCE, buckets: int | None = None) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored ``pieces`` of 1 to ``length`` tokens.

    Only the histogram, at most ``length`` rows, goes through the driver. A length that
    many pieces share is numbered in buckets, whose counts give each bucket its first
    number; patterns join back to the pieces by length and number. Pieces that are equal in
    all columns, of repeated documents, each get a place. No pieces give no rows.
    """
    buckets = buckets or max(16, partitions(pieces.sparkSession))
    dealt = pieces.withColumn(
        "_bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(buckets)).cast("int"))
    counts = stage(dealt.groupBy("length", "_bucket").agg(F.count("*").alias("_n")), "lengths")
    histogram = {r["length"]: r["n"]
                 for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    places = _places(shortest_pack_first(histogram, length))

    # At most `buckets` rows for each length.
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    numbered = (
        dealt.withColumn("_row", F.row_number().over(inside) - 1)
        .join(firsts, ["length", "_bucket"])
        .withColumn("_number", F.col("_before") + F.col("_row"))
        .drop("_bucket", "_before", "_row")
    )

    # Bounded by the lengths: some ten places for each of them, whatever the number of pieces.
    table = pieces.sparkSession.createDataFrame(places, _PLACES)
    here = ((F.col("length") == F.col("_length")) & (F.col("_number") >= F.col("_first"))
            & (F.col("_number") < F.col("_until")))
    sequence = F.col("_sequence") + F.col("_number") - F.col("_first")
    return numbered.join(F.broadcast(table), here).select(
        *pieces.columns, sequence.alias("sequence_id"), F.col("_offset").alias("offset"))
