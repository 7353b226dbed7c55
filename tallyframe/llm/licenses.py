"""License scan: rare words pick templates and windows, alignment measures them.

A match may miss ``missing`` words of a template, so it holds at least one of any
``missing + 1`` of its places. The places with the rarest words are an inverted index from
word to template and place. A document's words that are in the index vote for a template on
a diagonal (place in the document minus place in the template). Around it the words are
aligned with the template, in a window that reaches beyond it on both sides, and the matched
words give coverage and span. Whole licenses, with hundreds of places to choose, are looked
for where enough of their rarer words stand close together. What a window holds beside a match is aligned again, so copies
that follow each other are all found. So no match is lost to the search, whichever words
are changed, missing or put in between, as far as its window reaches.
"""

from __future__ import annotations

import bisect
import heapq
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from importlib import resources

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import whole_text

MIN_COVERAGE = 0.7
# So many words at least may be put in, or a longer template's missing ones be left out.
BAND = 6
MEMO_WORDS = 1_000_000

# Up to this length a template is searched by its rarest words, beyond by their density.
NOTICE_WORDS = 64

# Notices by which common licenses are stated.
NOTICES: dict[str, str] = {
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, "
                "are permitted provided that the following conditions are met",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-text": "This program is free software: you can redistribute it and/or modify it under the "
                "terms of the GNU General Public License as published by the Free Software Foundation",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
                "software and associated documentation files, to deal in the software without restriction",
    "MPL-2.0": "This work is subject to the terms of the Mozilla Public License, version 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def whole_licenses() -> dict[str, str]:
    """The license texts of this package, by identifier and ``-full``."""
    folder = resources.files("tallyframe.llm").joinpath("license_texts")
    return {f.name.removesuffix(".txt") + "-full": f.read_text(encoding="utf-8")
            for f in folder.iterdir() if f.name.endswith(".txt")}


TEMPLATES: dict[str, str] = {**NOTICES, **whole_licenses()}

_EDGE = re.compile(r"^[^0-9a-z]+|[^0-9a-z]+$")
_CHUNK = re.compile(r"[^\x20\x09-\x0D]+")


def _word(chunk: bytes) -> int:
    """Hash of a word in lower case without marks at its ends; a chunk of marks alone is itself."""
    word = chunk.decode("utf-8", "surrogatepass")
    return xxhash.xxh3_64_intdigest((_EDGE.sub("", word) or word).encode("utf-8", "surrogatepass"))


class _Words:
    def __init__(self) -> None:
        self._known: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        found = text.encode("utf-8", "surrogatepass").lower().split()
        missing = set(found).difference(self._known)
        if missing:
            if len(self._known) + len(missing) > MEMO_WORDS:
                self._known = {}
                missing = set(found)
            self._known.update((w, _word(w)) for w in missing)
        return np.fromiter(map(self._known.__getitem__, found), np.uint64, len(found))


_WORDS = _Words()  # of this Python worker, over its tasks


# Frequent words of English prose, taken as places of the index last.
_COMMON = frozenset("""
    a all also an and any are as at be but by can do each following for free from general has have
    if in including is it its made may met must new no not of on only or other public such than
    that the their this these to under use used was which will with within without work works you your
""".split())


@dataclass(frozen=True)
class Match:
    license: str
    first: int  # words of the document, the end exclusive
    last: int
    matched: int
    words: int

    @property
    def coverage(self) -> float:
        return self.matched / self.words


class _Template:
    def __init__(self, name: str, text: str, words: np.ndarray) -> None:
        self.name, self.words = name, words
        # In lower case without marks, as hashed.
        self.plain = [_EDGE.sub("", w) or w for w in text.lower().split()]
        self.least = math.ceil(MIN_COVERAGE * len(words) - 1e-9)
        self.missing = len(words) - self.least
        self.band = max(BAND, self.missing + 1)
        self._masks: tuple[dict[int, int], dict[int, int]] | None = None

    def masks(self) -> tuple[dict[int, int], dict[int, int]]:
        """The places of each word as bits, from the start and from the end."""
        if self._masks is None:
            there: dict[int, int] = defaultdict(int)
            back: dict[int, int] = defaultdict(int)
            for i, word in enumerate(self.words.tolist()):
                there[word] |= 1 << i
                back[word] |= 1 << (len(self.words) - 1 - i)
            self._masks = dict(there), dict(back)
        return self._masks

    def align(self, words: list[int], lo: int, hi: int) -> Match | None:
        """Longest common subsequence with the words from ``lo`` to ``hi``: the first end at
        which it is reached, and the last start for that end."""
        there, back = self.masks()
        matched, last = self._longest(there, words[lo:hi])
        if matched < self.least:
            return None
        last += lo
        _, first = self._longest(back, words[lo:last + 1][::-1])
        return Match(self.name, last - first, last + 1, matched, len(self.words))

    def _longest(self, masks: dict[int, int], words: list[int]) -> tuple[int, int]:
        """Length, and the place at which it is reached. A row of the table is one number,
        whose bits are 0 where the length grows along the template."""
        full = (1 << len(self.words)) - 1
        row, zeros, at = full, 0, -1
        for place, word in enumerate(words):
            mask = masks.get(word)
            if mask:
                both = row & mask
                row = ((row + both) | (row - both)) & full
                now = len(self.words) - row.bit_count()
                if now > zeros:
                    zeros, at = now, place
        return zeros, at


class Scanner:
    """Templates with their inverted index, small enough to go to every task."""

    def __init__(self, templates: Mapping[str, str]) -> None:
        known = _Words()
        self._templates = [_Template(n, templates[n], known(templates[n])) for n in sorted(templates)]
        used = Counter(w for t in self._templates for w in set(t.plain))
        index: dict[int, list[tuple[int, int]]] = defaultdict(list)
        long: dict[int, set[int]] = {}
        for number, t in enumerate(self._templates):
            rare = sorted(range(len(t.words)), key=lambda i: (
                t.plain[i] in _COMMON, used[t.plain[i]], -len(t.plain[i]), i))
            if len(t.words) > NOTICE_WORDS:
                # Of so many places a match misses less than half.
                long[number] = {int(t.words[place]) for place in rare[:2 * t.missing + 1]}
            else:
                for place in rare[:t.missing + 1]:
                    index[int(t.words[place])].append((number, place))
        self._index = dict(index)
        self._keys = np.array(sorted(index), np.uint64)
        self._long = list(long)
        self._long_keys = np.array(sorted(set().union(*long.values())), np.uint64)
        self._in_long = np.array([[k in long[n] for k in self._long_keys.tolist()] for n in long], bool)
        self._needed = np.array([self._templates[n].missing + 1 for n in long], np.int64)
        self._least = np.array([self._templates[n].least for n in long], np.int64)

    def scan(self, words: np.ndarray) -> list[Match]:
        """Matches that do not overlap: most matched words first, then coverage, then name."""
        if not len(words):
            return []
        windows = self._notice_windows(words) | self._long_windows(words)
        return self._best(words.tolist(), windows) if windows else []

    def _notice_windows(self, words: np.ndarray) -> set[tuple[int, int, int]]:
        """Templates with the bounds within which a match may lie."""
        windows: set[tuple[int, int, int]] = set()
        if not len(self._keys):
            return windows
        at = np.minimum(np.searchsorted(self._keys, words), len(self._keys) - 1)
        for place in np.flatnonzero(self._keys[at] == words).tolist():
            for number, origin in self._index[int(words[place])]:
                t = self._templates[number]
                start = place - origin
                windows.add((number, max(0, start - t.band), min(len(words), start + len(t.words) + t.band)))
        return windows

    def _long_windows(self, words: np.ndarray) -> set[tuple[int, int, int]]:
        """The same for long templates: windows in steps of the band that hold enough of
        the template's rarer words for a match."""
        windows: set[tuple[int, int, int]] = set()
        if not self._long or len(words) < self._least.min():
            return windows
        at = np.minimum(np.searchsorted(self._long_keys, words), len(self._long_keys) - 1)
        known = self._long_keys[at] == words
        counts = self._in_long @ np.bincount(at[known], minlength=len(self._long_keys))
        for i in np.flatnonzero((counts >= self._needed) & (self._least <= len(words))).tolist():
            t = self._templates[self._long[i]]
            before = np.concatenate(([0], np.cumsum(self._in_long[i][at] & known)))
            lo = np.arange(0, len(words), t.band)
            hi = np.minimum(len(words), lo + len(t.words) + 2 * t.band)
            enough = before[hi] - before[lo] >= self._needed[i]
            windows.update((self._long[i], int(a), int(b)) for a, b in zip(lo[enough], hi[enough], strict=True))
        return windows

    def _best(self, words: list[int], windows: set[tuple[int, int, int]]) -> list[Match]:
        queue: list[tuple[int, float, str, int, int, int, int, int]] = []
        done = set()

        def align(number: int, lo: int, hi: int) -> None:
            t = self._templates[number]
            if hi - lo < t.least or (number, lo, hi) in done:
                return
            done.add((number, lo, hi))
            m = t.align(words, lo, hi)
            if m:
                heapq.heappush(queue, (-m.matched, -m.coverage, m.license, m.first, m.last, number, lo, hi))

        for number, lo, hi in windows:
            align(number, lo, hi)
        kept: list[Match] = []
        while queue:
            matched, _, name, first, last, number, lo, hi = heapq.heappop(queue)
            # Those kept do not overlap, so of those that begin before the end the last one tells.
            i = bisect.bisect_left(kept, last, key=lambda m: m.first)
            if i and kept[i - 1].last > first:
                over = kept[i - 1]
            else:
                over = Match(name, first, last, -matched, len(self._templates[number].words))
                kept.insert(i, over)
            # What the window holds beside the better match.
            align(number, lo, min(hi, over.first))
            align(number, max(lo, over.last), hi)
        return kept


def scan_licenses(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id",
                  templates: Mapping[str, str] = TEMPLATES) -> DataFrame:
    """One row per match: ``doc_id``, ``license``, ``start``, ``end``, ``matched_words``,
    ``template_words``, ``coverage``.

    The span is in code points, its end exclusive. Of matches that overlap the one with most
    matched words stays. Whole texts are read; null, empty and unmatched texts have no rows,
    repeated rows have theirs each. The number and length of templates bound what goes to a
    task.
    """
    scanner = Scanner(templates)
    ids = docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text"))
    kind = ids.schema["doc_id"].dataType.simpleString()

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[int] = []
            out: list[tuple] = []
            for i, value in enumerate(batch.column(1)):
                body = value.as_py()
                matches = scanner.scan(_WORDS(body))
                if matches:
                    spans = [m.span() for m in _CHUNK.finditer(body)]
                    for m in matches:
                        rows.append(i)
                        out.append((m.license, spans[m.first][0], spans[m.last - 1][1], m.matched,
                                    m.words, m.coverage))
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())),
                 *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["doc_id", "license", "start", "end", "matched_words", "template_words", "coverage"])

    return ids.mapInArrow(
        scanned, f"doc_id {kind}, license string, start long, end long, matched_words long, "
                 "template_words long, coverage double")
