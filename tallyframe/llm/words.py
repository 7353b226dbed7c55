"""Hashes of words and of runs of words, for the operators that deal such runs out."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import xxhash

_U = np.uint64


class Numbers(dict):
    """Numbers for what is asked, in order of the first time."""

    def __missing__(self, name: bytes) -> int:
        self[name] = number = len(self)
        return number


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def word_hashes(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), _U, len(words))


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash for every run of ``length`` neighbours."""
    size = max(len(hashes) - length + 1, 0)
    total = np.zeros(size, _U)
    for i in range(length):
        total += hashes[i:i + size] * _U(pow(0x165667B19E3779F9, i + 1, 1 << 64))
    return mixed(total)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    have = 1
    while have < width:
        shift = min(have, width - have)
        if len(values) <= shift:
            return values[:0]
        values = np.minimum(values[:-shift], values[shift:])
        have += shift
    return values


def byte_spans(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts and ends in the words joined by one byte."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    return ends - lengths, ends
