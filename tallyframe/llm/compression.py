"""Quality score from compressed sizes.

Two zstandard dictionaries are built, one from good and one from bad labelled texts.
A text that compresses better with the good one is more like the good ones: the
difference of the two sizes, over the size without a dictionary, and the three sizes
over the length, go through a logistic curve that is fitted on labelled texts which
the dictionaries have not seen.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import whole_text

# Bound of the labelled sample: rows of each class, and the longest text in it.
TRAIN_ROWS = 3000
TRAIN_CHARS = 32_768
DICT_BYTES = 65_536
LEVEL = 3
CHUNK = 4096


@dataclass(frozen=True)
class Model:
    """Two dictionaries and a logistic curve; ``prior`` alone where a class has no texts."""

    good: bytes = b""
    bad: bytes = b""
    weights: tuple[float, ...] = ()
    prior: float = 0.5


def _dictionary(texts: list[str]) -> bytes:
    chunks = [data[i:i + CHUNK] for data in (t.encode() for t in texts)
              for i in range(0, len(data), CHUNK)]
    try:
        return zstandard.train_dictionary(DICT_BYTES, chunks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few samples to train from: take what there is
        return b"".join(chunks)[-DICT_BYTES:]


def _compressor(dictionary: bytes | None) -> zstandard.ZstdCompressor:
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL)
    known = zstandard.ZstdCompressionDict(dictionary)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=known)


def features(texts: list[str], good: bytes, bad: bytes) -> np.ndarray:
    compressors = [_compressor(d) for d in (good, bad, None)]
    rows = np.ones((len(texts), 6))
    for i, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass")
        by_good, by_bad, alone = (len(c.compress(data)) for c in compressors)
        size = len(data) + 16
        rows[i, 1:] = ((by_bad - by_good) / alone, by_good / size, by_bad / size, alone / size,
                       math.log(size) / 10)
    return rows


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, ...]:
    """Newton's method with halved steps; the weights hold for features as they are."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    mean[0], spread[0] = 0.0, 1.0
    z = (x - mean) / spread
    penalty = ridge * np.eye(z.shape[1])
    penalty[0, 0] = 1e-6

    def loss(w: np.ndarray) -> float:
        s = z @ w
        return float(np.logaddexp(0, s).sum() - y @ s + 0.5 * w @ penalty @ w)

    w = np.zeros(z.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        hessian = (z.T * (p * (1 - p))) @ z + penalty
        step = np.linalg.solve(hessian, z.T @ (p - y) + penalty @ w)
        scale = 1.0
        while scale > 1e-6 and loss(w - scale * step) > loss(w):
            scale /= 2
        w = w - scale * step
        if np.abs(scale * step).max() < 1e-8:
            break
    plain = w / spread
    plain[0] = w[0] - float((w[1:] * mean[1:] / spread[1:]).sum())
    return tuple(float(v) for v in plain)


def fit(texts: list[str], labels: list[int]) -> Model:
    """Texts in even places of each class build the dictionaries, the others the curve."""
    if not labels:
        return Model()
    by_label = {k: [t for t, y in zip(texts, labels, strict=True) if y == k] for k in (0, 1)}
    prior = (len(by_label[1]) + 1) / (len(labels) + 2)
    if min(len(v) for v in by_label.values()) < 2:
        return Model(prior=prior)
    good, bad = _dictionary(by_label[1][::2]), _dictionary(by_label[0][::2])
    if not good or not bad:
        return Model(prior=prior)
    rest, y = [*by_label[1][1::2], *by_label[0][1::2]], [1.0] * (len(by_label[1]) // 2)
    y += [0.0] * (len(by_label[0]) // 2)
    return Model(good, bad, _logistic(features(rest, good, bad), np.array(y)), prior)


def train(docs: DataFrame, labels: DataFrame, *, label: str, text: str = "text",
          doc_id: str = "doc_id", rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS,
          seed: int = 5) -> Model:
    """Fit on at most ``rows`` labelled texts of each class, none over ``chars`` long.

    The sample is drawn by a hash of the identifier. Rows without an identifier, with
    another label than 0 or 1, or without a document are not used.
    """
    marked = (
        labels.select(F.col(doc_id).alias("_id"), F.col(label).alias("_label"))
        .filter(F.col("_id").isNotNull())
        .withColumn("_place", F.xxhash64(F.lit(seed), F.col("_id").cast("string")))
    )
    drawn = None
    for value in (0, 1):
        part = (marked.filter(F.col("_label") == value)
                .orderBy("_place", "_id").limit(rows).select("_id", "_label", "_place"))
        drawn = part if drawn is None else drawn.unionByName(part)
    # Twice `rows` rows.
    texts = (
        docs.select(F.col(doc_id).alias("_id"), whole_text(text).alias("_text"))
        .filter(F.char_length("_text") <= chars)
        .join(F.broadcast(drawn), "_id")
        .orderBy("_place", "_id", "_text").limit(2 * rows)
        .select("_text", "_label").collect()
    )
    return fit([r["_text"] for r in texts], [int(r["_label"]) for r in texts])


def score(model: Model, text: Column) -> Column:
    """Likelihood of label 1, from 0 to 1; a null text counts as empty."""

    @F.pandas_udf("double")
    def scored(batch: pd.Series) -> pd.Series:
        if not model.weights:
            return pd.Series(np.full(len(batch), model.prior))
        x = features(batch.tolist(), model.good, model.bad)
        s = np.clip(x @ np.array(model.weights), -40, 40)
        return pd.Series(1 / (1 + np.exp(-s)))

    return scored(F.coalesce(text.cast("string"), F.lit("")))
