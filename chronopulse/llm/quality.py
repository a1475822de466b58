"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

Tokens are runs of word characters or of punctuation, lower-cased; a repetition of the token before it and a word in
capitals become marker tokens, so that repetitive and shouting texts share features. Feature values are log counts,
scaled to unit length; a score is a sparse dot product.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import append_columns, fold, unused
from .linear import FtrlProximal, HashedModel, PackedRows, train, train_sample

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_REPEAT = zlib.crc32(b"\x01repeat")
_CAPITALS = zlib.crc32(b"\x01capitals")


@dataclass(frozen=True)
class QualityConfig:
    """sample: most labelled documents used for fitting; bits: log2 of the feature space; orders: n-gram lengths."""

    sample: int = 8000
    bits: int = 18
    orders: int = 2
    alpha: float = 1.0
    l1: float = 0.1
    l2: float = 1e-3
    epochs: int = 5
    threshold: float = 0.7


class WordFeatures:
    """Text to (indices, values). Remembers token codes of recent space-delimited segments, a bounded number."""

    def __init__(self, config: QualityConfig, memo: int = 300_000):
        self.config, self.limit, self.memo = config, memo, {}

    def _learn(self, segment: str) -> tuple[int, ...]:
        if len(self.memo) >= self.limit:
            self.memo.clear()
        codes = tuple(
            _CAPITALS if len(w) > 1 and w.isupper() else zlib.crc32(w.lower().encode()) for w in _TOKEN.findall(segment)
        )
        if len(segment) < 100:
            self.memo[segment] = codes
        return codes

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        segments = text.split()
        found = list(map(self.memo.get, segments))
        if None in found:
            found = [(self.memo.get(s) or self._learn(s)) if f is None else f for s, f in zip(segments, found, strict=True)]
        codes = np.array(list(chain.from_iterable(found)), dtype=np.uint64)
        if not len(codes):
            return np.empty(0, dtype=np.int64), np.empty(0)
        again = np.flatnonzero(codes[1:] == codes[:-1]) + 1
        codes[again] = _REPEAT
        shift, parts = np.uint64(64 - self.config.bits), []
        gram = np.zeros_like(codes)
        for n in range(1, self.config.orders + 1):
            if len(codes) < n:
                break
            gram = gram[: len(codes) - n + 1] * np.uint64(0x100000001B3) + codes[n - 1 :]
            parts.append(((gram ^ np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> shift)
        idx, count = np.unique(np.concatenate(parts), return_counts=True)
        val = np.log1p(count)
        return idx.astype(np.int64), val / np.sqrt(val @ val)


def fit(docs: DataFrame, labels: DataFrame, usable=None, config: QualityConfig = QualityConfig()) -> np.ndarray:
    """Weights (bias last) learnt from docs (doc_id, text) and labels (doc_id, quality).

    usable: a function from the id column to a condition; other rows are never learnt from. Fits on at most
    config.sample labelled documents. Without any labelled row all weights are zero: every score is 0.5.
    """
    sample = train_sample(docs, labels, "quality", usable or (lambda c: c.isNotNull()), config.sample)

    def make_weights(texts: list[str], targets: list[int]) -> np.ndarray:
        features = WordFeatures(config)
        model = FtrlProximal(1 << config.bits, config.alpha, 1.0, config.l1, config.l2)
        rows = PackedRows(lambda idx, val: val)
        for t in texts:
            rows.append(*features(t))
        return model.fit(rows, targets, config.epochs)

    return train(sample, make_weights)


def _scored(docs: DataFrame, weights: np.ndarray, text_col: str, config: QualityConfig, out_col: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype("<f4"))  # 4 * 2^bits bytes, whatever the corpus

    def make():
        model = HashedModel(shared.value, WordFeatures(config))
        return lambda texts: [pa.array([model.score(t) for t in texts], pa.float64())]

    return append_columns(docs, text_col, make, f"{out_col} double")


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text", config: QualityConfig = QualityConfig()) -> DataFrame:
    """docs with score (0 to 1; higher: label 1 likelier) and predicted (1 if score >= config.threshold, else 0).

    Whole texts; null counts as empty; empty texts get the bias alone; columns of these names are replaced.
    """
    scored = _scored(docs, weights, text_col, config, "score")
    return scored.withColumn("predicted", (F.col("score") >= config.threshold).cast("int"))


def held_out(column):
    """Rows that the classifier never learns labels from: crc32 of the id modulo 4 is 2."""
    return fold(column, 4) == 2


def keep_good(docs: DataFrame, weights: np.ndarray, config: QualityConfig = QualityConfig()) -> DataFrame:
    """The rows of docs that the classifier accepts, with the columns of docs."""
    mine = unused(docs, "score")
    scored = _scored(docs, weights, "text", config, mine)
    return scored.where(F.col(mine) >= config.threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
