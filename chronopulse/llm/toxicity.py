"""Toxicity: a character n-gram linear classifier over naive Bayes log-count ratios.

A text's features are its hashed character n-grams, with log counts scaled to unit length. Each is multiplied by its
naive Bayes log-count ratio log(p/q), where p and q are the smoothed shares that the n-gram has of all n-grams of toxic
and of other training texts, every text counting alike; a logistic model is then trained on those values.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import append_columns, fold, unused
from .linear import FtrlProximal, PackedRows, sigmoid, train, train_sample


@dataclass(frozen=True)
class ToxicityConfig:
    """sample: most labelled documents used for fitting; bits: log2 of the feature space; orders: n-gram lengths."""

    sample: int = 6000
    bits: int = 18
    orders: tuple[int, ...] = (4, 6, 7)
    smoothing: float = 1.0
    scale: float = 16.0
    alpha: float = 0.2
    l2: float = 1e-3
    epochs: int = 3
    threshold: float = 0.5


class CharFeatures:
    """Text to the hashed indices of its n-grams and their values, lower-cased and padded by a space."""

    def __init__(self, config: ToxicityConfig):
        self.config = config

    def counts(self, text: str, block: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
        """Sorted indices and how often each occurs."""
        codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
        longest, shift, total = max(self.config.orders), np.uint32(32 - self.config.bits), None
        for start in range(0, len(codes), block):  # blocks overlap, so that memory stays bounded on huge texts
            part = codes[start : start + block + longest - 1]
            gram, found = part.copy(), []
            for n in range(2, longest + 1):
                if len(part) < n:
                    break
                gram = gram[:-1] * np.uint32(0x01000193) + part[n - 1 :]
                if n in self.config.orders:
                    own = gram[:block]  # those that start in this block
                    found.append(((own ^ (own >> np.uint32(15)) ^ np.uint32(n)) * np.uint32(0x9E3779B1)) >> shift)
            if not found:
                continue
            every = np.sort(np.concatenate(found))
            first = np.concatenate(([0], np.flatnonzero(every[1:] != every[:-1]) + 1))
            idx, count = every[first], np.diff(np.append(first, len(every)))
            if len(codes) <= block:
                return idx, count
            total = np.zeros(1 << self.config.bits, dtype=np.int64) if total is None else total
            total[idx] += count
        if total is None:
            return np.empty(0, dtype=np.uint32), np.empty(0, dtype=np.int64)
        idx = np.flatnonzero(total)
        return idx, total[idx]

    @staticmethod
    def values(count: np.ndarray) -> np.ndarray:
        val = np.log1p(count)
        return val / np.sqrt(val @ val) if len(val) else val


def fit(docs: DataFrame, labels: DataFrame, usable=None, config: ToxicityConfig = ToxicityConfig()) -> np.ndarray:
    """Weights (ratios and scale folded in, bias last) learnt from docs (doc_id, text) and labels (doc_id, toxic).

    usable: a function from the id column to a condition; other rows are never learnt from. Fits on at most
    config.sample labelled documents. Without any labelled row all weights are zero: every score is 0.5.
    """
    sample = train_sample(docs, labels, "toxic", usable or (lambda c: c.isNotNull()), config.sample)

    def make_weights(texts: list[str], targets: list[int]) -> np.ndarray:
        features, size = CharFeatures(config), 1 << config.bits
        counts = np.full((2, size), config.smoothing)
        rows = PackedRows(lambda idx, count: features.values(count) * ratio[idx])
        for text, label in zip(texts, targets, strict=True):
            idx, count = features.counts(text)
            counts[label, idx] += count * (1000.0 / max(1, count.sum()))
            rows.append(idx, count)
        share = counts / counts.sum(axis=1, keepdims=True)
        ratio = (np.log(share[1]) - np.log(share[0])) * config.scale
        model = FtrlProximal(size, config.alpha, 1.0, 0.0, config.l2)
        w = model.fit(rows, targets, config.epochs)
        w[:-1] *= ratio
        return w

    return train(sample, make_weights)


def _scored(docs: DataFrame, weights: np.ndarray, text_col: str, config: ToxicityConfig, out_col: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype("<f4"))  # 4 * 2^bits bytes, whatever the corpus

    def make():
        features, w = CharFeatures(config), shared.value

        def one(text: str) -> float:
            idx, count = features.counts(text)
            return float(sigmoid(w[idx].astype(np.float64) @ features.values(count) + w[-1]))

        return lambda texts: [pa.array([one(t) for t in texts], pa.float64())]

    return append_columns(docs, text_col, make, f"{out_col} double")


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text", config: ToxicityConfig = ToxicityConfig()) -> DataFrame:
    """docs with score (0 to 1; higher: label 1 likelier) and predicted (1 if score >= config.threshold, else 0).

    Whole texts; null counts as empty; empty texts get the bias and the padding's features; columns of these names
    are replaced.
    """
    scored = _scored(docs, weights, text_col, config, "score")
    return scored.withColumn("predicted", (F.col("score") >= config.threshold).cast("int"))


def held_out(column):
    """Rows that the classifier never learns labels from: crc32 of the id modulo 5 is 0."""
    return fold(column, 5) == 0


def keep_harmless(docs: DataFrame, weights: np.ndarray, config: ToxicityConfig = ToxicityConfig()) -> DataFrame:
    """The rows of docs that the classifier does not call toxic, with the columns of docs."""
    mine = unused(docs, "score")
    scored = _scored(docs, weights, "text", config, mine)
    return scored.where(F.col(mine) < config.threshold).select(*[F.col(f"`{c}`") for c in docs.columns])
