"""Follow-the-regularised-leader (proximal) training of sparse logistic models.

Both text classifiers of this subpackage share this trainer.  A row is a pair of arrays (feature indices,
feature values); the model is a dense weight vector over the hashed feature space plus a bias.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from ._common import started


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


class FtrlProximal:
    """Per-coordinate FTRL-proximal logistic regression.

    alpha, beta: learning-rate schedule; l1, l2: regularisation.  The state is two vectors (z, n); weights are
    derived from them lazily, so that coordinates whose evidence stays under l1 are exactly zero.
    """

    def __init__(self, n_features: int, alpha: float = 0.1, beta: float = 1.0, l1: float = 0.0, l2: float = 1.0):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros(n_features + 1)
        self.n = np.zeros(n_features + 1)

    def weights(self, idx=slice(None)) -> np.ndarray:
        z, n = self.z[idx], self.n[idx]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0.0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def update(self, idx: np.ndarray, val: np.ndarray, label: float, weight: float = 1.0) -> float:
        """One step on one row; returns the probability given before the step. The last coordinate is the bias."""
        w = self.weights(idx)
        p = float(sigmoid(w @ val))
        g = (p - label) * weight * val
        n = self.n[idx]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[idx] += g - sigma * w
        self.n[idx] = n + g * g
        return p

    def fit(
        self,
        rows: Sequence[tuple[np.ndarray, np.ndarray]],
        labels: Sequence[int],
        epochs: int,
        seed: int = 42,
        balance: float = 1.0,
    ) -> np.ndarray:
        """Shuffled passes over the rows; balance multiplies the gradient of label 1. Returns weights, bias last."""
        rng, bias = np.random.default_rng(seed), len(self.z) - 1
        for _ in range(epochs):
            for k in rng.permutation(len(rows)):
                idx, val = rows[k]
                self.update(np.append(idx, bias), np.append(val, 1.0), labels[k], balance if labels[k] else 1.0)
        return self.weights()


class PackedRows:
    """Rows (sorted indices, counts) in one growing buffer, which takes less than as many small arrays and is given back
    as a whole. A row has the gaps of its indices in 16 bits and its counts in 8 if all of them fit, else in 32 bits each.
    values: a function from indices and counts to the values of a row, called when the row is asked for."""

    def __init__(self, values):
        self.values, self.data = values, bytearray()
        self.rows: list[tuple[int, int, bool, bool]] = []  # start, length, whether gaps are narrow, whether counts are

    def append(self, idx: np.ndarray, count: np.ndarray) -> None:
        gaps = np.diff(idx.astype(np.int64), prepend=0)
        near = not len(gaps) or (gaps.min() >= 0 and gaps.max() < 1 << 16)
        low = count.dtype.kind in "iu" and (not len(count) or (count.min() >= 0 and count.max() < 1 << 8))
        self.rows.append((len(self.data), len(idx), near, low))
        self.data += (gaps.astype(np.uint16) if near else idx.astype(np.int32)).tobytes()
        self.data += count.astype(np.uint8 if low else np.float32).tobytes()

    def __len__(self):
        return len(self.rows)

    def __getitem__(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        at, n, near, low = self.rows[k]
        idx = np.frombuffer(self.data, dtype=np.uint16 if near else np.int32, count=n, offset=at)
        count = np.frombuffer(self.data, dtype=np.uint8 if low else np.float32, count=n, offset=at + idx.nbytes)
        idx = np.cumsum(idx, dtype=np.int64) if near else idx
        return idx, self.values(idx, count.astype(np.float64))


class HashedModel:
    """Weights over a hashed feature space (bias last) with a function from a text to (indices, values)."""

    def __init__(self, weights: np.ndarray, features):
        self.weights, self.features = weights.astype(np.float64), features

    def score(self, text: str) -> float:
        """Probability of label 1 as a sparse dot product; a text without features gets the bias alone."""
        idx, val = self.features(text)
        return float(sigmoid(self.weights[idx] @ val + self.weights[-1]))


def train_sample(docs, labels, label_col: str, usable, limit: int):
    """(doc_id, text, label): at most `limit` labelled rows, chosen by hash order, as even between the labels as they allow.

    The choice is made on the narrow labels table; the bounded set of ids is then broadcast to the documents.
    Rows with a null id, text or label are not used; a document with several labels counts once per distinct label, an
    id with several texts by its least one.
    """
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    known = labels.select("doc_id", F.col(label_col).cast("int").alias("label"))
    known = known.where("doc_id is not null and label in (0, 1)").where(usable(F.col("doc_id"))).distinct()
    known = known.withColumn("h", F.xxhash64("doc_id"))
    ids = None
    for label in (0, 1):
        some = known.where(F.col("label") == label).orderBy("h", "doc_id").limit(limit)
        ids = some if ids is None else ids.unionByName(some)
    rank = F.row_number().over(Window.partitionBy("label").orderBy("h", "doc_id"))
    # at most 2 * limit narrow rows are ranked; taking the lowest ranks of both labels evens them out
    ids = ids.withColumn("rank", rank).orderBy("rank", "label").limit(limit).select("doc_id", "label")
    texts = docs.select("doc_id", "text").where("text is not null")
    # repeats of an id would make the sample unbounded: each counts once, with its least text
    return texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def train(sample, make_weights) -> np.ndarray:
    """Runs make_weights(texts, labels) over the bounded sample in one task; returns the weights (a fixed size).

    Rows are sorted first, so the weights do not depend on their order; without rows, the weights of no rows.
    """
    import pandas as pd

    def run(frames):
        started(lambda: None)  # training keeps nothing that other operators have left in the process
        rows = pd.concat([pd.DataFrame({"doc_id": [], "text": [], "label": []}), *frames])
        rows = rows.sort_values(["doc_id", "label", "text"])
        texts, targets = rows["text"].tolist(), [int(x) for x in rows["label"]]
        del rows
        w = make_weights(texts, targets)
        yield pd.DataFrame({"w": [w.astype("<f4").tobytes()]})

    out = sample.repartition(1).mapInPandas(run, "w binary").first()
    if out is None:  # an empty table has no batch
        return make_weights([], [])
    return np.frombuffer(out["w"], dtype="<f4").astype(np.float64)
