"""The quality classifier's features, training and scores against plain Python."""

import math
import random
import re
import zlib

import numpy as np
import pytest

from chronopulse.llm import quality
from chronopulse.llm.linear import FtrlProximal

WORD = 1 << 64


def brute_features(text, bits, orders):
    codes = []
    for w in re.findall(r"\w+|[^\w\s]+", text):
        codes.append(zlib.crc32(b"\x01capitals") if len(w) > 1 and w.isupper() else zlib.crc32(w.lower().encode()))
    codes = [zlib.crc32(b"\x01repeat") if k and codes[k] == codes[k - 1] else c for k, c in enumerate(codes)]
    count = {}
    for n in range(1, orders + 1):
        for k in range(len(codes) - n + 1):
            gram = 0
            for c in codes[k : k + n]:
                gram = (gram * 0x100000001B3 + c) % WORD
            at = ((gram ^ n) * 0x9E3779B97F4A7C15 % WORD) >> (64 - bits)
            count[at] = count.get(at, 0) + 1
    size = math.sqrt(sum(math.log1p(c) ** 2 for c in count.values()))
    return {k: math.log1p(c) / size for k, c in count.items()}


def brute_ftrl(rows, labels, config, n_features, seed=42):
    """Follow the regularised leader, a coordinate at a time; the bias is the last coordinate."""
    z, n = {}, {}

    def weight(k):
        lasso = math.copysign(max(abs(z.get(k, 0.0)) - config.l1, 0.0), z.get(k, 0.0))
        return -lasso / ((1 + math.sqrt(n.get(k, 0.0))) / config.alpha + config.l2)

    rng = np.random.default_rng(seed)
    for _ in range(config.epochs):
        for r in rng.permutation(len(rows)):
            x = rows[r] | {n_features: 1.0}
            w = {k: weight(k) for k in x}
            p = 1 / (1 + math.exp(-sum(w[k] * v for k, v in x.items())))
            for k, v in x.items():
                g = (p - labels[r]) * v
                sigma = (math.sqrt(n.get(k, 0.0) + g * g) - math.sqrt(n.get(k, 0.0))) / config.alpha
                z[k], n[k] = z.get(k, 0.0) + g - sigma * w[k], n.get(k, 0.0) + g * g
    return {k: weight(k) for k in z}


def texts(n=60):
    rng = random.Random(2)
    some = ["", " \n", "One one ONE one!! ??", "SHOUT SHOUT a a a", "é É ÉÉ 漢字 漢字 _x_", "a" * 150 + " b"]
    return some + [" ".join(rng.choice(["good", "Fine", "bad", "BUY", "now!", "a", "the", "the the", "x1,y2"]) for _ in range(rng.randrange(1, 40))) for _ in range(n)]


def test_features_are_those_of_plain_python():
    config = quality.QualityConfig(bits=12, orders=3)
    features = quality.WordFeatures(config, memo=5)  # forgets often
    for t in texts() * 2:
        idx, val = features(t)
        assert dict(zip(idx.tolist(), val.tolist())) == pytest.approx(brute_features(t, 12, 3))


def test_weights_and_scores_are_those_of_plain_python(spark):
    config = quality.QualityConfig(bits=10, epochs=3, sample=1000)
    rows = [(k, t) for k, t in enumerate(texts())]
    labels = [(k, int("good" in t or "Fine" in t), 0) for k, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    weights = quality.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), config=config)
    want = brute_ftrl([brute_features(t, 10, 2) for _, t in rows], [y for _, y, _ in labels], config, 1 << 10)
    assert {k: w for k, w in enumerate(weights.tolist()) if w} == pytest.approx({k: w for k, w in want.items() if abs(w) > 1e-12}, rel=1e-4, abs=1e-6)
    scored = {r["doc_id"]: r for r in quality.score(docs, weights, config=config).collect()}
    for k, t in rows:
        x = sum(want.get(i, 0.0) * v for i, v in brute_features(t, 10, 2).items()) + want[1 << 10]
        assert scored[k]["score"] == pytest.approx(1 / (1 + math.exp(-x)), abs=1e-5)
        assert scored[k]["predicted"] == (scored[k]["score"] >= 0.7)


def test_lasso_keeps_weak_weights_at_zero():
    model = FtrlProximal(3, l1=10.0)
    assert not model.fit([(np.array([0, 1]), np.array([1.0, 1.0]))] * 5, [1] * 5, 2).any()
