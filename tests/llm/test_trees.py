"""Orchard clustering and the conversation prefix trie against plain Python and on edge cases."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from chronopulse.llm import orchard, prefixes


def brute_clusters(rows, k, rounds, size):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest())[:k]
    centroids = [v for _, v in first]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        sums = [[v for (_, v), o in zip(kept, own) if o == j] for j in range(len(centroids))]
        centroids = [[sum(c) // len(vs) for c in zip(*vs)] if vs else centroids[j] for j, vs in enumerate(sums)]
    found = [(i, near(v)) for i, v in kept]
    inertia = [sum(d for _, (d, j) in found if j == c) for c in range(len(centroids))]
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted([(i, j, d, inertia[j], sum(inertia), name[j]) for i, (d, j) in found], key=str)


@pytest.mark.parametrize("k", [1, 5, 16])
def test_clusters_are_those_of_plain_search(spark, k):
    rng = random.Random(k)
    rows = [(i, [rng.choice([0.0, 0.02, -0.3, 0.5, 1.1]) if i % 3 else rng.gauss(i % 5, 1) for _ in range(4)]) for i in range(150)]
    rows += [(500 + i, rows[7][1]) for i in range(20)]  # copies, so ties
    rows += [(7, rows[7][1]), (None, rows[3][1]), (900, None), (901, [1.0]), (902, [1.0] * 5), (903, [1.0, None, 2.0, 3.0]), (904, [1.0, math.nan, 2.0, 3.0]), (905, [math.inf] * 4), (906, [])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, cluster string").repartition(3)
    exact = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = orchard.cluster(df, config=orchard.OrchardConfig(k=k, rounds=3, size=4))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_clusters(exact, k, 3, 4)
    empty = orchard.cluster(df.limit(0), config=orchard.OrchardConfig(k=k, size=4))
    assert empty.count() == 0 and empty.columns == got.columns
    assert orchard.cluster(df.where("vec_id >= 900"), config=orchard.OrchardConfig(k=k, size=4)).count() == 0


def test_search_measures_few_centroids():
    rng = np.random.default_rng(1)
    centroids = rng.integers(-4000, 4000, (200, 3))
    vectors = centroids[rng.integers(0, 200, 3000)] + rng.integers(-200, 200, (3000, 3))
    found, distance, measured = orchard.nearest(vectors, centroids, *orchard.neighbour_lists(centroids))
    d = ((vectors[:, None, :] - centroids[None]) ** 2).sum(2)
    assert (found == d.argmin(1)).all() and (distance == d.min(1)).all()
    assert measured.mean() < 100


def test_large_components_stay_exact(spark):
    df = spark.createDataFrame([(1, [3e38, -3e38]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["distance"] for r in orchard.cluster(df, config=orchard.OrchardConfig(k=1, rounds=0, size=2)).collect()}
    assert sorted(got.values()) == [0, (orchard.LIMIT - 64) ** 2 + (orchard.LIMIT + 128) ** 2]


def text_order(spark, rows):
    """The hashes by which turns of equal place and role are ordered."""
    said = [(r or "", t or "") for _, _, r, t in rows]
    found = spark.createDataFrame(said, "role string, text string").selectExpr("role", "text", "xxhash64(1, role, text) as h").collect()
    return {(r["role"], r["text"]): r["h"] for r in found}


def brute_trie(rows, order):
    """rows: (conv_id, turn, role, text), in any order."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: (*t[:3], order[t[2:]]))] for c, ts in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    built = {c: own.get(c - c % 20, [])[: h[c]] + ts[h[c] :] for c, ts in own.items()}
    members = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    words = lambda k: len([w for w in "".join(" " if x in "\t\n\x0b\x0c\r" else x for x in k[-1][1]).split(" ") if w]) if k else 0
    out = []
    for k, m in members.items():
        below = [x for x in members if x[: len(k)] == k]
        kids = {x for x in below if len(x) == len(k) + 1}
        leaves = sum(not any(len(y) > len(x) and y[: len(x)] == x for y in below) for x in below)
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(k))
        out.append(
            (min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids), leaves, sum((len(members[x]) - 1) * words(x) for x in below), hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=str)


def chats(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(90), 4100, 4101, 8200]:
        for t in range(rng.choice([1, 1, 2, 3, 4, 6])):
            text = rng.choice(["hi", "hi  there\tyou", None, "", "same words here", "rare %d" % rng.randrange(40)])
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "assistant", None]) if t > 2 else ("user", "assistant")[t % 2], text))
    return rows + [rows[0], rows[5], rows[5], (None, 1, "user", "nobody's")]


@pytest.mark.parametrize("cells", [None, 1 << 16])
def test_trie_is_that_of_plain_python(spark, cells, monkeypatch):
    monkeypatch.setattr(prefixes, "SLAB", 2)  # conversations go over several slabs
    rows = chats(3)
    want = brute_trie(rows, text_order(spark, rows))
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int").repartition(3)
    got = prefixes.trie(prefixes.with_shared_heads(df), cells)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    assert prefixes.trie(prefixes.with_shared_heads(df.limit(0))).count() == 0


def test_sketch_that_proves_nothing_changes_nothing(spark, monkeypatch):
    """With every cell taken twice all prefixes are grouped exactly."""
    rows = chats(4)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    monkeypatch.setattr(prefixes, "count_min", lambda p, cells: np.full((2, cells // 8), 255, dtype=np.uint8))
    assert sorted((tuple(r) for r in prefixes.trie(prefixes.with_shared_heads(df)).collect()), key=str) == brute_trie(rows, text_order(spark, rows))


def test_sketch_never_counts_too_low(spark):
    digests = [(k % 700, (k % 700) * 7919) for k in range(1000)]
    bits = prefixes.count_min(spark.createDataFrame(digests, "p1 long, p2 long").repartition(5), 1 << 16)
    at = lambda row, x: bits[row, (x & 0xFFFF) >> 3] >> (x & 7) & 1
    assert all(at(0, a) and at(1, b) for a, b in digests[:300])  # these occur twice
    assert sum(1 - int(at(0, a) & at(1, b)) for a, b in digests[300:700]) == 400


def test_one_very_long_conversation(spark):
    turns = spark.range(5000).selectExpr("7L as conv_id", "id as turn", "'user' as role", "concat('t', id % 10) as text")
    both = turns.unionByName(turns.where("turn < 4990").selectExpr("20L as conv_id", "turn", "role", "text"))
    got = {(r["conv_id"], r["depth"]): r for r in prefixes.trie(prefixes.plain(prefixes.numbered(both))).collect()}
    assert len(got) == 5001 and got[7, 0]["n_leaves"] == 1 and got[7, 0]["saved_tokens"] == 4990
    assert got[7, 4990]["n_convs"] == 2 and got[7, 4990]["ends_sha256"] == hashlib.sha256(b"20").hexdigest()
    assert got[7, 4991]["parent_conv_id"] == 7 and got[7, 2000]["saved_tokens"] == 2991
