"""The Jaccard join by parity sketches against all pairs, and the bounds that it stands on."""

import random

import numpy as np
import pytest

from chronopulse.llm import parity
from chronopulse.llm.simhash import shingle_set


def brute(rows, size=5, percent=80):
    """doc_id: (set size, smallest id reachable over links) by all pairs; rows need distinct ids."""
    sets = []
    for _, text in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = [x for x in lower.translate({k: " " for k in range(9, 14)}).split(" ") if x]
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    label = [i for i, _ in rows]
    links = [
        (x, y) for x in range(len(rows)) for y in range(x)
        if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y])
    ]
    before = None
    while before != label:
        before = list(label)
        for x, y in links:
            label[x] = label[y] = min(label[x], label[y])
    return {i: (len(s), k) for (i, _), s, k in zip(rows, sets, label)}


def near_rows(seed=8, groups=14, sizes=(9, 12, 25, 60, 200)):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(40)]
    rows = [(900, None), (901, ""), (902, "one"), (903, "One"), (904, "one two three four"), (905, " \n"), (906, "ONE\x0btwo three\tfour")]
    for g in range(groups):
        base = [word() for _ in range(rng.choice(sizes))]
        base = base + passage if g % 2 else base
        for k in range(8):
            copy = [word() if rng.random() < rng.choice([0, 0.01, 0.02, 0.04]) else w for w in base]
            copy = copy[: len(copy) - rng.choice([0, 0, 1, 2, 9])] + [word() for _ in range(rng.choice([0, 0, 1, 5]))]
            rows.append((g * 20 + k, " ".join(copy)))
    return rows


def groups_of(docs, **settings):
    found = parity.jaccard_groups(docs, config=parity.ParityConfig(**settings)).collect()
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found}


@pytest.mark.parametrize("settings", [{}, {"busy": 0, "rounds": 1, "node_bits": 5}, {"sample": 1, "rounds": 0, "busy": 1, "percent": 60, "shingle": 3}])
def test_groups_are_those_of_all_pairs(spark, settings):
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = brute(rows, settings.get("shingle", 5), settings.get("percent", 80))
    assert groups_of(docs, **settings) == want
    assert len({k for _, k in want.values()}) < len(rows) - 20


def test_many_texts_of_one_passage(spark):
    """Documents that mostly are a passage which all share: their cells are weak, so they meet on their rarest shingles."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    passage = " ".join(word() for _ in range(80))
    rows = [(k, passage + " " + " ".join(word() for _ in range(rng.choice([10, 30, 40])))) for k in range(60)]
    rows += [(100 + k, rows[k][1] + " more") for k in range(0, 60, 7)]
    assert groups_of(spark.createDataFrame(rows, "doc_id long, text string"), busy=2) == brute(rows)


def test_edges(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta " * 4
    rows = [(5, text, "x"), (3, text + "iota", "y"), (3, text, "y"), (3, text, "y"), (None, text, "z"), (None, None, "z"), (8, "", "z"), (None, "only null here", "z"), (9, "w " * 20000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")  # a clashing column
    got = parity.jaccard_groups(docs).collect()
    assert len(got) == len(rows)
    by_size = {}
    for r in got:
        by_size.setdefault(r["n_shingles"], []).append((r["doc_id"], r["component_id"]))
    assert sorted(by_size[0], key=str) == [(8, 8), (None, None)]
    assert sorted(by_size[1], key=str) == [(9, 9), (None, None)]
    assert {c for n, pairs in by_size.items() if n > 1 for _, c in pairs} == {3}
    assert parity.jaccard_groups(docs.limit(0)).count() == 0
    named = docs.selectExpr("'k' || doc_id as name", "text as words")
    assert parity.jaccard_groups(named, "name", "words").where("component_id = 'k3'").count() == 5


def test_similar_sets_agree_in_enough_cells():
    rng = np.random.default_rng(2)
    for n in [4, 5, 9, 16, 30, 33, 64, 100, 255, 256, 700]:
        for _ in range(20):
            common = n - int(rng.integers(0, n // 5 + 1))
            other = int(rng.integers(0, n // 4 + 1))
            h = rng.integers(0, 1 << 63, n + other, dtype=np.uint64) * np.uint64(2)
            a, b = np.unique(h[:n]), np.unique(np.concatenate((h[:common], h[n:])))
            same = len(np.intersect1d(a, b))
            apart = len(a) + len(b) - 2 * same
            wa, wb = parity.bit_sketch(a), parity.bit_sketch(b)
            while len(wa) != len(wb):  # fold the longer
                wa, wb = (wa[: len(wb)] ^ wa[len(wb) :], wb) if len(wa) > len(wb) else (wa, wb[: len(wa)] ^ wb[len(wa) :])
            assert sum(int(x).bit_count() for x in (wa ^ wb).view("<u8")) <= apart
            if 100 * same < 80 * (len(a) + len(b) - same) or not apart:
                continue
            (ka, sa), (kb, sb) = parity.cell_keys(a, 80), parity.cell_keys(b, 80)
            assert apart <= parity.most_different(len(a), len(b), 80)
            assert len(set(ka) & set(kb)) > max(sa, sb) or (sa < 0 and sb < 0)


def test_few_sets_are_poor():
    rng = np.random.default_rng(3)
    for n in [4, 8, 16, 17, 40, 64, 130, 300, 600, 5000]:
        poor = sum(parity.cell_keys(np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)), 80)[1] < 0 for _ in range(200))
        assert poor <= 30
    assert parity.cell_keys(shingle_set("one two"), 80)[0].size == 0


def test_exact_removal_of_near_copies(spark):
    rows = near_rows(5, 8)
    want = brute(rows)
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string").repartition(3)
    kept = parity.deduplicate(docs)
    assert {r["doc_id"] for r in kept.collect()} == {i for i, (_, k) in want.items() if i == k} and kept.columns == docs.columns
    a, b = "alpha beta gamma delta epsilon zeta " * 5, "one two three four five six seven " * 5
    rows = [(1, a), (5, a), (5, b), (7, b), (None, a), (9, None), (10, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(str, parity.deduplicate(docs).collect())) == sorted(map(str, [r for r in docs.collect() if (r["doc_id"], r["text"]) not in ((5, a), (7, b))]))
    assert parity.deduplicate(docs.limit(0)).count() == 0
