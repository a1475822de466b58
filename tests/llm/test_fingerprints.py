"""SimHash and I-Match against brute force and on edge cases."""

import random
import re
import struct
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from chronopulse.llm import imatch, simhash
from chronopulse.llm._common import connected_components


def brute_fingerprint(text, size=4):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, prints, distance):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, x in zip(ids, prints):
            for b, y in zip(ids, prints):
                if (x ^ y).bit_count() <= distance and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


@pytest.mark.parametrize("text", ["", " \t", "One", "A b C", "a b c d e f a b c d", "é\x85x y z\xa0w Q\x0bR", "x " * 300])
def test_fingerprint_is_the_defined_one(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    row = spark.sql("select xxhash64('a b c d') as h").first()
    assert row["h"] % (1 << 64) == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_pigeonhole_keys_meet_for_every_close_pair():
    rng, plan = random.Random(1), simhash.Pigeonhole(4)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(5)):
            b ^= 1 << bit
        keys = plan(np.array([a, b], dtype=np.uint64))
        assert set(keys[0]) & set(keys[1])
    with pytest.raises(ValueError):
        simhash.Pigeonhole(4, blocks=6, choose=3)


def test_components_against_brute_force(spark):
    rng = random.Random(7)
    bases = [rng.getrandbits(64) for _ in range(25)]
    rows = []
    for i in range(400):
        x = rng.choice(bases)
        for bit in rng.sample(range(64), rng.randrange(6)):
            x ^= 1 << bit
        rows.append((1000 - i, f"{x:016x}"))
    prints = spark.createDataFrame(rows, "doc_id long, fingerprint string")
    got = simhash.components(prints, simhash.Pigeonhole(4), 4)
    got = {r["doc_id"]: r["component_id"] for r in prints.join(got, "fingerprint").collect()}
    assert got == brute_components([r[0] for r in rows], [int(r[1], 16) for r in rows], 4)


def test_near_duplicates_edges(spark):
    text = "alpha beta gamma delta epsilon zeta eta theta " * 20
    rows = [(5, text, "x"), (3, text, "y"), (3, text, "y"), (9, None, "z"), (8, "", "z"), (7, "other words " * 30, "z"), (None, text, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")  # a clashing column
    got = [tuple(r) for r in simhash.near_duplicates(docs).orderBy("doc_id").collect()]
    assert len(got) == 7
    by_id = {}
    for i, f, c in got:
        by_id.setdefault(i, set()).add((f, c))
    assert {c for _, c in by_id[5] | by_id[3] | by_id[None]} == {3}
    assert by_id[9] == {("0" * 16, 8)} and by_id[8] == {("0" * 16, 8)}
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_deduplicate_keeps_one_of_near_copies(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    rows, expected = [], set()
    for g in range(12):
        base = [word() for _ in range(300)]
        expected.add(g * 10)
        for k in range(5):
            copy = list(base)
            if k:
                copy[60 * k] = word()  # one word: 5 of 296 shingles differ
            rows.append((g * 10 + k, " ".join(copy), "en"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = simhash.deduplicate(docs)
    assert {r["doc_id"] for r in kept.collect()} == expected and kept.columns == docs.columns


def brute_groups(rows, size=5, similarity=0.8):
    """The smallest doc_id of each document's group, by all pairs of shingle sets."""
    sets = []
    for _, text in rows:
        w = (text or "").lower().split()
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    label = [i for i, _ in rows]
    links = []
    for x in range(len(rows)):
        for y in range(x):
            union = len(sets[x] | sets[y])
            if not union or len(sets[x] & sets[y]) / union >= similarity:
                links.append((x, y))
    for _ in rows:
        for x, y in links:
            label[x] = label[y] = min(label[x], label[y])
    return {i: k for (i, _), k in zip(rows, label)}


def test_deduplicate_against_all_pairs(spark):
    """Groups of copies around the limit, below it, and far from it: what links is what all pairs of sets say."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = [(900, None), (901, ""), (902, "one"), (903, "One"), (904, "one two three four"), (905, " \n")]
    for g in range(14):
        base = [word() for _ in range(rng.choice([12, 60, 200]))]
        for k in range(8):
            copy = [word() if rng.random() < rng.choice([0, 0.01, 0.02, 0.06]) else w for w in base]
            rows.append((g * 20 + k, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got, want = {r["doc_id"] for r in simhash.deduplicate(docs).collect()}, brute_groups(rows)
    assert want[901] == want[905] == 900 and want[903] == 902
    kept = {i for i, k in want.items() if i == k}
    assert kept <= got and len(got - kept) <= 1  # no document is lost that has no copy before it


def test_keys_of_similar_sets_meet():
    rng, plan = np.random.default_rng(5), simhash.Strongest()
    met = {0.8: 0, 0.9: 0, 0.3: 0}
    for similarity in met:
        for _ in range(200):
            common = round(300 * 2 * similarity / (1 + similarity))
            h = rng.integers(0, 1 << 63, 600 - common, dtype=np.uint64)
            a, b = h[:300], np.concatenate((h[:common], h[300:]))
            ka, kb = plan(np.stack([simhash.wide_sums(a, 4), simhash.wide_sums(b, 4)]))
            assert len(set(ka)) == plan.tables
            met[similarity] += bool(set(ka) & set(kb))
    assert met[0.8] >= 180 and met[0.9] >= 198 and met[0.3] <= 20


def test_connected_components_of_a_long_chain(spark):
    edges = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    edges = edges.unionByName(spark.createDataFrame([(100, 101), (101, 100), (7, 7), (None, 1)], "a long, b long"))
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}
    assert connected_components(edges.limit(0)).count() == 0


def brute_edited(docs):
    order = sorted(docs, key=lambda d: -d[0])
    out = {}
    for k, (i, t) in enumerate(order):
        t, nxt = t or "", (order[(k + 1) % len(order)][1] or "")
        m = len(t) // 3
        out[i] = t[: len(t) - m] + nxt[:m]
    return out, {order[k][0]: order[(k + 1) % len(order)][0] for k in range(len(order))}


def test_imatch_edited_text_and_likeness(spark):
    import hashlib

    rng = random.Random(5)
    vocabulary = ["w%dé" % i for i in range(60)]
    docs = [(i * 7, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(5, 60)))) for i in range(40)]
    docs += [(1000, None), (1001, ""), (1003, "same text here"), (1002, "same text here"), (5000, "𝄞" * 9)]
    frame = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, near_next int")
    words = imatch.lexicon(frame, 0.01, 0.6)
    edited, after = brute_edited(docs)
    for per_bucket in (5, 1000):
        got = {r["doc_id"]: r for r in imatch.compare_edited(frame, words, per_bucket=per_bucket).collect()}
        assert len(got) == len(docs)
        own = {r["doc_id"]: r for r in imatch.fingerprints(frame, words).collect()}
        for i, t in docs:
            assert got[i]["n_chars"] == len(t or "")
            assert got[i]["edited_sha256"] == hashlib.sha256(edited[i].encode()).hexdigest()
            assert got[i]["fingerprint"] == own[i]["fingerprint"]
            assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
            if own[i]["fingerprint"] == own[after[i]]["fingerprint"]:
                assert got[i]["near_next"] == 1
        assert got[1003]["fingerprint"] == got[1002]["fingerprint"] and got[1003]["near_next"] == 1
        mean = lambda c: np.mean([r[c] for r in got.values()])
        assert mean("near_edited") > mean("near_next") + 0.1
    assert imatch.compare_edited(frame.limit(0), words).count() == 0
    more = spark.createDataFrame([(None, "w1é w2é", 1), (None, "w1é w2é", 1), (7, "w3é", 1)], frame.schema)  # null and repeated ids
    got = imatch.compare_edited(frame.unionByName(more), words, per_bucket=5)
    assert got.count() == len(docs) + 3 and got.where("doc_id is null").count() == 2
    one = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert imatch.compare_edited(one, words).count() == 1


def brute_imatch(docs, low, high):
    """Fingerprints (lists, None for a subset without terms) and their text, in plain Python."""
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    terms = {i: {signed(xxhash.xxh64_intdigest(w.encode(), 42)) for w in re.findall(r"[^\W_]+", (t or "").lower())} for i, t in docs}
    count = Counter(h for own in terms.values() for h in own)
    lexicon = {h for h, n in count.items() if max(2, low * len(docs)) <= n <= max(2, high * len(docs))}
    out = {}
    for i, t in docs:
        kept, found = sorted(terms[i] & lexicon), []
        for first, bits in ((0, 4), (4, 7), (11, 10), (21, 13)):
            for subset in range(16):
                h = 42
                for term in kept:
                    if (term % (1 << 64)) >> first & ((1 << bits) - 1) == subset:
                        h = xxhash.xxh64_intdigest(struct.pack("<q", term), h)
                found.append(None if h == 42 else h & 0xFFFFFFFF)
        found.append(None if kept else xxhash.xxh64_intdigest((t or "").encode(), 42) & 0xFFFFFFFF)
        out[i] = found
    return out


def brute_likeness(a, b):
    if a == b:
        return 1.0
    share = lambda x, y: (sum(p is not None or q is not None for p, q in zip(x, y)), sum(p is not None and p == q for p, q in zip(x, y)))
    levels = [share(a[k : k + 16], b[k : k + 16]) for k in range(0, 64, 16)]
    best = [equal / used for used, equal in levels if used >= 4]
    used, equal = share(a, b)
    return max(best) if best else equal / used if used else 0.0


def test_imatch_against_brute_force(spark):
    rng = random.Random(15)
    vocabulary = ["w%dé" % i for i in range(300)]
    docs = [(i, ", ".join(rng.choice(vocabulary) for _ in range(rng.randrange(90)))) for i in range(60)] + [(90, None), (91, "__"), (92, "only here")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    words = imatch.lexicon(frame, 0.01, 0.5)
    want = brute_imatch(docs, 0.01, 0.5)
    text = lambda f: "".join("-" if h is None else f"{h:08x}" for h in f)
    got = {r["doc_id"]: r for r in imatch.compare_edited(frame, words, per_bucket=20).collect()}
    ordered = sorted(want, reverse=True)
    for k, i in enumerate(ordered):
        after = want[ordered[(k + 1) % len(ordered)]]
        assert got[i]["fingerprint"] == text(want[i])
        assert got[i]["near_next"] == pytest.approx(brute_likeness(want[i], after))
    named = spark.createDataFrame([(f"id{i:03}", t) for i, t in docs], "doc_id string, text string")
    other = {r["doc_id"]: r for r in imatch.compare_edited(named, words, per_bucket=20).collect()}  # ids of another type
    assert {int(i[2:]): tuple(r)[1:] for i, r in other.items()} == {i: tuple(r)[1:] for i, r in got.items()}


def test_lexicon_band(spark):
    rows = [(i, ("Every " + ("half " if i % 2 else "") + f"only{i}")) for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = spark.sql("select xxhash64('half') as h").first()["h"]
    assert [r["term"] for r in imatch.lexicon(docs, 0.1, 0.6).collect()] == [wanted]


@pytest.mark.parametrize("case", ["outlier", "nulls", "one id", "equal rows"])
def test_imatch_buckets_are_cut_at_row_counts(spark, case):
    ids = {"outlier": [*range(399), 9 * 10**9], "nulls": [None if k % 3 else k for k in range(400)], "one id": [7] * 400}
    docs = [(i, f"text {k}") for k, i in enumerate(ids.get(case, range(100)))]
    docs += [(50, "same")] * 300 if case == "equal rows" else []
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = imatch._in_order(d, 20).cache()
    assert sorted(map(str, docs)) == sorted(str((r["doc_id"], r["text"])) for r in rows.where("real").collect())
    sizes = [r["count"] for r in rows.where("real").groupBy("bucket").count().collect()]
    assert max(sizes) <= 60 and sum(sizes) == 400
    hashes = {r["text"]: r["h"] for r in d.select("text", F.xxhash64("text").alias("h")).collect()}
    order = lambda r: (r[0] is None, -(r[0] or 0), hashes[r[1]])
    ordered = sorted(docs, key=order)
    chain = []
    for _, group in sorted(((b, [r for r in rows.collect() if r["bucket"] == b]) for b in {r["bucket"] for r in rows.collect()})):
        own = sorted(((r["doc_id"], r["text"]) for r in group if r["real"]), key=order)
        after = [(r["doc_id"], r["text"]) for r in group if not r["real"]]
        assert len(after) == 1
        chain.append((own, after[0]))
    assert [x for own, _ in chain for x in own] == ordered
    assert [after for _, after in chain] == [own[0] for own, _ in chain[1:] + chain[:1]]


def test_one_id_with_two_texts(spark):
    a, b, c = ("alpha beta gamma delta epsilon zeta " * 20, "one two three four five six seven " * 20, "red green blue grey pink teal " * 20)
    rows = [(1, a), (5, a), (5, b), (7, b), (2, c), (2, "other words here and there again " * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r["doc_id"], r["text"]) for r in simhash.deduplicate(docs).collect())
    assert kept == sorted([rows[0], rows[2], rows[4], rows[5]])
    prints = [(2, "0" * 16), (2, "f" * 16), (3, "0" * 15 + "1"), (4, "f" * 15 + "e")]
    prints = spark.createDataFrame(prints, "doc_id long, fingerprint string")
    got = {r["fingerprint"]: r["component_id"] for r in simhash.components(prints, simhash.Pigeonhole(4), 4).collect()}
    assert set(got.values()) == {2} and len(got) == 4
    other = spark.createDataFrame([(2, "0" * 16), (2, "f" * 16), (1, "0" * 15 + "1"), (9, "f" * 15 + "e")], "doc_id long, fingerprint string")
    got = {r["fingerprint"][0]: r["component_id"] for r in simhash.components(other, simhash.Pigeonhole(4), 4).collect()}
    assert got == {"0": 1, "f": 2}
