"""Decontamination, licenses, classifiers, chats, urls."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronopulse.llm import chat, decontam, licenses, quality, toxicity, urls
from chronopulse.llm.linear import FtrlProximal, sigmoid, train_sample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_scan(docs, items, size):
    out = {}
    for doc, text in docs:
        w = plain_words(text)
        hit, found = set(), set()
        for item, other in items:
            v = plain_words(other)
            n = min(size, len(v))
            for k in range(len(v) - n + 1) if v else ():
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == v[k : k + n]:
                        hit |= set(range(j, j + n))
                        found.add(str(item))
        out[doc] = (len(w), len(hit), sorted(found))
    return out


@pytest.fixture(scope="module")
def passages():
    rng = random.Random(4)
    word = lambda: rng.choice(["A", "be", "Cé", "d1", "Ω", "x", "yy", "z-z"])
    items = [(k, " ".join(word() for _ in range(rng.choice([1, 3, 12, 15])))) for k in range(12)] + [(20, ""), (21, None), (3, "a b")]
    docs = [(k, ", ".join(word() for _ in range(40))) for k in range(30)] + [(50, items[2][1].upper()), (51, None), (52, ""), (53, "!!")]
    return docs, items


@pytest.mark.parametrize("block_chars", [10**9, 60])
def test_decontamination_against_brute_force(spark, passages, block_chars):
    docs, items = passages
    d = spark.createDataFrame([(i, t, "c") for i, t in docs], "doc_id long, text string, items string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], list(r["items"])) for r in decontam.scan(d, b, 5, block_chars=block_chars).collect()}
    assert got == brute_scan(docs, items, 5)


def test_decontamination_removes_passages_only(spark):
    item = "one two three four five six seven eight nine ten eleven"
    docs = [(1, f"Keep this. {item.title()}! And this é."), (2, "nothing here"), (3, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(7, item)], "item_id long, text string")
    cleaned = {r["doc_id"]: r["text"] for r in decontam.decontaminate(d, b).collect()}
    assert cleaned == {1: "Keep this. ! And this é.", 2: "nothing here", 3: None}
    assert {r["doc_id"] for r in decontam.decontaminate(d, b, mode="documents").collect()} == {2, 3}
    assert decontam.scan(d, b.limit(0)).agg(F.sum("n_hit")).first()[0] == 0
    assert decontam.scan(d.limit(0), b).count() == 0


def test_license_scan(spark):
    mit = licenses.TEMPLATES["mit-grant"]
    broken = mit.replace("free of charge", "free of all charge").replace("obtaining", "who obtains")
    docs = [(1, "Some code. Released under the MIT License. More."), (2, "x " * 500 + broken), (3, None), (4, "The license of MIT"), (5, "")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc_id"], r["template"]): r for r in licenses.matches(d).collect()}
    assert set(got) == {(1, "mit"), (2, "mit-grant")}
    r = got[1, "mit"]
    assert docs[0][1][r["start"] : r["stop"]] == "Released under the MIT License" and r["coverage"] == 1.0
    assert 0.8 <= got[2, "mit-grant"]["coverage"] < 1
    assert licenses.matches(d.limit(0)).count() == 0


def brute_align(template, found, shift, band):
    table = {}

    def best(i, j):
        if i < 0 or j < 0:
            return 0
        if (i, j) not in table:
            hit = template[i] == found[j] and abs(j - i - shift) <= band
            table[i, j] = max(best(i - 1, j), best(i, j - 1), best(i - 1, j - 1) + 1 if hit else 0)
        return table[i, j]

    return best(len(template) - 1, len(found) - 1)


def test_banded_alignment_against_brute_force():
    rng = random.Random(8)
    for _ in range(200):
        a = [rng.choice("abcd") for _ in range(rng.randrange(1, 12))]
        b = [rng.choice("abcd") for _ in range(rng.randrange(1, 14))]
        shift, band = rng.randrange(-3, 4), rng.randrange(0, 4)
        n, first, last = licenses.align(a, b, shift, band)
        assert n == brute_align(a, b, shift, band)
        assert n == 0 or 0 <= first < last <= len(b)


def test_winnowing_keeps_one_of_every_window():
    rng = random.Random(2)
    hashes = [rng.randrange(20) for _ in range(100)]
    kept = set(licenses.winnow(hashes, 4))
    assert all(kept & set(range(k, k + 4)) for k in range(97)) and licenses.winnow([], 4) == [] and licenses.winnow([3], 4) == [0]


def kept_shingles(template, index, size=3, window=4):
    """The template's fingerprints as word triples: of every four in a row the one of least hash, the last of equals."""
    triples = [tuple(template[k : k + size]) for k in range(len(template) - size + 1)]
    h = index._shingles(np.array([index.numbers[w] for w in template], dtype=np.uint64)).tolist()
    return {triples[max(range(k, k + window), key=lambda j: (-h[j], j))] for k in range(len(h) - window + 1)}


def brute_notices(text, templates=licenses.TEMPLATES, band=8, least=0.8):
    """Alignment at every position of what shares a fingerprint; the best match first, then the best one in the words
    that are left."""
    found, out, index = licenses.words(text), set(), licenses.LicenseIndex(templates, licenses.LicenseConfig())
    there = {tuple(found[k : k + 3]) for k in range(len(found))}
    for name, body in templates.items():
        template, free = licenses.words(body), [(0, len(found))]
        if len(template) >= 16 and not kept_shingles(template, index) & there:
            continue
        while True:
            best = (0, 0, 0)
            for a, b in free:
                for shift in range(a - len(template) - band, b + band + 1):
                    n, first, last = licenses.align(template, found[a:b], shift - a, band)
                    best = max(best, (n, a + first, -(a + last)))
            n, first, last = best[0], best[1], -best[2]
            if n / len(template) < least:
                break
            out.add((name, first, last, n))
            free = [x for a, b in free for x in ([(a, first), (last, b)] if a <= first < b else [(a, b)]) if x[0] < x[1]]
    return out


def test_every_notice_against_brute_force(spark):
    rng, t = random.Random(5), licenses.TEMPLATES
    texts = [" ".join([t[k]] * n) for k, n in (("mit", 7), ("cc-by-nc-4.0", 6), ("apache-2.0", 5), ("gpl-3.0", 3))]
    texts += ["Released under an MIT License", "Released under a the MIT License.", " ".join([t["mit"], t["cc-by-nc-4.0"]] * 4)]
    for name in ("mit", "mit", "mit", "apache-2.0", "cc-by-nc-4.0", "gpl-3.0", "gpl-3.0", "bsd-redistribution"):
        w = [w for _ in range(rng.randrange(1, 4)) for w in t[name].split()]
        for _ in range(len(w) // 5 + 1):
            k = rng.randrange(len(w))
            w[k : k + rng.randrange(2)] = [rng.choice(["the", "x", "License"])]
        texts.append(" ".join(w))
    every_third = [x for k, w in enumerate(t["bsd-redistribution"].split()) for x in ([w, "y"] if k % 3 == 1 else [w])]
    texts += [" ".join(every_third), "a b " * 9 + t["mit"] + " c" * 9]
    got = {}
    for r in licenses.matches(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), templates=t).collect():
        first = len(licenses.words(texts[r["doc_id"]][: r["start"]]))
        last = len(licenses.words(texts[r["doc_id"]][: r["stop"]]))
        assert (r["template"], first, last, r["matched"]) not in got.setdefault(r["doc_id"], set())
        got[r["doc_id"]].add((r["template"], first, last, r["matched"]))
    for k, text in enumerate(texts):
        assert got.get(k, set()) == brute_notices(text), text
    count = lambda k, name: sum(m[0] == name for m in got[k])
    assert (count(0, "mit"), count(1, "cc-by-nc-4.0"), count(2, "apache-2.0"), count(4, "mit")) == (7, 6, 5, 1)


def test_full_license_texts(spark):
    """Whole texts with edits, cut off, and next to each other; a text of which every second word differs is none."""
    rng, t = random.Random(3), licenses.FULL_TEXTS
    edited = t["mit-text"].split()
    for _ in range(12):
        edited[rng.randrange(len(edited))] = "changed"
    texts = [t["mit-text"] + " " + t["isc-text"], "x " * 900 + " ".join(edited) + " y" * 9, t["zlib-text"][: len(t["zlib-text"]) // 2]]
    texts += [" ".join(w if k % 2 else f"w{k}" for k, w in enumerate(t["bsd-2-clause-text"].split())), t["bsd-2-clause-text"].upper().replace(",", " ,")]
    rows = spark.createDataFrame([(k, x, 1) for k, x in enumerate(texts)], "`the id` long, text string, licenses int")
    got = {}
    for r in licenses.matches(rows, "the id", templates=t).collect():
        got.setdefault(r["doc_id"], []).append((r["template"], r["coverage"]))
    assert sorted(got[0]) == [("isc-text", 1.0), ("mit-text", 1.0)] and 2 not in got and 3 not in got
    assert got[1][0][0] == "mit-text" and 0.9 < got[1][0][1] < 1 and got[4] == [("bsd-2-clause-text", 1.0)]
    many = t | {f"other-{k}": " ".join(f"o{k}w{j}" for j in range(200)) for k in range(300)}
    index = licenses.LicenseIndex(many, licenses.LicenseConfig())
    assert set(index.candidates(licenses.words(texts[0]))) <= set(t)  # only what shares a fingerprint is looked at


@pytest.mark.parametrize("ids", ["null", "equal", "distinct"])
def test_benchmark_blocks_are_bounded_whatever_the_ids(spark, ids):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    items = [({"null": None if k % 2 else k, "equal": 7, "distinct": k}[ids], " ".join(word() for _ in range(rng.choice([4, 60, 900])))) for k in range(60)]
    docs = [(k, " ".join(items[k][1].split()[:25]) + " zz " + " ".join(items[-1 - k][1].split()[-12:])) for k in range(20)]
    b, d = spark.createDataFrame(items, "item_id long, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    blocks = decontam.benchmark_blocks(b, block_chars=6000)
    sizes = [sum(len(r["text"]) for r in block.collect()) for block in blocks]
    assert len(blocks) > 10 and max(sizes) <= 6000
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], list(r["items"])) for r in decontam.scan(d, b, block_chars=6000).collect()}
    want = {k: (n, hit, [i for i in found if i != "None"]) for k, (n, hit, found) in brute_scan(docs, items, 10).items()}
    assert got == want


def test_ftrl_separates():
    rng = np.random.default_rng(0)
    rows = [(np.array([k % 2, 2 + k % 5]), np.array([1.0, 1.0])) for k in range(400)]
    labels = [k % 2 for k in range(400)]
    w = FtrlProximal(8, l1=0.01).fit(rows, labels, 3)
    scores = [sigmoid(w[i] @ v + w[-1]) for i, v in rows]
    assert all((s > 0.5) == bool(y) for s, y in zip(scores, labels)) and rng is not None


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(11)
    good = ["the", "and", "river", "stone", "walks", "light", "over", "under", "garden", "slow"]
    docs, labels = [], []
    for i in range(240):
        bad, mean = i % 4 == 0, i % 3 == 0
        words = [rng.choice(good) for _ in range(60)]
        if mean:
            words[10] = words[40] = "scoundrel"
        text = " ".join(w.upper() + "!!" for w in words) if bad else " ".join(words)
        docs.append((i, text, "s"))
        labels.append((i, 0 if bad else 1, int(mean)))
    docs += [(1000, None, "s"), (1001, "", "s"), (1001, "", "s")]
    labels += [(1000, 1, 0), (2000, 1, 1), (None, 1, 1), (5, None, None)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, score string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_classifier_on_held_out_rows(spark, corpus, module, label):
    docs, labels = corpus
    weights = module.fit(docs, labels, lambda c: ~module.held_out(c))
    scored = module.score(docs, weights).select("doc_id", "score", "predicted", module.held_out(F.col("doc_id")).alias("held"))
    assert scored.count() == docs.count()
    rows = scored.join(labels.where(f"{label} is not null"), "doc_id").where("held and doc_id < 1000").collect()
    assert len(rows) > 30 and np.mean([r["predicted"] == r[label] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in scored.collect())
    again = module.fit(docs.repartition(7), labels.repartition(3), lambda c: ~module.held_out(c))
    assert np.array_equal(weights, again)  # the result does not depend on the order of rows
    empty = module.fit(docs, labels.limit(0))
    assert not empty.any() and module.score(docs.limit(0), empty).count() == 0


def tree_rows():
    # conversation 1: a root with two branches, one of which forks; 2: missing parent; 3: a cycle only
    return [
        (1, 10, None, "system", "Be </s> kind", 1.0),
        (1, 11, 10, "user", "[INST] <\\s> hi", 2.0),
        (1, 12, 11, "assistant", "yes [/OUT]", 5.0),
        (1, 13, 11, "assistant", None, 0.0),
        (1, 14, 12, "a]b ü", "more", None),
        (2, 1, 99, None, "alone", 1.0),
        (3, 1, 2, "user", "x", 1.0),
        (3, 2, 1, "user", "y", 1.0),
    ]


SCHEMA = "tree_id long, message_id long, parent_id long, role string, text string, score double"


@pytest.mark.parametrize("module,label,modulus,rest,least", [(quality, "quality", 4, 2, 0.9), (toxicity, "toxic", 5, 0, 0.75)])
def test_held_out_rows_of_the_supplied_labels(spark, module, label, modulus, rest, least):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.join(labels, "doc_id").select("doc_id", "text", label)
    weights = module.fit(docs, labels, lambda c: ~module.held_out(c))
    rows = [r for r in module.score(docs, weights).collect() if zlib.crc32(str(r["doc_id"]).encode()) % modulus == rest]
    hits = sum(r["predicted"] for r in rows if r[label] == 1)
    false = sum(r["predicted"] for r in rows if r[label] == 0)
    assert hits >= least * sum(r[label] for r in rows) and false <= 0.02 * len(rows)


def test_scores_against_brute_force(spark, corpus):
    """A score is the logistic function of a sum over the text's n-grams, counted one by one."""
    docs, labels = corpus[:2]
    config = toxicity.ToxicityConfig()
    weights = toxicity.fit(docs, labels).astype("<f4").astype(float)
    mask = (1 << 32) - 1

    def slow(text):
        codes, found = [ord(c) for c in f" {text.lower()} "], Counter()
        for n in config.orders:
            for k in range(len(codes) - n + 1):
                gram = codes[k]
                for c in codes[k + 1 : k + n]:
                    gram = (gram * 0x01000193 + c) & mask
                found[((gram ^ gram >> 15 ^ n) * 0x9E3779B1 & mask) >> 32 - config.bits] += 1
        norm = np.sqrt(sum(np.log1p(v) ** 2 for v in found.values()))
        return float(sigmoid(sum(weights[i] * np.log1p(v) for i, v in found.items()) / (norm or 1) + weights[-1]))

    for r in toxicity.score(docs.limit(40), weights).collect():
        assert r["score"] == pytest.approx(slow(r["text"] or ""), abs=1e-6)


def test_filters_keep_columns_that_clash(spark, corpus):
    docs, labels = corpus[:2]
    clash = docs.select("doc_id", "text", F.lit("mine").alias("score"), F.lit(7).alias("predicted"), F.lit("a").alias("items"), F.lit("b").alias("runs"), F.lit("c").alias("n_hit"), F.lit("d").alias("row"))
    benchmark = spark.createDataFrame([(1, "never there at all")], "item_id long, text string")
    for kept in (
        quality.keep_good(clash, quality.fit(docs, labels), quality.QualityConfig(threshold=0.0)),
        toxicity.keep_harmless(clash, toxicity.fit(docs, labels), toxicity.ToxicityConfig(threshold=2.0)),
        decontam.decontaminate(clash, benchmark),
        decontam.decontaminate(clash, benchmark, mode="documents"),
    ):
        assert kept.schema == clash.schema and sorted(map(str, kept.collect())) == sorted(map(str, clash.collect()))


def test_sample_is_bounded_by_ids(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, "c"), (None, "d"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 1), (None, 1)], "doc_id long, quality int")
    sample = train_sample(docs, labels, "quality", lambda c: c.isNotNull(), 10)
    assert sorted(map(tuple, sample.select("doc_id", "text", "label").collect())) == [(1, "a", 1), (2, "c", 0)]


def test_item_without_id_hits_but_is_not_named(spark):
    docs = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(None, "two three"), (5, "one two"), (6, "")], "item_id long, text string")
    r = decontam.scan(docs, benchmark).first()
    assert (r["n_hit"], list(r["items"])) == (3, ["5"])


def test_reply_trees(spark):
    messages = spark.createDataFrame(tree_rows(), SCHEMA)
    out = chat.format_chats(messages).withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.read_loss(F.col("formatted"), F.col("loss_spans")))
    got = {(r["tree_id"], r["leaf"]): r for r in out.collect()}
    assert set(got) == {(1, 13), (1, 14), (2, 1)}
    long = got[1, 14]
    assert [(t["role"], t["text"]) for t in long["turns"]] == [("system", "Be </s> kind"), ("user", "[INST] <\\s> hi"), ("assistant", "yes [/OUT]"), ("a]b ü", "more")]
    assert long["loss"] == "yes [/OUT]" and long["rank"] == 1 and got[1, 13]["rank"] == 2 and got[1, 13]["loss"] == ""
    assert [(t["role"], t["text"]) for t in got[2, 1]["turns"]] == [("", "alone")]
    best = {(r["tree_id"], r["leaf"]) for r in chat.format_chats(messages, best=1).collect()}
    assert best == {(1, 14), (2, 1)}
    assert chat.format_chats(messages.limit(0)).count() == 0


def test_escapes_are_reversible(spark):
    rng = random.Random(6)
    parts = ["[", "<", "\\", "/", "INST]", "SYS", "OUT]", "TURN ", "s>", "x", "\n", "]", "é"]
    rows = [("".join(rng.choice(parts) for _ in range(rng.randrange(12))),) for _ in range(500)]
    frame = spark.createDataFrame(rows, "t string")
    e = chat.escape(F.col("t"))
    bad = frame.select("t", e.alias("e"), chat.unescape(e).alias("u")).where("t <> u or e rlike '[\\\\[<]/?(INST|SYS|OUT|TURN|s>)'")
    assert bad.count() == 0


def test_linear_conversations(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 5, "assistant", None), (1, 2, None, "q")], "conv_id long, turn long, role string, text string")
    r = chat.digest(chat.format_chats(chat.linear_messages(turns))).first()
    assert r["n_turns"] == 4 and [t["role"] for t in r["turns"]] == ["user", "user", "", "assistant"]
    deep = spark.range(100).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    r = chat.digest(chat.format_chats(chat.linear_messages(deep))).first()
    assert [t["text"] for t in r["turns"]] == [str(i) for i in range(100)]


URLS = [
    ("HTTP://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("https://example.net/fr/x", "example.net", "/fr/x", "net/", "block"),
    ("https://notexample.com/de/1", "notexample.com", "/de/1", None, "allow"),
    ("https://x.org/fr/", "x.org", "/fr/", "org/fr/", "allow"),
    ("https://x.net", "x.net", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("a://b?c=/net/", "b", "", None, "allow"),
]


def test_url_rules(spark):
    pages = spark.createDataFrame([(k, u[0], "clash") for k, u in enumerate(URLS)], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge(pages).collect()}
    assert got == {k: u[1:] for k, u in enumerate(URLS)}
    assert urls.judge(pages.limit(0)).count() == 0


def test_url_templates(spark):
    bad = [(f"http://h.io/shop/{i}/buy", 1) for i in range(12)]
    good = [(f"http://h.io/blog/{i}/read", 0) for i in range(12)] + [(f"http://h.io/{k}/about", 0) for k in ("a", "b", "c") for _ in range(4)]
    labels = spark.createDataFrame(bad + good, "url string, label int")
    pages = spark.createDataFrame(
        [(1, "http://h.io/shop/999/buy"), (2, "http://h.io/blog/999/read"), (3, "http://h.io/shop/999/look"), (4, "http://h.io/a/about"), (5, "http://i.io/shop/9/buy")],
        "page_id long, url string",
    )
    got = {r["page_id"]: r["verdict"] for r in urls.judge(pages, labels=labels).collect()}
    assert got == {1: "block", 2: "allow", 3: "allow", 4: "allow", 5: "allow"}
    known = labels.select(urls.host_of(F.col("url")).alias("host"), urls.path_of(F.col("url")).alias("path"), "label")
    tree = {tuple(r["raw"]): tuple(r["template"]) for r in urls.templates(known).collect()}
    assert tree["a", "about"] == ("*", "about") == tree["c", "about"] and tree["shop", "*", "buy"] == ("shop", "*", "buy")
    many = spark.createDataFrame([("h", f"/u/name{i}/x", None) for i in range(50)], "host string, path string, label int")
    assert {tuple(r["template"]) for r in urls.templates(many).collect()} == {("u", "*", "x")}


def test_urls_without_labels_join_siblings_or_inherit(spark):
    bad = [(f"http://h.io/{k}/about", 1) for k in ("a", "b", "c") for _ in range(4)] + [("http://h.io/d/1/x", 1)] * 4
    one = [("http://i.io/shop/1", 1)] * 12  # one labelled branch does not tell how others are
    labels = spark.createDataFrame(bad + one + [("http://j.io/a/1", 0)] * 12, "url string, label int")
    pages = [(1, "http://h.io/z/about"), (2, "http://h.io/q"), (3, "http://h.io/d/2/y"), (4, "http://i.io/blog/1"), (5, "http://j.io/b/1")]
    pages = spark.createDataFrame(pages, "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in urls.judge(pages, labels=labels).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow"}


def test_rules_as_labels_decide_urls_without_rule(spark):
    rules = (urls.Rule("block", "h.io", "/a/"), urls.Rule("block", "h.io", "/b/"), urls.Rule("allow", "i.io", "/a/"))
    pages = [f"http://{h}.io/{s}/{k}" for h in "hi" for s in "abc" for k in range(8)]
    pages = spark.createDataFrame(list(enumerate(pages)), "page_id long, url string")
    got = {(r["host"], r["verdict"]) for r in urls.judge(pages, rules=rules).where("rule is null").collect()}
    assert got == {("h.io", "block"), ("i.io", "allow")}


def brute_templates(count, config):
    """(host, raw) -> template, for (host, raw) -> (labelled, blocked)."""
    final = {k: list(k[1]) for k in count}
    for level in range(max(len(r) for _, r in count)):
        children = {}
        for (host, _), t in final.items():
            if len(t) > level and t[level] != "*":
                children.setdefault((host, *t[:level]), set()).add(t[level])
        for (host, _), t in final.items():
            if len(t) > level and t[level] != "*" and len(children[host, *t[:level]]) > config.most_children:
                t[level] = "*"
    for level in reversed(range(max(len(r) for _, r in count))):
        shares = {}
        for k, t in final.items():
            if len(t) > level:
                n, b = shares.setdefault((k[0], *t[:level], None, *t[level + 1 :]), {}).get(t[level], (0, 0))
                shares[k[0], *t[:level], None, *t[level + 1 :]][t[level]] = (n + count[k][0], b + count[k][1])
        names = {}
        for where, branches in shares.items():
            groups = []
            for share, child, n, b in sorted((b / n, c, n, b) for c, (n, b) in branches.items() if n):
                if groups:
                    m, a, members = groups[-1]
                    pooled = (a + b) / (m + n)
                    expected = [m * pooled, m * (1 - pooled), n * pooled, n * (1 - pooled)]
                    got = [a, m - a, b, n - b]
                    if sum((x - e) ** 2 / e for x, e in zip(got, expected) if e) <= config.chi_square + 1e-9:
                        groups[-1] = (m + n, a + b, [*members, child])
                        continue
                groups.append((n, b, [child]))
            for _, _, members in groups:
                if len(members) > 1:
                    star = "*" if len(groups) == 1 or "*" in members else "*" + members[0]
                    names |= {(where, c): star for c in (branches if len(groups) == 1 else members) if c in members or not branches[c][0]}
        for k, t in final.items():
            if len(t) > level:
                t[level] = names.get(((k[0], *t[:level], None, *t[level + 1 :]), t[level]), t[level])
    return final


def brute_tree(rows, config):
    """(host, raw) -> template, basis, level, n, blocked, rejected; rows: (host, raw segments, label), no path too deep."""
    count, whole = {}, {}
    suffixes = lambda host: [*(".".join(host.split(".")[k:]) for k in range(1, host.count(".") + 1)), ""]
    for host, raw, label in rows:
        for found, key in ((count, (host, raw)), *((whole, (s, raw)) for s in suffixes(host))):
            n, b = found.get(key, (0, 0))
            found[key] = (n + (label is not None), b + (label or 0))
    final, every = brute_templates(count, config), brute_templates(whole, config)
    total, out = {}, {}
    for k, t in final.items():
        n, b = total.get((k[0], *t), (0, 0))
        total[k[0], *t] = (n + count[k][0], b + count[k][1])
    prior = sum(b for _, b in total.values()) / max(1, sum(n for n, _ in total.values()))

    def inherited(host, raw, t):
        branch = lambda raw, length: raw[length] if len(raw) > length else ""
        for length in range(len(t), -1, -1):
            under = [(r, c) for (h, r), c in count.items() if h == host and final[h, r][:length] == t[:length] and c[0]]
            if len({branch(r, length) for r, _ in under}) > 1:
                return sum(c[0] for _, c in under), sum(c[1] for _, c in under), "host", length
        for s in suffixes(host):
            there = every[s, raw]
            for length in range(len(there), -1 if s else 0, -1):
                under = [(h, r, c) for (h, r), c in count.items() if s in suffixes(h) and every[s, r][:length] == there[:length] and c[0]]
                if len({h for h, _, _ in under}) > 1 and (length or len({branch(r, 0) for _, r, _ in under}) > 1):
                    return sum(c[0] for *_, c in under), sum(c[1] for *_, c in under), "suffix" if s else "hosts", length
        return 0, 0, "none", None

    for k, t in final.items():
        (n, b), basis, level = total[k[0], *t], "own", len(t)
        if not n:
            n, b, basis, level = inherited(*k, t)
        purity = (b + config.prior_weight * prior) / (n + config.prior_weight)
        out[k] = (tuple(t), basis, level, n, b, purity >= config.purity and n >= config.least_labelled)
    return out


def test_template_tree_against_brute_force(spark):
    rng, config = random.Random(12), urls.TreeConfig(most_children=6)
    rows = []
    for _ in range(700):
        host = rng.choice(["a.x.io", "b.x.io", "c.x.io", "d.io", "e.net", "io"])
        path = [rng.choice("pqrs")] + [rng.choice(["x", "y", "z", str(rng.randrange(99))]) for _ in range(rng.randrange(3))]
        if rng.random() < 0.1:
            path.append(rng.choice("abcdefghijk"))
        chance = {"p": 0.95, "q": 0.9, "r": 0.1, "s": 0.5}[path[0]]
        label = int(rng.random() < chance) if host in "a.x.io b.x.io" and rng.random() < 0.6 else None
        path[0] = "t" if host == "e.net" and rng.random() < 0.2 else path[0]
        rows.append((host, "/" + "/".join(path), label))
    table = spark.createDataFrame(rows, "host string, path string, label int").repartition(3)
    found = urls.templates(table, config).collect()
    want = brute_tree([(h, tuple("*" if x.isdigit() else x for x in p[1:].split("/")), x) for h, p, x in rows], config)
    got = {(r["host"], tuple(r["raw"])): (tuple(r["template"]), r["basis"], r["level"], r["n"], r["blocked"], r["rejected"]) for r in found}
    assert got == want and len(found) == len(want)
    assert {x[1] for x in want.values()} == {"own", "host", "suffix", "hosts", "none"} and {x[5] for x in want.values()} == {True, False}


def test_templates_of_very_deep_paths(spark):
    paths = [("h", "/".join(["", *map(str, range(3000))]), 1), ("h", "/a" * 3000, 0), ("h", "", None), (None, None, 1)]
    table = spark.createDataFrame(paths, "host string, path string, label int")
    found = {len(r["raw"]): r for r in urls.templates(table, urls.TreeConfig(depth=4)).collect()}  # whole paths, told apart
    assert set(found) == {3000, 0} or len(found[3000]["raw"]) == 3000
    assert {len(r["raw"]) for r in urls.templates(table).collect()} == {3000, 0}
    pages = spark.createDataFrame([(1, "http://h" + "/a" * 100000), (1, "http://h" + "/a" * 100000)], "page_id long, url string")
    assert [r["verdict"] for r in urls.judge(pages).collect()] == ["allow", "allow"]


def test_what_decides_the_registered_query(spark):
    """Hosts have rule labels for one language only, so the tree of all hosts' paths decides, as the README says."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = {(r["basis"], r["verdict"]): r["count"] for r in urls.judge(pages).where("rule is null").groupBy("basis", "verdict").count().collect()}
    assert got == {("hosts", "allow"): 1151, ("hosts", "block"): 256}


def test_verdicts_agree_with_hidden_rules(spark):
    """Hosts whose rule labels are hidden are judged by related hosts as the rules judge them."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    split = pages.select(urls.host_of(F.col("url")).alias("host"), urls.path_of(F.col("url")).alias("path"))
    _, verdict = urls.rule_for(F.col("host"), F.col("path"))
    known = split.withColumn("label", F.when(verdict == "block", 1).when(verdict == "allow", 0))
    got = {r["basis"]: r for r in urls.agreement(known, modulus=2).collect()}
    assert got["suffix"]["n"] > 20 and got["suffix"]["agreeing"] >= 0.95 * got["suffix"]["n"]
