"""Token counts and byte-level BPE against the libraries."""

import array
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from chronopulse.llm import bpe, tokens

BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "abcdefgh   \n\n\t\u00a0\u0301\u0130\x1c\x85ÀéñΣ漢字😀'sStTlL12.,-_"


def texts(n=400, seed=1):
    rng = random.Random(seed)
    some = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(60))) for _ in range(n)]
    return some + ["", " ", "  a", "a  ", "a\n b", "don't we'll", "<|endoftext|> x<|startoftext|>", "ab" * 5000, "\n" * 50, "x" * 3000]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(BPE), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.TextEncoder(bpe.load_ranks(BPE), public_tokenizers.PATTERN, memo=50)


def test_encoding_is_the_library_s(library, encoder):
    decoder = bpe.TokenDecoder(bpe.load_ranks(BPE))
    for t in texts():
        ids = encoder.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(t)
        for chunk in (1, 3, 65536):
            assert "".join(decoder.stream(ids, chunk)) == t
            if len(t) > 1000:
                break


def test_transducer_with_few_states_and_long_pieces():
    ranks, rng = bpe.load_ranks(BPE), random.Random(2)
    small = bpe.BpeTransducer(ranks, max_states=20, max_pairs=30)
    for _ in range(200):
        piece = bytes(rng.choice(b"abcdeinrst\xc3\xa9") for _ in range(rng.randrange(1, 40)))
        whole = ranks.get(piece)
        assert small.encode(piece) == ([whole] if whole is not None else small.merge(piece))
    long = bytes(rng.choice(b"abcdeinrst") for _ in range(20000))
    library = tiktoken.Encoding("x", pat_str=r"[a-z]+", mergeable_ranks=ranks, special_tokens={})
    assert small.encode(long) == library.encode_ordinary(long.decode())


def test_tokens_leave_after_a_bounded_lookahead(monkeypatch):
    transducer, held, emit = bpe.BpeTransducer(bpe.load_ranks(BPE)), [], bpe.BpeTransducer._emit

    def watched(self, last, base, out):
        base = emit(self, last, base, out)
        held.append(len(last) - 1 - base)
        return base

    monkeypatch.setattr(bpe.BpeTransducer, "_emit", watched)
    rng = random.Random(4)
    for letters in ("abcdeinrst", "etaoin", "é漢字ж", "ab"):
        transducer.encode("".join(rng.choice(letters) for _ in range(20000)).encode())
    assert len(held) > 100 and max(held) <= 2 * transducer.longest


def test_utf8_machine_over_every_cut():
    data = "aé漢😀z".encode()
    for cut in range(len(data) + 1):
        machine = bpe.Utf8Decoder()
        assert machine.feed(data[:cut]) + machine.feed(data[cut:]) + machine.finish() == data.decode()
    broken = bpe.Utf8Decoder()
    assert broken.feed(b"\xff\xe6\xbc") + broken.finish() == b"\xff\xe6\xbc".decode("utf-8", "replace")


def test_round_trip_query(spark, library):
    rows = [(1, "Hello wörld"), (2, None), (3, ""), (3, "")]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, n_tokens string")
    got = bpe.round_trip(docs, BPE, public_tokenizers.PATTERN).collect()
    assert len(got) == 4
    for r in got:
        text = r["text"] or ""
        ids = np.array(library.encode_ordinary(text), dtype="<u4").tobytes()
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.round_trip(docs.limit(0), BPE, public_tokenizers.PATTERN).count() == 0
    back = bpe.decode(bpe.encode(docs, BPE, public_tokenizers.PATTERN), BPE)
    assert all(r["decoded"] == (r["text"] or "") for r in back.collect())


def test_counts_are_the_library_s():
    plain = tokens.LibraryEncoder(WORDS)
    every = texts(300)
    assert tokens.TokenCounter(WORDS, memo=100).count(every) == plain.counts(every)


@pytest.mark.parametrize("chunk,overlap", [(16, 1), (16, 8), (64, 4)])
def test_spliced_counts(chunk, overlap):
    plain = tokens.LibraryEncoder(WORDS)
    for t in texts(200, seed=9):
        if len(t) < 4000:
            assert tokens.spliced_count(t, plain.starts, chunk, overlap) == plain.counts([t])[0]


@pytest.mark.parametrize("chunk,overlap", [(16, 1), (64, 4), (32768, 1024)])
def test_byte_level_file_s_counts(chunk, overlap):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = tokens.LibraryEncoder(path)
    assert plain.boundary is tokens._lone_space and tokens.LibraryEncoder(WORDS).boundary is tokens._after_white
    some = [t for t in texts(200, seed=5) if len(t) < 4000] + ["a b  c\n d e\n\n f g " * 3, "  two  spaces  ", "one two three four five six"]
    assert tokens.TokenCounter(path, chunk, overlap).count(some) == plain.counts(some)


def test_boundaries_that_a_file_does_not_prove():
    def file(pattern="[a-z]+", added=(), **split):
        kind = {"type": "Split", "pattern": {"Regex": pattern}, "behavior": "Removed", "invert": True} | split
        return {"added_tokens": list(added), "normalizer": None, "pre_tokenizer": kind}

    token = {"content": "<x>", "lstrip": False, "rstrip": False}
    assert tokens.proven_boundary(file(added=[token])) is tokens._after_white
    assert tokens.proven_boundary(file(r"[^\s\p{L}]+|\p{L}+")) is tokens._after_white
    for other in (r"[^a]+", r"\s?[a-z]+", ".+", "a b", r"\W+"):
        assert tokens.proven_boundary(file(other)) is None
    assert tokens.proven_boundary(file(behavior="Isolated")) is None and tokens.proven_boundary(file(invert=False)) is None
    assert tokens.proven_boundary(file(added=[token | {"content": "a b"}])) is None
    assert tokens.proven_boundary(file(added=[token | {"lstrip": True}])) is None
    assert tokens.proven_boundary(file() | {"normalizer": {"type": "Strip"}}) is None
    assert tokens.proven_boundary({"pre_tokenizer": None}) is None


def test_count_tokens_query(spark):
    rows = [(1, "word " * 3000), (2, None), (3, "é"), (4, "x" * 5000)]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n_bytes int")
    got = {r["doc_id"]: r for r in tokens.count_tokens(docs, WORDS, chunk=1000, overlap=16).collect()}
    plain = tokens.LibraryEncoder(WORDS)
    for i, t in rows:
        n = plain.counts([t or ""])[0]
        assert (got[i]["n_tokens"], got[i]["over_limit"], got[i]["n_bytes"]) == (n, n > 2048, len((t or "").encode()))
    assert tokens.count_tokens(docs.limit(0), WORDS).count() == 0


def test_piece_tokenizer():
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    some = ["Hello there", " two  spaces", "", "é\n漢"]
    assert tokens.TokenCounter(path).count(some) == [len(library.encode(t)) for t in some]


@pytest.mark.parametrize("pattern", [r"\S+ \S+|\s+|\S+", r"[^\n]+|\n+", r"(\w)+|.|\n", r"\S+(?= x)|\s+|\S+|\S", r"\w+|\W"])
def test_patterns_of_all_kinds(pattern):
    """Patterns that do not prove that a space starts a match encode whole texts, as the library does."""
    import regex

    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoder = bpe.TextEncoder(ranks, pattern)
    one = tiktoken.Encoding("one", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
    for text in ["one two three", "a  b c", " x y", "don't stop\nnow or then", "", "caf\u00e9 au lait x y x"]:
        want = [i for m in regex.finditer(pattern, text) for i in one.encode_ordinary(m[0])]
        got = array.array("I", encoder.encode(text)).tolist()
        assert got == want
    assert bpe.space_starts_match(public_tokenizers.PATTERN) and bpe.space_starts_match(pattern) == (pattern == r"\w+|\W")
