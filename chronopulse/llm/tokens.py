"""Token counts of whole texts by a public tokenizer, with bounded memory for huge documents.

A document of more than a chunk is encoded in chunks. Chunks overlap; two neighbours are spliced at a common boundary
in the overlap: a place where tokens start in both encodings and that is proven, by what the tokenizer's file says of
its splitting, to be a boundary whatever stands around it. If the overlap holds no such place, it is widened until it
does or the text ends. Of a file that allows no such proof, texts are counted whole.

Where the file proves that white space is dropped, the counts of stretches between white space don't depend on each
other; those of shorter documents are remembered (a bounded number), and most text is not encoded again.
"""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_left
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Recent, append_columns

#: White space in the sense of every regular expression library and of str.isspace.
_WHITE = " \n"


def _after_white(text: str, at: int) -> bool:
    """Where white space is dropped: tokens on its two sides are independent."""
    return text[at - 1] in _WHITE


def _lone_space(text: str, at: int) -> bool:
    """Where matches hold white space in front of a word at most: a space between other characters starts a match."""
    return text[at] == " " and at + 1 < len(text) and not text[at - 1].isspace() and not text[at + 1].isspace()


def proven_boundary(described: dict):
    """The rule for boundaries that a tokenizer's description (the parsed .json file) proves; None if it proves none.

    White space is dropped if a first Split keeps only matches of a pattern that has no way to match white space: no
    wildcard, no space and no class of white space but in a negated set. Byte-level splitting by its own pattern
    starts a match at every space between two other characters. Added tokens that hold or strip white space, a prefix
    space, and normalizers other than composition, lower-casing and white space to a space prove nothing.
    """
    if any(t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) for t in described.get("added_tokens", [])):
        return None
    normal = described.get("normalizer")
    normal = [] if normal is None else normal.get("normalizers", [normal])
    harmless = [n["type"] in ("NFC", "Lowercase") or n["type"] == "Replace" and n["pattern"] == {"Regex": r"\s+"} and n["content"] == " " for n in normal]
    split = described.get("pre_tokenizer") or {}
    first = (split.get("pretokenizers") or [split])[0]
    if not all(harmless) or first.get("add_prefix_space"):
        return None
    if first.get("type") == "ByteLevel" and first["use_regex"] and not normal:
        return _lone_space
    if first.get("type") == "Split" and first["behavior"] == "Removed" and first["invert"]:
        pattern = re.sub(r"\[\^[^\]]*\\s[^\]]*\]", "", first["pattern"].get("Regex", "."))
        return None if re.search(r"\\[sSWDPhvRXn]|[.\s]|\[\^", pattern) else _after_white
    return None


class LibraryEncoder:
    """Counts and token starts by the library that a vocabulary file belongs to: tokenizers (.json)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.boundary = proven_boundary(json.loads(self.library.to_str()))

    def counts(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def starts(self, text: str) -> list[int]:
        """Code point at which each token starts."""
        return [a for a, _ in self.library.encode(text, add_special_tokens=False).offsets]


class PieceEncoder:
    """Counts by sentencepiece (.model). Its spacing depends on the text's start, so texts are counted whole."""

    boundary = None

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_file=path)

    def counts(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.library.encode(texts, num_threads=1)]


def spliced_count(text: str, starts, chunk: int, overlap: int, boundary=_after_white) -> int:
    """Number of tokens of a text, encoded in overlapping chunks of about `chunk` code points.

    starts: a function from a text to the code points at which its tokens start; boundary: tells whether a code point
    of a text is a boundary that is proven.
    """
    begin, end = 0, min(len(text), chunk + overlap)
    total, left = 0, starts(text[:end])
    while end < len(text):
        cut, wide = end - overlap, overlap
        while True:  # the right neighbour begins at the cut; both know the text from the cut to the end of the left one
            stop = min(len(text), cut + chunk + wide)
            right = starts(text[cut:stop])
            splice = _common_boundary(text, begin, left, cut, right, end, boundary)
            if splice is not None or end == len(text):
                break
            wide *= 2  # no proven boundary: widen the overlap to the right
            end = min(len(text), cut + wide)
            left = starts(text[begin:end])
        if splice is None:
            return total + len(left)
        total += bisect_left(left, splice - begin)
        k = bisect_left(right, splice - cut)
        left = [s + cut - splice for s in right[k:]]
        begin, end = splice, stop
    return total + len(left)


def _common_boundary(text: str, begin: int, left: list[int], cut: int, right: list[int], end: int, boundary) -> int | None:
    """The first proven boundary after the cut at which both encodings start a token."""
    ours = {s + begin for s in left[bisect_left(left, cut + 1 - begin) :]}
    for s in right:
        at = s + cut
        if at >= end:
            break
        if at > cut and at in ours and boundary(text, at):
            return at
    return None


class TokenCounter:
    """Counts of whole texts; remembers the counts of `memo` stretches at most."""

    def __init__(self, path: str, chunk: int = 32768, overlap: int = 1024, memo: int = 400_000):
        self.encoder = PieceEncoder(path) if path.endswith(".model") else LibraryEncoder(path)
        self.chunk, self.overlap, self.memo = chunk, overlap, Recent(memo)

    def count(self, texts: list[str]) -> list[int]:
        boundary = self.encoder.boundary
        if boundary is None:
            return self.encoder.counts(texts)
        out = []
        for text in texts:
            if len(text) > self.chunk:
                out.append(spliced_count(text, self.encoder.starts, self.chunk, self.overlap, boundary))
            elif boundary is _after_white:
                out.append(self._remembered(text))
            else:
                out += self.encoder.counts([text])
        return out

    def _remembered(self, text: str) -> int:
        stretches = text.replace("\n", " ").split(" ")
        found, missing = self.memo.look(stretches)
        if missing:
            self.memo.update(zip(missing, self.encoder.counts(missing), strict=True))
            found = [self.memo.new[s] if f is None else f for s, f in zip(stretches, found, strict=True)]
        return sum(found)


@lru_cache(maxsize=2)
def _counter(path: str, chunk: int, overlap: int) -> TokenCounter:
    """One counter a worker process: what it has learnt serves all tasks that the process runs."""
    return TokenCounter(path, chunk, overlap)


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = 2048,
    text_col: str = "text",
    chunk: int = 32768,
    overlap: int = 1024,
) -> DataFrame:
    """docs with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit).

    Counts are those of the library for the whole text, without begin, end or added special tokens; special strings
    inside texts are handled as the library does by default. Null and empty texts have no bytes and no tokens. Columns
    of these names are replaced; repeated rows stay; no shuffle. The file is read once a worker process, at a path that
    all machines have. Texts of more than `chunk` code points are spliced, with `overlap` to begin with; a .model
    tokenizer, whose spacing depends on the start of the text, and a file that proves no boundary count texts whole.
    """

    def make():
        counter = _counter(tokenizer_path, chunk, overlap)
        return lambda texts: [pa.array(counter.count(texts), pa.int64())]

    counted = append_columns(docs, text_col, make, "n_tokens bigint")
    n_bytes = F.octet_length(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).cast("bigint")
    return counted.withColumns({"n_bytes": n_bytes, "over_limit": F.col("n_tokens") > limit})
