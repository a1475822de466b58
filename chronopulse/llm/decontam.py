"""Benchmark decontamination.

The normalised n-word windows of the benchmark items form a hash set that is broadcast; every document's word windows
are looked up, hits are verified word by word, and the hit words are removed as spans or the documents as a whole.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import append_columns, stored, text_rows

#: Lower-cases A-Z; ASCII other than letters and digits separates words; bytes of other characters are word bytes.
_NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: Largest broadcast: characters of benchmark text in one block, whose index takes about seven bytes each. A larger
#: benchmark is scanned block by block.
BLOCK_CHARS = 8_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> list[bytes]:
    return text.encode().translate(_NORMAL).split()


class WindowIndex:
    """All windows of the items (id, text): `size` consecutive words; an item of fewer, but not none, is one window.

    Words are numbered; the items' numbers lie in one array, windows are places in it, sorted by hash for each length.
    """

    def __init__(self, items: Iterable[tuple[object, str]], size: int = 10):
        self.vocabulary: dict[bytes, int] = {}
        self.ids: list[str | None] = []
        parts, places, at = [np.empty(0, dtype=np.uint32)], defaultdict(list), 0
        for item, text in items:
            codes = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text or "")]
            if codes:
                n, count = min(size, len(codes)), max(1, len(codes) - size + 1)
                places[n].append((at, count, len(self.ids)))
                parts.append(np.array(codes, dtype=np.uint32))
                self.ids.append(None if item is None else str(item))
                at += len(codes)
        self.codes = np.concatenate(parts)
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}  # length -> hashes, places, items
        for n, found in places.items():
            start = np.concatenate([np.arange(a, a + count) for a, count, _ in found])
            owner = np.repeat([k for _, _, k in found], [count for _, count, _ in found])
            h = self._hash(self.codes.astype(np.uint64), n)[start]
            order = np.argsort(h, kind="stable")
            self.windows[n] = h[order], start[order].astype(np.uint32), owner[order].astype(np.uint32)

    @staticmethod
    def _hash(codes: np.ndarray, n: int) -> np.ndarray:
        """A hash of the n codes from each position on."""
        h = np.zeros(len(codes) - n + 1, dtype=np.uint64)
        for k in range(n):
            h = (h ^ codes[k : len(codes) - n + 1 + k]) * _MIX
            h ^= h >> np.uint64(29)
        return h

    def find(self, found: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """A flag for each word (inside an occurrence of a window) and the ids of items with occurring windows.

        An item without an id hits words but is not named.
        """
        hit, items = np.zeros(len(found), dtype=bool), set()
        look = self.vocabulary.get
        codes = np.array([look(w, 0) for w in found], dtype=np.uint32)
        for n, (hashes, places, owners) in self.windows.items():
            if len(codes) < n:
                continue
            seen: dict[bytes, bool] = {}
            # only stretches of n or more benchmark words can hold a window
            unknown = np.concatenate(([-1], np.flatnonzero(codes == 0), [len(codes)]))
            for gap in np.flatnonzero(np.diff(unknown) > n):
                start, stop = unknown[gap] + 1, unknown[gap + 1]
                h = self._hash(codes[start:stop].astype(np.uint64), n)
                first = np.searchsorted(hashes, h)
                for k in np.flatnonzero(hashes[np.minimum(first, len(hashes) - 1)] == h):
                    window = codes[start + k : start + k + n]
                    name = window.tobytes()
                    if name not in seen:  # verified: the words are equal, not only their hashes
                        low, high = first[k], np.searchsorted(hashes, h[k], "right")
                        there = (self.codes[places[low:high, None] + np.arange(n, dtype=np.uint32)] == window).all(axis=1)
                        seen[name] = bool(there.any())
                        items.update(self.ids[o] for o in np.unique(owners[low:high][there]))
                    if seen[name]:
                        hit[start + k : start + k + n] = True
        return hit, items - {None}


def _runs(text: str, hit: np.ndarray) -> list[dict]:
    """Runs of hit words: word numbers first to last (exclusive) and code points start to stop (exclusive)."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))).reshape(-1, 2)
    at = [m.span() for m in _WORD.finditer(text)]
    return [
        {"first": int(a), "last": int(b), "start": at[a][0], "stop": at[b - 1][1]} for a, b in edges
    ]


def _pieces(text: str, size: int, most: int) -> list[str]:
    """The text's words in runs of at most about `most` characters (a window is never divided) that share size - 1
    words, so that every window is in one run; a text of fewer than `size` words, but not none, is one run."""
    found = words(text)
    ends = np.cumsum([len(w) + 1 for w in found])
    out, start = [], 0
    while start < len(found):
        stop = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, "right"))
        stop = min(len(found), max(stop, start + size))
        out.append(b" ".join(found[start:stop]).decode("utf-8", "surrogatepass"))
        if stop == len(found):
            break
        start = stop - size + 1
    return out


def benchmark_blocks(benchmark: DataFrame, id_col="item_id", text_col="text", block_chars: int = BLOCK_CHARS, size: int = 10) -> list[DataFrame]:
    """The benchmark (item_id, text) in blocks of about block_chars characters of text at most.

    A larger benchmark is cut into runs of words of a 32nd of a block, which overlap by a window less a word; distinct
    runs go to blocks by a hash of item and text, two thirds full on average, so that neither long items nor many items
    of one id or none make a block larger.
    """
    items = text_rows(benchmark, id_col, text_col).select(F.col("doc_id").alias("item_id"), "text")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    if total <= block_chars:
        return [items]
    most = max(1, block_chars // 32)

    def make():
        return lambda texts: [pa.array([_pieces(t, size, most) for t in texts], pa.list_(pa.string()))]

    runs = append_columns(items, "text", make, "runs array<string>").select("item_id", F.explode("runs").alias("text")).distinct()
    runs, _ = stored(runs)
    held = runs.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-3 * held // (2 * block_chars)) or 1
    return [runs.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) for k in range(n)]


_RUN = "first:bigint,last:bigint,start:bigint,stop:bigint"
_RUN_TYPE = pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "last", "start", "stop")]))


def _scan(docs: DataFrame, block: DataFrame, size: int, text_col: str, names: tuple[str, str, str]) -> DataFrame:
    rows = ((r["item_id"], r["text"]) for r in block.collect())  # at most a block of stated size
    shared = docs.sparkSession.sparkContext.broadcast(WindowIndex(rows, size))  # unpacked once a worker process

    def make():
        index = shared.value

        def each(texts: list[str]):
            n_words, items, runs = [], [], []
            for t in texts:
                found = words(t)
                hit, ids = index.find(found)
                n_words.append(len(found))
                items.append(sorted(ids))
                runs.append(_runs(t, hit) if hit.any() else [])
            return [pa.array(n_words, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(runs, _RUN_TYPE)]

        return each

    ddl = f"{names[0]} bigint, {names[1]} array<string>, {names[2]} array<struct<{_RUN}>>"
    return append_columns(docs, text_col, make, ddl)


def scan(docs: DataFrame, benchmark: DataFrame, size: int = 10, text_col="text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """docs with n_words, n_hit, items (ids as sorted strings) and runs of hit words (word numbers, code points).

    A window is `size` consecutive words of an item; an item of fewer words, but not none, is one window. Whole texts,
    no shuffle. Null text has no words; an empty benchmark hits nothing; an item given twice counts once; an item with
    a null id hits words but is not named; repeated rows stay; columns of these names are replaced. A benchmark of more
    than block_chars characters is scanned in blocks of about that size, one after the other (see benchmark_blocks);
    runs found by different blocks may overlap.
    """
    out, blocks = docs, benchmark_blocks(benchmark, block_chars=block_chars, size=size)
    for k, block in enumerate(blocks):
        out = _scan(out, block, size, text_col, ("n_words", f"items_{k}", f"runs_{k}"))
    items = F.flatten(F.array(*[F.col(f"items_{k}") for k in range(len(blocks))]))
    runs = F.flatten(F.array(*[F.col(f"runs_{k}") for k in range(len(blocks))]))
    if len(blocks) == 1:
        n_hit = F.aggregate("runs", F.lit(0).cast("bigint"), lambda n, r: n + r["last"] - r["first"])
    else:
        hit_words = F.transform("runs", lambda r: F.sequence(r["first"], r["last"] - 1))
        n_hit = F.size(F.array_distinct(F.flatten(hit_words))).cast("bigint")
    out = out.withColumns({"items": F.array_sort(F.array_distinct(items)), "runs": F.array_sort(runs)})
    return out.withColumn("n_hit", n_hit).drop(*[f"{n}_{k}" for n in ("items", "runs") for k in range(len(blocks))])


def remove_spans(scanned: DataFrame, text_col: str = "text") -> DataFrame:
    """scanned (from scan) with the hit spans cut out of the text; what lies between words stays."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    # code points outside all runs: from the end of one run to the start of the next
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("kept"))
    kept = F.aggregate(
        "runs",
        start,
        lambda s, r: F.struct(
            F.greatest(s["at"], r["stop"]).alias("at"),
            F.concat(
                s["kept"],
                F.substring(text, (s["at"] + 1).cast("int"), F.greatest(r["start"] - s["at"], F.lit(0)).cast("int")),
            ).alias("kept"),
        ),
        lambda s: F.concat(s["kept"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))),
    )
    return scanned.withColumn(text_col, F.when(F.size("runs") > 0, kept).otherwise(F.col(text_col)))


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 10, mode: str = "spans", text_col="text") -> DataFrame:
    """docs without benchmark passages: mode "spans" cuts the hit words out, "documents" drops every document hit.

    All columns of docs stay as they are, but for the text; whatever their names, they do not clash with ours.
    """
    if mode not in ("spans", "documents"):
        raise ValueError(f"mode is spans or documents, not {mode}")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    scanned = scan(docs.select(F.col(f"`{text_col}`").alias("text"), row.alias("row")), benchmark, size)
    left = scanned.where("n_hit = 0") if mode == "documents" else remove_spans(scanned)
    return left.select(*[(F.col("text") if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns])
