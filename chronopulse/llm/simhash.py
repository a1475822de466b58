"""SimHash near-duplicate detection.

Every text becomes a fingerprint of 64-bit words: bit k is set if it is set in more than half of the hashes of the
text's word shingles. Fingerprints are cut into blocks; close pairs share blocks, so documents are joined on block
keys and the Hamming distance of each candidate pair is verified.

Two key plans exist. `Pigeonhole` is exact: with b blocks and distance at most d, at least b - d blocks of a close
pair agree, so joining on every choice of b - d blocks finds every pair. `Strongest` serves a similarity of 0.8 of
shingle sets, which is 15 % of the bits: no block of useful length agrees then. A bit is the sign of a sum over the
shingles; its blocks are random rotations of these sums, and a block's key is the place and sign of the largest one,
which small changes seldom alter. Its candidates pass a wide Hamming bound and are then verified by their shingle sets.

Groups of copies cost no pairs: equal fingerprints (or shingle sets) collapse first, members of a block key are first
linked to one head of that key only, in rounds, and then only pairs between different components so far are verified.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import append_columns, connected_components, cut, discard, small, stored, text_rows

#: Lower-cases A-Z and turns the white space that separates words into spaces; other bytes of UTF-8 stay.
_NORMAL = bytes(c + 32 if 65 <= c <= 90 else 32 if 9 <= c <= 13 else c for c in range(256))


def words(text: str) -> list[bytes]:
    """UTF-8 words, A-Z lower-cased, separated by space, tab, line feed, vertical tab, form feed, carriage return."""
    return [w for w in text.encode().translate(_NORMAL).split(b" ") if w]


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 (seed 42) of every space-joined run of `size` words, repeats included; fewer words: of them all; none: none."""
    w = words(text)
    if not w:
        return np.empty(0, dtype="<u8")
    ends = np.cumsum(np.fromiter(map(len, w), dtype=np.int64, count=len(w)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    take, joined, digest = max(1, len(w) - size + 1), b" ".join(w), xxhash.xxh64_intdigest
    bounds = zip(starts[:take].tolist(), ends[-take:].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], 42) for a, b in bounds), dtype="<u8", count=take)


def bit_sums(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of 64 bits, the lowest bit first."""
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 65535):  # 16-bit sums cannot overflow within a part
        part = hashes[start : start + 65535].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.uint16)
    return ones


def fingerprint(text: str, size: int = 4) -> int:
    """64 bits; zero for a text without words."""
    h = shingle_hashes(text, size)
    bits = (2 * bit_sums(h) > len(h)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def shingle_set(text: str, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `size` words; fewer words: of them all; none: none.

    A run's hash combines those of its words, which costs less than hashing joined words and serves comparison only.
    """
    w = words(text)
    codes = np.fromiter(map(xxhash.xxh64_intdigest, w), dtype="<u8", count=len(w))
    size = min(size, len(w))
    if not size:
        return codes
    h = codes[: len(w) - size + 1].copy()
    for k in range(1, size):
        h = h * _ODD[0] + codes[k : len(w) - size + 1 + k]
    return np.unique(_mixed(h))


_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _ODD[1]
    h = (h ^ (h >> np.uint64(29))) * _ODD[0]
    return h ^ (h >> np.uint64(32))


def wide_sums(shingles: np.ndarray, n_words: int) -> np.ndarray:
    """Sums of the shingles' signs in 64 * n_words independent bits; all zero for no shingles."""
    out = np.empty(64 * n_words, dtype=np.float32)
    for k in range(n_words):
        shingles = _mixed(shingles + _ODD[0])
        out[64 * k : 64 * k + 64] = 2 * bit_sums(shingles) - len(shingles)
    return out


@dataclass(frozen=True)
class Pigeonhole:
    """Keys of all choices of `blocks - distance` (or fewer: `choose`) blocks of 64-bit fingerprints.

    Larger corpora want longer keys: 8 blocks of which 4 are chosen give 70 keys of 32 bits instead of 35 of 27.
    """

    distance: int = 4
    blocks: int = 7
    choose: int = 3

    def __post_init__(self):
        if not 1 <= self.choose <= self.blocks - self.distance:
            raise ValueError("more blocks can differ than the keys leave out")

    def __call__(self, prints: np.ndarray) -> np.ndarray:
        """One row of keys a fingerprint."""
        edges = np.linspace(0, 64, self.blocks + 1).round().astype(int)
        keys = []
        for n, chosen in enumerate(combinations(range(self.blocks), self.choose)):
            key = np.full(len(prints), n, dtype=np.uint64)
            for b in chosen:
                bits = int(edges[b + 1] - edges[b])
                piece = (prints >> np.uint64(edges[b])) & np.uint64((1 << bits) - 1)
                key = (key << np.uint64(bits)) | piece
            keys.append(key)
        return np.stack(keys, axis=1)


@lru_cache(maxsize=2)
def _rotation(rows: int, columns: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2, (rows, columns), dtype=np.int8).astype(np.float32) * 2 - 1


@dataclass(frozen=True)
class Strongest:
    """`tables` keys of `blocks` blocks; each holds the place and sign of the largest of `width` rotated sums.

    A table's key has blocks * (log2(width) + 1) bits, 24 by default; larger corpora want another block and more
    tables. Of pairs of similarity 0.8, 0.85 and 0.9 a table finds 7, 11 and 18 %, 48 tables 96.5, 99.6 and 99.9 %.
    """

    tables: int = 48
    blocks: int = 3
    width: int = 128
    n_words: int = 4
    seed: int = 42

    def __call__(self, sums: np.ndarray) -> np.ndarray:
        """One row of keys a row of wide_sums()."""
        turn = _rotation(64 * self.n_words, self.tables * self.blocks * self.width, self.seed)
        turned = (sums @ turn).reshape(len(sums), self.tables * self.blocks, self.width)
        at = np.abs(turned).argmax(axis=2)
        positive = np.take_along_axis(turned, at[:, :, None], axis=2)[:, :, 0] > 0
        code = (2 * at + positive).astype(np.uint64).reshape(len(sums), self.tables, self.blocks)
        bits = np.uint64((2 * self.width - 1).bit_length())
        keys = np.broadcast_to(np.arange(self.tables, dtype=np.uint64), (len(sums), self.tables)).copy()
        for b in range(self.blocks):
            keys = (keys << bits) | code[:, :, b]
        return keys


def fingerprints(docs: DataFrame, id_col="doc_id", text_col="text", shingle=4) -> DataFrame:
    """(doc_id, fingerprint): 16 lowercase hex digits. Null text counts as empty."""

    def make():
        return lambda texts: [pa.array([f"{fingerprint(t, shingle):016x}" for t in texts], pa.string())]

    return append_columns(text_rows(docs, id_col, text_col), "text", make, "fingerprint string").drop("text")


def _hamming(a: Column, b: Column, n_words: int) -> Column:
    return sum((F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))) for k in range(n_words)), F.lit(0))


def _alike(similarity: float) -> Column:
    """Whether the sets sa and sb have at least the Jaccard similarity; sizes that rule it out are looked at first."""
    small, large = F.least(F.size("sa"), F.size("sb")), F.greatest(F.size("sa"), F.size("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    return (small >= similarity * large) & (common / (small + large - common) >= similarity)


def linked(nodes: DataFrame, distance: int, n_words: int, sets=None, similarity: float = 0.8, rounds: int = 2) -> DataFrame:
    """(node, component): the smallest node reachable over links; nodes without links are absent.

    nodes: node, w (n_words words of fingerprint), keys; a stored table. Nodes that share a key and differ in at most
    `distance` bits link. If sets is given, a function from some nodes to a stored table (node, s) and its path, the
    sets s must have at least the Jaccard similarity as well.

    Only keys that several nodes share count. In `rounds` rounds, members of other components are verified against one
    head a key; last, all pairs of different components that share a key are, so no pair that could change a component
    is left out. A dense group merges early and costs no pairs. The last join tests distance and similarity itself and
    so makes no rows but links; before, members without any close member of another component are left out.
    """
    spark = nodes.sparkSession
    rows = nodes.select("node", F.explode("keys").alias("key"))
    several = rows.groupBy("key").count().where("count > 1").select("key")
    shared, shared_path = stored(rows.join(several, "key").join(nodes.select("node", "w"), "node"))
    edges, paths, labels = None, [], None

    def state() -> DataFrame:
        if labels is None:
            return shared.withColumn("component", F.col("node"))
        return shared.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))

    def mixed(members: DataFrame, order: Column) -> DataFrame:
        """One head of each key that holds several components."""
        head = F.min(F.struct(order.alias("order"), "node", "w", "component")).alias("head")
        heads = members.groupBy("key").agg(head, F.min("component").alias("x"), F.max("component").alias("y"))
        return heads.where("x <> y").select("key", "head")

    for k in range(rounds + 1):
        members = state()
        heads = mixed(members, F.xxhash64("node", F.lit(k)))
        if k < rounds:
            some = heads.where(F.pmod(F.xxhash64("key"), F.lit(8)) == 0) if k == 0 else heads  # most groups merge by few keys
            near = _hamming(F.col("w"), F.col("head.w"), n_words) <= distance
            pairs = members.join(some, "key").where((F.col("component") != F.col("head.component")) & near)
            pairs = pairs.select(F.least("node", "head.node").alias("a"), F.greatest("node", "head.node").alias("b"))
            pairs, path = stored(pairs.distinct())
            paths.append(path)
            if sets and pairs.head(1):
                both = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
                known, path = sets(both.distinct())
                a = known.select(F.col("node").alias("a"), F.col("s").alias("sa"))
                b = known.select(F.col("node").alias("b"), F.col("s").alias("sb"))
                pairs, pairs_path = stored(pairs.join(b, "b").join(a, "a").where(_alike(similarity)).select("a", "b"))
                paths += [path, pairs_path]
        else:
            left_open, path = stored(members.join(heads.select("key"), "key").drop("head"))
            paths.append(path)
            names = {"key": "other_key", "node": "other", "component": "other_component", "w": "other_w"}
            right = left_open.withColumnsRenamed(names)
            near = (F.col("component") != F.col("other_component")) & (_hamming(F.col("w"), F.col("other_w"), n_words) <= distance)
            close, path = stored(left_open.join(right, (F.col("key") == F.col("other_key")) & near, "left_semi"))
            paths.append(path)
            if sets:
                known, path = sets(close.select("node").distinct())
                paths.append(path)
                close = close.join(known, "node")
            left = close.withColumnsRenamed({c: f"{c}a" for c in close.columns if c != "key"})
            right = close.withColumnsRenamed({c: f"{c}b" for c in close.columns if c != "key"})
            near = (F.col("componenta") < F.col("componentb")) & (_hamming(F.col("wa"), F.col("wb"), n_words) <= distance)
            both = left.join(right, "key").where(near & _alike(similarity) if sets else near)
            pairs, path = stored(both.select(F.col("nodea").alias("a"), F.col("nodeb").alias("b")).distinct())
            paths.append(path)
        if pairs.head(1):
            edges = pairs if edges is None else edges.unionByName(pairs)
            labels = connected_components(edges)
    discard(spark, shared_path, *paths)
    return spark.createDataFrame([], "node bigint, component bigint") if labels is None else labels


def components(prints: DataFrame, keys: Pigeonhole, distance: int) -> DataFrame:
    """(fingerprint, component_id) for every distinct fingerprint of prints (doc_id, fingerprint).

    component_id is the smallest doc_id whose fingerprint is reachable over links of at most `distance` bits. Rows
    with a null doc_id have no part in it.
    """
    same = prints.where("doc_id is not null").groupBy("fingerprint").agg(F.min("doc_id").alias("rep"))

    def make():
        def each(hexes: list[str]):
            w = np.array([int(h, 16) for h in hexes], dtype="<u8")
            return [pa.array(list(w.view("<i8")[:, None]), pa.list_(pa.int64())), pa.array(list(keys(w).view("<i8")), pa.list_(pa.int64()))]

        return each

    nodes = append_columns(same, "fingerprint", make, "w array<bigint>, keys array<bigint>")
    nodes, path = stored(nodes.withColumn("node", F.monotonically_increasing_id()))
    labels = linked(nodes, distance, 1)
    both = nodes.select("node", "fingerprint", "rep").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    both = cut(both)
    discard(nodes.sparkSession, path)
    least = both.groupBy("component").agg(F.min("rep").alias("component_id"))
    return both.join(least, "component").select("fingerprint", "component_id")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = 4, keys: Pigeonhole | None = None
) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row of docs.

    Documents link if their fingerprints differ in at most `distance` bits; component_id is the smallest doc_id
    reachable, itself included. Null and empty texts have the fingerprint zero and link like any other; repeated rows
    stay; a row with a null doc_id gets its fingerprint's component, or null if no other row has that fingerprint;
    an empty table gives an empty result.
    """
    prints = cut(fingerprints(docs, id_col, text_col, shingle))
    classes = components(prints, keys or Pigeonhole(distance), distance)
    return prints.join(classes, "fingerprint", "left").select("doc_id", "fingerprint", "component_id")


#: Of pairs of similarity 0.8, 39 of 256 bits differ (15 %), with a standard deviation of 6; all but one in a thousand
#: are within this bound. Pairs within it are verified by their shingle sets.
WIDE_DISTANCE = 58


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def shingle_sets(some: DataFrame, nodes: DataFrame, texts: DataFrame, shingle: int) -> tuple[DataFrame, str]:
    """(node, s: shingle set) of some nodes as a stored table, and its path.

    nodes: node, doc_id, hash of one text each; texts: doc_id, hash, text. Only the texts of these nodes are moved.
    """
    needed, needed_path = stored(some.join(nodes.select("node", "doc_id", "hash"), "node"))

    def make():
        return lambda rows: [pa.array([shingle_set(t, shingle).view("<i8") for t in rows], pa.list_(pa.int64()))]

    found = texts.join(small(needed), ["doc_id", "hash"]).select("node", "text").dropDuplicates(["node"])
    out = stored(append_columns(found, "text", make, "s array<bigint>").drop("text"))
    discard(texts.sparkSession, needed_path)
    return out


def deduplicate(
    docs: DataFrame, id_col="doc_id", text_col="text", shingle=5, similarity=0.8, distance=WIDE_DISTANCE, keys: Strongest | None = None
) -> DataFrame:
    """docs without near copies: of each group the row(s) with the smallest doc_id stay, all columns unchanged.

    Documents link if the sets of their shingles have at least that (Jaccard) similarity and differ in at most
    `distance` bits of their wide fingerprints; groups are what links connect. No pair below the similarity links; a
    small share of those at its limit is missed (see Strongest). Texts without words are copies of each other.

    Rows go by doc_id and text, so an id that occurs with other texts loses only those that are copies. Repeated rows
    stay or go together; rows with a null doc_id stay; an empty table gives no rows. docs is read several times, so it
    should come from a table.
    """
    plan = keys or Strongest()
    rows = text_rows(docs, id_col, text_col).withColumn("hash", _text_hash(F.col("text"))).where("doc_id is not null")

    def make():
        def each(texts: list[str]):
            sets = [shingle_set(t, shingle) for t in texts]
            sums = np.stack([wide_sums(s, plan.n_words) for s in sets])
            w = np.packbits(sums > 0, axis=1, bitorder="little").view("<i8")
            names = pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary())
            return [names, pa.array(list(w), pa.list_(pa.int64())), pa.array(list(plan(sums).view("<i8")), pa.list_(pa.int64()))]

        return each

    prints, prints_path = stored(append_columns(rows, "text", make, "same binary, w array<bigint>, keys array<bigint>").drop("text"))
    one = F.min(F.struct("doc_id", "hash", "w", "keys")).alias("one")
    nodes = prints.groupBy("same").agg(one).select("same", "one.*").withColumn("node", F.monotonically_increasing_id())
    nodes, nodes_path = stored(nodes)
    labels = linked(nodes, distance, plan.n_words, lambda some: shingle_sets(some, nodes, rows, shingle), similarity)
    narrow = nodes.select("same", "node", F.col("doc_id").alias("own")).join(labels, "node", "left")
    least = narrow.where("component is not null").groupBy("component").agg(F.min("own").alias("least"))
    kept = narrow.join(least, "component", "left").select("same", F.coalesce("least", "own").alias("kept"))
    gone = prints.select("doc_id", "hash", "same").join(kept, "same").where("doc_id <> kept")
    gone = cut(gone.select(F.col("doc_id").alias("__gone"), F.col("hash").alias("__hash")).distinct())
    discard(docs.sparkSession, prints_path, nodes_path)
    same = (docs[f"`{id_col}`"] == F.col("__gone")) & (_text_hash(docs[f"`{text_col}`"]) == F.col("__hash"))
    return docs.join(small(gone), same, "left_anti")
