"""N-gram Jaccard join by parity sketches.

A document is its set of distinct word shingles. A set's parity sketch is the XOR of what its shingles' hashes flip, so
two sets' sketches differ in no more places than the sets do. Two forms are used:

* Cells, for the join. The range of hashes is cut into k cells of equal width; a cell holds the XOR of the hashes that
  fall into it. A shingle touches one cell, so sets that differ in D shingles agree in k - D cells at least. Sizes n and
  m of similarity s differ in (1 - s) / (1 + s) * (n + m) shingles at most and by 1 / s as a ratio: sets go to bands of
  size (powers of two), each with its k, and to the band below if a partner may be there. A set shows its first D + c
  cells, D being the most shingles that it may differ in; two similar sets agree in c of them or more.
* Bits, for the filter: 2^j bits, at least as many as shingles; a longer sketch folds to the length of a shorter one.

An empty cell, and one that very many sets of different groups share (a common passage), is weak: it is not joined on.
A set with more than D strong cells meets every similar set in one of them; a set with fewer is poor. Pairs of which one
is not poor are all found by the cells; poor sets are joined among themselves on single shingles, the rarer ones first (a
sketch with a cell for each shingle), where nothing is weak. Nothing is lost, and no weak cell costs pairs.

Candidates that share a cell are first linked to one head of it, each to the head that it meets most often, in rounds:
groups of near copies merge without pairs. Then all pairs of different groups in a cell are tested: members of all but
the cell's largest group against all members. A pair must pass the sizes, the bits, and then its shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import append_columns, connected_components, cut, discard, small, stored, text_rows
from .simhash import _ODD, _mixed, shingle_set, shingle_sets


@dataclass(frozen=True)
class ParityConfig:
    """percent: the least similarity in per cent. busy: pairs of different groups per member above which a cell is weak.
    sample: one text in so many is looked at for cells that very many texts share; those are spared the sort. It and
    busy change the plan, not the result; so does ordering, about how many poor sets are sampled for common shingles.
    node_bits: bits of a set's name; equal names are told apart."""

    shingle: int = 5
    percent: int = 80
    rounds: int = 2
    busy: int = 64
    sample: int = 256
    ordering: int = 1024
    node_bits: int = 64


def most_different(n: int, m: int, percent: int) -> int:
    """The most shingles that sets of n and m shingles differ in if 100 * intersection >= percent * union."""
    return (100 - percent) * (n + m) // (100 + percent)


@lru_cache(maxsize=4096)
def shown_cells(n: int, percent: int) -> tuple[tuple[int, int, int, int], ...]:
    """(band, k, shown, differing) for each band that a set of n shingles goes to: of k cells the first `shown`, since
    partners there differ in up to `differing` shingles. Sets that no other set can be similar to go to none."""
    if not most_different(n, 100 * n // percent, percent):
        return ()
    out = []
    own, lowest = n.bit_length() - 1, ((percent * n + 99) // 100).bit_length() - 1
    for band in range(lowest, own + 1):
        low, high = 1 << band, (1 << band + 1) - 1
        spare = 3 + int(0.06 * low + low**0.5)
        k = most_different(high, 100 * high // percent, percent) + spare
        differing = most_different(n, 100 * n // percent if band == own else high, percent)
        out.append((band, k, min(k, differing + spare), differing))
    return tuple(out)


def cell_keys(h: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """Keys of the shown cells that are not empty, of a set's sorted hashes, and how many of them may be weak at most
    (over the bands the least; -1 or less: the set is poor already)."""
    keys, spare = [], len(h)
    for band, k, shown, differing in shown_cells(len(h), percent):
        inside = h if shown == k else h[: np.searchsorted(h, np.uint64(-(-(shown << 32) // k) << 32))]
        cell = ((inside >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1]))) if len(cell) else np.empty(0, dtype=np.int64)
        held = np.bitwise_xor.reduceat(_mixed(inside + _ODD[0]), first) if len(first) else np.empty(0, dtype="<u8")
        held = _mixed(held ^ _mixed((cell[first] << np.uint64(8)) + np.uint64(band)))
        keys.append(held)
        spare = min(spare, len(held) - differing - 1)
    return (np.concatenate(keys) if keys else np.empty(0, dtype="<u8")), spare


def bit_sketch(h: np.ndarray) -> np.ndarray:
    """Parities of the set's hashes in 64 * 2^j bits, at least as many as hashes, as 64-bit words."""
    bits = max(64, 1 << max(0, len(h) - 1).bit_length())
    odd = np.bincount((_mixed(h) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _bits_apart(a: str, b: str) -> Column:
    """Hamming distance of two bit sketches, the longer folded to the length of the shorter (half of it at most, as the
    sizes of similar sets are near each other; sketches further apart in length count as far)."""
    fold = lambda x, w: f"if(size({x}) > {w}, zip_with(slice({x}, 1, {w}), slice({x}, {w} + 1, {w}), (p, q) -> p ^ q), {x})"
    least = f"least(size({a}), size({b}))"
    pairs = f"zip_with({fold(a, least)}, {fold(b, least)}, (p, q) -> bit_count(p ^ q))"
    return F.expr(f"aggregate({pairs}, 0, (s, x) -> s + coalesce(x, 64))")


def _may_link(percent: int) -> Column:
    """Whether rows with sizes na, nb and sketches ba, bb may be of one link: by size, then by bits."""
    fits = F.expr(f"100L * least(na, nb) >= {percent}L * greatest(na, nb)")
    return fits & (_bits_apart("ba", "bb") <= F.expr(f"{100 - percent}L * (na + nb) div {100 + percent}"))


def _links(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, config: ParityConfig) -> DataFrame:
    """The pairs (a, b) whose shingle sets are similar, as a stored table."""
    spark = pairs.sparkSession
    both = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets, path = shingle_sets(both, nodes, texts, config.shingle)
    a, b = (sets.select(F.col("node").alias(k), F.col("s").alias(f"s{k}")) for k in "ab")
    common = F.size(F.array_intersect("sa", "sb")).cast("bigint")
    similar = 100 * common >= config.percent * (F.size("sa") + F.size("sb") - common)
    out, _ = stored(pairs.join(b, "b").join(a, "a").where(similar).select("a", "b"))
    discard(spark, path)
    return out


class _Groups:
    """Links found so far and the groups that they connect."""

    def __init__(self):
        self.edges = self.labels = None

    def add(self, links: DataFrame) -> None:
        if links.head(1):
            self.edges = links if self.edges is None else self.edges.unionByName(links)
            self.labels = connected_components(self.edges)

    def of(self, rows: DataFrame) -> DataFrame:
        """rows with `component`, the group of their node (the node itself while it has no link)."""
        if self.labels is None:
            return rows.withColumn("component", F.col("node"))
        return rows.join(self.labels, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _settle(rows: DataFrame, nodes: DataFrame, texts: DataFrame, groups: _Groups, config: ParityConfig, busy: int | None) -> DataFrame | None:
    """Adds to groups all links between nodes that share a key of rows (key, node; a stored table), but for keys with
    more than `busy` pairs of different groups a member; returns how many of those every node has (node, weak)."""
    spark, paths = rows.sparkSession, []
    for k in range(0 if busy is None else config.rounds):
        members = groups.of(rows)
        order = F.struct(F.xxhash64("node", F.lit(k)).alias("order"), "node", "component") if k else F.struct("node", "component")
        heads = members.groupBy("key").agg(F.min(order).alias("h"), F.min("component").alias("x"), F.max("component").alias("y"))
        heads = heads.where("x <> y").select("key", F.col("h.node").alias("head"), F.col("h.component").alias("its"))
        met = members.join(heads, "key").where("component <> its").groupBy("node", "head").count()
        best = met.groupBy("node").agg(F.max(F.struct("count", "head")).alias("h"))
        pairs = best.select(F.least("node", "h.head").alias("a"), F.greatest("node", "h.head").alias("b")).distinct()
        a, b = (nodes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("bits").alias(f"b{c}")) for c in "ab")
        pairs, path = stored(pairs.join(a, "a").join(b, "b").where(_may_link(config.percent)).select("a", "b"))
        paths.append(path)
        if pairs.head(1):
            groups.add(_links(pairs, nodes, texts, config))
    members, path = stored(groups.of(rows))
    paths.append(path)
    by_group = members.groupBy("key", "component").agg(F.count("*").alias("m"))
    keys = by_group.groupBy("key").agg(
        F.sum("m").alias("all"), F.sum(F.col("m").cast("double") * F.col("m")).alias("squares"), F.max(F.struct("m", "component")).alias("top"), F.count("*").alias("groups")
    )
    keys = keys.where("groups > 1").withColumn("pairs", F.col("all").cast("double") * F.col("all") - F.col("squares"))
    limit = F.lit(False) if busy is None else F.col("pairs") > 2.0 * busy * F.col("all")
    keys, path = stored(keys.select("key", F.col("top.component").alias("largest"), limit.alias("weak")))
    paths.append(path)
    weak = None
    if busy is not None:
        weak = cut(members.join(keys.where("weak").select("key"), "key").groupBy("node").agg(F.count("*").alias("weak")))
    shown = nodes.select("node", "n", "bits")
    still = members.join(keys.where("not weak").select("key", "largest"), "key").join(shown, "node")
    still, path = stored(still.withColumn("major", F.col("component") == F.col("largest")).drop("largest"))
    paths.append(path)
    left = still.where("not major").select("key", F.col("node").alias("a"), F.col("component").alias("ca"), F.col("n").alias("na"), F.col("bits").alias("ba"))
    right = still.select("key", F.col("node").alias("b"), F.col("component").alias("cb"), F.col("n").alias("nb"), F.col("bits").alias("bb"), "major")
    other = (F.col("ca") != F.col("cb")) & (F.col("major") | (F.col("a") < F.col("b")))
    same = left["key"] == right["key"]
    pairs = left.join(right, same & other & _may_link(config.percent)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs, path = stored(pairs.distinct())
    paths.append(path)
    if pairs.head(1):
        groups.add(_links(pairs, nodes, texts, config))
    discard(spark, *paths)
    return weak


def _shared_cells(prints: DataFrame, config: ParityConfig) -> DataFrame:
    """(key, node) of the cells that several sets show: by one sort of all cells, which skips the cells that a sample
    shows to be in very many texts (those are taken as they are, so that no task gets a cell of a third of all texts)."""
    rows = prints.select("node", "hash", F.explode("keys").alias("key"))
    often = rows.where(F.pmod("hash", F.lit(config.sample)) == 0).groupBy("key").count().where("count >= 16").select("key")
    often, path = stored(often)
    hot = small(often)
    order = Window.partitionBy("key").orderBy("node")
    near = rows.select("key", "node").join(hot, "key", "left_anti")
    near = near.withColumns({"before": F.lag("node").over(order), "after": F.lead("node").over(order)})
    near = near.where("before <> node or after <> node").select("key", "node")  # a repeated node passes twice at most
    frequent = rows.join(hot, "key", "left_semi").select("key", "node").distinct()
    out, _ = stored(near.unionByName(frequent))
    discard(prints.sparkSession, path)
    return out


def _rare_shingles(poor: DataFrame, nodes: DataFrame, texts: DataFrame, config: ParityConfig) -> DataFrame:
    """(key, node): the first shingles of each poor set, one more than may be absent from a similar set, in an order that
    all sets share: those last that are common in a sample of the sets, then by hash. Any such order finds all pairs.

    Shingles of 1/32 of the sampled sets are common: no more than 32 times the sets' mean size, whatever the corpus.
    """
    sets, path = shingle_sets(poor, nodes, texts, config.shingle)
    every = max(1, sets.count() // config.ordering)
    some = sets.where(F.pmod(F.xxhash64("node"), F.lit(every)) == 0).select("node", F.explode("s").alias("key"))
    least = max(2, config.ordering // 32)
    common = np.sort(np.array([r["key"] for r in some.groupBy("key").count().where(F.col("count") >= least).select("key").collect()], dtype=np.int64))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = []
            for s in batch.column(1):
                h = np.asarray(s.values)
                often = np.isin(h, common)
                keys.append(np.concatenate((h[~often], h[often]))[: len(h) + (-config.percent * len(h)) // 100 + 1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.list_(pa.int64()))], ["node", "keys"])

    first = sets.select("node", "s").mapInArrow(run, "node bigint, keys array<bigint>")
    out, _ = stored(first.select("node", F.explode("keys").alias("key")))
    discard(poor.sparkSession, path)
    return out


def prints_of(rows: DataFrame, config: ParityConfig) -> DataFrame:
    """rows (doc_id, hash, text) as doc_id, hash, same (128-bit name of the set, null without words), node (64-bit), n, bits,
    keys (its strong cells), spare."""

    def make():
        def each(texts: list[str]):
            sets = [shingle_set(t, config.shingle) for t in texts]
            cells = [cell_keys(s, config.percent) for s in sets]
            names = [xxhash.xxh3_128_digest(s) if len(s) else None for s in sets]
            mask = (1 << config.node_bits) - 1
            node = [None if d is None else int.from_bytes(d[:8], "little") & mask for d in names]
            node = [v if v is None or v < 1 << 63 else v - (1 << 64) for v in node]
            lists = lambda parts: pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum([len(p) for p in parts]))), pa.int32()), pa.array(np.concatenate([p.view("<i8") for p in parts]))
            )
            return [
                pa.array(names, pa.binary()), pa.array(node, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                lists([bit_sketch(s) for s in sets]), lists([k for k, _ in cells]), pa.array([s for _, s in cells], pa.int64()),
            ]

        return each

    fields = "same binary, node bigint, n bigint, bits array<bigint>, keys array<bigint>, spare bigint"
    return append_columns(rows, "text", make, fields).drop("text")


def _told_apart(prints: DataFrame) -> DataFrame:
    """prints with different nodes for different sets: all but one of the sets with one name get another."""
    names = prints.where("node is not null").groupBy("node").agg(F.min("same").alias("one"), F.max("same").alias("x"))
    twice = cut(names.where("one <> x").select("node", "one"))
    if not twice.head(1):
        return prints
    other = cut(prints.join(small(twice), "node").where("same <> one").select("same").distinct().withColumn("other", F.xxhash64("same")))
    return prints.join(small(other), "same", "left").withColumn("node", F.coalesce("other", "node")).drop("other")


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: ParityConfig | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of docs.

    Documents link if 100 * intersection >= percent * union of their sets of distinct shingles of lower-cased (A-Z) words;
    with fewer words than a shingle has, the whole sequence is one. component_id is the smallest doc_id reachable over
    links, itself included. Null and empty texts have no shingles, link with nothing and keep their own id. Repeated rows
    stay; a row with a null doc_id has its group's smallest id (null if there is none); an empty table gives no rows;
    other columns are ignored. docs is read several times, so it should come from a table.
    """
    config, spark = config or ParityConfig(), docs.sparkSession
    rows = text_rows(docs, id_col, text_col).withColumn("hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    table, prints_path = stored(prints_of(rows, config))
    prints = _told_apart(table)
    texts = rows.withColumn("doc_id", F.xxhash64("doc_id"))  # with the text's hash it names a row, null ids as well
    one = F.min(F.struct("hash", F.xxhash64("doc_id").alias("doc_id"), "n", "bits", "spare")).alias("one")
    nodes = prints.where("node is not null").groupBy("node").agg(one, F.min("doc_id").alias("least"))
    nodes, nodes_path = stored(nodes.select("node", "one.*", "least"))
    groups = _Groups()
    shared = _shared_cells(prints.where("node is not null"), config)
    weak = _settle(shared, nodes, texts, groups, config, config.busy)
    poor = nodes.join(weak, "node", "left").where(F.coalesce("weak", F.lit(0)) > F.col("spare"))
    poor = poor.where(F.expr(f"{100 - config.percent}L * (n + 100L * n div {config.percent}) >= {100 + config.percent}")).select("node")
    poor, poor_path = stored(poor)
    if poor.head(1):
        _settle(_rare_shingles(poor, nodes, texts, config), nodes, texts, groups, config, None)
    named = groups.of(nodes.select("node", "least"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named, _ = stored(named.select("node", "component").join(least, "component").select("node", "component_id"))
    found = prints.select("doc_id", "node", F.col("n").alias("n_shingles")).join(named, "node", "left")
    found = cut(found.select("doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))
    discard(spark, prints_path, nodes_path, poor_path)
    return found


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: ParityConfig | None = None) -> DataFrame:
    """docs without near copies, exactly: of each group that links connect, the row(s) with the smallest id stay, with all
    columns as they are.

    The exact counterpart of simhash.deduplicate(), which misses a small share of pairs at its limit. Rows go by id and
    text, so an id that occurs with other texts loses only those that are copies; rows with a null id stay, and so do
    texts without words; an empty table gives no rows. docs is read several times, so it should come from a table.
    """
    hashed = lambda text: F.xxhash64(F.coalesce(text, F.lit("")))
    row = F.struct(F.col(f"`{id_col}`").alias("id"), hashed(F.col(f"`{text_col}`")).alias("hash")).alias("row")
    found = jaccard_groups(docs.where(F.col(f"`{id_col}`").isNotNull()).select(row, F.col(f"`{text_col}`").alias("text")), "row", "text", config)
    gone = found.where("doc_id.id <> component_id.id").select(F.col("doc_id.id").alias("__gone"), F.col("doc_id.hash").alias("__hash"))
    gone = cut(gone.distinct())
    same = (docs[f"`{id_col}`"] == F.col("__gone")) & (hashed(docs[f"`{text_col}`"]) == F.col("__hash"))
    return docs.join(small(gone), same, "left_anti")
