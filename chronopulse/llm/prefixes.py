"""Conversation prefix trie: which first turns conversations share, and what a cache of them would save.

Conversations are sequences of turns (role, text). Each turn has a 128-bit hash; the digest of the first d turns is the
XOR of those hashes mixed with their places, so digests of a very long conversation come from sums of slabs of turns and
no task walks through all of it. A node of the trie is a distinct digest.

Most prefixes belong to one conversation. A count-min sketch of all digests tells them: an estimate is never too low, so
an estimate of one proves a singleton. Its row of the trie is known where it is and is emitted there; only prefixes that
may be shared are shuffled for exact grouping. Sums over subtrees take no walk either: the smallest member stands for a
node, so what a node adds is put on its row in that conversation, summed from there towards the conversation's first
turn, and summed over the members of each prefix.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import cut, discard, small, stored

#: Turns of a conversation that are summed together.
SLAB = 1024
#: Cells of the sketch's two rows: eight times the prefixes, within these bounds; so its bits broadcast 16 MB at most.
CELLS = (1 << 16, 1 << 26)
_BLOCK = 1 << 15
_KEY = ("depth", "p1", "p2")


def numbered(turns: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """(conv_id, position, h1, h2, words): turns numbered from 1 by turn (null first), then role and the text's hash.

    Null roles and texts count as empty; rows without a conversation are left out. Texts stay where they are. Rows are
    ordered in ranges of (conversation, turn): one that goes over several ranges is numbered on by a row a range.
    """
    named = turns.select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    ).where("conv_id is not null")
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")
    rows = named.select("conv_id", "turn", "role", F.xxhash64(F.lit(1), "role", "text").alias("h1"), F.xxhash64(F.lit(2), "text", "role").alias("h2"), words.alias("words"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("h1")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select("conv_id", "h1", "h2", "words", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    rows, _ = stored(rows)
    counts = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = counts.select("conv_id", "part", F.sum("n").over(earlier).alias("before")).where("before is not null")
    local = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("at"))
    rows = rows.join(F.broadcast(carried), ["conv_id", "part"], "left")  # a range continues one conversation at most
    return rows.select("conv_id", (local + F.coalesce("before", F.lit(0))).alias("position"), "h1", "h2", "words")


def plain(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered turns as they are, for trie(): the turns by depth, and the conversations."""
    convs = rows.groupBy("conv_id").agg(F.max("position").alias("len"))
    return rows.select("conv_id", F.col("position").alias("depth"), "h1", "h2", "words"), convs


def with_shared_heads(turns: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: c gets the first h turns of conversation c - c % group (all if it has fewer), then its own
    turns after its first h; h = crc32(c) % most. Ids are integers; turns are those of the table, see numbered()."""
    rows, _ = stored(numbered(turns))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most))
    convs = rows.groupBy("conv_id").agg(F.max("position").alias("own"))
    convs = convs.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % group})
    turn = F.struct("position", "h1", "h2", "words")
    heads = rows.where((F.col("conv_id") % group == 0) & (F.col("position") < most)).groupBy(F.col("conv_id").alias("base"))
    convs = convs.join(heads.agg(F.sort_array(F.collect_list(turn)).alias("head")), "base", "left")
    lent = F.when(F.col("h") > 0, F.slice("head", F.lit(1), F.greatest(F.col("h"), F.lit(1)).cast("int")))
    convs = convs.withColumn("lent", F.coalesce(lent, F.slice(F.array(F.struct(F.lit(0).alias("position"), F.lit(0).cast("bigint").alias("h1"), F.lit(0).cast("bigint").alias("h2"), F.lit(0).cast("bigint").alias("words"))), 1, 0)))
    size = F.size("lent").cast("bigint")
    convs = convs.select("conv_id", "h", "lent", size.alias("n"), (size + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("len"))
    convs, _ = stored(convs)
    own = rows.join(convs.select("conv_id", "h", "n"), "conv_id").where("position > h")
    own = own.select("conv_id", (F.col("position") - F.col("h") + F.col("n")).alias("depth"), "h1", "h2", "words")
    first = convs.select("conv_id", F.posexplode("lent").alias("at", "t"))
    first = first.select("conv_id", (F.col("at") + 1).cast("bigint").alias("depth"), "t.h1", "t.h2", "t.words")
    return own.unionByName(first), convs.select("conv_id", "len")


def _carried(rows: DataFrame, sums: dict[str, Column], later: bool) -> DataFrame:
    """(conv_id, slab, the sums over the slabs before, or after, of each conversation); conversations of several slabs."""
    per = rows.groupBy("conv_id", "slab").agg(*[s.alias(k) for k, s in sums.items()])
    order = F.desc("slab") if later else F.col("slab")
    other = Window.partitionBy("conv_id").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    add = F.sum if later else F.bit_xor
    found, _ = stored(per.select("conv_id", "slab", *[add(k).over(other).alias(k) for k in sums]).where(f"{next(iter(sums))} is not null"))
    return small(found)


def digests(turns: DataFrame) -> DataFrame:
    """turns with the digest p1, p2 of each prefix and q1, q2 of the one before."""
    mixed = {"m1": F.xxhash64("h1", "depth"), "m2": F.xxhash64("h2", "depth", F.lit(2)), "slab": F.floor((F.col("depth") - 1) / SLAB)}
    rows, _ = stored(turns.withColumns(mixed).drop("h1", "h2"))
    carry = _carried(rows, {"c1": F.bit_xor("m1"), "c2": F.bit_xor("m2")}, later=False)
    upto = Window.partitionBy("conv_id", "slab").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(carry, ["conv_id", "slab"], "left")
    for k in "12":
        rows = rows.withColumn(f"p{k}", F.bit_xor(f"m{k}").over(upto).bitwiseXOR(F.coalesce(f"c{k}", F.lit(0))))
    back = {f"q{k}": F.col(f"p{k}").bitwiseXOR(F.col(f"m{k}")) for k in "12"}
    return rows.withColumns(back).select("conv_id", "depth", "words", "p1", "p2", "q1", "q2")


def count_min(prefixes: DataFrame, cells: int) -> np.ndarray:
    """Two rows of packed bits: whether a cell counts more than one of the digests p1 (first row), p2 (second row).

    Each task counts its own digests (two is enough); blocks of cells are added up by block.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, cells), dtype=np.uint8)
        for batch in batches:
            for k in range(2):
                at, n = np.unique(np.asarray(batch.column(k)) & (cells - 1), return_counts=True)
                sums[k, at] = np.minimum(sums[k, at] + np.minimum(n, 2), 2)
        used = np.flatnonzero(sums.reshape(-1, _BLOCK).any(axis=1))
        blocks = sums.reshape(-1, _BLOCK)
        for start in range(0, len(used), 64):
            part = used[start : start + 64]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([blocks[b].tobytes() for b in part], pa.binary())], ["block", "counts"])

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for b, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = np.frombuffer(counts, dtype=np.uint8)
                total[b] = np.minimum(total[b] + counts, 2) if b in total else counts
        bits = [np.packbits(t >= 2, bitorder="little").tobytes() for t in total.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(bits, pa.binary())], ["block", "bits"])

    counted = prefixes.select("p1", "p2").mapInArrow(count, "block bigint, counts binary")
    found = counted.repartition("block").mapInArrow(add, "block bigint, bits binary")
    out = np.zeros((2 * cells // _BLOCK, _BLOCK // 8), dtype=np.uint8)
    for r in found.toLocalIterator():
        out[r["block"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out.reshape(2, -1)


def screened(prefixes: DataFrame, bits: np.ndarray) -> DataFrame:
    """prefixes with maybe and parent_maybe: false if the sketch proves that the prefix (the one before) has one member."""
    held, cells = prefixes.sparkSession.sparkContext.broadcast(bits), bits.shape[1] * 8
    names = prefixes.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = held.value

        def several(k: int, digest: pa.Array) -> np.ndarray:
            at = np.asarray(digest) & (cells - 1)
            return (rows[k, at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1

        for batch in batches:
            col = {n: batch.column(k) for k, n in enumerate(names)}
            maybe = several(0, col["p1"]) & several(1, col["p2"])
            parent = (several(0, col["q1"]) & several(1, col["q2"])) | (np.asarray(col["depth"]) == 1)  # the root is never proven
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(maybe), pa.array(parent)], [*names, "maybe", "parent_maybe"])

    kinds = ", ".join(f"{n} {k}" for n, k in prefixes.dtypes)
    return prefixes.mapInArrow(run, f"{kinds}, maybe boolean, parent_maybe boolean")


def _ends(last: DataFrame) -> DataFrame:
    """(depth, p1, p2, ends_sha256) of rows (depth, p1, p2, conv_id): ids in parts of a range, joined; parts by a stream."""
    part = F.expr("conv_id div 4096").alias("part")
    joined = F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",")
    parts = last.groupBy(*_KEY, part).agg(joined.alias("ids")).repartition(*_KEY).sortWithinPartitions(*_KEY, "part")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, out = None, None, []
        for batch in batches:
            for *now, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if now == key:
                    digest.update(b",")
                else:
                    if key:
                        out.append((*key, digest.hexdigest()))
                    key, digest = now, hashlib.sha256()
                digest.update(ids.encode())
            if len(out) > 1000:
                yield rows_of(out)
                out = []
        if key:
            yield rows_of([*out, (*key, digest.hexdigest())])

    def rows_of(out: list) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3])], [*_KEY, "ends_sha256"])

    return parts.select(*_KEY, "ids").mapInArrow(run, "depth bigint, p1 bigint, p2 bigint, ends_sha256 string")


def trie(source: tuple[DataFrame, DataFrame], cells: int | None = None) -> DataFrame:
    """One row a node: conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    source: turns (conv_id, depth from 1, h1, h2, words) and conversations (conv_id, len), as plain() or
    with_shared_heads() make them. A node's subtree includes it; leaves have no children; saved tokens are (members - 1)
    * words of the last turn, summed over the subtree; ends are the ids, in ascending order, of the conversations that
    end there. Without conversations there are no nodes. The sketch's cells (a power of two) change no result.
    """
    turns, convs = source
    spark = turns.sparkSession
    convs, _ = stored(convs)
    prefixes, raw = stored(digests(turns).join(convs, "conv_id"))
    if cells is None:
        cells = min(CELLS[1], max(CELLS[0], 1 << (8 * prefixes.count()).bit_length()))
    rows, _ = stored(screened(prefixes, count_min(prefixes, cells)))
    discard(spark, raw)
    zero = [F.lit(0).cast("bigint").alias(k) for k in ("depth", "words", "p1", "p2", "q1", "q2")]
    root = convs.select("conv_id", *zero, "len", F.lit(True).alias("maybe"), F.lit(False).alias("parent_maybe"))
    shared = rows.where("maybe").unionByName(root)
    alone = rows.where("not maybe")

    per = shared.groupBy(*_KEY).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("rep"), F.count(F.when(F.col("len") > F.col("depth"), 1)).alias("longer")
    )
    known = shared.join(per, list(_KEY)).drop("maybe")
    own, last = F.col("conv_id") == F.col("rep"), F.col("depth") == F.col("len")
    known = known.withColumns(
        {
            "leaf": F.when(own & (F.col("longer") == 0), 1).otherwise(0),  # the smallest member ends there, as all do
            "saved": F.when(own, (F.col("n_convs") - 1) * F.col("words")).otherwise(0),
            "slab": F.floor(F.greatest(F.col("depth") - 1, F.lit(0)) / SLAB),
        }
    )
    known, _ = stored(known)
    ends = alone.where(last).select("conv_id", "depth", F.lit(1).alias("leaf"), F.lit(0).cast("bigint").alias("saved"), F.floor((F.col("depth") - 1) / SLAB).alias("slab"))
    values = known.select("conv_id", "depth", "leaf", "saved", "slab", *_KEY[1:], "q1", "q2", "n_convs", "rep")
    values = values.unionByName(ends, allowMissingColumns=True)
    carry = _carried(values, {"c_leaf": F.sum("leaf"), "c_saved": F.sum("saved")}, later=True)
    onward = Window.partitionBy("conv_id", "slab").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    values = values.join(carry, ["conv_id", "slab"], "left")
    values = values.withColumns({f"all_{k}": F.sum(k).over(onward) + F.coalesce(f"c_{k}", F.lit(0)) for k in ("leaf", "saved")})
    nodes = values.where("rep is not null").groupBy(*_KEY).agg(
        F.first("rep").alias("conv_id"), F.first("n_convs").alias("n_convs"), F.first("q1").alias("q1"), F.first("q2").alias("q2"),
        F.sum("all_leaf").alias("n_leaves"), F.sum("all_saved").alias("saved_tokens"),
    )
    nodes, _ = stored(nodes)

    above = [(F.col("depth") - 1).alias("depth"), F.col("q1").alias("p1"), F.col("q2").alias("p2")]
    tops = alone.where("parent_maybe")
    born = known.where(own & (F.col("depth") > 0)).select(*above).unionByName(tops.select(*above))
    children = born.groupBy(*_KEY).agg(F.count("*").alias("n_children"))
    finals = _ends(known.where(last).select(*_KEY, "conv_id"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("above"))
    grouped = nodes.join(children, list(_KEY), "left").join(finals, list(_KEY), "left").join(parents, ["depth", "q1", "q2"], "left")
    none = F.sha2(F.lit(""), 256)
    # a parent that is no shared node has the same single member
    grouped = grouped.select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("above", "conv_id")).alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )
    inner = alone.where("not parent_maybe").withColumn("above", F.col("conv_id"))
    tail = tops.join(parents, ["depth", "q1", "q2"]).select(*inner.columns).unionByName(inner)
    one = F.lit(1).cast("bigint")
    tail = tail.select(
        "conv_id", "depth", F.col("above").alias("parent_conv_id"), one.alias("n_convs"), F.when(last, 0).otherwise(1).cast("bigint").alias("n_children"),
        one.alias("n_leaves"), F.lit(0).cast("bigint").alias("saved_tokens"), F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(none).alias("ends_sha256"),
    )
    return cut(grouped.unionByName(tail))
