"""I-Match document fingerprints.

The lexicon is every term whose inverse document frequency lies in a band. A text keeps its distinct lexicon terms,
sorted; each of several random subsets of the lexicon gives one hash of the terms that text and subset share. Subsets
come in levels of 16 that hold a 16th, a 128th, a 1024th and an 8192nd of the lexicon, so that texts of any length
have subsets with a few of their terms each. A level draws a number for each term, by bits of its hash that no other
level uses, and subset i holds the terms that drew i: the subsets of a level are disjoint random samples of the
lexicon, so a changed term spoils one of them at most. Built-in functions only.

The band's lower end bounds the lexicon: terms that at least a share s of all documents hold number at most 1/s times
the mean number of distinct terms of a document, however many documents there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import cut, text_rows

#: (first bit of the term hash, number of bits) of each level's draw; a term is in subset i if the drawn number is i.
_LEVELS = ((0, 4), (4, 7), (11, 10), (21, 13))
_SUBSETS = 16
#: xxhash64 of no terms is its seed: the subset is empty for this text.
_EMPTY = 42
#: Bits of a subset's hash, all of which the fingerprint shows.
_SHOWN = 0xFFFFFFFF
#: Largest lexicon that is broadcast (16 bytes a term); a larger one is joined by a shuffle.
BROADCAST_TERMS = 2_000_000


def term_hashes(text: Column) -> Column:
    """Distinct hashes of the terms (lower-cased runs of letters and digits) of a text."""
    terms = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")
    return F.array_distinct(F.transform(terms, lambda t: F.xxhash64(t)))


def lexicon(docs: DataFrame, low_share: float = 0.0005, high_share: float = 0.2, text_col: str = "text") -> DataFrame:
    """(term): hashes of the terms that at least two documents and a share of low_share to high_share of them hold.

    In terms of inverse document frequency, the band from log(1/high_share) to log(1/low_share). Counts over all
    documents; null texts count as empty documents.
    """
    n = docs.count()
    text = F.coalesce(F.col(text_col), F.lit(""))
    counts = docs.select(F.explode(term_hashes(text)).alias("term")).groupBy("term").count()
    return counts.where(F.col("count").between(max(2, low_share * n), max(2, high_share * n))).select("term")


def _level(terms: Column, first: int, bits: int) -> Column:
    """The hashes of one level's subsets of the terms."""

    def subset(i: Column) -> Column:
        drawn = lambda t: F.shiftrightunsigned(t, first).bitwiseAND(F.lit((1 << bits) - 1))
        return F.xxhash64(F.filter(terms, lambda t: drawn(t) == i)).bitwiseAND(F.lit(_SHOWN))

    return F.transform(F.sequence(F.lit(0), F.lit(_SUBSETS - 1)), subset)


def _hashes(terms: Column, whole: Column) -> Column:
    """Subset hashes of sorted distinct terms; last, a hash of the whole text if it holds no term of the lexicon."""
    last = F.when(F.size(terms) == 0, whole.bitwiseAND(F.lit(_SHOWN))).otherwise(F.lit(_EMPTY).cast("bigint"))
    return F.concat(*[_level(terms, first, bits) for first, bits in _LEVELS], F.array(last))


def to_text(hashes: Column) -> Column:
    """A fingerprint as text: eight hex digits a subset, dashes for a subset without terms."""
    one = lambda h: F.when(h == _EMPTY, F.lit("-")).otherwise(F.lpad(F.lower(F.hex(h)), 8, "0"))
    return F.array_join(F.transform(hashes, one), "")


def likeness(a: Column, b: Column) -> Column:
    """0 to 1. Equal fingerprints: 1. Else the largest share, over levels with at least four subsets in use, of the
    subsets in use (not empty for both) whose hashes are equal; if no level has four, that share over all levels."""
    used = lambda x, y: (x != _EMPTY) | (y != _EMPTY)

    def share(start: int, size: int, least: int) -> Column:
        x, y = F.slice(a, start + 1, size), F.slice(b, start + 1, size)
        both = F.arrays_zip(x.alias("x"), y.alias("y"))
        in_use = F.size(F.filter(both, lambda p: used(p["x"], p["y"])))
        equal = F.size(F.filter(both, lambda p: used(p["x"], p["y"]) & (p["x"] == p["y"])))
        return F.when(in_use >= least, equal / in_use)

    n = _SUBSETS * len(_LEVELS)
    best = F.greatest(*[share(k * _SUBSETS, _SUBSETS, 4) for k in range(len(_LEVELS))])
    return F.when(a == b, F.lit(1.0)).otherwise(F.coalesce(best, share(0, n + 1, 1), F.lit(0.0)))


def with_lexicon_terms(rows: DataFrame, keys: list[str], arrays: list[str], carried: list[str], words: DataFrame) -> DataFrame:
    """rows with each array of term hashes cut down to the lexicon and sorted; one row per distinct value of keys.

    Terms are exploded, looked up and collected again per row. If rows are partitioned by some of the keys, only the
    lexicon moves. Each row must have distinct keys; the columns `carried` come along once per row.
    """
    kinds = dict(rows.dtypes)
    carry = F.struct(*[F.col(c) for c in carried])
    nothing = F.lit(None).cast(f"struct<{','.join(f'{c}:{kinds[c]}' for c in carried)}>")
    head = F.array(F.struct(F.lit(-1).alias("which"), F.lit(None).cast("bigint").alias("term"), carry.alias("carry")))

    def marked(k: int, terms: str) -> Column:
        return F.transform(terms, lambda t: F.struct(F.lit(k).alias("which"), t.alias("term"), nothing.alias("carry")))

    each = [marked(k, a) for k, a in enumerate(arrays)]
    exploded = rows.select(*keys, F.explode(F.concat(head, *each)).alias("e")).select(*keys, "e.which", "e.term", "e.carry")
    known = words.select(F.col("term").alias("known"))
    n = known.count()
    known = F.broadcast(known) if n <= BROADCAST_TERMS else known
    found = exploded.join(known, F.col("term") == F.col("known"), "left").where("known is not null or which = -1")
    lists = [F.sort_array(F.collect_list(F.when(F.col("which") == k, F.col("known")))).alias(a) for k, a in enumerate(arrays)]
    grouped = found.groupBy(*keys).agg(F.first("carry", ignorenulls=True).alias("carry"), *lists)
    return grouped.select(*keys, "carry.*", *arrays)


def fingerprints(docs: DataFrame, words: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, hashes, fingerprint), one row per row of docs, over a lexicon `words` from lexicon().

    Whole texts; null counts as empty; equal texts have equal fingerprints, repeated rows stay.
    """
    rows = text_rows(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.select("doc_id", term_hashes(F.col("text")).alias("terms"), F.xxhash64("text").alias("whole"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    found = with_lexicon_terms(rows, ["row"], ["terms"], ["doc_id", "whole"], words)
    hashed = found.select("doc_id", _hashes(F.col("terms"), F.col("whole")).alias("hashes"))
    return hashed.withColumn("fingerprint", to_text(F.col("hashes")))


#: The order of documents: descending doc_id, null ids last, then a hash of the text.
_ORDER = ("absent", "back", "hash")


#: Most buckets: so many cuts reach the driver, whatever the number of documents.
MOST_BUCKETS = 20_000


def _numbered(docs: DataFrame) -> DataFrame:
    """docs with number, a bigint in the order of doc_id: integers are their own, other ids get their rank."""
    if dict(docs.dtypes)["doc_id"] in ("tinyint", "smallint", "int", "bigint"):
        return docs.withColumn("number", F.col("doc_id").cast("bigint"))
    ids = docs.select("doc_id").where("doc_id is not null").distinct()
    ids = ids.repartitionByRange("doc_id").sortWithinPartitions("doc_id").withColumn("number", F.monotonically_increasing_id())
    return docs.join(cut(ids), "doc_id", "left")


def _placed_keys(docs: DataFrame) -> DataFrame:
    """docs with their order as three columns, all ascending, and a row number that only deals out equal rows."""
    docs = _numbered(docs)
    back = F.coalesce(F.bitwise_not(F.col("number")), F.lit(0))
    keys = {"absent": F.col("doc_id").isNull().cast("bigint"), "back": back, "hash": F.xxhash64("text")}
    return docs.withColumns(keys | {"row": F.monotonically_increasing_id()})


def _cuts(keys: DataFrame, per_bucket: int) -> list[tuple]:
    """The keys of every per_bucket-th row in their order, which is found in ranges with a narrow row a document."""
    n = keys.count()
    per_bucket = max(per_bucket, -(-n // MOST_BUCKETS))
    parts = max(1, min(2000, -(-n // 20_000)))
    ranged = cut(keys.repartitionByRange(parts, *_ORDER, "row").withColumn("part", F.spark_partition_id()))
    sizes, offsets, total = sorted(ranged.groupBy("part").count().collect()), [], 0
    for part, size in sizes:
        offsets.append((part, total))
        total += size
    before = keys.sparkSession.createDataFrame(offsets, "part int, before bigint")
    rank = F.row_number().over(Window.partitionBy("part").orderBy(*_ORDER, "row"))
    at = ranged.withColumn("rank", rank).join(F.broadcast(before), "part").select(*_ORDER, (F.col("before") + F.col("rank") - 1).alias("at"))
    return sorted(tuple(r) for r in at.where((F.col("at") > 0) & (F.col("at") % per_bucket == 0)).select(*_ORDER).collect())


def _bucket(cuts: list[tuple]) -> Column:
    """The number of cuts at or before a row's key, by binary search. Rows that several cuts equal are equal rows: they
    are dealt out to the buckets between these cuts."""
    if not cuts:
        return F.lit(0).cast("bigint")
    arrays = [F.split(F.lit(",".join(str(c[k]) for c in cuts)), ",").cast("array<bigint>") for k in range(len(_ORDER))]
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])

    def search(fits) -> Column:
        def step(found: Column, by: Column) -> Column:
            to = found + by
            one = F.struct(*[F.get(a, to - 1).alias(c) for a, c in zip(arrays, _ORDER)])
            return F.when((to <= len(cuts)) & fits(one), to).otherwise(found)

        return F.aggregate(steps, F.lit(0), step)

    key = F.struct(*[F.col(c) for c in _ORDER])
    last, first = search(lambda one: one <= key), search(lambda one: one < key)
    between = last - first - 1
    return F.when(between > 0, first + 1 + F.pmod(F.col("row"), between)).otherwise(last).cast("bigint")


def _in_order(docs: DataFrame, per_bucket: int) -> DataFrame:
    """(bucket, doc_id, text, real): documents in buckets of descending doc_id; each bucket ends with a copy (real:
    false) of the document after its last one, after the very last the first.

    Buckets are cut at row counts, whatever the ids: about per_bucket documents each, null and repeated ids included;
    more where there would be over MOST_BUCKETS. What follows sorts and spills, so a bucket need not fit in memory.
    Only narrow rows are ordered for that (one a document in ranges, one a bucket as a whole).
    """
    keyed = _placed_keys(docs)
    keys = cut(keyed.select(*_ORDER, "row"))
    bucket = _bucket(_cuts(keys, per_bucket))
    placed = keyed.select(bucket.alias("bucket"), "doc_id", "text", *_ORDER)
    first = keys.select(bucket.alias("bucket"), F.struct(*_ORDER).alias("key")).groupBy("bucket").agg(F.min("key").alias("head"))
    whole = Window.orderBy("bucket")
    before = F.lag("bucket").over(whole)  # the bucket that the head follows; the very first follows the last
    heads = first.withColumn("to", F.coalesce(before, F.max("bucket").over(Window.partitionBy())))
    heads = cut(heads)
    marked = heads.select(F.col("bucket").alias("b"), "to", "head")
    same = (F.col("bucket") == F.col("b")) & (F.struct(*_ORDER) == F.col("head"))
    narrow = F.broadcast(marked) if heads.count() <= 200_000 else marked
    copies = placed.join(narrow, same).groupBy("to").agg(F.first(F.struct("doc_id", "text")).alias("d"))
    copies = copies.select(F.col("to").alias("bucket"), "d.doc_id", "d.text", F.lit(False).alias("real"))
    return placed.select("bucket", "doc_id", "text", F.lit(True).alias("real")).unionByName(copies)


def compare_edited(
    docs: DataFrame, words: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_bucket: int = 2000
) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row of docs.

    The edited text has the last floor(n_chars / 3) code points replaced by the first as many (or all) of the next
    document's, in descending doc_id (of any type that has an order); after the last comes the first. near_edited and near_next are the likeness of a
    fingerprint to the edited text's and to the next document's. Null counts as empty; documents of equal id follow
    each other in the order of a hash of their texts; null ids come last; an empty table gives no rows.

    The texts move once, to buckets of consecutive ids; all that follows stays within them.
    """
    rows = text_rows(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    ordered = _in_order(rows, per_bucket)
    order = Window.partitionBy("bucket").orderBy(F.desc("real"), F.desc_nulls_last("doc_id"), F.xxhash64("text"))
    placed = ordered.withColumns({"position": F.row_number().over(order), "next": F.lead("text").over(order)})
    n = F.length("text")
    tail = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - tail), F.substring(F.coalesce("next", F.lit("")), F.lit(1), tail))
    placed = placed.select(
        "bucket", "position", "real", "doc_id", n.cast("bigint").alias("n_chars"), "text", F.when(F.col("real"), edited).otherwise("").alias("edited")
    )
    placed = placed.select(
        "bucket",
        "position",
        "real",
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.xxhash64("text").alias("whole"),
        F.xxhash64("edited").alias("edited_whole"),
        term_hashes(F.col("text")).alias("terms"),
        term_hashes(F.col("edited")).alias("edited_terms"),
    )
    carried = ["real", "doc_id", "n_chars", "edited_sha256", "whole", "edited_whole"]
    found = with_lexicon_terms(placed, ["bucket", "position"], ["terms", "edited_terms"], carried, words)
    found = found.select(
        *["bucket", "position", "real", "doc_id", "n_chars", "edited_sha256"],
        _hashes(F.col("terms"), F.col("whole")).alias("own"),
        _hashes(F.col("edited_terms"), F.col("edited_whole")).alias("edited"),
    )
    after = F.lead("own").over(Window.partitionBy("bucket").orderBy("position"))
    found = found.withColumn("next", after).where("real")
    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        to_text(F.col("own")).alias("fingerprint"),
        to_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )
