"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows handed to a helper at once; bounds the Python objects alive in a worker.
ROWS_AT_ONCE = 256


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where it is unset, a temporary one serves local
    sessions only, as in tests: executors of a cluster could not read each other's files there."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _local_folder()


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="spark-")


def stored(df: DataFrame) -> tuple[DataFrame, str]:
    """df written to a table of its own in the shared folder and read again, and that table's path."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def cut(df: DataFrame) -> DataFrame:
    """df from a table written to the shared folder, so that lost executors cost no recomputation of its lineage."""
    return stored(df)[0]


#: Most narrow rows that are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 500_000


def small(df: DataFrame) -> DataFrame:
    """df (narrow rows of a stored table), marked for broadcast if it has at most BROADCAST_ROWS rows."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def discard(spark: SparkSession, *paths: str) -> None:
    """Removes tables that stored() wrote and that nothing needs any more."""
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Recent:
    """Values by text, of at most `limit` recent texts: two generations, of which the older goes when the newer is full."""

    def __init__(self, limit: int):
        self.limit, self.new, self.old = limit // 2, {}, {}

    def look(self, texts: list[str]) -> tuple[list, list[str]]:
        """The values of texts, None where not known, and the distinct texts not known."""
        found = list(map(self.new.get, texts))
        if None not in found:
            return found, []
        if len(self.new) >= self.limit:
            self.old, self.new = self.new, {}
            found = [None] * len(texts)
        missing, new, old = {}, self.new, self.old
        for k, f in enumerate(found):
            if f is None:
                f = old.get(texts[k])
                if f is None:
                    missing[texts[k]] = None
                else:
                    found[k] = new[texts[k]] = f
        return found, list(missing)

    def update(self, pairs) -> None:
        self.new.update(pairs)


#: What this worker process keeps from task to task, and what the helper that was started last has asked for.
_RESIDENT: dict[tuple, object] = {}
_ASKED: set[tuple] = set()


def resident(make: Callable, *args):
    """make(*args), of which a worker process makes one only, for as long as each helper that starts there asks for it."""
    key = (make, *args)
    _ASKED.add(key)
    if key not in _RESIDENT:
        _RESIDENT[key] = make(*args)
    return _RESIDENT[key]


def started(make: Callable):
    """make(), the start of a helper. What resident() holds and make() doesn't ask for is given back: workers go on to other
    operators, whose memory would add to it."""
    _ASKED.clear()
    made = make()
    idle = [key for key in _RESIDENT if key not in _ASKED]
    for key in idle:
        del _RESIDENT[key]
    if idle:
        gc.collect()
    return made


def append_columns(
    df: DataFrame,
    text_col: str,
    make: Callable[[], Callable[[list[str]], Sequence[pa.Array]]],
    fields: str,
) -> DataFrame:
    """All columns of df plus those of `fields` ("name type, ..."), computed from whole texts (null: empty).

    make() is called once per task and returns a function from a list of texts to one Arrow array per new column.
    Columns of df whose names clash with the new ones are replaced. No shuffle; a few hundred rows at a time.
    """
    new = T.StructType.fromDDL(fields)
    names = new.names
    kept = [c for c in df.columns if c not in names]
    source = df.select(*[F.col(f"`{c}`") for c in kept])
    at = kept.index(text_col)
    schema = T.StructType([*source.schema.fields, *new.fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = started(make)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                texts = [t or "" for t in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, *each(texts)], [*kept, *names])

    return source.mapInArrow(run, schema)


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the id and text columns, under the names doc_id and text; other columns cannot clash with ours."""
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores until no column of df has it."""
    while name in df.columns:
        name += "_"
    return name


def fold(column: Column, modulus: int) -> Column:
    """crc32 of a column's text form modulo a number; null counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over the undirected edges (a, b); nodes without edges are absent.

    Alternating large-star and small-star rounds, each written to a table of which only the last stays; the number of
    rounds grows with the logarithm of the longest path. Ties and repeated edges don't matter; rows with a null end
    are ignored; no edges: no rows.
    """
    spark = edges.sparkSession
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    star, path = stored(pairs)
    for _ in range(max_rounds):
        both = star.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            star.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large, middle = stored(large.distinct())
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        star, after = stored(small.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct())
        discard(spark, path, middle)
        path = after
        # settled: every node but the roots hangs from one node, and that is a root
        once = star.select(F.col("hi").alias("node"), F.lit(1).alias("n"))
        below = once.unionByName(star.select(F.col("lo").alias("node"), F.lit(None).cast("int").alias("n")).distinct())
        hung = below.groupBy("node").agg(F.count("n").alias("n"), F.count("*").alias("all"))
        if not hung.where("n > 1 or (n = 1 and all > 1)").head(1):
            break
    else:
        raise RuntimeError("the components did not settle")
    roots = star.select(F.col("lo").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return star.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)
