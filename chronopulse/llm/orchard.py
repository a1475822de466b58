"""Centroid clustering with Orchard's search for the nearest centroid.

Every centroid has a list of all centroids by their distance from it. The search for a vector starts at one centroid and
reads that centroid's list from the near end; whenever it meets a centroid closer to the vector, it goes on in the list
of that one. Centroids that were measured are marked and not measured again. By the triangle inequality, a centroid
further from the current one than twice the vector's distance to it can't be as close; the search stops strictly beyond
that, so that ties are seen (the smaller number wins). Vectors and centroids are integers and distances are exact.

The vectors of an Arrow batch are searched together, a step of all at a time. Of a round, a task returns a row of sums for
each batch and cluster; Spark adds them up. What comes to the driver is one row a centroid and component.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import stored

#: Components are held to this size, so that squared distances and sums of a batch fit in 64 bits; far beyond any
#: embedding (2^21 before scaling).
LIMIT = 1 << 27


@dataclass(frozen=True)
class OrchardConfig:
    """k is bounded by the driver's memory: the lists have k^2 entries, which every task gets."""

    k: int = 16
    rounds: int = 3
    size: int = 64
    scale: int = 64


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, size: int, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component as packed 32-bit integers, for vectors of exactly `size`
    components, none of them null, NaN or infinite; the others are left out."""
    source = df.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.columns
            right = np.flatnonzero(np.asarray(lists.value_lengths().fill_null(-1)) == size)
            chosen = lists.take(pa.array(right))
            flat = np.asarray(chosen.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)  # null becomes NaN
            x = flat.reshape(-1, size)
            whole = np.isfinite(x).all(axis=1)
            v = np.clip(np.floor(x[whole] * scale), -LIMIT, LIMIT).astype("<i4")
            rows = pa.array([r.tobytes() for r in v], pa.binary())
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(right[whole])), rows], ["vec_id", "v"])

    return source.mapInArrow(run, f"vec_id {dict(source.dtypes)['vec_id']}, v binary")


def neighbour_lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each centroid all centroids by (squared distance, number), and those distances."""
    apart = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(2)
    order = np.argsort(apart, axis=1, kind="stable")
    return order, np.take_along_axis(apart, order, 1)


def nearest(vectors: np.ndarray, centroids: np.ndarray, order: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest centroid of every vector (ties: the smaller number), its squared distance, and how many were measured."""
    n, k = len(vectors), len(centroids)
    current, at = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    best = ((vectors - centroids[0]) ** 2).sum(1)
    seen = np.zeros((n, k), dtype=bool)
    seen[:, 0] = True
    active = np.arange(n)
    while len(active):
        place = current[active], at[active]
        active = active[(apart[place] <= 4 * best[active])]  # stop strictly beyond twice the distance
        candidate = order[current[active], at[active]]
        at[active] += 1
        new = ~seen[active, candidate]
        rows, tried = active[new], candidate[new]
        seen[rows, tried] = True
        d = ((vectors[rows] - centroids[tried]) ** 2).sum(1)
        better = (d < best[rows]) | ((d == best[rows]) & (tried < current[rows]))
        rows, tried, d = rows[better], tried[better], d[better]
        current[rows], best[rows], at[rows] = tried, d, 0
        active = active[at[active] < k]
    return current, best, seen.sum(1)


def _searched(table: DataFrame, centroids: np.ndarray, each, names: list[str], fields: str) -> DataFrame:
    """One output of each(batch, vectors, cluster, distance) a batch; the centroids and lists travel with the task."""
    order, apart = neighbour_lists(centroids)
    size = centroids.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype="<i4").reshape(-1, size).astype(np.int64)
                cluster, distance, _ = nearest(v, centroids, order, apart)
                yield pa.RecordBatch.from_arrays(each(batch, v, cluster, distance), names)

    return table.mapInArrow(run, fields)


def first_centroids(table: DataFrame, config: OrchardConfig) -> np.ndarray:
    """The vectors with the k smallest sha256 of `1:<vec_id>`, in that order (equal ids: by their components)."""
    name = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = table.select("v", name.alias("h")).orderBy("h", "v").limit(config.k).collect()
    return np.array([np.frombuffer(r["v"], dtype="<i4") for r in chosen], dtype=np.int64).reshape(-1, config.size)


def next_centroids(table: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid becomes floor(sum / count) of its vectors, exactly; one without vectors stays."""
    size = centroids.shape[1]

    def sums(batch, v, cluster, distance):
        used = np.unique(cluster)
        rows = [[*v[cluster == c].sum(0).tolist(), int((cluster == c).sum())] for c in used]
        return [pa.array(used), pa.array(rows, pa.list_(pa.int64()))]

    parts = _searched(table, centroids, sums, ["cluster", "sums"], "cluster bigint, sums array<bigint>")
    rows = parts.select("cluster", F.posexplode("sums").alias("j", "x"))
    total = rows.groupBy("cluster", "j").agg(F.sum(F.col("x").cast("decimal(38, 0)")).alias("x")).collect()
    found = {(r["cluster"], r["j"]): int(r["x"]) for r in total}
    out = centroids.copy()
    for c in {c for c, _ in found}:
        out[c] = [found[c, j] // found[c, size] for j in range(size)]
    return out


def cluster(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", config: OrchardConfig | None = None) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row per kept vector.

    Vectors that have another size than config.size, or a null, NaN or infinite component, are left out. Fewer vectors
    than k: as many centroids. Repeated vectors and ids stay, also null ids (as an empty id in the choice of the first
    centroids); an empty table gives no rows; other columns are ignored.
    """
    config, spark = config or OrchardConfig(), df.sparkSession
    table, _ = stored(integer_vectors(df, id_col, vector_col, config.size, config.scale))
    fields = f"vec_id {dict(table.dtypes)['vec_id']}, cluster int, distance bigint"
    centroids = first_centroids(table, config)
    if not len(centroids):
        return spark.createDataFrame([], f"{fields}, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    for _ in range(config.rounds):
        centroids = next_centroids(table, centroids)
    each = lambda batch, v, cluster, distance: [batch.column(0), pa.array(cluster, pa.int32()), pa.array(distance)]
    found, _ = stored(_searched(table, centroids, each, ["vec_id", "cluster", "distance"], fields))
    own = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    name = lambda c: hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()
    per = [(c, s, sum(own.values()), name(c)) for c, s in own.items()]
    per = spark.createDataFrame(per, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(per), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
