"""Vectorized helpers (numpy on Arrow batches) for what array functions express badly, and their column wrappers.

Lists of a batch are taken as one array of values with the places where lists begin, so that no helper loops over rows:
runs come from one difference over all values, sums and maxima go by segment, one binary search serves all lists.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Lists:
    """A batch's lists, each cut to its length: values, and start (one more than lists). Null lists are empty; null values are 0."""

    def __init__(self, column: pa.Array, length: pa.Array | None = None):
        sizes = np.asarray(column.value_lengths().fill_null(0), dtype=np.int64)
        flat = column.flatten()  # of lists that are there
        flat = flat.fill_null(0) if flat.null_count else flat
        values, begin = np.asarray(flat), np.concatenate(([0], np.cumsum(sizes)))[:-1]
        self.sizes = sizes if length is None else np.clip(np.asarray(length.fill_null(0), dtype=np.int64), 0, sizes)
        self.start = np.concatenate(([0], np.cumsum(self.sizes)))
        self.row = np.repeat(np.arange(len(sizes)), self.sizes)  # the list of each value
        self.index = np.arange(self.start[-1]) - self.start[:-1][self.row]  # its place in the list
        self.values = values if self.start[-1] == len(values) else values[begin[self.row] + self.index]

    def list_of(self, flat: np.ndarray, per: int, kind: pa.DataType = pa.float64()) -> pa.Array:
        """An array of lists of `per` values each."""
        return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, per), pa.int32()), pa.array(flat, kind))


def _mapped(df: DataFrame, each: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType | str) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield each(batch)

    return df.mapInArrow(run, schema)


def _with(df: DataFrame, inputs: Sequence[str], each: Callable[..., list[pa.Array]], fields: str) -> DataFrame:
    """df with the columns of `fields` (replaced where df has them) from whole columns of a batch."""
    new = T.StructType.fromDDL(fields)
    kept = [f for f in df.schema.fields if f.name not in new.names]
    used = [f"__in_{k}" for k in range(len(inputs))]
    source = df.select(*[F.col(f"`{f.name}`") for f in kept], *[F.col(c).alias(u) for c, u in zip(inputs, used, strict=True)])
    names = [*[f.name for f in kept], *new.names]

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = each(*batch.columns[len(kept) :])
        return pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *made], names)

    return _mapped(source, one, T.StructType([*kept, *new.fields]))


def runs_of(lists: Lists, limits: np.ndarray | float) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [start, stop) of values at or above a limit (one for all, or one a list), as places in lists.values."""
    if not len(lists.values):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    above = lists.values >= (limits if np.isscalar(limits) else limits[lists.row])
    new = above & ((lists.index == 0) | ~np.concatenate(([False], above[:-1])))
    last = above & np.concatenate((~above[1:] | (lists.index[1:] == 0), [True]))
    return np.flatnonzero(new), np.flatnonzero(last) + 1


def find_hits(records: DataFrame, thresholds=15.0) -> DataFrame:
    """One row per hit: run_id, channel, time, endtime, record_time, left, length, height, area.

    A hit is a maximal run of consecutive samples at or above the threshold within the record's length; thresholds is
    a number for all channels or a list by channel (others 15). Null data gives no hits.
    """
    table = None if np.isscalar(thresholds) else np.array([*thresholds, 15.0])
    schema = (
        "run_id string, channel int, time bigint, endtime bigint, record_time bigint, left int, length int, height double, area double"
    )
    source = records.select("run_id", "channel", "time", "dt", "length", "data").where("data is not null")

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        run_id, channel, time, dt, length, data = batch.columns
        lists = Lists(data, length)
        limits = thresholds
        if table is not None:
            at = np.asarray(channel.fill_null(-1))
            limits = table[np.where((at >= 0) & (at < len(table) - 1), at, len(table) - 1)]
        start, stop = runs_of(lists, limits)
        row = lists.row[start] if len(start) else start
        begin, step, first = np.asarray(time)[row], np.asarray(dt)[row].astype(np.int64), lists.index[start] if len(start) else start
        sums = np.concatenate(([0.0], np.cumsum(lists.values, dtype=np.float64)))
        if np.issubdtype(lists.values.dtype, np.integer):
            area = sums[stop] - sums[start]  # exact
        else:
            area = np.add.reduceat(np.append(lists.values, 0.0), np.stack((start, stop), axis=1).ravel())[::2] if len(start) else sums[:0]
        height = np.maximum.reduceat(np.append(lists.values, lists.values[-1:]), np.stack((start, stop), axis=1).ravel())[::2] if len(start) else sums[:0]
        took = pa.array(row)
        n = stop - start
        columns = [
            run_id.take(took), channel.take(took), begin + first * step, begin + (first + n) * step, begin, first.astype(np.int32),
            n.astype(np.int32), height.astype(np.float64), area.astype(np.float64),
        ]
        return pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], [f.split()[0] for f in schema.split(", ")])

    return _mapped(source, each, schema)


def decile_times(lists: Lists, dt: np.ndarray, n: int = 20) -> np.ndarray:
    """For each list a row of the times since its start at which 0, 1/n, ... 1 of the area is reached, by linear
    interpolation within samples; all zero if the total area is not positive. A quantile is taken at the first place
    where it is reached.

    Lists of like sizes go together as a matrix (about four million places at once): cumulative sums and running maxima
    by row, and one binary search for all quantiles of all rows.
    """
    rows, x = len(lists.sizes), lists.values.astype(np.float64)
    out = np.zeros((rows, n + 1))
    width = int(lists.sizes.max()) if rows else 0
    if not width:
        return out
    for part in np.array_split(np.argsort(lists.sizes, kind="stable"), max(1, rows * width // 4_000_000)):  # lists of like sizes, as a matrix
        wide = int(lists.sizes[part].max()) if len(part) else 0
        if not wide:
            continue
        inside = np.arange(wide) < lists.sizes[part][:, None]
        sums = np.zeros((len(part), wide + 1))
        at = np.minimum(lists.start[part][:, None] + np.arange(wide), len(x) - 1)
        np.cumsum(np.where(inside, x[at], 0.0), axis=1, out=sums[:, 1:])
        total = np.where(inside, x[at], 0.0).sum(1)
        top = np.maximum.accumulate(sums, axis=1)
        target = total[:, None] * np.arange(n + 1) / n
        place = np.minimum(_places(top, target), lists.sizes[part][:, None])
        before = np.maximum(place - 1, 0)
        low, high = np.take_along_axis(top, before, 1), np.take_along_axis(top, place, 1)
        step = high - low
        share = np.where(step > 0, before + (target - low) / np.where(step > 0, step, 1.0), place)
        found = np.where(place == 0, 0.0, share) * dt[part][:, None]
        out[part] = np.where(total[:, None] > 0, found, 0.0)
    return out


def _places(top: np.ndarray, target: np.ndarray) -> np.ndarray:
    """For each row the first place of top (ascending) at or above each target: a binary search of all rows together."""
    low, high = np.zeros(target.shape, dtype=np.int64), np.full(target.shape, top.shape[1], dtype=np.int64)
    while (low < high).any():
        middle = (low + high) // 2
        below = np.take_along_axis(top, np.minimum(middle, top.shape[1] - 1), 1) < target
        low, high = np.where(below & (low < high), middle + 1, low), np.where(~below & (low < high), middle, high)
    return low


def peak_widths(peaks: DataFrame) -> DataFrame:
    """Adds width[11] (central 0..100 % of the area) and area_decile_from_midpoint[11] (times relative to 50 %)."""

    def each(data: pa.Array, length: pa.Array, dt: pa.Array) -> list[pa.Array]:
        lists = Lists(data, length)
        t = decile_times(lists, np.asarray(dt.fill_null(0), dtype=np.float64), 20)
        k = np.arange(11)
        return [lists.list_of((t[:, 10 + k] - t[:, 10 - k]).ravel(), 11), lists.list_of((t[:, ::2] - t[:, 10:11]).ravel(), 11)]

    return _with(peaks, ("data", "length", "dt"), each, "width array<double>, area_decile_from_midpoint array<double>")


def split_points(lists: Lists, min_height: float, min_ratio: float) -> tuple[np.ndarray, np.ndarray]:
    """(list, index) of local minima m at which both sides rise to at least max(m + min_height, min_ratio * m).

    Found from left to right: after the highest sample since the last split falls to a minimum, the split stands once
    a later sample rises enough above it; plateaus split at their first sample. All lists take a step together: the
    loop is over places in a list, the state (highest, lowest, its place) is an array over lists.
    """
    rows = len(lists.sizes)
    top, low = np.full(rows, -np.inf), np.full(rows, np.inf)
    at = np.full(rows, -1, dtype=np.int64)
    found_row, found_at = [], []
    by_size = np.argsort(-lists.sizes, kind="stable")  # lists that still have a sample at place k come first
    sizes, values = lists.sizes[by_size], lists.values
    rise = lambda m: np.maximum(m + min_height, min_ratio * m)
    for k in range(int(sizes[0]) if rows else 0):
        open_rows = by_size[: np.searchsorted(-sizes, -k, "left")]
        x = values[lists.start[open_rows] + k].astype(np.float64)
        t, m, p = top[open_rows], low[open_rows], at[open_rows]
        with np.errstate(invalid="ignore"):
            split = (p >= 0) & (x >= rise(m))
        found_row.append(open_rows[split])
        found_at.append(p[split])
        t = np.where(split | ((p < 0) & (x > t)), x, t)
        m, p = np.where(split, np.inf, m), np.where(split, -1, p)
        lower = (x < m) & (t >= rise(x))
        top[open_rows], low[open_rows], at[open_rows] = t, np.where(lower, x, m), np.where(lower, k, p)
    if not found_row:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    row, place = np.concatenate(found_row), np.concatenate(found_at)
    order = np.lexsort((place, row))
    return row[order], place[order]


def split_peaks(peaks: DataFrame, min_height: float = 25.0, min_ratio: float = 4.0) -> DataFrame:
    """One row per part of each peak: peak_id becomes (peak_id, part); time, endtime, length, data and area are the part's."""

    def each(data: pa.Array, length: pa.Array) -> list[pa.Array]:
        lists = Lists(data, length)
        row, place = split_points(lists, min_height, min_ratio)
        counts = np.bincount(row, minlength=len(lists.sizes))
        offsets = np.concatenate(([0], np.cumsum(counts)))
        return [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(place, pa.int32()))]

    cuts = _with(peaks, ("data", "length"), each, "__p array<int>")
    starts = F.concat(F.array(F.lit(0)), F.col("__p"))
    stops = F.concat(F.col("__p"), F.array(F.col("length").cast("int")))
    parts = cuts.select("*", F.posexplode(F.arrays_zip(starts.alias("a"), stops.alias("b"))).alias("part", "__r"))
    a, b = F.col("__r")["a"], F.col("__r")["b"]
    data = F.slice("data", a + 1, b - a)
    area = F.aggregate(data, F.lit(0.0), lambda s, x: s + x.cast("double"))
    start = F.col("time")
    return parts.withColumns(
        {
            "__data": data,
            "__area": area,
            "__time": start + a * F.col("dt"),
            "__end": start + b * F.col("dt"),
            "__length": b - a,
        }
    ).drop("data", "area", "time", "endtime", "length", "__p", "__r").withColumnsRenamed(
        {"__data": "data", "__area": "area", "__time": "time", "__end": "endtime", "__length": "length"}
    )


def cut_outside_hits(records: DataFrame, threshold: float = 15.0, left: int = 3, right: int = 20) -> DataFrame:
    """Samples further than `left` before or `right` after every hit of their record become zero; null data becomes empty."""
    kind, order = records.schema["data"].dataType, records.columns

    def each(data: pa.Array, length: pa.Array) -> list[pa.Array]:
        whole, lists = Lists(data), Lists(data, length)
        start, stop = runs_of(lists, threshold)
        row = lists.row[start] if len(start) else start
        first, last = lists.index[start] if len(start) else start, (lists.index[stop - 1] + 1 if len(start) else stop)
        begin, end = whole.start[:-1][row], whole.start[1:][row]
        steps = np.zeros(len(whole.values) + 1, dtype=np.int64)  # +1 where a kept stretch begins, -1 where it ends
        np.add.at(steps, np.maximum(begin + first - left, begin), 1)
        np.add.at(steps, np.minimum(begin + last + right, end), -1)
        kept = np.where(np.cumsum(steps)[:-1] > 0, whole.values, 0)
        return [pa.ListArray.from_arrays(pa.array(whole.start, pa.int32()), pa.array(kept.astype(whole.values.dtype)))]

    return _with(records, ("data", "length"), each, f"data {kind.simpleString()}").select(*[F.col(f"`{c}`") for c in order])


def reconstruct_position(peaks: DataFrame, sensors: list[dict], method: str = "COG", half_width: float = 150.0, steps: int = 31) -> DataFrame:
    """Adds x, y and the fit's value to peaks (peak_id, area_per_channel), one sensor (x, y, z, qe) per array element.

    COG: centre of gravity. CHI2 and LNLIKE scan an (x, y) grid with light yield g = qe * cos(theta) / d^2 of each
    sensor and the rate that fits best there. With N = sum(n) and G = sum(g) their values have closed forms, in which a
    peak meets a grid point in one scalar product, so peaks and grid are multiplied as matrices:
    CHI2, rate sqrt(sum(n^2/g) / G): 2 * (sqrt(sum(n^2/g) * G) - N);
    LNLIKE, rate N / G: N - N ln N + N ln G - sum(n ln g) + sum(ln n!).
    The least value to nine decimals wins, on a tie the first grid point by x, then y. Null without light. Null, NaN and
    negative areas count as no light; missing elements of the array too.
    """
    sx, sy = ([float(s[k]) for s in sensors] for k in ("x", "y"))
    n = F.col("area_per_channel")
    if method == "COG":
        total = F.aggregate(n, F.lit(0.0), lambda s, v: s + v.cast("double"))
        weigh = lambda w: F.aggregate(F.zip_with(n, F.lit(w), lambda a, b: a.cast("double") * b), F.lit(0.0), lambda s, v: s + v)
        found = {k: F.when(total > 0, F.try_divide(weigh(w), total)) for k, w in (("x", sx), ("y", sy))}
        return peaks.withColumns(found | {"fit": F.lit(None).cast("double")})
    if method not in ("CHI2", "LNLIKE"):
        raise ValueError(f"unknown method {method}")
    axis = np.linspace(-half_width, half_width, steps)
    gx, gy = (g.ravel() for g in np.meshgrid(axis, axis, indexing="ij"))
    place = np.array([[s["x"], s["y"], s["z"], s.get("qe", 1.0)] for s in sensors], dtype=float)
    square = (gx[:, None] - place[:, 0]) ** 2 + (gy[:, None] - place[:, 1]) ** 2 + place[:, 2] ** 2
    yields = place[:, 3] * np.abs(place[:, 2]) / np.sqrt(square) / square  # a constant table of steps^2 rows
    whole = yields.sum(1)

    def values(light: np.ndarray) -> np.ndarray:
        total = light.sum(1)[:, None]
        if method == "CHI2":
            return 2 * (np.sqrt(light**2 @ (1 / yields).T * whole) - total)
        return total - total * np.log(total) + total * np.log(whole) - light @ np.log(yields).T + _log_factorial(light).sum(1)[:, None]

    def each(areas: pa.Array) -> list[pa.Array]:
        lists = Lists(areas)
        light = np.zeros((len(lists.sizes), len(sensors)))
        known = lists.index < len(sensors)
        light[lists.row[known], lists.index[known]] = np.clip(np.nan_to_num(lists.values[known].astype(np.float64)), 0, None)
        lit = np.flatnonzero(light.sum(1) > 0)
        out = np.full((3, len(light)), np.nan)
        for start in range(0, len(lit), 2048):
            some = lit[start : start + 2048]
            value = np.round(values(light[some]), 9)
            best = value.argmin(1)
            out[:, some] = gx[best], gy[best], value[np.arange(len(some)), best]
        return [pa.array(c, mask=np.isnan(c)) for c in out]

    return _with(peaks, ("area_per_channel",), each, "x double, y double, fit double")


def _log_factorial(n: np.ndarray) -> np.ndarray:
    """ln n! by Stirling's series, shifted to arguments where it is exact to double precision."""
    x, shift = n + 1.0, np.zeros_like(n)
    while (x < 8).any():
        small = x < 8
        shift = np.where(small, shift - np.log(x), shift)
        x = np.where(small, x + 1, x)
    return shift + (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
