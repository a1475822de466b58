"""Tables behind the usual plots: histograms, matrices, livetimes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import bin_index, floor_div
from .records import baseline


def log_edges(low: float, high: float, n: int) -> list[float]:
    return [float(x) for x in np.logspace(np.log10(low), np.log10(high), n)]


def histogram(df: DataFrame, axes: dict[str, tuple[Column, list[float]]]) -> DataFrame:
    """Counts n by bin index of each axis; rows outside any axis are dropped. Empty cells are absent."""
    binned = df.select(*[bin_index(x, edges).alias(name) for name, (x, edges) in axes.items()]).dropna()
    return binned.groupBy(*axes).agg(F.count("*").alias("n"))


def mean_histogram(df: DataFrame, axes: dict[str, tuple[Column, list[float]]], along: str, livetime: float) -> DataFrame:
    """From the histogram over three axes: per cell of the two others, rate (n / livetime) and the mean of `along`,
    from its bins' centres."""
    cells = histogram(df, axes)
    edges = axes[along][1]
    centres = F.lit([(a + b) / 2 for a, b in zip(edges, edges[1:], strict=False)])
    value = F.get(centres, F.col(along))
    others = [a for a in axes if a != along]
    return cells.groupBy(*others).agg(
        (F.sum("n") / F.lit(float(livetime))).alias("rate"), (F.sum(value * F.col("n")) / F.sum("n")).alias("mean")
    )


def _axes(pe, rt, aft) -> dict:
    return {
        "area_bin": (F.col("area"), pe or log_edges(1, 1e6, 121)),
        "width_bin": (F.col("range_50p_area"), rt or log_edges(1, 1e5, 121)),
        "aft_bin": (F.col("area_fraction_top"), aft or [float(x) for x in np.linspace(0, 1, 101)]),
    }


def area_aft_histogram(peaks: DataFrame, pe_bins=None, rt_bins=None, aft_bins=None, livetime: float = 1.0) -> DataFrame:
    """Per cell of area and width: rate and mean fraction on top."""
    return mean_histogram(peaks, _axes(pe_bins, rt_bins, aft_bins), "aft_bin", livetime)


def area_width_histogram(peaks: DataFrame, pe_bins=None, rt_bins=None, aft_bins=None, livetime: float = 1.0) -> DataFrame:
    """Per cell of area and fraction on top: rate and mean width."""
    return mean_histogram(peaks, _axes(pe_bins, rt_bins, aft_bins), "width_bin", livetime)


def cell_margins(hist: DataFrame, axes: list[str]) -> DataFrame:
    """Marginal sums of a histogram over every subset of its axes; axes summed over are null, total says how many."""
    return hist.cube(*axes).agg(F.sum("n").alias("n"), F.grouping_id().cast("bigint").alias("total"))


def energy_spectrum(
    events: DataFrame, column: str = "e_ces", n_bins: int = 100, low: float = 1.0, high: float = 100.0, geometric: bool = True, unit: str = "kg_day", exposure_kg_s: float = 1.0
) -> DataFrame:
    """(bin, low, high, n, rate): n_bins edges, so n_bins - 1 bins; rate is per exposure and bin width.

    unit scales the exposure: kg_day, tonne_day, tonne_year (the same factor as tonne_day).
    """
    edges = [float(x) for x in (np.geomspace if geometric else np.linspace)(low, high, n_bins)]
    factor = {"kg_day": 86400.0, "tonne_day": 86400.0 * 1000, "tonne_year": 86400.0 * 1000}[unit]
    counts = histogram(events, {"bin": (F.col(column), edges)})
    a, b = F.get(F.lit(edges), F.col("bin")), F.get(F.lit(edges), F.col("bin") + 1)
    rate = F.col("n") * F.lit(factor / exposure_kg_s) / (b - a)
    return counts.select("bin", a.alias("low"), b.alias("high"), "n", rate.alias("rate"))


def led_area_histogram(led: DataFrame, bins: int = 250, channels=range(5)) -> DataFrame:
    """(channel, bin, n): equal bins between each channel's least and largest area, the last bin closed."""
    rows = led.where(F.col("channel").isin(list(channels)))
    bounds = F.broadcast(rows.groupBy("channel").agg(F.min("area").alias("lo"), F.max("area").alias("hi")))  # a row a channel
    at = F.floor((F.col("area") - F.col("lo")) * bins / (F.col("hi") - F.col("lo")))
    at = F.when(F.col("hi") > F.col("lo"), F.least(at, F.lit(bins - 1))).otherwise(0)
    return rows.join(bounds, "channel").groupBy("channel", at.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def matrix_dt(record_length: int, dt: int, window: int, max_samples: int) -> int:
    """The time bin of a matrix: dt if the window has at most max_samples of them; else the least multiple of dt that
    divides the record's duration and fits; else the larger of that duration and window DIV max_samples."""
    duration = record_length * dt
    if window // dt <= max_samples:
        return dt
    for k in range(2, record_length + 1):
        if record_length % k == 0 and window // (k * dt) <= max_samples and k < record_length:
            return k * dt
    return max(duration, window // max_samples)


def records_matrix(records: DataFrame, t0: int, t1: int, n_channels: int, gains=None, record_length: int = 110, dt: int = 10, max_samples: int = 20_000) -> DataFrame:
    """(time_bin, channel, pe_per_ns), dense over time bins that hold anything: intensity of records that start in
    [t0, t1). With bins at least as long as a record, a record's whole area goes to the bin of its start."""
    step = matrix_dt(record_length, dt, t1 - t0, max_samples)
    rows = records.where((F.col("time") >= t0) & (F.col("time") < t1) & (F.col("channel") < n_channels))
    gain = F.get(F.lit([float(g) for g in gains]), F.col("channel")) if gains else F.lit(1.0)
    if step >= record_length * dt:
        area = F.aggregate("data", F.lit(0.0), lambda s, x: s + x.cast("double"))
        points = rows.select("channel", F.col("time").alias("at"), (area * gain).alias("v"))
    else:
        points = rows.select("channel", "time", "dt", gain.alias("g"), F.posexplode(F.slice("data", F.lit(1), F.col("length"))).alias("i", "x"))
        points = points.select("channel", (F.col("time") + F.col("i") * F.col("dt")).alias("at"), (F.col("x") * F.col("g")).alias("v"))
    sums = points.where(F.col("at") < t1).groupBy(floor_div(F.col("at") - t0, step).alias("time_bin"), "channel").agg((F.sum("v") / step).alias("v"))
    grid = sums.select("time_bin").distinct().withColumn("channel", F.explode(F.sequence(F.lit(0), F.lit(n_channels - 1))))
    return grid.join(sums, ["time_bin", "channel"], "left").select("time_bin", "channel", F.coalesce("v", F.lit(0.0)).alias("pe_per_ns"))


def raw_records_matrix(raw: DataFrame, t0: int, t1: int, n_channels: int, **options) -> DataFrame:
    """records_matrix() of raw fragments, baselined first; a missing first fragment is tolerated.

    Only the range is baselined, with the last first fragment of each channel before it, which it may inherit from.
    """
    wanted = raw.where(F.col("channel") < n_channels)
    earlier = wanted.where((F.col("time") < t0) & (F.col("record_i") == 0)).groupBy("run_id", "channel")
    earlier = earlier.agg(F.max_by(F.struct(*raw.columns), "time").alias("__r")).select("__r.*")
    inside = wanted.where((F.col("time") >= t0) & (F.col("time") < t1))
    return records_matrix(baseline(inside.unionByName(earlier.select(*raw.columns))), t0, t1, n_channels, **options)


def livetime(runs: DataFrame, things: DataFrame, second: float = 1e9) -> DataFrame:
    """(run_id, livetime): the run's, else end - start in seconds, else from the first thing's time to the endtime of
    the thing that starts last."""
    spans = things.groupBy("run_id").agg(((F.max_by("endtime", "time") - F.min("time")) / second).alias("__span"))
    asked = F.coalesce(F.col("livetime"), F.unix_micros(F.col("end")).cast("double") / 1e6 - F.unix_micros(F.col("start")).cast("double") / 1e6)
    return runs.join(spans, "run_id", "left").select("run_id", F.coalesce(asked, F.col("__span")).alias("livetime"))


def distinct_sketches(df: DataFrame, keys: list[str], columns: list[str], bits: int = 14) -> DataFrame:
    """Per keys, a sketch of the distinct values of each column (HyperLogLog with 2^bits registers): a few kilobytes that
    can be stored by slab or run, and united later without the rows. Nulls don't count."""
    return df.groupBy(*keys).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), bits).alias(c) for c in columns])


def distinct_counts(sketches: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Per keys (fewer than the sketches have: they are united), the estimated number of distinct values of each column.

    The relative standard error is about 0.8 / sqrt(2^bits), 0.7 % for 14 bits; few values are counted exactly.
    """
    united = sketches.groupBy(*keys).agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns])
    return united.withColumns({c: F.coalesce(c, F.lit(0)) for c in columns})
