"""Peak level: basics, positions, hit patterns, waveform points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import NAN, center_time, poly
from ..schemas import PeakConfig
from .filters import fraction_top, peak_type


def peak_basics(peaks: DataFrame, cfg: PeakConfig = PeakConfig(), channel_map=None, mode: str = "tpc") -> DataFrame:
    """Scalar properties of peaks with arrays: endtime, n_channels (area > 0), widths, the channel of the largest area
    (the first on a tie) and its area, fraction on top (null in mode aux), rise and centre time, class."""
    per = F.col("area_per_channel")
    aft = fraction_top(channel_map) if mode == "tpc" else F.lit(None).cast("double")
    rows = peaks.select(
        *[c for c in ("run_id", "peak_id", "time", "length", "dt", "area", "n_hits", "tight_coincidence", "n_saturated_channels") if c in peaks.columns],
        (F.col("time") + F.col("dt").cast("bigint") * F.col("length")).alias("endtime"),
        F.size(F.filter(per, lambda a: a > 0)).alias("n_channels"),
        F.get("width", F.lit(5)).alias("range_50p_area"),
        F.get("width", F.lit(9)).alias("range_90p_area"),
        (F.array_position(per, F.array_max(per)) - 1).cast("int").alias("max_pmt"),
        F.array_max(per).alias("max_pmt_area"),
        aft.alias("area_fraction_top"),
        (-F.get("area_decile_from_midpoint", F.lit(1))).alias("rise_time"),
        center_time(F.col("time"), F.col("dt"), F.col("data"), F.col("area")).alias("center_time"),
    )
    return rows.withColumn("type", peak_type(cfg, mode))


#: Default cubic of the corrected positions, highest power first: the identity.
IDENTITY = (0.0, 0.0, 1.0, 0.0)


def peak_positions(peaks: DataFrame, top: tuple[int, int, int] = (1, 2, 3), coefficients: dict[str, tuple] | None = None, algo: str = "corr") -> DataFrame:
    """Adds x_cgr, y_cgr, r_cgr (centre of gravity), x_corr, y_corr, r_corr (by cubic polynomials) and x, y, r of algo.

    f12 and f13 are the shares of the top light in the first and second, and first and third top channel; NaN without
    top light.
    """
    light = F.col("area") * F.col("area_fraction_top")
    at = lambda k: F.get("area_per_channel", F.lit(k)).cast("double")
    usable = (light != 0) & ~F.isnan(light)
    share = lambda a, b: F.when(usable, F.try_divide(at(a) + at(b), light)).otherwise(F.lit(NAN))
    c = coefficients or {"x": IDENTITY, "y": IDENTITY}
    rows = peaks.withColumns({"x_cgr": share(top[0], top[1]), "y_cgr": share(top[0], top[2])})
    rows = rows.withColumns({"x_corr": poly(F.col("x_cgr"), c["x"]), "y_corr": poly(F.col("y_cgr"), c["y"])})
    radius = lambda k: F.sqrt(F.col(f"x_{k}") * F.col(f"x_{k}") + F.col(f"y_{k}") * F.col(f"y_{k}"))
    rows = rows.withColumns({"r_cgr": radius("cgr"), "r_corr": radius("corr")})
    return rows.withColumns({k: F.col(f"{k}_{algo}") for k in ("x", "y", "r")})


def hit_pattern(peaks: DataFrame) -> DataFrame:
    """(channel, area): element-wise sum of area_per_channel."""
    return peaks.select(F.posexplode("area_per_channel").alias("channel", "a")).groupBy("channel").agg(F.sum("a").alias("area"))


def waveform_points(peaks: DataFrame, t0: int = 0, second: float = 1e9) -> DataFrame:
    """(peak_id, i, seconds, pe_per_ns): the n + 1 step points of each peak's waveform; the last repeats the last value."""
    data = F.slice("data", F.lit(1), F.col("length"))
    closed = F.concat(data, F.slice(data, F.greatest(F.size(data), F.lit(1)), F.lit(1)))
    points = peaks.select("peak_id", "time", "dt", F.posexplode(closed).alias("i", "v"))
    seconds = (F.col("time") - t0 + F.col("i") * F.col("dt").cast("bigint")).cast("double") / second
    return points.select("peak_id", "i", seconds.alias("seconds"), (F.col("v") / F.col("dt")).alias("pe_per_ns"))


def largest_peaks(peaks: DataFrame, k: int = 100) -> DataFrame:
    """The k peaks of largest area (ties: smaller peak_id), by time."""
    return peaks.orderBy(F.desc("area"), "peak_id").limit(k).orderBy("time", "peak_id")


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """The first n rows by time."""
    return df.orderBy("time", *[c for c in ("channel", "record_i") if c in df.columns]).limit(n)


def sort_by_time(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Total time order, ties by channel; with `partitions`, ranges of time sorted within, for writing."""
    order = [c for c in ("time", "channel") if c in df.columns]
    if partitions:
        return df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    return df.orderBy(*order)


def per_class(peaks: DataFrame) -> DataFrame:
    return peaks.groupBy("type").agg(F.count("*").alias("n"))
