"""Projections, filters and predicates."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import NAN, array_sum, floor_div
from ..schemas import CHANNEL_MAP, DEAD_TIME_CHANNEL, PeakConfig


def select_channels(df: DataFrame, channels) -> DataFrame:
    return df.where(F.col("channel").isin(list(channels)))


def select_time(
    df: DataFrame,
    time_range: tuple[int, int] | None = None,
    seconds_range: tuple[float, float] | None = None,
    time_within: tuple[int, int] | None = None,
    mode: str = "touching",
    predicate: str | None = None,
    run_start: int = 0,
    warn_beyond_sec: float | None = None,
) -> DataFrame:
    """Intervals (time, endtime) that touch a range, or lie fully in it (mode fully_contained).

    The range is one of: ticks, seconds since run_start, or another interval's (time, endtime).
    """
    given = [r for r in (time_range, seconds_range, time_within) if r is not None]
    if len(given) > 1:
        raise ValueError("give one kind of range")
    if seconds_range is not None:
        start, stop = (run_start + int(s * 1e9) for s in seconds_range)
    else:
        start, stop = given[0] if given else (None, None)
    if given:
        if warn_beyond_sec is not None and stop - start > warn_beyond_sec * 1e9:
            warnings.warn(f"more than {warn_beyond_sec} s were asked for", stacklevel=2)
        if mode == "touching":
            df = df.where((F.col("endtime") > start) & (F.col("time") < stop))
        elif mode == "fully_contained":
            df = df.where((F.col("time") >= start) & (F.col("endtime") <= stop))
        else:
            raise ValueError(f"unknown mode {mode}")
    return df.where(F.expr(predicate)) if predicate else df


def to_epoch(df: DataFrame, run_start_s: float) -> DataFrame:
    """Times since the run's start become times since the epoch: whole samples of the start time are added.

    One dt per detector: the first by time of the channel's detector would do, and all are equal.
    """
    start = int(run_start_s) * 1_000_000_000
    return df.withColumn("time", F.col("time") + F.col("dt").cast("bigint") * floor_div(F.lit(start), F.col("dt").cast("bigint")))


def apply_polarity(df: DataFrame, polarity: DataFrame) -> DataFrame:
    """Samples of channels with polarity +1 are negated; polarity (channel, polarity) has a row a channel at most."""
    flip = F.broadcast(polarity.where("polarity = 1").select(F.col("channel").alias("__channel")).distinct())
    joined = df.join(flip, df["channel"] == flip["__channel"], "left")
    data = F.when(F.col("__channel").isNotNull(), F.transform("data", lambda x: -x)).otherwise(F.col("data"))
    kind = dict(df.dtypes)["data"]
    return joined.withColumn("data", data.cast(kind)).drop("__channel")


def route_detectors(df: DataFrame, channel_map=None, unknown: str = "error") -> DataFrame:
    """Adds detector: tpc (from the least to the largest of bottom and top), external, sipm or dead_time.

    Ranges are inclusive; the first match wins. unknown: error raises on any other channel, null keeps it with a null.
    """
    m = dict(channel_map or CHANNEL_MAP)
    tpc = [m[k] for k in ("bottom", "top") if k in m]
    ranges = [("tpc", (min(a for a, _ in tpc), max(b for _, b in tpc)))] if tpc else []
    ranges += [(k, v) for k, v in m.items() if k not in ("bottom", "top")]
    channel, detector = F.col("channel"), F.when(F.col("channel") == DEAD_TIME_CHANNEL, "dead_time")
    for name, (a, b) in ranges:
        detector = detector.when(channel.between(a, b), name)
    if unknown == "error":
        detector = detector.otherwise(F.raise_error(F.concat(F.lit("no detector has channel "), channel.cast("string"))))
    return df.withColumn("detector", detector)


def keep_tpc(df: DataFrame, n: int) -> DataFrame:
    return df.where(F.col("channel") < n)


def zero_out_of_bounds(df: DataFrame) -> DataFrame:
    """Samples at and beyond length become zero."""
    kind = dict(df.dtypes)["data"]
    return df.withColumn("data", F.transform("data", lambda x, i: F.when(i < F.col("length"), x).otherwise(0)).cast(kind))


def split_by(df: DataFrame, first_other_channel: int) -> tuple[DataFrame, DataFrame]:
    """Rows of the channels below a limit, and the others (null channels too)."""
    below = F.coalesce(F.col("channel") < first_other_channel, F.lit(False))
    return df.where(below), df.where(~below)


def peak_type(cfg: PeakConfig, mode: str = "tpc") -> Column:
    """1, 2 or 0 from area, range_50p_area, area_fraction_top and n_channels; a peak that fits both is 2.

    A null or NaN fraction fits neither class of the tpc. mode aux: areas (S1 from 0 on, S2 above 0) and widths only.
    """
    area, width, aft, n = (F.col(c) for c in ("area", "range_50p_area", "area_fraction_top", "n_channels"))
    narrow = (width > cfg.s1_min_width) & (width < cfg.s1_max_width)
    if mode == "aux":
        is_s1, is_s2 = (area >= 0) & narrow, (area > 0) & (width > cfg.s2_min_width)
    else:
        known = aft.isNotNull() & ~F.isnan(aft)
        is_s1 = (area >= cfg.s1_min_area) & narrow & known & (aft <= cfg.s1_max_aft) & (n >= cfg.s1_min_channels)
        is_s2 = (area > cfg.s2_min_area) & (width > cfg.s2_min_width) & known & (aft >= cfg.s2_min_aft) & (n >= cfg.s2_min_channels)
    return F.when(is_s2, 2).when(is_s1, 1).otherwise(0)


def classify_peaks(df: DataFrame, cfg: PeakConfig = PeakConfig(), mode: str = "tpc") -> DataFrame:
    return df.withColumn("type", peak_type(cfg, mode))


def trigger_peaks(df: DataFrame, min_area: float = 10.0) -> DataFrame:
    return df.where((F.col("type") == 2) & (F.col("area") > min_area))


def absorption_window(df: DataFrame, centre: float = 511.0, delta: float = 65.0) -> DataFrame:
    """Areas strictly within delta of the centre."""
    return df.where((F.col("area") > centre - delta) & (F.col("area") < centre + delta))


def scatter_view(events: DataFrame, columns=("cs1", "cs2"), least: float = 0.9) -> DataFrame:
    """Missing areas as zero, then none below `least`, as logarithmic axes want them."""
    return events.withColumns({c: F.greatest(F.nanvl(F.coalesce(F.col(c), F.lit(0.0)), F.lit(0.0)), F.lit(least)) for c in columns})


#: Most runs with offenders that an observation names, and items that it tracks for that; so many are counted exactly.
OBSERVED_RUNS = 1000


def observed(df: DataFrame, bad: Column, observation: Observation) -> DataFrame:
    """df, unchanged; when it is computed, the observation gets rows, offenders (rows that are bad) and runs, the runs that
    have any with how many (of more than OBSERVED_RUNS, those with most), in the same pass: no second scan. What is
    gathered is bounded, however many rows offend."""
    runs = F.expr(f"approx_top_k(__bad_run, {OBSERVED_RUNS}, {4 * OBSERVED_RUNS})")
    named = F.filter(runs, lambda r: r["item"].isNotNull())
    marked = df.withColumn("__bad_run", F.when(bad, F.col("run_id")))
    return marked.observe(observation, F.count("*").alias("rows"), F.count("__bad_run").alias("offenders"), named.alias("runs")).drop("__bad_run")


def check_area(df: DataFrame, channel_map=None, rtol: float = 1e-4, fail: bool = False, observation: Observation | None = None) -> DataFrame:
    """Offending rows: area > 0, but top and bottom areas do not sum up to it; with fraction_off.

    fail: df itself, in which an offender raises an error when it is computed. observation: df itself; offenders are
    counted by run in it when it is computed (see observed).
    """
    total = top_area(channel_map) + bottom_area(channel_map)
    area = F.col("area")
    bad = (area > 0) & (F.abs(total - area) > 1e-8 + rtol * F.abs(area))
    off = 1 - total / area
    if observation is not None:
        return observed(df, F.coalesce(bad, F.lit(False)), observation)
    if not fail:
        return df.where(bad).withColumn("fraction_off", off)
    said = F.concat(F.lit("area is off by a fraction of "), off.cast("string"))
    return df.withColumn("area", F.when(bad, F.raise_error(said).cast("double")).otherwise(area))


def _channels_area(first: int, last: int) -> Column:
    return array_sum(F.slice(F.col("area_per_channel"), first + 1, last - first + 1))


def top_area(channel_map=None) -> Column:
    return _channels_area(*(channel_map or CHANNEL_MAP)["top"])


def bottom_area(channel_map=None) -> Column:
    return _channels_area(*(channel_map or CHANNEL_MAP)["bottom"])


def fraction_top(channel_map=None) -> Column:
    """top / (top + bottom); NaN unless the area is positive."""
    total = top_area(channel_map) + bottom_area(channel_map)
    return F.when(F.col("area") > 0, F.coalesce(F.try_divide(top_area(channel_map), total), F.lit(NAN))).otherwise(F.lit(NAN))
