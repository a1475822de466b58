"""Column expressions: positions, corrections, names, urls, arrays. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN = float("nan")


def floor_div(x: Column, d) -> Column:
    """Floor division of longs, also right for negative ones (DIV truncates)."""
    d = d if isinstance(d, Column) else F.lit(d)
    return F.call_function("div", x - F.pmod(x, d), d)


def array_sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double"))


def poly(x: Column, coefficients) -> Column:
    """Polynomial, highest power first, by Horner's rule."""
    out = F.lit(0.0)
    for c in coefficients:
        out = out * x + F.lit(float(c))
    return out


def center_time(time: Column, dt: Column, data: Column, area: Column) -> Column:
    """time + trunc(sum(i * dt * data[i]) / area) if area > 0, else time."""
    weighted = F.aggregate(
        F.transform(data, lambda w, i: i.cast("double") * dt * w), F.lit(0.0), lambda s, x: s + x
    )
    return F.when(area > 0, time + F.try_divide(weighted, area).cast("bigint")).otherwise(time)


def bin_index(x: Column, edges) -> Column:
    """Index of the half-open bin that holds x, the last bin closed; null outside and for null and NaN."""
    edges = [float(e) for e in edges]
    below = F.size(F.filter(F.lit(edges), lambda e: e <= x))
    inside = x.isNotNull() & ~F.isnan(x) & (x >= edges[0]) & (x <= edges[-1])
    return F.when(inside, F.least(below, F.lit(len(edges) - 1)) - 1)


def run_key(number: Column) -> Column:
    """A run number as its six-digit name."""
    return F.lpad(number.cast("string"), 6, "0")


def run_range(text: Column) -> tuple[Column, Column]:
    """(first, last) six-digit names of "start-end", "start-*" or a single run; an open end sorts after every run."""
    parts = F.split(F.trim(text), "-")
    first, last = F.trim(F.get(parts, F.lit(0))), F.trim(F.coalesce(F.get(parts, F.lit(1)), F.get(parts, F.lit(0))))
    pad = lambda s: F.when(s == "*", F.lit("999999")).otherwise(F.lpad(s, 6, "0"))
    return F.when(first == "*", F.lit("000000")).otherwise(F.lpad(first, 6, "0")), pad(last)


def config_url(text: Column) -> dict[str, Column]:
    """scheme and the query values version, filename, github_branch of a configuration url; null if absent."""
    out = {"scheme": F.regexp_extract(text, r"^([a-z0-9_]+)://", 1)}
    for key in ("version", "filename", "github_branch"):
        out[key] = F.try_parse_url(text, F.lit("QUERY"), F.lit(key))
    return out


def split_off_ns(time: Column, second: int = 1_000_000_000) -> tuple[Column, Column]:
    """Whole seconds and the rest of a time."""
    return floor_div(time, second), F.pmod(time, F.lit(second))


def channel_polarity(registers: Column) -> Column:
    """array<struct<channel, value, polarity>> of the polarity registers of a digitizer.

    A register counts if its hex address starts with 1 and ends with 80; its channel is (address - 0x1080) DIV 0x100;
    values 110000 and 1110000 mean -1, 100000 and 1100000 mean +1, any other null.
    """
    chosen = F.filter(registers, lambda r: F.startswith(F.lower(r["reg"]), F.lit("1")) & F.endswith(F.lower(r["reg"]), F.lit("80")))
    bare = lambda v: F.regexp_replace(F.lower(v), "^0x", "")

    def one(r: Column) -> Column:
        address = F.conv(r["reg"], 16, 10).cast("bigint")
        sign = F.when(bare(r["val"]).isin("110000", "1110000"), -1).when(bare(r["val"]).isin("100000", "1100000"), 1)
        channel = floor_div(address - 0x1080, 0x100).cast("int")
        return F.struct(channel.alias("channel"), r["val"].alias("value"), sign.alias("polarity"))

    return F.transform(chosen, one)


def hit_threshold(model, n_channels: int) -> list[float]:
    """Threshold of each channel: a number for all, a list as given, a named model 15 ADC."""
    if isinstance(model, (int, float)):
        return [float(model)] * n_channels
    if isinstance(model, str):
        return [15.0] * n_channels
    if len(model) != n_channels:
        raise ValueError(f"{len(model)} thresholds for {n_channels} channels")
    return [float(x) for x in model]
