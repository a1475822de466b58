"""Record level: overlap checks, baselines, lone pulses, counts, pulse assembly, LED calibration."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.columns import NAN, floor_div
from ..functions.kernels import Lists
from ..schemas import SLAB_NS
from .filters import observed
from .intervals import break_groups, overlap_join, sessionize

_PAST = (Window.unboundedPreceding, -1)


def _end() -> Column:
    return F.col("time") + F.col("length").cast("bigint") * F.col("dt")


def _with_previous_end(df: DataFrame, slab: int) -> DataFrame:
    """df with previous_end: where the row before in the channel ends. Rows meet within slabs of time; one narrow row
    per channel and slab carries the last end across."""
    stamp = F.struct("time", "record_i")
    rows = df.withColumn("__slab", floor_div(F.col("time"), slab))
    last = rows.groupBy("run_id", "channel", "__slab").agg(F.max(F.struct(stamp.alias("at"), _end().alias("end"))).alias("__last"))
    earlier = Window.partitionBy("run_id", "channel").orderBy("__slab")
    carry = last.withColumn("__carry", F.lag("__last.end").over(earlier)).drop("__last")
    before = F.lag(_end()).over(Window.partitionBy("run_id", "channel", "__slab").orderBy("time", "record_i"))
    rows = rows.join(carry, ["run_id", "channel", "__slab"])
    return rows.withColumn("previous_end", F.coalesce(before, "__carry")).drop("__slab", "__carry")


def check_overlaps(df: DataFrame, fail: bool = False, slab: int = SLAB_NS, observation: Observation | None = None) -> DataFrame:
    """Rows that start before the row before them in their channel ends, with previous_end.

    fail: df itself, in which such a row raises an error when it is computed. observation: df itself; such rows are
    counted by run in it when it is computed (see filters.observed).
    """
    found, over = _with_previous_end(df, slab), F.col("time") < F.col("previous_end")
    if observation is not None:
        return observed(found, F.coalesce(over, F.lit(False)), observation).drop("previous_end")
    if not fail:
        return found.where(over)
    error = F.raise_error(F.concat(F.lit("pulses overlap in channel "), F.col("channel").cast("string"))).cast("bigint")
    return found.withColumn("time", F.when(over, error).otherwise(F.col("time"))).drop("previous_end")


def baseline(
    df: DataFrame, samples: int = 20, flip: bool = True, fallback: float = 16000.0, allow_sloppy: bool = True, slab: int = SLAB_NS
) -> DataFrame:
    """Adds baseline and baseline_rms and subtracts the baseline.

    A first fragment (record_i 0) has the mean and population deviation of its first `samples` samples, padding
    included; a later one inherits the last first fragment of its channel; if there was none: fallback and NaN, or an
    error unless allow_sloppy. data becomes -(data - trunc(baseline)) within length if flip; padding stays 0.

    The last value is carried within slabs of time and, by one narrow row per channel and slab, across them.
    """
    kind = dict(df.dtypes)["data"]
    head = F.slice("data", 1, samples)
    n = F.size(head)
    mean = F.try_divide(F.aggregate(head, F.lit(0.0), lambda s, x: s + x.cast("double")), n)
    square = F.try_divide(F.aggregate(head, F.lit(0.0), lambda s, x: s + x.cast("double") * x), n)
    own = F.when(F.col("record_i") == 0, F.struct(mean.alias("b"), F.sqrt(F.greatest(square - mean * mean, F.lit(0.0))).alias("r")))
    rows = df.withColumns({"__own": own, "__slab": floor_div(F.col("time"), slab)})
    keys = ["run_id", "channel"]
    stamp = F.struct("time", "record_i")
    last = rows.groupBy(*keys, "__slab").agg(F.max_by("__own", F.when(F.col("__own").isNotNull(), stamp)).alias("__last"))
    earlier = Window.partitionBy(*keys).orderBy("__slab").rowsBetween(*_PAST)
    carry = last.select(*keys, "__slab", F.last("__last", ignorenulls=True).over(earlier).alias("__carry"))
    order = Window.partitionBy(*keys, "__slab").orderBy("time", "record_i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(carry, [*keys, "__slab"])
    found = F.coalesce(F.last("__own", ignorenulls=True).over(order), F.col("__carry"))
    rows = rows.withColumn("__found", found)
    base = F.coalesce(F.col("__found.b"), F.lit(fallback) if allow_sloppy else F.raise_error(F.lit("a pulse has no first fragment")).cast("double"))
    rows = rows.withColumns({"baseline": base, "baseline_rms": F.coalesce(F.col("__found.r"), F.lit(NAN))})
    if flip:
        whole = F.col("baseline").cast("int")
        data = F.transform("data", lambda x, i: F.when(i < F.col("length"), -(x - whole)).otherwise(F.lit(0)))
        rows = rows.withColumn("data", data.cast("array<int>" if kind == "array<smallint>" else kind))
    return rows.drop("__own", "__slab", "__carry", "__found")


def integrate(df: DataFrame) -> DataFrame:
    """Adds area, the sum of the samples."""
    return df.withColumn("area", F.aggregate("data", F.lit(0).cast("bigint"), lambda s, x: s + x))


def lone_pulses(df: DataFrame, slab: int = SLAB_NS) -> DataFrame:
    """Adds lone: a first fragment after the end of all earlier pulses of all channels, whose own end lies before the
    next record's time. The very last record is never lone; the next record may be the pulse's own second fragment.
    Later fragments carry the flag of the last first fragment of their channel (null if there was none)."""
    stop = F.col("time") + F.col("pulse_length").cast("bigint") * F.col("dt")
    rows = df.withColumns({"__slab": floor_div(F.col("time"), slab), "__stop": F.when(F.col("record_i") == 0, stop)})
    per = rows.groupBy("run_id", "__slab").agg(F.max("__stop").alias("__top"), F.min("time").alias("__first"))
    by = Window.partitionBy("run_id").orderBy("__slab")
    per = per.select(
        "run_id", "__slab", F.max("__top").over(by.rowsBetween(*_PAST)).alias("__before"), F.lead("__first").over(by).alias("__after")
    )
    local = Window.partitionBy("run_id", "__slab").orderBy("time", "channel", "record_i")
    rows = rows.join(per, ["run_id", "__slab"]).withColumns(
        {
            "__busy": F.greatest(F.max("__stop").over(local.rowsBetween(*_PAST)), F.col("__before")),
            "__next": F.coalesce(F.lead("time").over(local), F.col("__after")),
        }
    )
    clear = (F.col("__busy").isNull() | (F.col("time") > F.col("__busy"))) & (F.col("__stop") < F.col("__next"))
    rows = rows.withColumn("__flag", F.when(F.col("record_i") == 0, F.coalesce(clear, F.lit(False))))
    keys, stamp = ["run_id", "channel"], F.struct("time", "record_i")
    last = rows.groupBy(*keys, "__slab").agg(F.max_by("__flag", F.when(F.col("__flag").isNotNull(), stamp)).alias("__last"))
    earlier = Window.partitionBy(*keys).orderBy("__slab").rowsBetween(*_PAST)
    carry = last.select(*keys, "__slab", F.last("__last", ignorenulls=True).over(earlier).alias("__carry"))
    order = Window.partitionBy(*keys, "__slab").orderBy("time", "record_i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(carry, [*keys, "__slab"])
    rows = rows.withColumn("lone", F.coalesce(F.last("__flag", ignorenulls=True).over(order), F.col("__carry")))
    return rows.drop("__slab", "__stop", "__before", "__after", "__busy", "__next", "__flag", "__carry")


def channel_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("run_id", "chunk_i", "channel").agg(F.count("*").alias("n"))


def pulse_counts(df: DataFrame, n_channels: int) -> DataFrame:
    """Per (run_id, chunk_i, channel), every channel below n_channels present: pulse_count, lone_pulse_count,
    pulse_area (all fragments), lone_pulse_area, baseline_mean (truncated; -9999 without pulses), baseline_rms_mean
    (NaN without). df has area, baseline, baseline_rms and lone."""
    first = F.col("record_i") == 0
    lone = F.coalesce(F.col("lone"), F.lit(False))
    sums = df.where(F.col("channel") < n_channels).groupBy("run_id", "chunk_i", "channel").agg(
        F.count(F.when(first, 1)).alias("pulse_count"),
        F.count(F.when(first & lone, 1)).alias("lone_pulse_count"),
        F.sum("area").alias("pulse_area"),
        F.coalesce(F.sum(F.when(lone, F.col("area"))), F.lit(0)).alias("lone_pulse_area"),
        F.avg(F.when(first, F.col("baseline"))).alias("__b"),
        F.avg(F.when(first, F.col("baseline_rms"))).alias("__r"),
    )
    grid = df.select("run_id", "chunk_i").distinct().withColumn("channel", F.explode(F.sequence(F.lit(0), F.lit(n_channels - 1))))
    full = grid.join(sums, ["run_id", "chunk_i", "channel"], "left")
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("pulse_count", "lone_pulse_count", "pulse_area", "lone_pulse_area")}
    return full.withColumns(
        counts | {"baseline_mean": F.coalesce(F.col("__b").cast("int"), F.lit(-9999)), "baseline_rms_mean": F.coalesce("__r", F.lit(NAN))}
    ).drop("__b", "__r")


def pulse_counts_arrays(counts: DataFrame) -> DataFrame:
    """pulse_counts() with one row per chunk and an array by channel of each column."""
    columns = [c for c in counts.columns if c not in ("run_id", "chunk_i", "channel")]
    gathered = counts.groupBy("run_id", "chunk_i").agg(F.sort_array(F.collect_list(F.struct("channel", *columns))).alias("__c"))
    return gathered.select("run_id", "chunk_i", *[F.col(f"__c.{c}").alias(c) for c in columns])


def insert_dead_time(df: DataFrame, end: int, cut: int, dt: int, part: str, channel: int = 799) -> DataFrame:
    """What becomes of a stream part that has no break to be cut at.

    post: rows that end after the cut are dropped and one dead-time row from cut to end is added; pre: only the
    dead-time row from cut to end stays, which is DIV dt samples long. One such row per run_id.
    """
    rows = df.where(_end() <= cut) if part == "post" else df.limit(0)
    made = df.select("run_id").distinct().select(
        "run_id", F.lit(cut).cast("bigint").alias("time"), F.lit((end - cut) // dt).cast("int").alias("length"), F.lit(dt).alias("dt"), F.lit(channel).alias("channel")
    )
    return rows.unionByName(made, allowMissingColumns=True)


def safe_parts(
    fragments: DataFrame, chunk: int, overlap: int, safe_break: int = 1000, record_length: int = 110, dt: int = 10, dead_channel: int = 799, slab: int = SLAB_NS
) -> DataFrame:
    """fragments (run_id, chunk_i, kind, time, length, dt, ...) of all chunks, each row once: the overlap of two chunks,
    which the one before holds as post and the one after as pre, is cut at one time.

    Chunk i covers `chunk` ticks from i * (chunk + overlap) on, and the overlap follows. The cut is safe_break before its
    end if all is quiet from there on; else after the first safe_break of quiet that no record of the chunk before can
    reach into; else, with data loss, safe_break before the end: what reaches beyond goes, and dead-time rows (of
    dead_channel, otherwise null) mark the longest record before the cut and all after it. post keeps what lies before
    the cut, pre what starts after it; a pre part of the first chunk is ignored. All overlaps are cut at once, each on
    its own.
    """
    place = ["run_id", "chunk_i", "kind"]
    begin = F.col("chunk_i").cast("bigint") * (chunk + overlap) + F.when(F.col("kind") == "pre", -overlap).otherwise(chunk)
    sides = fragments.where((F.col("kind") == "post") | ((F.col("kind") == "pre") & (F.col("chunk_i") > 0)))
    sides = sides.withColumns({"endtime": _end(), "__begin": begin})
    sides = break_groups(sides, safe_break, F.col("__begin") + record_length * dt, slab, place)
    part = sides.groupBy(*place).agg(F.max("endtime").alias("__last"), F.max("break_group").alias("__groups"), F.first("__begin").alias("__from"))
    stop, cut = F.col("__from") + overlap, F.col("__from") + overlap - safe_break
    quiet = F.col("__last") + safe_break < stop
    part = part.withColumns({"__case": F.when(quiet, 0).when(F.col("__groups") > 0, 1).otherwise(2), "__cut": cut, "__stop": stop})
    joined = sides.join(part.select(*place, "__case", "__cut"), place)
    case, post = F.col("__case"), F.col("kind") == "post"
    stays = F.when(case == 0, post).when(case == 1, post == (F.col("break_group") == 0)).otherwise(post & (F.col("endtime") <= F.col("__cut")))
    kept = joined.where(stays).select(*fragments.columns)
    first = F.when(post, F.col("__cut") - record_length * dt).otherwise(F.col("__cut"))
    last = F.when(post, F.col("__cut")).otherwise(F.col("__stop"))
    kinds = dict(fragments.dtypes)
    dead = part.where("__case = 2").select(
        *place, first.alias("time"), F.call_function("div", last - first, F.lit(dt)).cast(kinds["length"]).alias("length"),
        F.lit(dt).cast(kinds["dt"]).alias("dt"), F.lit(dead_channel).cast(kinds["channel"]).alias("channel"),
    )
    central = fragments.where("kind = 'central'")
    return central.unionByName(kept).unionByName(dead, allowMissingColumns=True).select(*fragments.columns)


def assemble_pulse(df: DataFrame) -> DataFrame:
    """(run_id, channel, pulse_start, n_fragments, data): the fragments of each pulse by record_i, trimmed to length.

    A pulse starts at time - record_i * (samples of a full fragment) * dt, so fragments need no ordered window.
    """
    part = F.struct("record_i", F.slice("data", F.lit(1), F.greatest(F.col("length"), F.lit(0))).alias("d"))
    return df.groupBy("run_id", "channel", _pulse_start().alias("pulse_start")).agg(
        F.count("*").alias("n_fragments"), F.flatten(F.transform(F.sort_array(F.collect_list(part)), lambda p: p["d"])).alias("data")
    )


def _pulse_start() -> Column:
    return F.col("time") - F.col("record_i").cast("bigint") * F.size("data") * F.col("dt")


def led_pulses(df: DataFrame, n_records: int = 2, baseline_window: tuple[int, int] = (0, 50)) -> DataFrame:
    """One row per pulse with at least n_records fragments: their samples joined untrimmed, minus the mean of a window,
    negated; length is the sum of lengths, other fields are the first fragment's."""
    part = F.struct("record_i", "length", "dt", "pulse_length", "data")
    grouped = df.where(F.col("record_i") < n_records).groupBy("run_id", "channel", _pulse_start().alias("time")).agg(F.sort_array(F.collect_list(part)).alias("__p"))
    whole = grouped.where(F.size("__p") == n_records).select(
        "run_id",
        "channel",
        "time",
        F.get("__p", F.lit(0))["dt"].alias("dt"),
        F.get("__p", F.lit(0))["pulse_length"].alias("pulse_length"),
        F.aggregate("__p", F.lit(0), lambda s, p: s + p["length"]).alias("length"),
        F.flatten(F.transform("__p", lambda p: p["data"])).alias("__d"),
    )
    a, b = baseline_window
    window = F.slice("__d", a + 1, b - a)
    mean = F.try_divide(F.aggregate(window, F.lit(0.0), lambda s, x: s + x.cast("double")), F.size(window))
    return whole.withColumn("__m", mean).withColumn("data", F.transform("__d", lambda x: -(x - F.col("__m")))).drop("__d", "__m")


def led_calibration(pulses: DataFrame, led_window: tuple[int, int] = (80, 110), noise_window: tuple[int, int] = (0, 10)) -> DataFrame:
    """amplitude_led and amplitude_noise: the largest sample of a window; area: the mean of six sums from the led
    window's start to its end, and to 2, 4, ... 10 samples later."""
    part = lambda a, b: F.slice("data", a + 1, max(b - a, 0))
    sums = [F.aggregate(part(led_window[0], led_window[1] + 2 * i), F.lit(0.0), lambda s, x: s + x) for i in range(6)]
    total = sums[0]
    for s in sums[1:]:
        total = total + s
    return pulses.select(
        "run_id",
        "channel",
        "time",
        F.array_max(part(*led_window)).alias("amplitude_led"),
        F.array_max(part(*noise_window)).alias("amplitude_noise"),
        (total / 6).alias("area"),
    )


def gain_to_pe(hits: DataFrame, gains: list[float] | None = None) -> DataFrame:
    """area times the channel's gain; without gains, 1; a channel beyond the list gets null."""
    factor = F.get(F.lit([float(g) for g in gains]), F.col("channel")) if gains else F.lit(1.0)
    return hits.withColumn("area", F.col("area") * factor)


def record_points(records: DataFrame, raw: bool = False, peaks: DataFrame | None = None, bucket: int = 100_000) -> DataFrame:
    """(run_id, channel, record_time, offset, sample): samples up to length, by ticks since the run's first record.

    raw samples are negated. With peaks (run_id, peak_id, time, endtime): the records that touch each peak, by ticks
    since its start, with peak_id; a record that touches several peaks comes once for each.
    """
    if peaks is None:
        first = records.groupBy("run_id").agg(F.min("time").alias("__first"))
        rows, named = records.join(F.broadcast(first), "run_id"), ["run_id"]  # one row a run
    else:
        touching = records.withColumn("endtime", _end()).select("run_id", "channel", "time", "endtime", "dt", "length", "data")
        met = overlap_join(peaks.select("run_id", "peak_id", "time", "endtime"), touching, bucket)
        rows = met.select("run_id", "peak_id", F.col("time").alias("__first"), *[F.col(f"r_{c}").alias(c) for c in ("channel", "time", "dt", "length", "data")])
        named = ["run_id", "peak_id"]
    points = rows.select(
        *named, "channel", F.col("time").alias("record_time"), "dt", "__first", F.posexplode(F.slice("data", F.lit(1), F.greatest(F.col("length"), F.lit(0)))).alias("i", "sample")
    )
    value = -F.col("sample") if raw else F.col("sample")
    offset = F.col("record_time") - F.col("__first") + F.col("i") * F.col("dt")
    return points.select(*named, "channel", "record_time", offset.alias("offset"), value.alias("sample"))


def build_peaks(
    hits: DataFrame, n_channels: int, gap: int = 300, left: int = 10, right: int = 10, min_area: float = 10.0, min_channels: int = 1, slab: int = SLAB_NS
) -> DataFrame:
    """Clusters hits into peaks: run_id, peak_id, time, endtime, area, area_per_channel, n_hits, n_channels.

    hits: run_id, time, endtime, channel, area in PE. Bounds are extended; peaks below min_area or min_channels go.
    Sums go by (peak, channel) first, so a peak's hits are never gathered.
    """
    rows = sessionize(hits.select("run_id", "time", "endtime", "channel", "area"), gap, slab=slab, group="peak_id")
    by_channel = rows.groupBy("run_id", "peak_id", "channel").agg(
        F.sum("area").alias("a"), F.count("*").alias("n"), F.min("time").alias("t0"), F.max("endtime").alias("t1")
    )
    areas = F.map_from_entries(F.collect_list(F.struct("channel", "a")))
    peaks = by_channel.groupBy("run_id", "peak_id").agg(
        (F.min("t0") - left).alias("time"),
        (F.max("t1") + right).alias("endtime"),
        F.sum("a").alias("area"),
        F.sum("n").alias("n_hits"),
        F.count("*").alias("n_channels"),
        areas.alias("__m"),
    )
    per = F.transform(F.sequence(F.lit(0), F.lit(n_channels - 1)), lambda c: F.coalesce(F.try_element_at("__m", c), F.lit(0.0)))
    peaks = peaks.withColumn("area_per_channel", per).drop("__m")
    return peaks.where((F.col("area") >= min_area) & (F.col("n_channels") >= min_channels))


def sum_waveform(peaks: DataFrame, records: DataFrame, gains: list[float] | None = None, bucket: int = 100_000) -> DataFrame:
    """(run_id, peak_id, time, dt, length, area, data): gain-weighted samples of all records on each peak's own grid.

    Record samples fall to the peak sample DIV dt after its start; samples outside the peak are left out. A channel
    beyond the gains adds nothing.

    No sample is a row: the pairs of peak and record that meet are added up batch by batch where they meet, as aligned
    arrays, and only these partial sums (one row for each peak and batch, as long as what the records cover) are shuffled
    by peak and added again.
    """
    rec = records.select("run_id", "time", _end().alias("endtime"), "channel", "dt", "length", "data")
    met = overlap_join(peaks.select("run_id", "peak_id", "time", "endtime"), rec, bucket)
    factor = F.coalesce(F.get(F.lit([float(g) for g in gains]), F.col("r_channel")), F.lit(0.0)) if gains else F.lit(1.0)
    pairs = met.select("run_id", "peak_id", "time", "endtime", F.col("r_dt").alias("dt"), "r_time", factor.alias("g"), F.col("r_length").alias("n"), F.col("r_data").alias("data"))
    kind = dict(pairs.dtypes)
    key = f"run_id {kind['run_id']}, peak_id {kind['peak_id']}, time bigint, endtime bigint, dt int"
    names = ["run_id", "peak_id", "time", "endtime", "dt"]

    def add_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            col = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            time, endtime, start = (np.asarray(col[n]) for n in ("time", "endtime", "r_time"))
            dt, lists = np.asarray(col["dt"]).astype(np.int64), Lists(col["data"], col["n"])
            first = np.clip(-((start - time) // dt), 0, lists.sizes)  # the record's first sample at or after the peak's start
            last = np.clip(-((start - endtime) // dt), first, lists.sizes)
            at = (start + first * dt - time) // dt  # the peak's sample that it falls to
            _, one, peak = np.unique(np.stack([pd.factorize(col[n].to_pandas())[0] for n in names[:2]] + [time, endtime, dt]), axis=1, return_index=True, return_inverse=True)
            low, high = np.full(len(one), 1 << 62), np.zeros(len(one), dtype=np.int64)
            some = last > first
            np.minimum.at(low, peak[some], at[some])
            np.maximum.at(high, peak[some], (at + last - first)[some])
            low = np.minimum(low, high)
            begin = np.concatenate(([0], np.cumsum(high - low)))
            used = (lists.index >= first[lists.row]) & (lists.index < last[lists.row])
            row = lists.row[used]
            place = begin[peak[row]] + at[row] - low[peak[row]] + lists.index[used] - first[row]
            sums = np.bincount(place, lists.values[used] * np.asarray(col["g"])[row], minlength=begin[-1])
            took = pa.array(one)
            data = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(sums))
            yield pa.RecordBatch.from_arrays([*[col[n].take(took) for n in names], pa.array(low), data], [*names, "at", "part"])

    def add_parts(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        time, endtime, dt = (k.as_py() for k in key[2:])
        data = np.zeros(max(0, -((time - endtime) // dt)))
        for batch in batches:
            for at, part in zip(batch.column("at").to_pylist(), batch.column("part"), strict=True):
                values = np.asarray(part.values)
                data[at : at + len(values)] += values
        whole = [pa.array([k.as_py()], k.type) for k in key]
        yield pa.RecordBatch.from_arrays([*whole, pa.array([len(data)], pa.int32()), pa.array([float(data.sum())]), pa.array([data])], [*names, "length", "area", "data"])

    parts = pairs.mapInArrow(add_batch, f"{key}, at bigint, part array<double>").where("size(part) > 0")
    added = parts.groupBy(*names).applyInArrow(add_parts, f"{key}, length int, area double, data array<double>")
    return added.select("run_id", "peak_id", "time", "endtime", "dt", "length", "area", "data")
