"""Aggregations: counts, peaks, histograms, matrices, positions, LED calibration."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import kernels
from ..operators import analysis, filters, peaks, records
from ..schemas import PeakConfig
from .base import query, rounded, v_fragments, v_light, v_peaks, v_waves

_FRAGMENTS = "v_waves v_fragments"


@query("select run_id, chunk_i, channel, count(*) as n from v_fragments group by all", _FRAGMENTS)
def g1_channel_counts(spark, sf):
    return records.channel_counts(v_fragments(spark, sf))


@query("select time, channel, cast(list_sum(data) as bigint) as area from v_fragments", _FRAGMENTS)
def g2_integrate(spark, sf):
    return records.integrate(v_fragments(spark, sf)).select("time", "channel", "area")


_G3 = """
with own as (select *, case when record_i = 0 then list_avg(data) end as b, case when record_i = 0 then time + pulse_length * dt end as stop from v_fragments),
f as (select *, last_value(b ignore nulls) over (partition by channel order by time, record_i rows between unbounded preceding and current row) as baseline,
  max(stop) over (order by time, channel, record_i rows between unbounded preceding and 1 preceding) as busy, lead(time) over (order by time, channel, record_i) as nxt from own),
fl as (select *, case when record_i = 0 then coalesce((busy is null or time > busy) and stop < nxt, false) end as flag,
  cast(-list_sum(list_transform(data, lambda x: x - trunc(baseline))) as bigint) as area from f),
l as (select *, last_value(flag ignore nulls) over (partition by channel order by time, record_i rows between unbounded preceding and current row) as lone from fl),
g as (select run_id, chunk_i, channel, count(*) filter (record_i = 0) as pulse_count, count(*) filter (record_i = 0 and lone) as lone_pulse_count, cast(sum(area) as bigint) as pulse_area,
  cast(coalesce(sum(area) filter (lone), 0) as bigint) as lone_pulse_area, cast(trunc(avg(baseline) filter (record_i = 0)) as int) as baseline_mean from l where channel < 12 group by all),
grid as (select distinct run_id, chunk_i, cast(c as int) as channel from v_fragments, unnest(range(0, 12)) as t(c))
select run_id, chunk_i, channel, coalesce(pulse_count, 0) as pulse_count, coalesce(lone_pulse_count, 0) as lone_pulse_count, coalesce(pulse_area, 0) as pulse_area,
  coalesce(lone_pulse_area, 0) as lone_pulse_area, coalesce(baseline_mean, -9999) as baseline_mean from grid left join g using (run_id, chunk_i, channel)"""


@query(_G3, _FRAGMENTS)
def g3_pulse_counts(spark, sf):
    rows = records.integrate(records.baseline(v_fragments(spark, sf), slab=20_000))
    return records.pulse_counts(records.lone_pulses(rows, slab=20_000), 12).drop("baseline_rms_mean")


_HITS = """runs as (select w.run_id, w.channel, w.time, w.dt, i, x, i - row_number() over (partition by w.peak_id order by i) as island, w.peak_id
  from (select *, unnest(data) as x, unnest(range(0, 64)) as i from v_waves) w where x >= 150),
hits as (select run_id, channel, time + min(i) * dt as time, time + (max(i) + 1) * dt as endtime, time as record_time, cast(min(i) as int) as "left",
  cast(count(*) as int) as length, cast(max(x) as double) as height, cast(sum(x) as double) as area from runs group by run_id, channel, time, dt, island)"""


def v_hits(spark, sf):
    return kernels.find_hits(v_waves(spark, sf), 150.0)


@rounded("height area")
@query(f"with {_HITS} select * from hits", "v_waves")
def m21_find_hits(spark, sf):
    return v_hits(spark, sf)


_PEAKS = f"""{_HITS},
a as (select *, max(endtime) over (partition by run_id order by time, endtime rows between unbounded preceding and 1 preceding) as last_end from hits),
s as (select *, sum(case when last_end is null or time - last_end >= 30 then 1 else 0 end) over (partition by run_id order by time, endtime) - 1 as peak_id from a),
built as (select run_id, cast(peak_id as bigint) as peak_id, min(time) - 10 as time, max(endtime) + 10 as endtime, sum(area) as area, count(*) as n_hits, count(distinct channel) as n_channels
from s group by run_id, peak_id having sum(area) >= 200)"""


def built(spark, sf):
    return records.build_peaks(v_hits(spark, sf), 10, 30, 10, 10, 200.0, 1, slab=5_000)


@rounded("area")
@query(f"with {_PEAKS} select * from built", "v_waves")
def g4_build_peaks(spark, sf):
    return built(spark, sf).drop("area_per_channel")


@rounded("area height")
@query(
    f"""with {_PEAKS}, pts as (select time + i * dt as tick, x from (select *, unnest(data) as x, unnest(range(0, 64)) as i from v_waves)),
m as (select b.peak_id, b.time, (tick - b.time) // 10 as s, sum(x) as v from built b join pts on tick >= b.time and tick < b.endtime group by all)
select peak_id, cast(sum(v) as double) as area, cast(max(v) as double) as height, count(*) filter (v > 0) as n_samples from m group by peak_id""",
    "v_waves",
)
def g5_sum_waveform(spark, sf):
    waves = records.sum_waveform(built(spark, sf), v_waves(spark, sf), None, 1000)
    lit = F.size(F.filter("data", lambda x: x > 0)).cast("bigint")
    return waves.select("peak_id", "area", F.array_max("data").alias("height"), lit.alias("n_samples"))


_M6 = """
with s as (select peak_id, i, x, sum(x) over (partition by peak_id order by i) as c, sum(x) over (partition by peak_id) as total
  from (select peak_id, unnest(data) as x, unnest(range(1, 65)) as i from v_waves)),
q as (select distinct peak_id, k, cast(total as double) * k / 20 as target from s, unnest(range(0, 21)) as r(k)),
t as (select peak_id, k, case when k = 0 then 0.0 else min_by((i - 1 + (target - (c - x)) / x) * 10, i) filter (c >= target) end as t from q join s using (peak_id) group by peak_id, k),
p as (select peak_id, max(t) filter (k = 15) - max(t) filter (k = 5) as w5, max(t) filter (k = 19) - max(t) filter (k = 1) as w9, max(t) filter (k = 2) - max(t) filter (k = 10) as d1 from t group by peak_id)
select * from p"""


@rounded("w5 w9 d1")
@query(_M6, "v_waves")
def m6_peak_widths(spark, sf):
    out = kernels.peak_widths(v_waves(spark, sf))
    w, d = F.col("width"), F.col("area_decile_from_midpoint")
    return out.select("peak_id", F.get(w, F.lit(5)).alias("w5"), F.get(w, F.lit(9)).alias("w9"), F.get(d, F.lit(1)).alias("d1"))


_M22 = """
with recursive walk as (
  select peak_id, time, data, cast(0 as bigint) as k, cast('-infinity' as double) as top, cast('infinity' as double) as low, cast(-1 as bigint) as spot, cast(null as bigint) as cut from v_waves
  union all
  select peak_id, time, data, k + 1, top, case when x < low and top >= greatest(x + 100, 4 * x) then x else low end,
    case when x < low and top >= greatest(x + 100, 4 * x) then k else spot end, cut
  from (select peak_id, time, data, k, x, case when split or (spot < 0 and x > top) then x else top end as top, case when split then cast('infinity' as double) else low end as low,
      case when split then -1 else spot end as spot, case when split then spot end as cut
    from (select *, data[k + 1] as x, spot >= 0 and data[k + 1] >= greatest(low + 100, 4 * low) as split from walk where k < 64))),
edges as (select peak_id, time, data, cut as a from walk where cut is not null union all select peak_id, time, data, 0 from v_waves),
parts as (select *, lead(a, 1, 64) over (partition by peak_id order by a) as b, row_number() over (partition by peak_id order by a) - 1 as part from edges)
select peak_id, cast(part as int) as part, time + a * 10 as time, time + b * 10 as endtime, cast(b - a as int) as length, cast(list_sum(data[a + 1:b]) as double) as area from parts"""


@query(_M22, "v_waves")
def m22_split_peaks(spark, sf):
    return kernels.split_peaks(v_waves(spark, sf), 100.0, 4.0).select("peak_id", "part", "time", "endtime", "length", "area")


@query(
    """select peak_id, cast(sum(case when near >= 200 then x else 0 end) as bigint) as area from (
  select peak_id, x, max(x) over (partition by peak_id order by i rows between 20 preceding and 3 following) as near
  from (select peak_id, unnest(data) as x, unnest(range(0, 64)) as i from v_waves)) group by peak_id""",
    "v_waves",
)
def m23_cut_outside_hits(spark, sf):
    out = kernels.cut_outside_hits(v_waves(spark, sf), 200.0, 3, 20)
    return out.select("peak_id", F.aggregate("data", F.lit(0).cast("bigint"), lambda s, x: s + x).alias("area"))


def full_peaks(spark, sf):
    w = v_waves(spark, sf)
    i = F.col("peak_id")
    part = lambda a, b: F.aggregate(F.slice("data", a, b), F.lit(0.0), lambda s, x: s + x)
    width = F.transform(F.sequence(F.lit(0), F.lit(10)), lambda k: (k * i % 37).cast("double"))
    return w.select(
        "*",
        part(1, 64).alias("area"),
        F.array(*[part(1 + 13 * k, 13) for k in range(5)]).alias("area_per_channel"),
        width.alias("width"),
        width.alias("area_decile_from_midpoint"),
        (i % 9).cast("int").alias("n_hits"),
        (i % 6).cast("int").alias("tight_coincidence"),
        F.lit(0).alias("n_saturated_channels"),
    )


_FULL = """p as (select *, cast(list_sum(data) as double) as area, [cast(list_sum(data[1:13]) as double), cast(list_sum(data[14:26]) as double), cast(list_sum(data[27:39]) as double),
  cast(list_sum(data[40:52]) as double), cast(list_sum(data[53:64]) as double)] as per from v_waves),
q as (select *, list_sum(per[2:5]) / list_sum(per) as area_fraction_top, cast(5 * peak_id % 37 as double) as range_50p_area from p)"""


@rounded("range_50p_area range_90p_area max_pmt_area area_fraction_top rise_time")
@query(
    f"""with {_FULL} select peak_id, time + 640 as endtime, cast(len(list_filter(per, lambda x: x > 0)) as int) as n_channels, range_50p_area, cast(9 * peak_id % 37 as double) as range_90p_area,
  cast(list_position(per, list_max(per)) - 1 as int) as max_pmt, list_max(per) as max_pmt_area, area_fraction_top, -cast(peak_id % 37 as double) as rise_time,
  cast(case when area > 5000 and range_50p_area > 20 and area_fraction_top >= 0 then 2 when area >= 10 and range_50p_area > 5 and range_50p_area < 20 and area_fraction_top <= 0.8 then 1 else 0 end as int) as type
from q""",
    "v_waves",
)
def g6_peak_basics(spark, sf):
    cfg = PeakConfig(s1_min_width=5, s1_max_width=20, s1_max_aft=0.8, s2_min_area=5000, s2_min_width=20)
    out = peaks.peak_basics(full_peaks(spark, sf), cfg)
    return out.select("peak_id", "endtime", "n_channels", "range_50p_area", "range_90p_area", "max_pmt", "max_pmt_area", "area_fraction_top", "rise_time", "type")


@query(
    """select peak_id, case when peak_id % 5 > 0 then time + cast(trunc(list_sum(list_transform(range(1, 65), lambda i: (i - 1) * 10 * data[i])) / list_sum(data)) as bigint) else time end as center_time
from v_waves""",
    "v_waves",
)
def m5_center_time(spark, sf):
    dark = F.when(F.col("peak_id") % 5 > 0, F.col("area")).otherwise(0.0)  # without area: the start
    out = peaks.peak_basics(full_peaks(spark, sf).withColumn("area", dark))
    return out.select("peak_id", "center_time")


_M2 = f"""with {_FULL}, s as (select peak_id, case when peak_id % 5 > 0 then area * area_fraction_top else 0 end as top, per from q),
c as (select peak_id, case when top <> 0 then (per[2] + per[3]) / top else 'nan'::double end as x_cgr, case when top <> 0 then (per[2] + per[4]) / top else 'nan'::double end as y_cgr from s)
select peak_id, x_cgr, y_cgr, 2 * power(x_cgr, 3) - x_cgr + 0.5 as x_corr, y_cgr * 3 - 1 as y_corr,
  sqrt(power(2 * power(x_cgr, 3) - x_cgr + 0.5, 2) + power(y_cgr * 3 - 1, 2)) as r from c"""


@rounded("x_cgr y_cgr x_corr y_corr r")
@query(_M2, "v_waves")
def m2_peak_positions(spark, sf):
    top = F.when(F.col("peak_id") % 5 > 0, filters.fraction_top()).otherwise(0.0)  # no position without light on top
    rows = full_peaks(spark, sf).withColumn("area_fraction_top", top)
    out = peaks.peak_positions(rows, coefficients={"x": (2, 0, -1, 0.5), "y": (0, 0, 3, -1)})
    return out.select("peak_id", "x_cgr", "y_cgr", "x_corr", "y_corr", "r")


@rounded("area")
@query("select channel, sum(v) as area from (select unnest(area_per_channel) as v, cast(unnest(range(0, 7)) as int) as channel from v_light) group by channel", "v_light")
def g14_hit_pattern(spark, sf):
    return peaks.hit_pattern(v_light(spark, sf))


SENSORS = [{"x": 50.0 * (k % 3 - 1), "y": 40.0 * (k // 3 - 1), "z": 60.0, "qe": 0.3 + 0.01 * k} for k in range(7)]


@rounded("x y")
@query(
    """select peak_id, (-50 * a[1] + 0 * a[2] + 50 * a[3] - 50 * a[4] + 0 * a[5] + 50 * a[6] - 50 * a[7]) / list_sum(a) as x,
(-40 * a[1] - 40 * a[2] - 40 * a[3] + 40 * a[7]) / list_sum(a) as y from (select peak_id, area_per_channel as a from v_light)""",
    "v_light",
)
def m7_position_cog(spark, sf):
    return kernels.reconstruct_position(v_light(spark, sf), SENSORS).select("peak_id", "x", "y")


def _scan_sql(value: str, rate: str) -> str:
    """All grid points for all peaks: the least value to nine decimals, then the first point by x, then y."""
    light = ", ".join(f"area_per_channel[{k}] as n{k}" for k in range(1, 8))
    square = [f"(power(gx - ({p['x']}), 2) + power(gy - ({p['y']}), 2) + {p['z'] ** 2})" for p in SENSORS]
    yields = ", ".join(f"{p['qe']} * {p['z']} / sqrt({q}) / {q} as g{k}" for k, (p, q) in enumerate(zip(SENSORS, square, strict=True), 1))
    total = lambda term: "(" + " + ".join(term.replace("#", str(k)) for k in range(1, 8)) + ")"
    return f"""
with axis as (select cast(i as double) as i, -150.0 + 10.0 * i as at from range(0, 31) as t(i)),
grid as (select a.i as ix, b.i as iy, a.at as gx, b.at as gy from axis a, axis b),
points as (select ix, iy, {yields} from grid),
light as (select peak_id, {light} from v_light where area > 0),
fits as (select *, sqrt({total("n# * n# / g#")} / {total("g#")}) as r2, {total("n#")} / {total("g#")} as r1 from light, points),
best as (select peak_id, min([round({total(value.replace("mu#", f"({rate} * g#)"))}, 9), ix, iy]) as b from fits group by peak_id)
select peak_id, -150.0 + 10.0 * b[2] as x, -150.0 + 10.0 * b[3] as y, b[1] as fit from best"""


@rounded("fit", 3)
@rounded("x y")
@query(_scan_sql("power(n# - mu#, 2) / mu#", "r2"), "v_light")
def m7_position_chi2(spark, sf):
    return kernels.reconstruct_position(v_light(spark, sf), SENSORS, "CHI2").select("peak_id", "x", "y", "fit")


@rounded("fit", 3)
@rounded("x y")
@query(_scan_sql("(mu# - n# * ln(mu#) + lgamma(n# + 1))", "r1"), "v_light")
def m7_position_lnlike(spark, sf):
    return kernels.reconstruct_position(v_light(spark, sf), SENSORS, "LNLIKE").select("peak_id", "x", "y", "fit")


AREA, WIDTH, AFT = [0.0, 1, 2, 5, 10, 20, 50, 100, 200, 500], [0.0, 50, 100, 150, 225, 300, 400], [0.0, 0.25, 0.5, 0.75, 1.0]


def _bin(column: str, edges: list[float]) -> str:
    """SQL for the bin of a column: number of edges at or below, the last bin closed."""
    n = " + ".join(f"cast({column} >= {e} as int)" for e in edges)
    return f"case when {column} >= {edges[0]} and {column} <= {edges[-1]} then least({n}, {len(edges) - 1}) - 1 end"


_BINNED = f"""b as (select {_bin("area", AREA)} as area_bin, {_bin("range_50p_area", WIDTH)} as width_bin, {_bin("area_fraction_top", AFT)} as aft_bin from v_peaks),
h as (select area_bin, width_bin, aft_bin, count(*) as n from b where area_bin is not null and width_bin is not null and aft_bin is not null group by all)"""


@rounded("rate mean")
@query(
    f"with {_BINNED} select area_bin, width_bin, sum(n) / 3600.0 as rate, sum(n * ({AFT}[aft_bin + 1] + {AFT}[aft_bin + 2]) / 2) / sum(n) as mean from h group by area_bin, width_bin",
    "v_peaks",
)
def g9_area_aft_histogram(spark, sf):
    return analysis.area_aft_histogram(v_peaks(spark, sf), AREA, WIDTH, AFT, 3600.0)


@rounded("rate mean")
@query(
    f"with {_BINNED} select area_bin, aft_bin, sum(n) / 3600.0 as rate, sum(n * ({WIDTH}[width_bin + 1] + {WIDTH}[width_bin + 2]) / 2) / sum(n) as mean from h group by area_bin, aft_bin",
    "v_peaks",
)
def g10_area_width_histogram(spark, sf):
    return analysis.area_width_histogram(v_peaks(spark, sf), AREA, WIDTH, AFT, 3600.0)


@rounded("low high rate")
@query(
    f"""with e as (select {_bin("area", [1.0, 10.0, 20.0, 50.0, 100.0])} as bin from v_peaks), l as (select [1.0, 10.0, 20.0, 50.0, 100.0] as edges)
select bin, cast(edges[bin + 1] as double) as low, cast(edges[bin + 2] as double) as high, count(*) as n, count(*) * 86400.0 / 7 / (edges[bin + 2] - edges[bin + 1]) as rate from e, l where bin is not null group by bin, edges""",
    "v_peaks",
)
def g11_energy_spectrum_edges(spark, sf):
    edges = [1.0, 10.0, 20.0, 50.0, 100.0]
    counts = analysis.histogram(v_peaks(spark, sf), {"bin": (F.col("area"), edges)})
    a, b = F.get(F.lit(edges), F.col("bin")), F.get(F.lit(edges), F.col("bin") + 1)
    return counts.select("bin", a.alias("low"), b.alias("high"), "n", (F.col("n") * F.lit(86400.0 / 7) / (b - a)).alias("rate"))


@query(
    """with e as (select area as x from v_peaks where area >= 1 and area <= 100)
select cast(least(floor((x - 1) / 11.0), 8) as int) as bin, count(*) as n from e group by 1""",
    "v_peaks",
)
def g11_energy_spectrum(spark, sf):
    return analysis.energy_spectrum(v_peaks(spark, sf), "area", 10, 1.0, 100.0, geometric=False).select("bin", "n")


_LED = """with p as (select run_id, channel, time, dt, data as raw, list_avg(data[1:10]) as m from v_waves where peak_id % 4 >= 1),
l as (select run_id, channel, time, list_transform(raw, lambda x: -(x - m)) as data from (select run_id, channel, time, raw[1:32] as raw, list_avg(raw[1:10]) as m from p)),
c as (select channel, time, list_max(data[21:28]) as amplitude_led, list_max(data[1:10]) as amplitude_noise,
  (list_sum(data[21:28]) + list_sum(data[21:30]) + list_sum(data[21:32]) + list_sum(data[21:32]) + list_sum(data[21:32]) + list_sum(data[21:32])) / 6 as area from l)"""


def led(spark, sf):
    pulses = records.led_pulses(v_fragments(spark, sf), 2, (0, 10))
    return records.led_calibration(pulses, (20, 28), (0, 10))


@rounded("amplitude_led amplitude_noise area")
@query(f"{_LED} select * from c", "v_waves")
def m11_led_calibration(spark, sf):
    return led(spark, sf).drop("run_id")


@query("select channel, peak_id * 400 as time, cast(32 as int) as length, cast(16 * (1 + peak_id % 4) as int) as pulse_length, 32 - 0 as n from v_waves where peak_id % 4 >= 1", "v_waves")
def m10_led_pulses(spark, sf):
    pulses = records.led_pulses(v_fragments(spark, sf), 2, (0, 10))
    return pulses.select("channel", "time", "length", "pulse_length", F.size("data").alias("n"))


@query(
    f"""{_LED}, b as (select channel, min(area) as lo, max(area) as hi from c where channel < 5 group by channel)
select c.channel, cast(case when hi > lo then least(floor((area - lo) * 25 / (hi - lo)), 24) else 0 end as int) as bin, count(*) as n from c join b using (channel) group by 1, 2""",
    "v_waves",
)
def g12_led_area_histogram(spark, sf):
    return analysis.led_area_histogram(led(spark, sf), 25)


@query("select type, count(*) as n from v_peaks group by type", "v_peaks")
def g13_classification_counts(spark, sf):
    return peaks.per_class(v_peaks(spark, sf))


_POINTS = "pts as (select channel, time, i, x, time + i * 10 as tick from (select *, unnest(data) as x, unnest(range(0, 64)) as i from v_waves where time >= 1000 and time < 100000))"


@rounded("pe_per_ns")
@query(
    f"""with {_POINTS}, s as (select (tick - 1000) // 10 as time_bin, channel, sum(x) / 10.0 as v from pts where tick < 100000 group by all),
g as (select distinct time_bin, cast(c as int) as channel from s, unnest(range(0, 10)) as t(c)) select time_bin, channel, coalesce(v, 0) as pe_per_ns from g left join s using (time_bin, channel)""",
    "v_waves",
)
def g15_records_matrix(spark, sf):
    return analysis.records_matrix(v_waves(spark, sf), 1000, 100_000, 10, record_length=64)


@rounded("pe_per_ns")
@query(
    """with s as (select (time - 1000) // 640 as time_bin, channel, sum(list_sum(data)) / 640.0 as v from v_waves where time >= 1000 and time < 100000 group by all),
g as (select distinct time_bin, cast(c as int) as channel from s, unnest(range(0, 10)) as t(c)) select time_bin, channel, coalesce(v, 0) as pe_per_ns from g left join s using (time_bin, channel)""",
    "v_waves",
)
def g15_records_matrix_coarse(spark, sf):
    return analysis.records_matrix(v_waves(spark, sf), 1000, 100_000, 10, record_length=64, max_samples=160)


@rounded("pe_per_ns")
@query(
    """with own as (select *, case when record_i = 0 then list_avg(data) end as b from v_fragments),
f as (select *, last_value(b ignore nulls) over (partition by channel order by time, record_i rows between unbounded preceding and current row) as base from own),
pts as (select channel, time + i * 10 as tick, -(x - trunc(base)) as v from (
  select channel, time, base, unnest(data) as x, unnest(range(0, 16)) as i from f where time >= 0 and time < 100000)),
s as (select tick // 10 as time_bin, channel, sum(v) / 10 as v from pts where tick < 100000 group by all),
g as (select distinct time_bin, cast(c as int) as channel from s, unnest(range(0, 10)) as t(c)) select time_bin, channel, coalesce(v, 0) as pe_per_ns from g left join s using (time_bin, channel)""",
    _FRAGMENTS,
)
def g16_raw_records_matrix(spark, sf):
    return analysis.raw_records_matrix(v_fragments(spark, sf), 0, 100_000, 10, record_length=16)


@rounded("livetime")
@query(
    """with t as (select run_id, (max_by(endtime, time) - min(time)) / 1e6 as span from v_peaks group by run_id),
r as (select distinct run_id, cast(run_id as int) % 3 as k from v_peaks)
select run_id, case when k = 0 then 100.0 when k = 1 then 3600.0 else span end as livetime from r join t using (run_id)""",
    "v_peaks",
)
def g17_livetime(spark, sf):
    p = v_peaks(spark, sf)
    k = F.col("run_id").cast("int") % 3
    start = F.timestamp_seconds(F.lit(0))
    runs = p.select("run_id").distinct().select(
        "run_id", F.when(k == 0, 100.0).alias("livetime"), F.when(k == 1, start).alias("start"), F.when(k == 1, F.timestamp_seconds(F.lit(3600))).alias("end")
    )
    return analysis.livetime(runs, p, 1e6)


@query(
    f"""with {_BINNED} select area_bin, width_bin, cast(sum(n) as bigint) as n, cast(grouping_id(area_bin, width_bin) as bigint) as total from h group by cube (area_bin, width_bin)""",
    "v_peaks",
)
def g20_cell_margins(spark, sf):
    hist = analysis.histogram(v_peaks(spark, sf), analysis._axes(AREA, WIDTH, AFT))
    return analysis.cell_margins(hist, ["area_bin", "width_bin"])


@query("select run_id, count(distinct channel) as channels, count(distinct type) as types from v_peaks group by run_id", "v_peaks")
def g21_distinct_counts(spark, sf):
    return v_peaks(spark, sf).groupBy("run_id").agg(F.count_distinct("channel").alias("channels"), F.count_distinct("type").alias("types"))


@query("select run_id, count(distinct channel) as channel, count(distinct type) as type, count(distinct n_channels) as n_channels from v_peaks group by run_id", "v_peaks")
def g21_distinct_sketches(spark, sf):
    """Sketches by run and hour, united by run."""
    columns = ["channel", "type", "n_channels"]
    hourly = v_peaks(spark, sf).withColumn("slab", F.call_function("div", F.col("time"), F.lit(3_600_000_000)))
    return analysis.distinct_counts(analysis.distinct_sketches(hourly, ["run_id", "slab"], columns), ["run_id"], columns)


@query(f"select peak_id, {_bin('area', AREA)} as bin from v_peaks", "v_peaks")
def m8_bin_index(spark, sf):
    from ..functions.columns import bin_index

    return v_peaks(spark, sf).select("peak_id", bin_index(F.col("area"), AREA).alias("bin"))


@query(
    "select channel, peak_id * 400 as pulse_start, 1 + peak_id % 4 as n_fragments, cast(list_sum(data[1:16 * (1 + peak_id % 4)]) as bigint) as total, cast(16 * (1 + peak_id % 4) as int) as n from v_waves",
    "v_waves",
)
def m9_assemble_pulse(spark, sf):
    out = records.assemble_pulse(v_fragments(spark, sf))
    total = F.aggregate("data", F.lit(0).cast("bigint"), lambda s, x: s + x)
    return out.select("channel", "pulse_start", "n_fragments", total.alias("total"), F.size("data").alias("n"))


@rounded("seconds pe_per_ns", 9)
@query(
    """select peak_id, cast(i as int) as i, (time + i * 10) / 1e9 as seconds, data[least(i, 63) + 1] / 10.0 as pe_per_ns from (select *, unnest(range(0, 65)) as i from v_waves)""",
    "v_waves",
)
def m19_waveform_points(spark, sf):
    return peaks.waveform_points(v_waves(spark, sf))


@rounded("area")
@query("select time, channel, area * [1.0, 1.5, 0.5, 2.0, 1.0, 1.0, 0.25][channel + 1] as area from v_peaks", "v_peaks")
def m24_gain_to_pe(spark, sf):
    return records.gain_to_pe(v_peaks(spark, sf), [1.0, 1.5, 0.5, 2.0, 1.0, 1.0, 0.25]).select("time", "channel", "area")


@query(
    'select channel, time as record_time, time - min(time) over () + i * 10 as "offset", -x as sample from (select *, unnest(data) as x, unnest(range(0, 16)) as i from v_fragments)',
    _FRAGMENTS,
)
def m26_record_points(spark, sf):
    return records.record_points(v_fragments(spark, sf), raw=True).drop("run_id")



@query(
    """select w.peak_id, f.channel, f.time as record_time, f.time - w.time + i * 10 as "offset", -x as sample
from (select *, unnest(data) as x, unnest(range(0, 16)) as i from v_fragments) f join v_waves w on f.time < w.endtime and w.time < f.time + f.length * f.dt where w.peak_id % 5 = 0""",
    _FRAGMENTS,
)
def m26_record_points_of_peaks(spark, sf):
    """Samples of the records that touch every fifth peak, from the peak's start."""
    chosen = v_waves(spark, sf).where("peak_id % 5 = 0").drop("data")
    return records.record_points(v_fragments(spark, sf), raw=True, peaks=chosen, bucket=1000).drop("run_id")


@rounded("baseline_rms_mean")
@query(
    """with own as (select *, case when record_i = 0 then sqrt(list_avg(list_transform(data, lambda x: x * x)) - list_avg(data) * list_avg(data)) end as r from v_fragments),
g as (select run_id, chunk_i, channel, avg(r) as baseline_rms_mean from own where channel < 12 group by all),
grid as (select distinct run_id, chunk_i, cast(c as int) as channel from v_fragments, unnest(range(0, 12)) as t(c))
select run_id, chunk_i, channel, coalesce(baseline_rms_mean, 'nan'::double) as baseline_rms_mean from grid left join g using (run_id, chunk_i, channel)""",
    _FRAGMENTS,
)
def g3_baseline_rms(spark, sf):
    rows = records.integrate(records.baseline(v_fragments(spark, sf), slab=20_000))
    return records.pulse_counts(records.lone_pulses(rows, slab=20_000), 12).select("run_id", "chunk_i", "channel", "baseline_rms_mean")


@query(
    f"""with {_PEAKS.replace("sum(area) as area, count(*)", "sum(area) as area, count(*)")},
per as (select run_id, peak_id, channel, sum(area) as a from s group by all),
grid as (select b.run_id, b.peak_id, cast(c as int) as channel from built b, unnest(range(0, 10)) as t(c))
select g.run_id, cast(g.peak_id as bigint) as peak_id, g.channel, coalesce(a, 0.0) as area from grid g left join per using (run_id, peak_id, channel)""",
    "v_waves",
)
def g4_area_per_channel(spark, sf):
    return built(spark, sf).select("run_id", "peak_id", F.posexplode("area_per_channel").alias("channel", "area"))
