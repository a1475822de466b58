"""Interval and key joins, event chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import events as ev
from ..operators import filters, intervals
from ..plans import jobs, registry
from ..schemas import Corrections, EventConfig
from .base import SLAB, query, rounded, v_ext, v_peaks, v_waves
from .windows import EVENTS_SQL, v_events

CONFIG = EventConfig(left_extension=500_000_000, right_extension=50_000_000, max_drift_length=10.0, drift_velocity=10.0 / 400_000_000)


@query(
    f"""with {EVENTS_SQL} select p.peak_id, e.event_number, p.run_id from v_peaks p join v_events e
on p.run_id = e.run_id and p.time >= e.time and p.endtime <= e.endtime""",
    "v_peaks",
)
def j1_containment_join(spark, sf):
    return intervals.containment_join(v_peaks(spark, sf), v_events(spark, sf), slab=SLAB).select("peak_id", "event_number", "run_id")


@query(
    """select a.peak_id, b.peak_id as r_peak_id from v_waves a join v_waves b
on a.time < b.endtime and b.time < a.endtime""",
    "v_waves",
)
def j2_overlap_join(spark, sf):
    w = v_waves(spark, sf).drop("data")
    return intervals.overlap_join(w, w, 1000).select("peak_id", "r_peak_id")


def _greedy(left: str, right: str) -> str:
    """The greedy match as a walk with one pointer a side: hit holds the rows of left that are paired."""
    return f"""l as (select *, row_number() over (partition by run_id order by time, id) as i from ({left}) where time is not null),
r as (select run_id, time, row_number() over (partition by run_id order by time) as j from ({right})),
walk as (select distinct run_id, cast(1 as bigint) as i, cast(1 as bigint) as j, cast(null as bigint) as hit from l
  union all
  select w.run_id, case when r.time >= l.time then w.i + 1 else w.i end, case when r.time - l.time <= 120000000 then w.j + 1 else w.j end,
    case when r.time - l.time between 0 and 120000000 then w.i end
  from walk w join l on l.run_id = w.run_id and l.i = w.i join r on r.run_id = w.run_id and r.j = w.j)"""


@query(
    f"""with recursive {_greedy("select run_id, time, peak_id as id from v_peaks where type = 2 and area > 0", "select * from v_ext")}
select l.run_id, id as peak_id, l.time, exists(select 1 from walk w where w.run_id = l.run_id and w.hit = l.i) as is_coinc from l""",
    "v_peaks v_ext",
)
def j3_coincidence_match(spark, sf):
    peaks = filters.trigger_peaks(v_peaks(spark, sf), 0).select("run_id", "peak_id", "time")
    return intervals.coincidence_match(peaks, v_ext(spark, sf), 120_000_000, slab=SLAB)


@query(
    """select peak_id, exists(select 1 from v_ext x where x.run_id = p.run_id and x.time between p.time and p.time + 120000000) as is_coinc
from v_peaks p where type = 2""",
    "v_peaks v_ext",
)
def j4_coincidence_exists(spark, sf):
    peaks = v_peaks(spark, sf).where("type = 2").select("run_id", "peak_id", "time")
    return intervals.coincidence_exists(peaks, v_ext(spark, sf), 120_000_000).select("peak_id", "is_coinc")


@query(
    """select p.peak_id, case when x.time - p.time <= 300000000 then x.time end as next_time, case when x.time - p.time <= 300000000 then x.time - p.time end as delay
from (select * from v_peaks where type = 1) p asof left join v_ext x on p.run_id = x.run_id and p.time <= x.time""",
    "v_peaks v_ext",
)
def j5_asof_forward(spark, sf):
    peaks = v_peaks(spark, sf).where("type = 1").select("run_id", "peak_id", "time")
    return intervals.asof_forward(peaks, v_ext(spark, sf), 300_000_000).select("peak_id", "next_time", "delay")


_BASICS = f"""{EVENTS_SQL},
inside as (select p.*, e.event_number from v_peaks p join v_events e on p.run_id = e.run_id and p.time >= e.time and p.endtime <= e.endtime),
indexed as (select *, cast(row_number() over (partition by run_id, event_number order by time, peak_id) - 1 as int) as index from inside),
ms2 as (select run_id, event_number, time as s2_time, center_time as s2_center, area as s2_area, index as s2_index from (
  select *, row_number() over (partition by run_id, event_number order by area desc, index desc) as r from indexed where type = 2) where r = 1),
s1 as (select * from (select i.*, row_number() over (partition by i.run_id, i.event_number order by area desc, index desc) as r
  from indexed i left join ms2 m using (run_id, event_number) where i.type = 1 and (m.s2_time is null or i.time < m.s2_time)) where r <= 2),
main as (select run_id, event_number, max(area) filter (r = 1) as s1_area, max(index) filter (r = 1) as s1_index, max(center_time) filter (r = 1) as s1_center,
  max(area) filter (r = 2) as alt_s1_area, max(index) filter (r = 2) as alt_s1_index, max(center_time) filter (r = 2) as alt_s1_center from s1 group by run_id, event_number),
s2 as (select * from (select i.*, m.s2_center, row_number() over (partition by i.run_id, i.event_number order by i.area desc, i.index desc) as r
  from indexed i join ms2 m using (run_id, event_number) left join main n using (run_id, event_number)
  where i.type = 2 and i.index <> m.s2_index and (n.s1_center is null or (i.center_time > n.s1_center and i.center_time - n.s1_center < 1.01 * 400000000))) where r = 1),
before as (select i.run_id, i.event_number, sum(area) as a, max(area) filter (type = 2) as l from indexed i join ms2 m using (run_id, event_number) where i.time < m.s2_time group by 1, 2),
counts as (select run_id, event_number, count(*) as n_peaks from indexed group by 1, 2),
basics as (select e.run_id, e.event_number, e.time, e.endtime, coalesce(c.n_peaks, 0) as n_peaks, n.s1_index, n.s1_area, n.alt_s1_index, n.alt_s1_area, m.s2_index, m.s2_area,
  s.index as alt_s2_index, s.area as alt_s2_area, m.s2_center - n.s1_center as drift_time, m.s2_center - n.alt_s1_center as alt_s1_interaction_drift_time,
  case when m.s2_center is not null then n.alt_s1_center - n.s1_center end as alt_s1_delay, s.center_time - n.s1_center as alt_s2_interaction_drift_time,
  case when n.s1_center is not null then s.center_time - m.s2_center end as alt_s2_delay,
  case when m.s2_index is not null then coalesce(b.a, 0) end as area_before_main_s2, case when m.s2_index is not null then coalesce(b.l, 0) end as large_s2_before_main_s2
from v_events e left join counts c using (run_id, event_number) left join ms2 m using (run_id, event_number) left join main n using (run_id, event_number)
left join s2 s using (run_id, event_number) left join before b using (run_id, event_number))"""
_SHOWN = (
    "run_id", "event_number", "time", "endtime", "n_peaks", "s1_index", "s1_area", "alt_s1_index", "alt_s1_area", "s2_index", "s2_area", "alt_s2_index", "alt_s2_area",
    "drift_time", "alt_s1_interaction_drift_time", "alt_s1_delay", "alt_s2_interaction_drift_time", "alt_s2_delay", "area_before_main_s2", "large_s2_before_main_s2",
)


def basics(spark, sf):
    return ev.event_basics(v_events(spark, sf), v_peaks(spark, sf), CONFIG, slab=SLAB)


@rounded("s1_area alt_s1_area s2_area alt_s2_area area_before_main_s2 large_s2_before_main_s2")
@query(f"with {_BASICS} select * from basics", "v_peaks")
def g7_event_basics(spark, sf):
    return basics(spark, sf).select(*_SHOWN)


@rounded("area_before_main_s2 large_s2_before_main_s2")
@query(
    f"with {_BASICS} select run_id, event_number, area_before_main_s2, large_s2_before_main_s2 from basics where s2_index is not null", "v_peaks"
)
def g8_area_before_main_s2(spark, sf):
    return basics(spark, sf).where("s2_index is not null").select("run_id", "event_number", "area_before_main_s2", "large_s2_before_main_s2")


_INFO = f"""with {_BASICS}, z as (select *, -50.5 / (39500000.0 - 3000.0) * (drift_time - 3000.0) as z from basics)
select run_id, event_number, z, s1_area * (700 + -7.69 * (-52.0 + 0.0) / 2) / (700 + -7.69 * z) as cs1, s2_area * exp(drift_time / 300000000.0) as cs2,
  alt_s1_area * (700 + -7.69 * (-52.0 + 0.0) / 2) / (700 + -7.69 * z) as alt_cs1, alt_s2_area * exp(drift_time / 300000000.0) as alt_cs2 from z"""


def areas(spark, sf):
    z = -50.5 / (39_500_000.0 - 3000.0) * (F.col("drift_time") - 3000.0)
    return ev.corrected_areas(basics(spark, sf).withColumn("z", z), Corrections(elife=300_000_000.0))


@rounded("z cs1 cs2 alt_cs1 alt_cs2")
@query(_INFO, "v_peaks")
def m4_corrected_areas(spark, sf):
    return areas(spark, sf).select("run_id", "event_number", "z", "cs1", "cs2", "alt_cs1", "alt_cs2")


@rounded("s1_area s2_area cs2")
@query(
    f"""with {_BASICS} select run_id, event_number, n_peaks, s1_area, s2_area, drift_time, s2_area * exp(drift_time / 300000000.0) as cs2 from basics""", "v_peaks"
)
def j6_merge_kind(spark, sf):
    corrected = areas(spark, sf).select("run_id", "event_number", "cs2")
    merged = ev.merge_kind(basics(spark, sf), corrected)
    return merged.select("run_id", "event_number", "n_peaks", "s1_area", "s2_area", "drift_time", "cs2")


@query(
    f"""with {_BASICS} select b.run_id, b.event_number, p.peak_id as s1_peak_id, q.peak_id as s2_peak_id, q.length as s2_length from basics b
left join indexed p on p.run_id = b.run_id and p.event_number = b.event_number and p.index = b.s1_index
left join indexed q on q.run_id = b.run_id and q.event_number = b.event_number and q.index = b.s2_index""",
    "v_peaks",
)
def j7_lookup_by_index(spark, sf):
    inside = ev.peak_index(intervals.containment_join(v_peaks(spark, sf), v_events(spark, sf), slab=SLAB))
    found = ev.lookup_by_index(basics(spark, sf), inside, ("peak_id", "length"), ("s1", "s2"))
    return found.select("run_id", "event_number", "s1_peak_id", "s2_peak_id", "s2_length")


@query(
    f"""with recursive {_BASICS}, s1s as (select b.run_id, b.event_number, b.event_number as id, p.time from basics b
  left join indexed p on p.run_id = b.run_id and p.event_number = b.event_number and p.index = b.s1_index),
{_greedy("select * from s1s", "select * from v_ext where area > 446 and area < 576")}
select s.run_id, s.event_number, s.time as s1_time, exists(select 1 from walk w join l on l.run_id = w.run_id and l.i = w.hit where w.run_id = s.run_id and l.id = s.id) as is_coinc
from s1s s""",
    "v_peaks v_ext",
)
def event_coincidences(spark, sf):
    rows = basics(spark, sf)
    return ev.event_coincidences(rows, v_ext(spark, sf), 120_000_000, slab=SLAB).select("run_id", "event_number", "s1_time", "is_coinc")


_ROLES = ("s1", "alt_s1", "s2", "alt_s2")
_COPIED = ("center_time", "endtime", "n_channels", "n_hits", "max_pmt", "max_pmt_area", "range_50p_area", "range_90p_area", "rise_time", "area_fraction_top", "tight_coincidence", "n_saturated_channels")


def _full_peaks(spark, sf):
    """Peaks with all copied properties but saturation, and positions of two algorithms."""
    p = v_peaks(spark, sf)
    i = F.col("peak_id")
    more = {"n_hits": (i % 50).cast("int"), "max_pmt": (i % 5).cast("int"), "max_pmt_area": F.col("area") / 2, "range_90p_area": F.col("range_50p_area") * 2, "rise_time": (i % 90).cast("double")}
    places = {"x_cgr": (i % 13).cast("double"), "y_cgr": (i % 17).cast("double"), "x_corr": (i % 13) * 2.0, "y_corr": (i % 17) * 3.0}
    return p.withColumns(more | places)


_FULL = _BASICS + """, whole as (select *, cast(peak_id % 50 as int) as n_hits, cast(peak_id % 5 as int) as max_pmt, area / 2 as max_pmt_area, range_50p_area * 2 as range_90p_area,
  cast(peak_id % 90 as double) as rise_time, cast(null as int) as n_saturated_channels, cast(peak_id % 13 as double) as x_cgr, cast(peak_id % 17 as double) as y_cgr,
  (peak_id % 13) * 2.0 as x_corr, (peak_id % 17) * 3.0 as y_corr from indexed)"""


def _full_basics(spark, sf):
    return ev.event_basics(v_events(spark, sf), _full_peaks(spark, sf), CONFIG, slab=SLAB)


def _picked(role: str, columns) -> str:
    return ", ".join(f"{role}.{c} as {role}_{c}" for c in columns)


_MET = " ".join(f"left join whole {r} on {r}.run_id = b.run_id and {r}.event_number = b.event_number and {r}.index = b.{r}_index" for r in _ROLES)


@rounded(" ".join(f"{r}_{c}" for r in _ROLES for c in ("max_pmt_area", "range_50p_area", "range_90p_area", "rise_time", "area_fraction_top")))
@query(
    f"with {_FULL} select b.run_id, b.event_number, {', '.join(_picked(r, ('time', *_COPIED)) for r in _ROLES)}, {_picked('s2', ('x_cgr', 'y_corr'))}, "
    f"{_picked('alt_s2', ('x_cgr', 'y_corr'))}, cast(null as int) as s1_max_diff, cast(null as double) as alt_s2_x from basics b {_MET}",
    "v_peaks",
)
def g7_event_properties(spark, sf):
    columns = [f"{r}_{c}" for r in _ROLES for c in ("time", *_COPIED)] + [f"{r}_{c}" for r in ("s2", "alt_s2") for c in ("x_cgr", "y_corr")]
    return _full_basics(spark, sf).select("run_id", "event_number", *columns, "s1_max_diff", "alt_s2_x")


@rounded("x y alt_s2_x alt_s2_y r alt_s2_r z")
@query(
    f"""with {_FULL} select b.run_id, b.event_number, s2.x_corr as x, s2.y_corr as y, alt_s2.x_corr as alt_s2_x, alt_s2.y_corr as alt_s2_y,
sqrt(s2.x_corr * s2.x_corr + s2.y_corr * s2.y_corr) as r, sqrt(alt_s2.x_corr * alt_s2.x_corr + alt_s2.y_corr * alt_s2.y_corr) as alt_s2_r,
-50.5 / (39500000.0 - 3000.0) * (drift_time - 3000.0) as z from basics b {_MET}""",
    "v_peaks",
)
def m3_event_positions(spark, sf):
    found = jobs.make_event_positions(_full_basics(spark, sf), cathode=39_500_000.0)
    return found.drop("time", "endtime")


@rounded("s1_area cs1 x r z")
@query(
    f"""with {_FULL}, e as (select b.*, s2.x_corr as x, sqrt(s2.x_corr * s2.x_corr + s2.y_corr * s2.y_corr) as r, -50.5 / (39500000.0 - 3000.0) * (drift_time - 3000.0) as z
from basics b {_MET}) select run_id, event_number, n_peaks, s1_area, x, r, z, s1_area * (700 + -7.69 * (-52.0 + 0.0) / 2) / (700 + -7.69 * z) as cs1 from e""",
    "v_peaks",
)
def event_info(spark, sf):
    given = {"event_basics": _full_basics(spark, sf)}
    found = registry.build("event_info", given, {"event_positions": {"cathode": 39_500_000.0}})
    return found.select("run_id", "event_number", "n_peaks", "s1_area", "x", "r", "z", "cs1")


def _light_peaks(spark, sf):
    """Peaks with an array of channel areas and a waveform."""
    i, a = F.col("peak_id"), F.col("area")
    per = F.array(*[F.when((i + k) % 3 == 0, 0.0).otherwise(a / (k + 1)) for k in range(5)])
    return v_peaks(spark, sf).withColumns({"area_per_channel": per, "data": F.array(a, a * 2, (i % 7).cast("double"))})


_ARRAYS = f"""{_BASICS}, whole as (select *, [case when (peak_id + 0) % 3 = 0 then 0.0 else area / 1 end, case when (peak_id + 1) % 3 = 0 then 0.0 else area / 2 end,
  case when (peak_id + 2) % 3 = 0 then 0.0 else area / 3 end, case when (peak_id + 3) % 3 = 0 then 0.0 else area / 4 end, case when (peak_id + 4) % 3 = 0 then 0.0 else area / 5 end] as area_per_channel,
  [area, area * 2, cast(peak_id % 7 as double)] as data from indexed)"""


@rounded("s1_light s2_light alt_s2_light")
@query(
    f"""with {_ARRAYS} select b.run_id, b.event_number, b.time, list_sum(s1.area_per_channel) as s1_light, list_sum(s2.area_per_channel) as s2_light,
list_sum(alt_s2.area_per_channel) as alt_s2_light, s1.length as s1_length, alt_s1.dt as alt_s1_dt, cast(len(list_filter(s1.area_per_channel, lambda x: x > 0)) as int) as s1_n_channels
from basics b {_MET}""",
    "v_peaks",
)
def event_area_per_channel(spark, sf):
    found = jobs.make_event_area_per_channel(basics(spark, sf), _light_peaks(spark, sf), slab=SLAB)
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda s, x: s + x)
    light = [total(f"{r}_area_per_channel").alias(f"{r}_light") for r in ("s1", "s2", "alt_s2")]
    return found.select("run_id", "event_number", "time", *light, "s1_length", "alt_s1_dt", "s1_n_channels")


@query(
    f"""with {_ARRAYS} select b.run_id, b.event_number, b.endtime, cast(len(list_filter(s1.area_per_channel, lambda x: x > 0)) as int) as s1_n_channels from basics b {_MET}""",
    "v_peaks",
)
def event_n_channel(spark, sf):
    given = {"event_basics": basics(spark, sf), "peaks": _light_peaks(spark, sf)}
    found = registry.build("event_n_channel", given, {"event_area_per_channel": {"slab": SLAB}})
    return found.select("run_id", "event_number", "endtime", "s1_n_channels")


@rounded("s1_first s2_second alt_s2_third")
@query(
    f"""with {_ARRAYS} select b.run_id, b.event_number, s1.data[1] as s1_first, s2.data[2] as s2_second, alt_s2.data[3] as alt_s2_third, s2.length as s2_length, s1.dt as s1_dt
from basics b {_MET}""",
    "v_peaks",
)
def event_waveform(spark, sf):
    found = jobs.make_event_waveform(basics(spark, sf), _light_peaks(spark, sf), slab=SLAB)
    values = [F.get("s1_data", F.lit(0)).alias("s1_first"), F.get("s2_data", F.lit(1)).alias("s2_second"), F.get("alt_s2_data", F.lit(2)).alias("alt_s2_third")]
    return found.select("run_id", "event_number", *values, "s2_length", "s1_dt")
