"""Window operators: overlaps, baselines, lone pulses, sessions, events, breaks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import events as ev
from ..operators import filters, intervals, records
from ..plans import jobs, registry
from .base import SLAB, query, rounded, v_fragments, v_peaks

_FRAGMENTS = "v_waves v_fragments"


@query(
    """select time, channel, record_i, previous_end from (
  select *, lag(time + length * dt) over (partition by run_id, channel order by time, record_i) as previous_end from v_fragments)
where time < previous_end""",
    _FRAGMENTS,
)
def w1_check_overlaps(spark, sf):
    return records.check_overlaps(v_fragments(spark, sf), slab=20_000).select("time", "channel", "record_i", "previous_end")


_W2 = """
with own as (select *, case when record_i = 0 then list_avg(data) end as b,
    case when record_i = 0 then sqrt(list_avg(list_transform(data, lambda x: x * x)) - list_avg(data) * list_avg(data)) end as r from v_fragments),
filled as (select *, last_value(b ignore nulls) over w as baseline, last_value(r ignore nulls) over w as baseline_rms
  from own window w as (partition by run_id, channel order by time, record_i rows between unbounded preceding and current row))
select time, channel, record_i, baseline, baseline_rms, cast(-list_sum(list_transform(data, lambda x: x - trunc(baseline))) as bigint) as area from filled"""


@rounded("baseline baseline_rms")
@query(_W2, _FRAGMENTS)
def w2_baseline(spark, sf):
    rows = records.integrate(records.baseline(v_fragments(spark, sf), slab=20_000))
    return rows.select("time", "channel", "record_i", "baseline", "baseline_rms", "area")


_W3 = """
with a as (select *, case when record_i = 0 then time + pulse_length * dt end as stop from v_fragments),
b as (select *, max(stop) over (order by time, channel, record_i rows between unbounded preceding and 1 preceding) as busy,
    lead(time) over (order by time, channel, record_i) as nxt from a),
c as (select *, case when record_i = 0 then coalesce((busy is null or time > busy) and stop < nxt, false) end as flag from b)
select time, channel, record_i, last_value(flag ignore nulls) over (partition by channel order by time, record_i rows between unbounded preceding and current row) as lone from c"""


@query(_W3, _FRAGMENTS)
def w3_lone_pulses(spark, sf):
    return records.lone_pulses(v_fragments(spark, sf), slab=20_000).select("time", "channel", "record_i", "lone")


_W4 = """
with a as (select *, max(endtime) over (partition by run_id order by time, endtime rows between unbounded preceding and 1 preceding) as last_end from v_peaks)
select peak_id, run_id, cast(sum(case when last_end is null or time - last_end >= 300000000 then 1 else 0 end)
  over (partition by run_id order by time, endtime) - 1 as bigint) as group_id from a"""


@query(_W4, "v_peaks")
def w4_sessionize(spark, sf):
    return intervals.sessionize(v_peaks(spark, sf), 300_000_000, slab=SLAB).select("peak_id", "run_id", "group_id")


EVENTS_SQL = """t as (select * from v_peaks where type = 2 and area > 10),
  g as (select *, max(endtime) over (partition by run_id order by time, endtime rows between unbounded preceding and 1 preceding) as last_end from t),
  s as (select *, sum(case when last_end is null or time - last_end >= 550000001 then 1 else 0 end) over (partition by run_id order by time, endtime) - 1 as grp from g),
  v_events as (select run_id, cast(grp as bigint) as event_number, min(time) - 500000000 as time, max(endtime) + 50000000 as endtime, count(*) as n_triggers from s group by run_id, grp)"""
LEFT, RIGHT = 500_000_000, 50_000_000


def v_events(spark, sf):
    return intervals.build_events(filters.trigger_peaks(v_peaks(spark, sf)), LEFT, RIGHT, slab=SLAB)


@query(f"with {EVENTS_SQL} select * from v_events", "v_peaks")
def w5_build_events(spark, sf):
    return v_events(spark, sf)


#: Peaks numbered from 0 in every run, as build_peaks() does.
_RUNS_FROM_0 = "n as (select run_id, time, area, row_number() over (partition by run_id order by time, area, peak_id) - 1 as peak_id from v_peaks)"


def _numbered_from_0(spark, sf):
    order = Window.partitionBy("run_id").orderBy("time", "area", "peak_id")
    return v_peaks(spark, sf).select("run_id", "time", "area", (F.row_number().over(order) - 1).cast("bigint").alias("peak_id"))


@query(
    f"""with {_RUNS_FROM_0} select a.run_id, a.peak_id, count(*) filter (b.area > a.area * 0.5) as n_competing from n a
join n b on a.run_id = b.run_id and b.time between a.time - 600000000 and a.time + 600000000 group by a.run_id, a.peak_id""",
    "v_peaks",
)
def w6_n_competing(spark, sf):
    return intervals.n_competing(_numbered_from_0(spark, sf), 600_000_000, 0.5).select("run_id", "peak_id", "n_competing")


@query(
    f"""with {_RUNS_FROM_0},
e as (select a.run_id, a.peak_id, min(b.time) as edge from n a join n b on a.run_id = b.run_id and b.time >= a.time + 600000000 group by all),
last as (select e.run_id, e.peak_id, max(b.area) as edge_area from e join n b on b.run_id = e.run_id and b.time = e.edge group by all)
select a.run_id, a.peak_id, count(*) filter (b.area > a.area * 0.5) + coalesce(any_value(cast(edge_area > a.area * 0.5 as int)), 0) as n_competing from n a
join n b on a.run_id = b.run_id and b.time >= a.time - 600000000 and b.time < a.time + 600000000
left join last on last.run_id = a.run_id and last.peak_id = a.peak_id group by a.run_id, a.peak_id""",
    "v_peaks",
)
def w6_n_competing_to_edge(spark, sf):
    """The slice that ends with the first peak at or beyond the right edge; dense slabs in parts."""
    rows = intervals.n_competing(_numbered_from_0(spark, sf), 600_000_000, 0.5, inclusive_edge=True, most=500)
    return rows.select("run_id", "peak_id", "n_competing")


@query(
    """with a as (select *, max(endtime) over (partition by run_id order by time, endtime rows between unbounded preceding and 1 preceding) as last_end from v_peaks)
select run_id, break_group, count(*) as n from (
  select run_id, cast(sum(case when last_end is null or time - last_end >= 900000000 then 1 else 0 end) over (partition by run_id order by time, endtime) - 1 as bigint) as break_group from a)
group by run_id, break_group""",
    "v_peaks",
)
def w7_break_groups(spark, sf):
    return intervals.break_groups(v_peaks(spark, sf), 900_000_000, slab=SLAB).groupBy("run_id", "break_group").agg(F.count("*").alias("n"))


@query(
    """select time, channel, length from v_fragments where time + length * dt <= 30000
union all select 30000, 799, cast((50000 - 30000) // 10 as int)""",
    _FRAGMENTS,
)
def w8_insert_dead_time(spark, sf):
    return records.insert_dead_time(v_fragments(spark, sf), 50_000, 30_000, 10, "post").select("time", "channel", "length")


_CHUNK, _OVERLAP, _QUIET, _LENGTH = 20_000, 3_000, 230, 16
_ALL = {"bottom": (0, 0), "top": (1, 700)}


_RAW = f"""
with placed as (select *, time // {_CHUNK + _OVERLAP} as c, time % {_CHUNK + _OVERLAP} as within from v_fragments where channel % 3 < 2 or time % {7 * (_CHUNK + _OVERLAP)} < 30000),
sides as (
  select *, c as chunk, 'post' as kind from placed where within >= {_CHUNK} union all select *, c + 1, 'pre' from placed where within >= {_CHUNK}),
ended as (select *, time + length * dt as endtime, c * {_CHUNK + _OVERLAP} + {_CHUNK} as begins from sides),
seen as (select *, max(endtime) over (partition by run_id, chunk, kind order by time, endtime rows between unbounded preceding and 1 preceding) as before from ended),
parts as (
  select run_id, chunk, kind, begins, max(endtime) as last, min(time) filter (before is not null and time - greatest(before, begins + {_LENGTH * 10}) >= {_QUIET}) as break
  from seen group by all),
cased as (select *, begins + {_OVERLAP - _QUIET} as cut, case when last + {_QUIET} < begins + {_OVERLAP} then 0 when break is not null then 1 else 2 end as case_ from parts),
kept as (
  select s.time, s.channel, s.length, p.kind from seen s join cased p using (run_id, chunk, kind)
  where case when case_ = 0 then kind = 'post' when case_ = 1 then (kind = 'post') = (s.time < p.break) else kind = 'post' and endtime <= cut end)
select time, channel, length, 'central' as kind from placed where within < {_CHUNK}
union all select * from kept
union all select case when kind = 'post' then cut - {_LENGTH * 10} else cut end, 799, case when kind = 'post' then {_LENGTH} else {_QUIET // 10} end, kind from cased where case_ = 2"""


@query(_RAW, _FRAGMENTS)
def w8_cut_overlaps(spark, sf):
    """Chunks with overlaps that both neighbours hold, cut at breaks or with dead time."""
    period, t = _CHUNK + _OVERLAP, F.col("time")
    rows = v_fragments(spark, sf).where((F.col("channel") % 3 < 2) | (t % (7 * period) < 30_000)).drop("chunk_i")
    c = F.call_function("div", t, F.lit(period)).cast("int")
    central = rows.where(t % period < _CHUNK).withColumns({"chunk_i": c, "kind": F.lit("central")})
    post = rows.where(t % period >= _CHUNK).withColumns({"chunk_i": c, "kind": F.lit("post")})
    every = central.unionByName(post).unionByName(post.withColumns({"chunk_i": F.col("chunk_i") + 1, "kind": F.lit("pre")}))
    made = jobs.raw_records_all(every, channel_map=_ALL, chunk=_CHUNK, overlap=_OVERLAP, safe_break=_QUIET, record_length=_LENGTH, slab=700)
    return made.select("time", "channel", "length", "kind")


@query("select peak_id, (time - 86400000000 * (time // 86400000000)) // 3600000000 as hour from v_peaks where endtime > 1704067200000000 and time < 1704672000000000 and type = 2", "v_peaks")
def v2_analysis(spark, sf):
    """An analysis over the peaks of a range of time that a predicate holds for."""
    return peaks_by_hour({"peak_basics": v_peaks(spark, sf)}, time_range=(1_704_067_200_000_000, 1_704_672_000_000_000), predicate="type = 2")


@registry.analysis("peak_basics")
def peaks_by_hour(rows):
    day = 86_400_000_000
    return rows.select("peak_id", F.call_function("div", F.col("time") % day, F.lit(3_600_000_000)).alias("hour"))


@query(
    """with e as (select *, time // 3600000000 as event_number from v_peaks)
select peak_id, cast(row_number() over (partition by run_id, event_number order by time, peak_id) - 1 as int) as index from e""",
    "v_peaks",
)
def w9_peak_index(spark, sf):
    rows = v_peaks(spark, sf).withColumn("event_number", F.call_function("div", F.col("time"), F.lit(3600000000)))
    return ev.peak_index(rows).select("peak_id", "index")
