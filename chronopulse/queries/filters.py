"""Projections, filters, predicates, sorts and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import events as ev
from ..operators import filters, peaks
from ..schemas import with_sentinels
from .base import query, rounded, v_ext, v_fragments, v_light, v_peaks, v_waves


@rounded("area")
@query("select peak_id, channel, area from v_peaks where channel in (0, 3, 4)", "v_peaks")
def f1_select_channels(spark, sf):
    return filters.select_channels(v_peaks(spark, sf), (0, 3, 4)).select("peak_id", "channel", "area")


@query(
    "select peak_id, time from v_peaks where endtime > 1704412800000000 and time < 1705017600000000 and area > 20", "v_peaks"
)
def f2_select_time_touching(spark, sf):
    return filters.select_time(v_peaks(spark, sf), (1704412800000000, 1705017600000000), predicate="area > 20").select("peak_id", "time")


@query("select peak_id, time from v_peaks where time >= 1704412800000000 and endtime <= 1705017600000000", "v_peaks")
def f2_select_time_contained(spark, sf):
    return filters.select_time(v_peaks(spark, sf), time_within=(1704412800000000, 1705017600000000), mode="fully_contained").select("peak_id", "time")


@query("select record_i, channel, time + dt * (12345000000000 // dt) as time from v_fragments", "v_waves v_fragments")
def f3_to_epoch(spark, sf):
    return filters.to_epoch(v_fragments(spark, sf), 12345.6).select("record_i", "channel", "time")


@query(
    "select time, channel, cast(list_sum(list_transform(data, lambda x: case when channel in (1, 3, 5) then -x else x end)) as bigint) as total from v_fragments",
    "v_waves v_fragments",
)
def f4_apply_polarity(spark, sf):
    signs = spark.range(10).select(F.col("id").cast("int").alias("channel"), F.when(F.col("id").isin(1, 3, 5), 1).otherwise(-1).alias("polarity"))
    out = filters.apply_polarity(v_fragments(spark, sf), signs)
    return out.select("time", "channel", F.aggregate("data", F.lit(0).cast("bigint"), lambda s, x: s + x).alias("total"))


@query(
    "select peak_id, channel, case when channel <= 4 then 'tpc' when channel = 5 then 'external' else 'sipm' end as detector from v_peaks",
    "v_peaks",
)
def f5_route_detectors(spark, sf):
    return filters.route_detectors(v_peaks(spark, sf)).select("peak_id", "channel", "detector")


@query("select peak_id from v_peaks where channel < 5", "v_peaks")
def f6_keep_tpc(spark, sf):
    return filters.keep_tpc(v_peaks(spark, sf), 5).select("peak_id")


@query(
    "select peak_id, cast(list_sum(data[1:1 + peak_id % 50]) as bigint) as total, cast(len(data) as int) as n from v_waves",
    "v_waves",
)
def f7_zero_out_of_bounds(spark, sf):
    cut = v_waves(spark, sf).withColumn("length", (1 + F.col("peak_id") % 50).cast("int"))
    out = filters.zero_out_of_bounds(cut)
    return out.select("peak_id", F.aggregate("data", F.lit(0).cast("bigint"), lambda s, x: s + x).alias("total"), F.size("data").alias("n"))


@rounded("area")
@query("select channel < 5 as first_part, count(*) as n, sum(area) as area from v_peaks group by 1", "v_peaks")
def f8_split_by(spark, sf):
    a, b = filters.split_by(v_peaks(spark, sf), 5)
    both = a.withColumn("first_part", F.lit(True)).unionByName(b.withColumn("first_part", F.lit(False)))
    return both.groupBy("first_part").agg(F.count("*").alias("n"), F.sum("area").alias("area"))


_F9 = """
select peak_id, cast(case when area > 10 and range_50p_area > 225 and area_fraction_top >= 0 and n_channels >= 5 then 2
  when area >= 10 and range_50p_area > 10 and range_50p_area < 225 and area_fraction_top <= 0.2 and n_channels >= 5 then 1
  else 0 end as int) as type from v_peaks"""


@query(_F9, "v_peaks")
def f9_classify_peaks(spark, sf):
    return filters.classify_peaks(v_peaks(spark, sf)).select("peak_id", "type")


@query(
    "select peak_id, cast(case when area > 0 and range_50p_area > 225 then 2 when area >= 0 and range_50p_area > 10 and range_50p_area < 225 then 1 else 0 end as int) as type from v_peaks",
    "v_peaks",
)
def f9_classify_peaks_aux(spark, sf):
    return filters.classify_peaks(v_peaks(spark, sf), mode="aux").select("peak_id", "type")


@rounded("area")
@query("select peak_id, area from v_peaks where type = 2 and area > 10", "v_peaks")
def f10_trigger_peaks(spark, sf):
    return filters.trigger_peaks(v_peaks(spark, sf)).select("peak_id", "area")


@rounded("area")
@query("select ext_id, area from v_ext where area > 446 and area < 576", "v_ext")
def f11_absorption_window(spark, sf):
    return filters.absorption_window(v_ext(spark, sf)).select("ext_id", "area")


@rounded("cs1 cs2")
@query(
    "select peak_id, greatest(case when type = 1 then area else 0 end, 0.9) as cs1, greatest(case when type = 2 then area else 0 end, 0.9) as cs2 from v_peaks",
    "v_peaks",
)
def f12_scatter_view(spark, sf):
    area = v_peaks(spark, sf).select(
        "peak_id", F.when(F.col("type") == 1, F.col("area")).alias("cs1"), F.when(F.col("type") == 2, F.col("area")).otherwise(F.lit(float("nan"))).alias("cs2")
    )
    return filters.scatter_view(area)


@rounded("fraction_off")
@query(
    "select peak_id, 1 - list_sum(area_per_channel[1:5]) / area as fraction_off from v_light where area > 0 and abs(list_sum(area_per_channel[1:5]) - area) > 1e-8 + 1e-4 * area",
    "v_light",
)
def f13_check_area(spark, sf):
    return filters.check_area(v_light(spark, sf)).select("peak_id", "fraction_off")


@query("select peak_id, coalesce(case when type = 1 then tight_coincidence end, -1) as index from v_peaks", "v_peaks")
def with_sentinels_view(spark, sf):
    return with_sentinels(v_peaks(spark, sf).select("peak_id", F.when(F.col("type") == 1, F.col("tight_coincidence")).alias("index")))


@query("select time, channel, peak_id from v_peaks order by time, channel", "v_peaks")
def t1_sort_by_time(spark, sf):
    return peaks.sort_by_time(v_peaks(spark, sf)).select("time", "channel", "peak_id")


_T2 = """
with e as (select *, cast(time // 3600000000 as bigint) as event_number from v_peaks),
i as (select *, cast(row_number() over (partition by run_id, event_number order by time, peak_id) - 1 as int) as index from e)
select run_id, event_number, peak_id, index, cast(r as int) as rank from (
  select *, row_number() over (partition by run_id, event_number order by area desc, index desc) as r from i where type = 2)
where r <= 2"""


@query(_T2, "v_peaks")
def t2_largest_peaks_per_event(spark, sf):
    rows = ev.peak_index(v_peaks(spark, sf).withColumn("event_number", F.call_function("div", F.col("time"), F.lit(3600000000))))
    return ev.largest_peaks_per_event(rows, 2).select("run_id", "event_number", "peak_id", "index", "rank")


@rounded("area")
@query("select peak_id, time, area from v_peaks order by area desc, peak_id limit 100", "v_peaks")
def t3_largest_peaks(spark, sf):
    return peaks.largest_peaks(v_peaks(spark, sf), 100).select("peak_id", "time", "area")


@query("select time, channel, record_i from v_fragments order by time, channel, record_i limit 20", "v_waves v_fragments")
def t5_first_pulses(spark, sf):
    return peaks.first_rows(v_fragments(spark, sf), 20).select("time", "channel", "record_i")
