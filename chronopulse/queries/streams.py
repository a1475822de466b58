"""Streaming operators, run over the event and fragment views until everything available is processed."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import streams as st
from .base import query, rounded, shared_folder, v_ext, v_fragments, v_peaks

_FRAGMENTS = "v_waves v_fragments"


_SLICES = 6
_ROWS_A_FILE = 1_000_000


def _as_stream(spark, df, at: str, flush=None, late=None):
    """The rows of df as a stream of micro-batches in order of time: slices of time are written one after the other, each
    as files of bounded size, and a trigger takes as many files as a slice has. late rows come after them, then flush
    rows, of a time that closes what is open."""
    edges = df.approxQuantile("time", [k / _SLICES for k in range(1, _SLICES)], 0.001)
    files = max(1, -(-df.count() // (_ROWS_A_FILE * _SLICES)))
    for a, b in zip([None, *edges], [*edges, None], strict=True):
        part = df if a is None else df.where(F.col("time") >= a)
        part = part if b is None else part.where(F.col("time") < b)
        part.repartition(files).write.mode("append").parquet(at)
    for more in (late, flush):
        if more is not None:
            more.select(*df.columns).repartition(files).write.mode("append").parquet(at)
    return st.event_time(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(at), 1)


def _closing(df, **values):
    """A row far after all others: its time, the given values, else nulls."""
    row = {"time": FAR} | values
    return df.sparkSession.range(1).select(*[F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields])


FAR = 4_000_000_000_000_000


@query("select run_id, channel, time, record_i from v_fragments", _FRAGMENTS)
def x1_stream_fragments(spark, sf):
    root = shared_folder(spark)
    rows = v_fragments(spark, sf).select("run_id", "channel", "time", "record_i")
    rows.write.parquet(f"{root}/in")
    st.run_to_files(st.stream_fragments(spark, f"{root}/in", 2, rows.schema), f"{root}/out", f"{root}/state")
    return spark.read.parquet(f"{root}/out")


@query("select run_id, channel, time + 1000000 as time, record_i from v_fragments", _FRAGMENTS)
def x2_stream_dedup(spark, sf):
    root = shared_folder(spark)
    shifted = (F.col("time") + 1_000_000).alias("time")  # a stream takes times up to the epoch itself as late
    rows = v_fragments(spark, sf).select("run_id", "channel", shifted, "record_i")
    twice = rows.unionByName(rows.where("time % 3 = 0"))
    stream = _as_stream(spark, twice, f"{root}/in")
    st.run_to_files(st.stream_dedup(stream, "1 hour").drop("ts"), f"{root}/out", f"{root}/state")
    return spark.read.parquet(f"{root}/out")


_DELAY_US = 20_000


@query(
    f"""with f as (select *, time + 1000000 as tick, (time // 160) % 11 = 3 as held from v_fragments),
newest as (select max(tick) as tick from f where not held),
g as (select f.*, held and f.tick < newest.tick - {_DELAY_US} as late from f, newest)
select tick // 50000 * 50000 as start, channel, count(*) filter (record_i = 0 and not late) as pulse_count, count(*) filter (not late) as n,
  cast(coalesce(sum(list_sum(data)) filter (not late), 0) as bigint) as pulse_area, count(*) filter (late) as n_late
from g group by all""",
    _FRAGMENTS,
)
def x3_stream_pulse_counts(spark, sf):
    """Counts by window in append mode; an eleventh of the rows comes after all others, and those too late are told apart."""
    root = shared_folder(spark)
    area = F.aggregate("data", F.lit(0).cast("bigint"), lambda s, x: s + x)
    rows = v_fragments(spark, sf).select("channel", (F.col("time") + 1_000_000).alias("time"), "record_i", area.alias("area"))
    held = F.call_function("div", F.col("time") - 1_000_000, F.lit(160)) % 11 == 3
    stream = _as_stream(spark, rows.where(~held), f"{root}/in", _closing(rows, channel=-1), rows.where(held))
    st.split_late(stream, _DELAY_US, f"{root}/split", f"{root}/split_state")
    on_time = spark.readStream.schema(f"{rows.schema.simpleString()[7:-1].replace(':', ' ')}, ts timestamp").option("maxFilesPerTrigger", 2).parquet(f"{root}/split/on_time")
    st.run_to_files(st.stream_pulse_counts(on_time, "50 milliseconds", "20 milliseconds"), f"{root}/out", f"{root}/state")
    late = spark.read.parquet(f"{root}/split/late").groupBy((F.call_function("div", F.col("time"), F.lit(50_000)) * 50_000).alias("start"), "channel").agg(F.count("*").alias("n_late"))
    found = spark.read.parquet(f"{root}/out").join(late, ["start", "channel"], "full")
    return found.select("start", "channel", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("pulse_count", "n", "pulse_area", "n_late")])


@query(
    """with t as (select * from v_peaks where type = 2 and area > 10),
g as (select *, max(endtime) over (partition by run_id order by time, endtime rows between unbounded preceding and 1 preceding) as last_end from t),
s as (select *, sum(case when last_end is null or time - last_end >= 550000001 then 1 else 0 end) over (partition by run_id order by time, endtime) as grp from g)
select run_id, min(time) - 500000000 as time, max(endtime) + 50000000 as endtime, count(*) as n_triggers from s group by run_id, grp""",
    "v_peaks",
)
def x4_stream_events(spark, sf):
    root = shared_folder(spark)
    rows = v_peaks(spark, sf).where("type = 2 and area > 10").select("run_id", "time", "endtime")
    stream = _as_stream(spark, rows, f"{root}/in", _closing(rows, run_id="closing", endtime=FAR))
    st.run_to_files(st.stream_events(stream, 500_000_000, 50_000_000, 1), f"{root}/out", f"{root}/state")
    return spark.read.parquet(f"{root}/out")


@query(
    """select run_id, peak_id from v_peaks p where type = 2 and exists (select 1 from v_ext x where x.run_id = p.run_id and x.time between p.time and p.time + 120000000)""",
    "v_peaks v_ext",
)
def x5_stream_coincidences(spark, sf):
    root = shared_folder(spark)
    peaks = v_peaks(spark, sf).where("type = 2").select("run_id", "peak_id", "time")
    others = v_ext(spark, sf).select("run_id", "time")
    left = _as_stream(spark, peaks, f"{root}/left", _closing(peaks, run_id="closing"))
    right = _as_stream(spark, others, f"{root}/right", _closing(others, run_id="closing right"))
    st.run_to_files(st.stream_coincidences(left, right, 120_000_000, "1 hour").drop("ts"), f"{root}/out", f"{root}/state")
    return spark.read.parquet(f"{root}/out").select("run_id", "peak_id")


@rounded("baseline")
@query(
    """with own as (select *, case when record_i = 0 then list_avg(data) end as b from v_fragments)
select run_id, channel, time, record_i, last_value(b ignore nulls) over (partition by run_id, channel order by time, record_i rows between unbounded preceding and current row) as baseline from own""",
    _FRAGMENTS,
)
def x6_stream_baseline(spark, sf):
    root = shared_folder(spark)
    shifted = (F.col("time") + 1_000_000).alias("time")  # a stream takes times up to the epoch itself as late
    rows = v_fragments(spark, sf).select("run_id", "channel", shifted, "record_i", "data")
    stream = _as_stream(spark, rows, f"{root}/in", _closing(rows, run_id="closing", channel=0, record_i=0))
    st.run_to_files(st.stream_baseline(stream, delay="10 milliseconds", slab_ms=20), f"{root}/out", f"{root}/state")
    return spark.read.parquet(f"{root}/out").withColumn("time", F.col("time") - 1_000_000)


@query(
    "select run_id, row_number() over (partition by run_id order by time) - 1 as event_number, time, endtime from v_peaks where type = 2", "v_peaks"
)
def x7_stream_event_number(spark, sf):
    root = shared_folder(spark)
    rows = v_peaks(spark, sf).where("type = 2").select("run_id", "time", "endtime")
    stream = _as_stream(spark, rows, f"{root}/in", _closing(rows, run_id="closing", endtime=FAR))
    st.number_events(st.stream_event_ranks(stream, "1 hour", 6 * 3_600_000), root, f"{root}/state")
    return spark.read.schema("run_id string, event_number long, time long, endtime long").parquet(f"{root}/events").drop("batch")
