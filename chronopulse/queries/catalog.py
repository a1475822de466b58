"""The run catalogue: joins, set operations, selections and updates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import catalog
from ..sources import io
from .base import query, rounded, shared_folder, table, v_entries, v_fragments, v_peaks, v_runs


def _has(host: str | None = None, kind: str | None = None) -> str:
    host = f" and e.host = '{host}'" if host else ""
    kind = f" and e.type = '{kind}'" if kind else ""
    return f"exists (select 1 from v_entries e where e.number = r.number{host}{kind})"


_RUNS = "v_entries v_runs"


def corrections(spark):
    rows = [(0, "000100-000900", 1.5), (1, "000500-001500", 2.5), (2, "002000", 3.5), (3, "002001-*", 4.5)]
    return spark.createDataFrame(rows, "position int, range string, value double")


_J8 = """case when n between 100 and 900 then '000100-000900' when n between 500 and 1500 then '000500-001500' when n = 2000 then '002000' when n >= 2001 then '002001-*' end"""
_J8V = "case when n between 100 and 900 then 1.5 when n between 500 and 1500 then 2.5 when n = 2000 then 3.5 when n >= 2001 then 4.5 end"


@rounded("value")
@query(f"select lpad(cast(n as varchar), 6, '0') as run_id, {_J8} as range, cast({_J8V} as double) as value from (select number as n from v_runs)", "v_runs")
def j8_correction_for_run(spark, sf):
    runs = v_runs(spark, sf).select(io.run_key(F.col("number")).alias("run_id"))
    return catalog.correction_for_run(runs, corrections(spark), missing="null")


@rounded("elife gain")
@query(f"select lpad(cast(n as varchar), 6, '0') as run_id, cast({_J8V} as double) as elife, 7.0::double as gain from (select number as n from v_runs)", "v_runs")
def j9_correction_version(spark, sf):
    index = spark.createDataFrame([("elife", "elife_v0.json", None), ("gain", None, 7.0), ("skipped", None, None)], "name string, file string, value double")
    files = corrections(spark).withColumn("file", F.lit("elife_v0.json"))
    runs = v_runs(spark, sf).select(io.run_key(F.col("number")).alias("run_id"))
    return catalog.apply_correction_version(runs, index, files)


@query(f"select number from v_runs r where not {_has('R', 'live_data')}", _RUNS)
def j10_runs_without(spark, sf):
    return catalog.runs_without(v_runs(spark, sf), "R", "live_data").select("number")


@query(f"select number from v_runs r where {_has('A', 'raw_records')}", _RUNS)
def j11_runs_with(spark, sf):
    return catalog.runs_with(v_runs(spark, sf), "A", "raw_records").select("number")


@query(
    """select r.number, 'live_data' as type, f.host, f.host || '/live_data' as location, f.host is not null as found
from v_runs r left join (select number, min(host) as host from v_entries where type = 'live_data' group by number) f using (number)""",
    _RUNS,
)
def j12_find_datasets(spark, sf):
    keys = v_runs(spark, sf).select("number", F.lit("live_data").alias("type"), F.lit("h").alias("lineage_hash"))
    return catalog.find_datasets(keys, v_runs(spark, sf)).drop("lineage_hash")


@query(
    """with c as (select number, count(*) filter (host = 'A') as A, count(*) filter (host = 'N') as N, count(*) filter (host = 'R') as R from v_entries group by number)
select cast(number as varchar) as run_id, A, N, R, A = N and A = R and A > 0 as safe from c""",
    "v_entries",
)
def g18_replica_file_counts(spark, sf):
    files = v_entries(spark, sf).select(F.col("number").cast("string").alias("run_id"), "host")
    return catalog.replica_file_counts(files, ["A", "N", "R"])


@query(
    "select count(*) filter (status in ('running', 'submitted')) as running, greatest(20000 - count(*) filter (status in ('running', 'submitted')), 0) as free from v_runs",
    "v_runs",
)
def g19_running_jobs(spark, sf):
    return catalog.running_jobs(v_runs(spark, sf), 20000)


@query("select number from v_runs where status in ('running', 'submitted') and start < timestamp '2000-01-01 00:00:00' - interval 30 minute", "v_runs")
def w10_stale_jobs(spark, sf):
    return catalog.stale_jobs(v_runs(spark, sf), F.expr("timestamp '2000-01-01 00:00:00'")).select("number")


@query("select number from v_runs where status = 'done' order by number desc limit 30 offset 10", "v_runs")
def t4_next_runs(spark, sf):
    return catalog.next_runs(v_runs(spark, sf).where("processing_status.status = 'done'"), 30, 10).select("number")


@query(
    """with doubled as (select run_id, peak_id, channel, time from v_peaks union all select run_id, peak_id, channel, time from v_peaks where peak_id % 5 = 0)
select distinct run_id, channel, time, cast(0 as int) as record_i from doubled""",
    "v_peaks",
)
def u1_concat_chunks(spark, sf):
    p = v_peaks(spark, sf).withColumn("record_i", F.lit(0))
    return io.concat_chunks(p.unionByName(p.where("peak_id % 5 = 0"))).select("run_id", "channel", "time", "record_i")


@query(
    f"""with c as (select number, case when not {_has('A', 'live_data')} then 'A' else 'N' end as target, case when not {_has('A', 'live_data')} then 0 else 1 end as p
  from v_runs r where number >= 1000 and (not {_has('A', 'live_data')} or not {_has('N', 'live_data')}))
select number, target from c order by p, number desc limit 500""",
    _RUNS,
)
def u2_runs_to_copy(spark, sf):
    return catalog.runs_to_copy(v_runs(spark, sf), ("A", "N"), 1000, max_runs=500)


@query(f"select number from v_runs r where ({_has('A', 'live_data')} and {_has('R', 'live_data')}) or tag = 'abandon'", _RUNS)
def u3_runs_on_all_hosts(spark, sf):
    return catalog.runs_on_all_hosts(v_runs(spark, sf), ["A", "R"]).select("number")


@query(
    f"""select number from v_runs r where {_has(None, 'live_data')} and ((not {_has(None, 'raw_records')} and processing_failed <= 3 and status = 'done'
  and tag <> 'abandon' and start >= timestamp '1997-01-01' and number >= 100) or tag = 'process')""",
    _RUNS,
)
def u4_runs_to_process(spark, sf):
    return catalog.runs_to_process(v_runs(spark, sf), F.expr("timestamp '1997-01-01 00:00:00'"), 100).select("number")


def _flat(spark, sf):
    return v_entries(spark, sf).select("number", "type", "host", F.col("host").alias("location"), F.lit("h").alias("lineage_hash"))


@query(
    """select number, type, host, host as location, 'h' as lineage_hash from v_entries where host <> 'A'
union all select distinct number, type, host, host, 'h' from v_entries where host = 'A' and number % 2 = 0""",
    "v_entries",
)
def u5_add_data_entries(spark, sf):
    every = _flat(spark, sf)
    return catalog.add_data_entries(every.where("host <> 'A'"), every.where("number % 2 = 0"))


@query("select number, type, host, host = 'A' and number % 2 = 0 as deleted from v_entries", "v_entries")
def u6_archive_entries(spark, sf):
    every = _flat(spark, sf)
    left, gone = catalog.archive_entries(every, every.where("host = 'A' and number % 2 = 0"), F.current_timestamp(), "agent")
    a = left.select("number", "type", "host", F.lit(False).alias("deleted"))
    return a.unionByName(gone.select("number", "type", "host", F.lit(True).alias("deleted")))


@query(
    """select number, case when number % 3 = 0 then 'failed' else status end as status,
  cast(processing_failed + case when number % 3 = 0 then 2 else 0 end as int) as processing_failed,
  case when number % 3 = 0 and tag <> 'process' then tag || ',second,first' when number % 3 = 0 then 'second,first' else tag end as tags from v_runs""",
    "v_runs",
)
def u7_apply_status_updates(spark, sf):
    """Four updates of a run, two with a reason, two at one time: each adds or pulls tags of its own."""
    runs = v_runs(spark, sf)
    base = runs.where("number % 3 = 0")
    text = lambda x: F.lit(x).cast("string")
    update = lambda status, hours, reason, add, remove: base.select(
        "number", F.lit(status).alias("status"), (F.col("start") + F.make_dt_interval(F.lit(0), F.lit(hours))).alias("time"), F.lit("host").alias("host"),
        text(reason).alias("reason"), text(add).alias("add_tag"), text(remove).alias("remove_tag"),
    )
    rows = [("failed", 3, "memory", "first", None), ("running", 1, None, "first", "process"), ("a", 2, "lost", "second", "first"), ("b", 2, None, "seen", None), ("c", 2, None, None, "seen")]
    changed = catalog.apply_status_updates(runs, reduce(DataFrame.unionByName, [update(*r) for r in rows]))
    return changed.select("number", F.col("processing_status.status").alias("status"), "processing_failed", F.array_join("tags.name", ",").alias("tags"))


@query(
    """select number, case when mode like '%ledcalibration%' then 'led_calibration' when mode like '%_nai%' then 'peak_basics,event_info,peak_basics_ext' else 'peak_basics,event_info' end as targets from v_runs""",
    "v_runs",
)
def m16_run_targets(spark, sf):
    return catalog.run_targets(v_runs(spark, sf)).select("number", F.array_join("targets", ",").alias("targets"))


@rounded("duration")
@query("""select number, cast(epoch_ms("end") - epoch_ms(start) as double) / 1000 as duration, epoch_us(start) as start_us from v_runs""", "v_runs")
def m17_run_duration(spark, sf):
    ms = lambda c: F.unix_millis(c).alias(f"{c}_ms")
    out = catalog.run_duration(v_runs(spark, sf).select("number", ms("start"), ms("end")))
    return out.select("number", "duration", F.unix_micros("start").alias("start_us"))


@query(
    """select number, cast(220 as int) as record_length, cast(5000000000 as bigint) as chunk_ns, cast(500000000 as bigint) as overlap_ns, cast(epoch(start) as bigint) as start_s from v_runs""",
    "v_runs",
)
def m25_daq_settings(spark, sf):
    config = F.struct(F.lit(440).alias("fragment_payload_bytes"), F.lit(5.0).alias("chunk_length"), F.lit(0.5).alias("chunk_overlap"), F.create_map(F.lit("reader0"), F.lit(2)).alias("processing_threads"))
    return catalog.daq_settings(v_runs(spark, sf).withColumn("daq_config", config)).drop("threads")


_S8 = """
with f as (select run_id, cast(time // 3600000000 as int) as chunk_i, case channel % 3 when 0 then 'pre' when 1 then 'central' else 'post' end as kind,
  'reader' || cast(peak_id % 2 as varchar) as thread from v_peaks),
parts as (select distinct run_id, chunk_i, kind from f),
c as (select run_id, chunk_i, kind, thread, count(*) as got from f group by all),
g as (select p.*, t.thread, t.want, coalesce(c.got, 0) as got from parts p cross join (values ('reader0', 1), ('reader1', 1)) t(thread, want) left join c using (run_id, chunk_i, kind, thread)),
s as (select run_id, chunk_i, kind, bool_or(got > want) as too_many, bool_and(got >= want) as complete from g group by all),
k as (select run_id, chunk_i, coalesce(bool_or(complete) filter (kind = 'pre'), false) as pre, coalesce(bool_or(complete) filter (kind = 'central'), false) as central,
  coalesce(bool_or(complete) filter (kind = 'post'), false) as post, bool_or(too_many) as too_many from s group by all),
o as (select *, lag(chunk_i) over w is null as first, lead(chunk_i) over w is null as last from k window w as (partition by run_id order by chunk_i))
select run_id, chunk_i, pre, central, post, too_many, central and ((pre and post) or (first and post) or (last and pre)) as ready from o"""


@query(_S8, "v_peaks")
def s8_chunk_completeness(spark, sf):
    p = v_peaks(spark, sf)
    kind = F.when(F.col("channel") % 3 == 0, "pre").when(F.col("channel") % 3 == 1, "central").otherwise("post")
    files = p.select(
        "run_id", F.call_function("div", F.col("time"), F.lit(3_600_000_000)).cast("int").alias("chunk_i"), kind.alias("kind"), F.concat(F.lit("reader"), (F.col("peak_id") % 2).cast("string")).alias("thread")
    )
    expected = spark.createDataFrame([("reader0", 1), ("reader1", 1)], "thread string, n int")
    return catalog.chunk_completeness(files, expected).select("run_id", "chunk_i", "pre", "central", "post", "too_many", "ready")


@query("select distinct run_id from v_peaks where run_id not in (select run_id from v_peaks where area > 300)", "v_peaks")
def s6_missing_runs(spark, sf):
    p = v_peaks(spark, sf)
    return io.missing_runs(p.select("run_id").distinct(), p.where("area > 300"))


@query("select count(*) as n_rows from lineitem")
def s7_file_inventory(spark, sf):
    return io.file_inventory(table(spark, sf, "lineitem")).agg(F.sum("n_rows").alias("n_rows"))


@query("select run_id, chunk_i, time, length, dt, channel, pulse_length, record_i, cast(list_sum(data) as bigint) as total from v_fragments", "v_waves v_fragments")
def s1_read_fragments(spark, sf):
    """Fragments written in folders of runs, chunks and parts, and read again."""
    at = shared_folder(spark)
    rows = v_fragments(spark, sf).withColumns(
        {"kind": F.when(F.col("channel") % 3 == 0, "pre").otherwise("central"), "thread": F.lit("reader0"), "baseline": F.lit(16000), "data": F.col("data").cast("array<smallint>")}
    )
    rows.write.partitionBy("run_id", "chunk_i", "kind").parquet(at)
    total = F.aggregate("data", F.lit(0).cast("bigint"), lambda s, x: s + x)
    return io.read_fragments(spark, at).select("run_id", "chunk_i", "time", "length", "dt", "channel", "pulse_length", "record_i", total.alias("total"))


@query("select number, mode, status, cast(processing_failed as int) as failed from v_runs", "v_runs")
def s2_read_run_docs(spark, sf):
    at = shared_folder(spark)
    v_runs(spark, sf).write.json(at)
    docs = io.read_run_docs(spark, at, ["number", "mode", "processing_status.status", "processing_failed"])
    return docs.select("number", "mode", F.col("processing_status_status").alias("status"), F.col("processing_failed").alias("failed"))


@query(
    """select k as "range", round(v, 6) as value, cast(row_number() over (partition by file order by k) - 1 as int) as position
from (select s_suppkey % 5 as file, lpad(cast(s_suppkey as varchar), 6, '0') || '-' || lpad(cast(s_suppkey + 3 as varchar), 6, '0') as k, s_acctbal as v from supplier)"""
)
def s3_read_corrections(spark, sf):
    """Correction files, one a folder, of run ranges and values."""
    at = shared_folder(spark)
    k = F.col("s_suppkey")
    key = F.concat_ws("-", F.lpad(k.cast("string"), 6, "0"), F.lpad((k + 3).cast("string"), 6, "0"))
    entries = F.sort_array(F.collect_list(F.struct(key.alias("k"), F.col("s_acctbal").cast("double").alias("v"))))
    files = table(spark, sf, "supplier").groupBy((k % 5).alias("file")).agg(F.to_json(F.map_from_entries(entries)).alias("value"))
    files.write.partitionBy("file").text(at)
    found = io.read_corrections(spark, at).select("range", F.round(F.col("value").cast("double"), 6).alias("value"), "position")
    return found


@query("select lpad(cast(o_orderkey as varchar), 6, '0') as run_id from orders")
def s4_read_run_list(spark, sf):
    at = shared_folder(spark)
    table(spark, sf, "orders").select(F.concat(F.lit(" "), F.col("o_orderkey").cast("string"), F.lit("\n")).alias("value")).write.text(at)
    return io.read_run_list(spark, at)


@query("select cast(o_orderkey as int) as run, o_orderpriority as notes, case when o_orderkey % 3 > 0 then r.mode end as mode from orders join v_runs r on r.number = o_orderkey", "v_runs")
def s5_read_measurements(spark, sf):
    """A lab book joined to runs, of which a third is missing."""
    at = shared_folder(spark)
    table(spark, sf, "orders").select(F.col("o_orderkey").alias("run"), F.col("o_orderpriority").alias("notes")).write.option("header", True).csv(at)
    runs = v_runs(spark, sf).where("number % 3 > 0").select("number", "mode")
    return io.read_measurements(spark, at, runs).select("run", "notes", "mode")


@query("select run_id, 'peaks' as data_type, cast(1 as bigint) as n_files, true as has_size, count(*) as n_rows from v_peaks group by run_id", "v_peaks")
def s7_dataset_inventory(spark, sf):
    """A data set written by run and its files: one a run, with a size."""
    path = io.write_dataset(v_peaks(spark, sf).repartition("run_id"), shared_folder(spark), "peaks", {"left": 10})
    back = spark.read.schema("peak_id long, run_id string").parquet(path)
    files = io.dataset_inventory(back).select("run_id", "data_type", "n_files", (F.col("mb") > 0).alias("has_size"))
    return files.join(back.groupBy("run_id").agg(F.count("*").alias("n_rows")), "run_id")
