"""Views of the supplied tables in the shapes that the operators take, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.io import shared_folder as shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SLAB = 6 * 3_600_000_000


def query(sql: str | None = None, views: str = ""):
    """Registers f(spark, sf_dir); views names the views (see VIEWS) that the SQL starts with."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            names = views.split()
            head = "with " + ",\n".join(VIEWS[v] for v in names) if names else ""
            body = sql.strip()
            if head and body.startswith("with recursive "):
                head, body = head.replace("with ", "with recursive ", 1), ", " + body[15:]
            elif head and body.startswith("with "):
                body = ", " + body[5:]
            ORACLES[f.__name__] = f"{head}\n{body}"
        return f

    return add


def rounded(columns: str, digits: int = 6):
    """Rounds columns of a registered query in both forms: sums of doubles depend on the order of their terms."""
    names = columns.split()

    def change(f):
        def query_rounded(spark, sf_dir):
            return f(spark, sf_dir).withColumns({c: F.round(c, digits) for c in names})

        QUERIES[f.__name__] = query_rounded
        if f.__name__ in ORACLES:
            parts = ", ".join(f'round("{c}", {digits}) as "{c}"' for c in names)
            ORACLES[f.__name__] = f"select * replace ({parts}) from (\n{ORACLES[f.__name__]}\n)"
        return f

    return change


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


VIEWS = {
    "v_peaks": """v_peaks as (
  select lpad(cast(epoch_us(ts) // 86400000000 as varchar), 6, '0') as run_id, event_id as peak_id, epoch_us(ts) as time,
    epoch_us(ts) + 1000000 * (1 + event_id % 60) as endtime, cast(1000000 as int) as dt, cast(1 + event_id % 60 as int) as length,
    value as area, cast(user_id % 7 as int) as channel,
    cast(case event_type when 'purchase' then 2 when 'click' then 1 else 0 end as int) as type,
    cast(json_extract_string(props, '$.k') as int) as tight_coincidence,
    cast(1 + event_id * 37 % 400 as double) as range_50p_area, cast(event_id % 11 as double) / 10 as area_fraction_top,
    cast(1 + event_id % 7 as int) as n_channels, epoch_us(ts) + 500000 as center_time
  from events)""",
    "v_ext": """v_ext as (
  select lpad(cast(epoch_us(ts) // 86400000000 as varchar), 6, '0') as run_id, event_id as ext_id, epoch_us(ts) as time,
    epoch_us(ts) + 1000000 as endtime, value * 20 as area
  from events where event_type = 'view')""",
    "v_waves": """v_waves as (
  select '000001' as run_id, vec_id as peak_id, vec_id * 400 as time, cast(10 as int) as dt, cast(64 as int) as length,
    cast(label as int) as channel, vec_id * 400 + 640 as endtime,
    list_transform(embedding, lambda x: cast(floor(abs(cast(x as double)) * 1000) as int)) as data
  from embeddings)""",
    "v_fragments": """v_fragments as (
  select run_id, cast(peak_id // 100 as int) as chunk_i, time + r * 160 as time, cast(16 as int) as length, dt, channel,
    cast(16 * (1 + peak_id % 4) as int) as pulse_length, cast(r as int) as record_i, data[r * 16 + 1 : r * 16 + 16] as data
  from v_waves, unnest(range(0, 1 + peak_id % 4)) as t(r))""",
    "v_light": """v_light as (
  select '000001' as run_id, l_orderkey as peak_id, l_orderkey * 1000 as time, l_orderkey * 1000 + 640 as endtime,
    [coalesce(sum(l_quantity) filter (l_linenumber = 1), 0), coalesce(sum(l_quantity) filter (l_linenumber = 2), 0),
     coalesce(sum(l_quantity) filter (l_linenumber = 3), 0), coalesce(sum(l_quantity) filter (l_linenumber = 4), 0),
     coalesce(sum(l_quantity) filter (l_linenumber = 5), 0), coalesce(sum(l_quantity) filter (l_linenumber = 6), 0),
     coalesce(sum(l_quantity) filter (l_linenumber = 7), 0)] as area_per_channel,
    sum(l_quantity) as area
  from lineitem group by l_orderkey)""",
    "v_entries": """v_entries as (
  select distinct l_orderkey as number, l_returnflag as host,
    case l_linestatus when 'F' then 'live_data' else 'raw_records' end as type
  from lineitem)""",
    "v_runs": """v_runs as (
  select o_orderkey as number, o_orderdate as start, o_orderdate + to_hours(1 + o_custkey % 50) as "end",
    case when o_custkey % 3 = 0 then null else o_totalprice / 1000 end as livetime,
    case o_orderstatus when 'O' then 'running' when 'P' then 'submitted' else 'done' end as status,
    cast(o_custkey % 5 as int) as processing_failed,
    case o_custkey % 4 when 0 then 'ledcalibration' when 1 then 'bg_nai' else 'bg' end as mode,
    case o_orderpriority when '1-URGENT' then 'process' when '5-LOW' then 'abandon' else 'none' end as tag
  from orders)""",
}


def run_of(time):
    return F.lpad(F.call_function("div", time, F.lit(86_400_000_000)).cast("string"), 6, "0")


def v_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    time, i = F.unix_micros(F.col("ts").cast("timestamp")), F.col("event_id")
    return e.select(
        run_of(time).alias("run_id"),
        i.alias("peak_id"),
        time.alias("time"),
        (time + 1_000_000 * (1 + i % 60)).alias("endtime"),
        F.lit(1_000_000).alias("dt"),
        (1 + i % 60).cast("int").alias("length"),
        F.col("value").alias("area"),
        (F.col("user_id") % 7).cast("int").alias("channel"),
        F.when(F.col("event_type") == "purchase", 2).when(F.col("event_type") == "click", 1).otherwise(0).alias("type"),
        F.get_json_object("props", "$.k").cast("int").alias("tight_coincidence"),
        (1 + i * 37 % 400).cast("double").alias("range_50p_area"),
        ((i % 11).cast("double") / 10).alias("area_fraction_top"),
        (1 + i % 7).cast("int").alias("n_channels"),
        (time + 500_000).alias("center_time"),
    )


def v_ext(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where("event_type = 'view'")
    time = F.unix_micros(F.col("ts").cast("timestamp"))
    return e.select(run_of(time).alias("run_id"), F.col("event_id").alias("ext_id"), time.alias("time"), (time + 1_000_000).alias("endtime"), (F.col("value") * 20).alias("area"))


def v_waves(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("vec_id")
    data = F.transform("embedding", lambda x: F.floor(F.abs(x.cast("double")) * 1000).cast("int"))
    return table(spark, sf_dir, "embeddings").select(
        F.lit("000001").alias("run_id"), v.alias("peak_id"), (v * 400).alias("time"), F.lit(10).alias("dt"), F.lit(64).alias("length"),
        F.col("label").cast("int").alias("channel"), (v * 400 + 640).alias("endtime"), data.alias("data"),
    )


def v_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = v_waves(spark, sf_dir).withColumn("r", F.explode(F.sequence(F.lit(0), (F.col("peak_id") % 4).cast("int"))))
    return w.select(
        "run_id",
        F.call_function("div", F.col("peak_id"), F.lit(100)).cast("int").alias("chunk_i"),
        (F.col("time") + F.col("r") * 160).alias("time"),
        F.lit(16).alias("length"),
        "dt",
        "channel",
        (16 * (1 + F.col("peak_id") % 4)).cast("int").alias("pulse_length"),
        F.col("r").alias("record_i"),
        F.slice("data", F.col("r") * 16 + 1, F.lit(16)).alias("data"),
    )


def v_light(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("l_orderkey")
    sums = [F.coalesce(F.sum(F.when(F.col("l_linenumber") == n, F.col("l_quantity"))), F.lit(0.0)) for n in range(1, 8)]
    g = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array(*sums).alias("area_per_channel"), F.sum("l_quantity").alias("area"))
    return g.select(F.lit("000001").alias("run_id"), k.alias("peak_id"), (k * 1000).alias("time"), (k * 1000 + 640).alias("endtime"), "area_per_channel", "area")


def v_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("l_linestatus") == "F", "live_data").otherwise("raw_records")
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("number"), F.col("l_returnflag").alias("host"), kind.alias("type")).distinct()


def v_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run documents: status, tags and data entries nested as in a catalogue."""
    c = F.col("o_custkey")
    start = F.col("o_orderdate").cast("timestamp")
    tag = F.when(F.col("o_orderpriority") == "1-URGENT", "process").when(F.col("o_orderpriority") == "5-LOW", "abandon").otherwise("none")
    status = F.when(F.col("o_orderstatus") == "O", "running").when(F.col("o_orderstatus") == "P", "submitted").otherwise("done")
    none = F.lit(None).cast("string")
    runs = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("number"),
        start.alias("start"),
        (start + F.make_dt_interval(F.lit(0), (1 + c % 50).cast("int"))).alias("end"),
        F.when(c % 3 != 0, F.col("o_totalprice") / 1000).alias("livetime"),
        F.struct(status.alias("status"), none.alias("host"), none.alias("reason"), start.alias("time")).alias("processing_status"),
        (c % 5).cast("int").alias("processing_failed"),
        F.when(c % 4 == 0, "ledcalibration").when(c % 4 == 1, "bg_nai").otherwise("bg").alias("mode"),
        F.array(F.struct(tag.alias("name"), none.alias("user"), start.alias("time"))).alias("tags"),
    )
    entry = F.struct("type", "host", F.concat_ws("/", "host", "type").alias("location"), F.lit("h").alias("lineage_hash"))
    entries = v_entries(spark, sf_dir).groupBy("number").agg(F.sort_array(F.collect_list(entry)).alias("data"))
    return runs.join(entries, "number", "left")
