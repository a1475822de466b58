"""Scalar functions over table columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import columns as c
from .base import query, rounded, table, v_peaks


@rounded("y")
@query("select peak_id, ((2 * area - 1) * area + 0.5) * area - 7 as y from v_peaks", "v_peaks")
def m1_poly(spark, sf):
    return v_peaks(spark, sf).select("peak_id", c.poly(F.col("area"), (2, -1, 0.5, -7)).alias("y"))


@query("select o_orderkey, lpad(cast(o_orderkey as varchar), 6, '0') as run_id from orders")
def m13_run_key(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", c.run_key(F.col("o_orderkey")).alias("run_id"))


@query(
    """select o_orderkey, case when o_orderkey % 3 = 0 then lpad(cast(o_orderkey as varchar), 6, '0') else lpad(cast(o_orderkey as varchar), 6, '0') end as first,
case o_orderkey % 3 when 0 then lpad(cast(o_orderkey as varchar), 6, '0') when 1 then lpad(cast(o_orderkey + 10 as varchar), 6, '0') else '999999' end as last from orders"""
)
def m14_run_range(spark, sf):
    k = F.col("o_orderkey")
    text = F.when(k % 3 == 0, k.cast("string")).when(k % 3 == 1, F.concat_ws("-", k.cast("string"), (k + 10).cast("string"))).otherwise(F.concat(k.cast("string"), F.lit("-*")))
    first, last = c.run_range(text)
    return table(spark, sf, "orders").select("o_orderkey", first.alias("first"), last.alias("last"))


@query(
    """select o_orderkey, case when o_orderkey % 2 = 0 then 'file' else 'cmt' end as scheme, case when o_orderkey % 2 = 1 then 'v' || cast(o_orderkey as varchar) end as version,
case when o_orderkey % 2 = 0 then 'f' || cast(o_orderkey as varchar) || '.json' end as filename, 'main' as github_branch from orders"""
)
def m15_config_url(spark, sf):
    k = F.col("o_orderkey").cast("string")
    local = F.concat(F.lit("file://?filename=f"), k, F.lit(".json&github_branch=main"))
    remote = F.concat(F.lit("cmt://elife?version=v"), k, F.lit("&github_branch=main"))
    text = F.when(F.col("o_orderkey") % 2 == 0, local).otherwise(remote)
    return table(spark, sf, "orders").select("o_orderkey", *[v.alias(n) for n, v in c.config_url(text).items()])


@query("select peak_id, time // 1000000 as seconds, time % 1000000 as rest from v_peaks", "v_peaks")
def m18_split_off_ns(spark, sf):
    s, r = c.split_off_ns(F.col("time"), 1_000_000)
    return v_peaks(spark, sf).select("peak_id", s.alias("seconds"), r.alias("rest"))


@query(
    """select o_orderkey, cast(o_orderkey % 8 as int) as channel, cast(case o_orderkey % 3 when 0 then -1 when 1 then 1 end as int) as polarity from orders"""
)
def m12_channel_polarity(spark, sf):
    k = F.col("o_orderkey")
    address = F.lower(F.hex(F.lit(0x1080) + (k % 8) * 0x100))
    value = F.when(k % 3 == 0, "110000").when(k % 3 == 1, "1100000").otherwise("7")
    registers = F.array(F.struct(address.alias("reg"), value.alias("val")), F.struct(F.lit("2080").alias("reg"), F.lit("110000").alias("val")))
    out = table(spark, sf, "orders").select("o_orderkey", F.explode(c.channel_polarity(registers)).alias("p"))
    return out.select("o_orderkey", "p.channel", "p.polarity")


@query(
    "select peak_id, channel, area > [15, 15, 15, 15, 15, 15, 15][channel + 1] as over from v_peaks",
    "v_peaks",
)
def m20_hit_threshold(spark, sf):
    limits = F.lit(c.hit_threshold("pulse_model", 7))
    return v_peaks(spark, sf).select("peak_id", "channel", (F.col("area") > F.get(limits, F.col("channel"))).alias("over"))
