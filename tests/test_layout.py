"""Stored layouts, sketches, overlaps of chunks, and what the entry point does when parts are absent."""

import subprocess
import sys
from pathlib import Path

from pyspark.sql import Observation
from pyspark.sql import functions as F

from chronopulse.operators import analysis, intervals, records
from chronopulse.plans import jobs
from chronopulse.sources import io

ROOT = Path(__file__).resolve().parents[1]


def test_bucketed_tables_meet_without_a_shuffle(spark):
    rows = spark.range(2000).selectExpr("cast(id % 7 as string) as run_id", "id as peak_id", "cast(id as double) as area")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = io.write_bucketed(rows, "layout_basics", 4)
        b = io.write_bucketed(rows.selectExpr("run_id", "peak_id", "area * 2 as x"), "layout_positions", 4)
        met = a.join(b, ["run_id", "peak_id"]).groupBy("run_id", "peak_id").agg(F.sum("x").alias("x"))
        assert met.count() == 2000
        assert "Exchange" not in met._jdf.queryExecution().executedPlan().toString()
        assert io.write_bucketed(rows.limit(5), "layout_basics", 4).count() == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table if exists layout_basics")
        spark.sql("drop table if exists layout_positions")


def test_sketches_unite_and_are_near(spark):
    rows = spark.range(60_000).selectExpr("cast(id % 2 as string) as run_id", "id div 1000 as slab", "id % 20000 as x", "cast(null as int) as nothing")
    hourly = analysis.distinct_sketches(rows, ["run_id", "slab"], ["x", "nothing"])
    assert hourly.count() == 120
    for r in analysis.distinct_counts(hourly, ["run_id"], ["x", "nothing"]).collect():
        assert abs(r["x"] - 10_000) < 10_000 * 0.035 and r["nothing"] == 0  # five standard errors


def test_overlaps_are_cut_once(spark):
    """Quiet, broken and dense overlaps of three chunks, and a pre part of the first chunk, which is ignored."""
    chunk, overlap = 10_000, 4_000
    row = lambda i, kind, t: ("1", i, kind, t, 10, 10, 0, "x")
    over = {0: [10_100, 10_400], 1: [24_050, 26_500, 27_900], 2: list(range(38_000, 42_000, 90))}
    rows = [row(0, "pre", -50)] + [row(i, "central", i * 14_000 + t) for i in range(4) for t in (0, 5000)]
    rows += [row(i, "post", t) for i, ts in over.items() for t in ts] + [row(i + 1, "pre", t) for i, ts in over.items() for t in ts]
    df = spark.createDataFrame(rows, "run_id string, chunk_i int, kind string, time long, length int, dt int, channel int, note string")
    got = sorted((r["time"], r["channel"], r["chunk_i"], r["kind"]) for r in records.safe_parts(df, chunk, overlap, 1000, 10, 10, slab=500).collect())
    want = [(i * 14_000 + t, 0, i, "central") for i in range(4) for t in (0, 5000)]
    want += [(t, 0, 0, "post") for t in over[0]] + [(24_050, 0, 1, "post"), (26_500, 0, 2, "pre"), (27_900, 0, 2, "pre")]
    want += [(t, 0, 2, "post") for t in over[2] if t + 100 <= 41_000] + [(40_900, 799, 2, "post"), (41_000, 799, 3, "pre")]
    assert got == sorted(want)
    made = jobs.raw_records_all(df, chunk=chunk, overlap=overlap, record_length=10)
    assert made.where("detector = 'dead_time'").count() == 2 and made.count() == len(want)
    assert records.safe_parts(df.limit(0), chunk, overlap).count() == 0


def test_breaks_wait_until_quiet_after_a_time(spark):
    rows = [("1", t, t + 10) for t in (0, 500, 990, 2100, 2200)]
    df = spark.createDataFrame(rows, "run_id string, time long, endtime long")
    groups = lambda nb: [r["break_group"] for r in intervals.break_groups(df, 400, nb).orderBy("time").collect()]
    assert groups(None) == [0, 1, 2, 3, 3] and groups(600) == [0, 0, 0, 1, 1] and groups(1600) == [0, 0, 0, 1, 1] and groups(1900) == [0, 0, 0, 0, 0]


def test_the_entry_point_without_its_parts():
    """Packages that only the corpus operators need may be absent; so may their folder; a broken import may not."""
    code = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name in {names!r}:
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as e
q = e.queries()
print(len([n for n in q if n.startswith('op')]), 'pipeline' in q, 'w6_n_competing' in q)
"""
    def run(*names):
        done = subprocess.run([sys.executable, "-c", code.replace("{names!r}", repr(set(names)))], cwd=ROOT, capture_output=True, text=True)
        return done.stdout.strip() or done.stderr.strip().splitlines()[-1]

    everything = run("nothing")
    assert run("chronopulse.llm", "corpus_pipeline") == "0 False True" and run("public_tokenizers") == "0 False True"
    if not everything.startswith("0 "):
        assert run("corpus_pipeline") == everything.replace("True", "False", 1)
    assert "Error" in run("chronopulse.functions.kernels") and "Error" in run("chronopulse.sources.io")


def test_offenders_are_observed_by_run(spark):
    schema = "run_id string, channel int, time long, length int, dt int, pulse_length int, record_i int, baseline int, data array<int>"
    rows = [(r, c, t, 4, 10, 4, 0, 0, [1, 2, 3, 4]) for r, c, t in [("a", 0, 0), ("a", 0, 20), ("a", 0, 50), ("a", 1, 0), ("b", 0, 0), ("b", 0, 39), ("c", 2, 7)]]
    seen = Observation("overlaps")
    made = jobs.make_records(spark.createDataFrame(rows, schema).repartition(3), samples=2, observation=seen)
    by_run = lambda seen: {r["item"]: r["count"] for r in seen.get["runs"]}
    assert made.count() == 7 and (seen.get["rows"], seen.get["offenders"], by_run(seen)) == (7, 3, {"a": 2, "b": 1})
    peaks = spark.createDataFrame([("a", 10.0, [4.0, 3.0, 3.0, 0.0, 0.0]), ("b", 9.0, [4.0, 3.0, 3.0, 0.0, 0.0]), ("b", 0.0, None)], "run_id string, area double, area_per_channel array<double>")
    seen = Observation("areas")
    from chronopulse.operators import filters

    assert filters.check_area(peaks, observation=seen).count() == 3 and (seen.get["offenders"], by_run(seen)) == (1, {"b": 1})
