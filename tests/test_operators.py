"""Operators on hand-made frames, against brute force, and under changes that must not matter."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronopulse.functions import columns as c
from chronopulse.functions import kernels
from chronopulse.operators import analysis, catalog, events, filters, intervals, peaks, records
from chronopulse.plans import jobs, registry
from chronopulse.schemas import EventConfig, PeakConfig
from chronopulse.sources import io


def rows(frame, *names):
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)


@pytest.fixture(scope="module")
def spans(spark):
    rng = random.Random(3)
    data = []
    for k in range(300):
        t = rng.randrange(20_000)
        data.append((f"{rng.randrange(3):06d}", k, t, t + rng.choice([0, 1, 5, 40, 900]), float(rng.randrange(1, 60)), rng.randrange(3)))
    return spark.createDataFrame(data, "run_id string, peak_id long, time long, endtime long, area double, type int")


@pytest.mark.parametrize("slab", [7, 500, 10**9])
def test_sessions_do_not_depend_on_the_slab(spans, slab):
    want = rows(intervals.sessionize_plain(spans, 30), "peak_id", "group_id")
    assert rows(intervals.sessionize(spans.repartition(5), 30, slab=slab), "peak_id", "group_id") == want
    by_run = {}
    for r in spans.collect():
        by_run.setdefault(r["run_id"], []).append((r["time"], r["endtime"], r["peak_id"]))
    brute = []
    for found in by_run.values():
        group, last = -1, None
        for t, e, k in sorted(found):
            if last is None or t - last >= 30:
                group += 1
            last = e if last is None else max(last, e)
            brute.append((k, group))
    assert sorted(brute, key=repr) == want


def test_session_gap_is_inclusive(spark):
    hits = spark.createDataFrame([("1", 0, 10, 0, 1.0), ("1", 309, 320, 0, 1.0), ("1", 620, 630, 1, 1.0)], "run_id string, time long, endtime long, channel int, area double")
    assert rows(intervals.sessionize(hits, 300), "time", "group_id") == [(0, 0), (309, 0), (620, 1)]
    assert intervals.sessionize(hits.limit(0), 300).count() == 0


def test_containment_and_overlap_against_brute_force(spans):
    ev = intervals.build_events(spans.where("type = 2"), 100, 50, slab=3000)
    e = [(r["run_id"], r["event_number"], r["time"], r["endtime"]) for r in ev.collect()]
    p = [(r["run_id"], r["peak_id"], r["time"], r["endtime"]) for r in spans.collect()]
    want = sorted(((k, n) for run, k, t, s in p for er, n, a, b in e if er == run and t >= a and s <= b), key=repr)
    for slab in (50, 10**9):
        assert rows(intervals.containment_join(spans, ev, slab=slab), "peak_id", "event_number") == want
    want = sorted(((k, n) for run, k, t, s in p for er, n, a, b in e if er == run and t < b and a < s), key=repr)
    assert rows(intervals.overlap_join(spans, ev, 64), "peak_id", "r_event_number") == want


def brute_greedy(left, right, delay):
    out, i, j = [], 0, 0
    while i < len(left) and j < len(right):
        d = right[j] - left[i]
        if d < 0:
            j += 1
        elif d <= delay:
            out.append(i)
            i, j = i + 1, j + 1
        else:
            i += 1
    return out


def test_coincidences(spark, spans):
    a, b = spans.where("type = 1"), spans.where("type = 0")
    got = {r["peak_id"] for r in intervals.coincidence_match(a, b, 40, slab=777).collect() if r["is_coinc"]}
    exists, want, near = set(), set(), set()
    for run in ("000000", "000001", "000002"):
        left = sorted((r["time"], r["peak_id"]) for r in a.where(F.col("run_id") == run).collect())
        right = sorted(r["time"] for r in b.where(F.col("run_id") == run).collect())
        want |= {left[i][1] for i in brute_greedy([t for t, _ in left], right, 40)}
        near |= {k for t, k in left if any(0 <= x - t <= 40 for x in right)}
    assert got == want
    assert {r["peak_id"] for r in intervals.coincidence_exists(a, b, 40).collect() if r["is_coinc"]} == near
    exact = [(100, True), (0, True), (101, False), (-1, False)]
    for delay, hit in exact:
        l = spark.createDataFrame([("1", 1, 1000)], "run_id string, peak_id long, time long")
        r = spark.createDataFrame([("1", 1000 + delay)], "run_id string, time long")
        assert intervals.coincidence_match(l, r, 100).first()["is_coinc"] is hit
    l = spark.createDataFrame([("1", k, 1000 * k) for k in range(5)] + [("1", 9, None)], "run_id string, peak_id long, time long")
    r = spark.createDataFrame([("1", 1000 * k) for k in range(5)], "run_id string, time long")
    assert rows(intervals.coincidence_match(l, r, 10, "reference").where("is_coinc"), "peak_id") == [(0,), (1,), (2,)]
    assert exists == set()


def test_n_competing_edges(spark):
    p = spark.createDataFrame([("1", 0, 0, 10.0), ("1", 1, 100, 6.0), ("1", 2, 101, 9.0), ("1", 3, 500, 1.0)], "run_id string, peak_id long, time long, area double")
    assert rows(intervals.n_competing(p, 100, 0.5), "peak_id", "n_competing") == [(0, 2), (1, 3), (2, 2), (3, 1)]
    assert rows(intervals.n_competing(p, 100, 0.5, inclusive_edge=True), "peak_id", "n_competing") == [(0, 2), (1, 3), (2, 2), (3, 1)]  # the first at the edge ends the slice


def test_classification_borders(spark):
    data = [(10.0, 50.0, 0.2, 5), (10.0, 225.0, 0.1, 9), (11.0, 226.0, 0.0, 5), (50.0, 100.0, 0.1, 5), (50.0, 100.0, float("nan"), 5), (50.0, 300.0, None, 5), (None, 1.0, 1.0, 1)]
    p = spark.createDataFrame(data, "area double, range_50p_area double, area_fraction_top double, n_channels int")
    assert [r["type"] for r in filters.classify_peaks(p).collect()] == [1, 0, 2, 1, 0, 0, 0]
    both = PeakConfig(s1_max_width=400, s2_min_width=10)
    assert filters.classify_peaks(p.limit(4).where("area = 50"), both).first()["type"] == 2


def test_channels(spark):
    d = spark.createDataFrame([(0,), (4,), (5,), (6,), (799,), (9,)], "channel int")
    assert [r["detector"] for r in filters.route_detectors(d, unknown="null").collect()] == ["tpc", "tpc", "external", "sipm", "dead_time", None]
    with pytest.raises(Exception, match="no detector has channel 9"):
        filters.route_detectors(d).collect()


FRAGMENT = "run_id string, channel int, time long, length int, dt int, pulse_length int, record_i int, data array<int>"


def fragments(spark):
    f = lambda ch, t, i, n=3, pl=3, d=(5, 5, 8): ("1", ch, t, n, 10, pl, i, list(d))
    return spark.createDataFrame(
        [f(0, 0, 0), f(0, 1000, 1), f(1, 500, 1, d=(1, 2, 3)), f(0, 2000, 0, pl=6, d=(7, 7, 9)), f(0, 2030, 1, n=2, pl=6, d=(1, 1, 50)), f(1, 2010, 0), f(0, 2040, 0)], FRAGMENT
    )


def test_baseline_and_lone_pulses(spark):
    for slab in (100, 10**9):
        b = {(r["channel"], r["time"]): r for r in records.baseline(fragments(spark), slab=slab).collect()}
        assert b[0, 0]["baseline"] == 6.0 and b[0, 1000]["baseline"] == 6.0 and math.isclose(b[0, 0]["baseline_rms"], math.sqrt(2))
        assert b[1, 500]["baseline"] == 16000.0 and math.isnan(b[1, 500]["baseline_rms"]) and b[1, 500]["data"] == [15999, 15998, 15997]
        assert math.isclose(b[0, 2030]["baseline"], 23 / 3) and b[0, 2030]["data"] == [6, 6, 0]
        lone = {(r["channel"], r["time"]): r["lone"] for r in records.lone_pulses(fragments(spark), slab=slab).collect()}
        assert lone == {(0, 0): True, (0, 1000): True, (1, 500): None, (0, 2000): False, (0, 2030): False, (1, 2010): False, (0, 2040): False}
    with pytest.raises(Exception, match="no first fragment"):
        records.baseline(fragments(spark), allow_sloppy=False).collect()
    assert rows(records.check_overlaps(fragments(spark)), "time") == [(2040,)]


def test_pulse_counts_cover_all_channels(spark):
    f = fragments(spark).withColumn("chunk_i", F.lit(0))
    counts = records.pulse_counts(records.lone_pulses(records.integrate(records.baseline(f))), 3)
    got = {r["channel"]: r for r in counts.collect()}
    assert [got[k]["pulse_count"] for k in range(3)] == [3, 1, 0] and got[2]["baseline_mean"] == -9999 and got[0]["lone_pulse_count"] == 1
    wide = records.pulse_counts_arrays(counts).first()
    assert wide["pulse_count"] == [3, 1, 0]


def test_hits_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    data = [("1", 0, 1000 * k, 10, 18, rng.integers(0, 30, 20).tolist()) for k in range(50)]
    rec = spark.createDataFrame(data, "run_id string, channel int, time long, dt int, length int, data array<int>")
    want = []
    for _, _, t, dt, n, d in data:
        run = None
        for k in range(n + 1):
            over = k < n and d[k] >= 15
            if over and run is None:
                run = k
            elif not over and run is not None:
                want.append((t + run * dt, t + k * dt, float(sum(d[run:k])), float(max(d[run:k]))))
                run = None
    assert rows(kernels.find_hits(rec), "time", "endtime", "area", "height") == sorted(want, key=repr)


def test_split_conserves_area(spark):
    rng = np.random.default_rng(2)
    p = spark.createDataFrame([("1", k, 100 * k, 100 * k + 640, 10, 64, [int(x) for x in rng.integers(0, 200, 64)]) for k in range(20)], "run_id string, peak_id long, time long, endtime long, dt int, length int, data array<int>")
    p = p.withColumn("area", F.aggregate("data", F.lit(0.0), lambda s, x: s + x))
    parts = kernels.split_peaks(p).groupBy("peak_id").agg(F.sum("area").alias("a"), F.sum("length").alias("n"))
    assert rows(parts, "peak_id", "a") == rows(p, "peak_id", "area") and {r["n"] for r in parts.collect()} == {64}


def test_positions_agree_on_a_source_above_a_sensor(spark):
    sensors = [{"x": x, "y": y, "z": 60.0, "qe": 1.0} for x in (-80.0, 0.0, 80.0) for y in (-80.0, 0.0, 80.0)]
    light = [float(60.0) / (np.hypot(s["x"] - 80, s["y"]) ** 2 + 3600) ** 1.5 * 1e7 for s in sensors]
    light = [float(v) for v in light]
    p = spark.createDataFrame([(1, light), (2, [0.0] * 9), (3, None)], "peak_id long, area_per_channel array<double>")
    for method in ("CHI2", "LNLIKE"):
        got = {r["peak_id"]: (r["x"], r["y"]) for r in kernels.reconstruct_position(p, sensors, method, 160.0, 41).collect()}
        assert got[1] == (80.0, 0.0) and got[2] == (None, None) == got[3]
    assert kernels.reconstruct_position(p, sensors).where("peak_id = 1").first()["x"] > 20


def test_event_basics_rules(spark):
    base = ("1", 0, 0, 10_000)
    ev = spark.createDataFrame([base, ("1", 1, 20_000, 30_000)], "run_id string, event_number long, time long, endtime long")
    p = lambda k, t, kind, area, tc=5: ("1", k, t, t + 10, t + 5, area, kind, tc)
    ps = [p(0, 100, 1, 50.0), p(1, 200, 1, 50.0), p(2, 1000, 2, 500.0), p(3, 1500, 1, 900.0), p(4, 2000, 2, 400.0), p(5, 9000, 2, 450.0), p(6, 50, 0, 7.0), p(7, 500, 2, 3.0)]
    pk = spark.createDataFrame(ps, "run_id string, peak_id long, time long, endtime long, center_time long, area double, type int, tight_coincidence int")
    cfg = EventConfig(max_drift_length=5000.0, drift_velocity=1.0)
    a, b = events.event_basics(ev, pk, cfg).orderBy("event_number").collect()
    assert (a["n_peaks"], b["n_peaks"], b["s1_area"]) == (8, 0, None)
    assert (a["s1_index"], a["alt_s1_index"], a["s2_index"], a["alt_s2_index"]) == (2, 1, 4, 6)  # ties: larger index; late S1 and far S2 left out
    assert a["drift_time"] == 800 and a["area_before_main_s2"] == 110.0 and a["large_s2_before_main_s2"] == 3.0
    free = events.event_basics(ev, pk, EventConfig(allow_posts2_s1s=True, force_alt_s2_in_max_drift_time=False, force_main_before_alt=True)).orderBy("event_number").first()
    assert (free["s1_area"], free["s2_area"], free["alt_s2_area"]) == (900.0, 500.0, 450.0)


def test_corrections(spark):
    table = spark.createDataFrame([(0, "001200-001300", 1.0), (1, "1250-1400", 2.0), (2, "002230", 3.0), (3, "002231-*", 4.0)], "position int, range string, value double")
    runs = spark.createDataFrame([("001250",), ("001350",), ("002230",), ("009999",)], "run_id string")
    assert rows(catalog.correction_for_run(runs, table), "run_id", "value") == [("001250", 1.0), ("001350", 2.0), ("002230", 3.0), ("009999", 4.0)]
    with pytest.raises(Exception, match="no correction for run 000001"):
        catalog.correction_for_run(spark.createDataFrame([("000001",)], "run_id string"), table).collect()


def test_bins_and_matrices(spark):
    x = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (2.0,), (2.1,), (float("nan"),), (None,)], "x double")
    assert [r["b"] for r in x.select(c.bin_index(F.col("x"), [0, 1, 2]).alias("b")).collect()] == [0, 1, 1, 1, None, None, None]
    assert analysis.matrix_dt(110, 10, 1000, 20000) == 10 and analysis.matrix_dt(110, 10, 400_000, 20_000) == 20
    assert analysis.matrix_dt(110, 10, 10**9, 20_000) == 50_000


def test_raw_matrix_inherits_from_before_its_range(spark):
    """A later range shows what the whole one shows there, though its first fragments lie before it."""
    data = [("0", k * 20, 2, 10, 0, k % 3, [2 * k, 5 * k]) for k in range(40)]
    raw = spark.createDataFrame(data, "run_id string, time long, length int, dt int, channel int, record_i int, data array<int>")
    whole = rows(analysis.raw_records_matrix(raw, 0, 800, 1, record_length=2), "time_bin", "pe_per_ns")
    part = {(b + 50, v) for b, v in rows(analysis.raw_records_matrix(raw, 500, 800, 1, record_length=2), "time_bin", "pe_per_ns")}
    assert len(part) == 30 and part == {(b, v) for b, v in whole if b >= 50}


def test_floor_division(spark):
    d = spark.createDataFrame([(-7,), (-6,), (7,)], "x long")
    assert [r["y"] for r in d.select(c.floor_div(F.col("x"), 2).alias("y")).collect()] == [-4, -3, 3]


def test_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"001200-001300": 1.5, "002230": 2}')
    assert rows(io.read_corrections(spark, str(tmp_path / "a.json")), "position", "range", "value") == [(0, "001200-001300", "1.5"), (1, "002230", "2")]
    (tmp_path / "list.txt").write_text("12\n\n 345 \n")
    assert rows(io.read_run_list(spark, str(tmp_path / "list.txt")), "run_id") == [("000012",), ("000345",)]
    (tmp_path / "log.csv").write_text("run,notes\n3,hello\n")
    assert io.read_measurements(spark, str(tmp_path / "log.csv")).first()["notes"] == "hello"
    (tmp_path / "runs.json").write_text('{"number": 3, "daq_config": {"daq_chunk_length": 5.0, "daq_fragment_payload_bytes": 220, "compressor": "zstd"}}\n{"number": 4, "mode": "x"}\n')
    docs = io.read_run_docs(spark, str(tmp_path / "runs.json"), prefix="daq_")
    assert rows(docs, "number", "mode") == [(3, ""), (4, "x")] and catalog.daq_settings(docs).where("number = 3").first()["record_length"] == 110
    assert io.read_run_docs(spark, str(tmp_path / "runs.json"), ["number", "daq_config.chunk_length"], 3).columns == ["number", "daq_config_chunk_length"]
    df = spark.createDataFrame([("000001", 1), ("000002", 2)], "run_id string, x int")
    path = io.write_dataset(df, str(tmp_path / "out"), "peaks", {"gap": 300})
    io.write_dataset(df.where("x = 2").withColumn("x", F.lit(9)), str(tmp_path / "out"), "peaks", {"gap": 300})
    back = spark.read.parquet(path)
    assert rows(back, "x") == [(1,), (9,)]
    kinds = io.file_inventory(back).collect()
    assert sum(r["n_rows"] for r in kinds) == 2
    stored = io.dataset_inventory(back).collect()
    assert {(r["run_id"], r["data_type"], r["n_files"]) for r in stored} == {("000001", "peaks", 1), ("000002", "peaks", 1)} and stored[0]["mb"] > 0
    wanted = spark.createDataFrame([("000001",), ("000003",)], "run_id string")
    assert rows(io.missing_runs(wanted, back.withColumn("run_id", F.lpad(F.col("run_id").cast("string"), 6, "0"))), "run_id") == [("000003",)]


def test_job_chain(spark, tmp_path):
    """Fragments to event_info: the areas of the peaks are those of their hits, and each peak is in one event at most."""
    rng = np.random.default_rng(5)
    data, t = [], 0
    for k in range(60):
        t += int(rng.integers(2_000, 200_000))
        for ch in rng.choice(5, 4, replace=False):
            shape = 16000 - np.round(400 * np.exp(-(((np.arange(110) - 50) / (4 if k % 2 else 20)) ** 2))).astype(int)
            data.append(("000001", 0, "central", "r0", t, 110, 10, int(ch), 110, 0, 16000, [int(x) for x in shape]))
    from chronopulse.schemas import FRAGMENT as schema

    frag = spark.createDataFrame(data, schema)
    given = {"fragments": frag}

    def keep(name, df):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    options = {"peaks": {"gap": 300, "min_area": 10.0}, "peak_basics": {"cfg": PeakConfig(s1_min_channels=1, s2_min_channels=1, s1_max_aft=1.0, s1_max_width=100.0, s2_min_width=100.0)}}
    basics = registry.build("peak_basics", given, options, keep)
    assert basics.count() == 60 and {r["type"] for r in basics.collect()} <= {0, 1, 2}
    hits = kernels.find_hits(given["records"]).agg(F.sum("area")).first()[0]
    total = given["peaks"].agg(F.sum(F.aggregate("area_per_channel", F.lit(0.0), lambda s, x: s + x))).first()[0]
    assert math.isclose(hits, total)
    info = registry.build("event_info", given, options, keep)
    assert info.count() == given["events"].count() > 0 and "cs2" in info.columns
    assert {"x", "y", "z", "r", "alt_s2_x", "cs1", "s2_x_corr", "s1_max_pmt", "s1_max_diff", "alt_s1_rise_time"} <= set(info.columns)
    assert info.where("x is not null and x = s2_x_corr").count() == info.where("s2_x_corr is not null").count()
    light = registry.build("event_area_per_channel", given, options, keep)
    assert light.count() == info.count() and registry.build("event_n_channel", given, options, keep).columns == ["run_id", "event_number", "time", "endtime", "s1_n_channels"]
    both = light.drop("s1_n_channels").join(given["event_basics"].select("run_id", "event_number", "s1_n_channels", "s2_n_channels"), ["run_id", "event_number"])
    for role in ("s1", "s2"):
        lit = F.size(F.filter(f"{role}_area_per_channel", lambda x: x > 0))
        assert both.where(F.col(f"{role}_n_channels").isNotNull()).where(lit != F.col(f"{role}_n_channels")).count() == 0
    waves = registry.build("event_waveform", given, options, keep)
    assert waves.where("s1_data is not null").count() == info.where("s1_index is not null").count()
    external = spark.createDataFrame([("000001", "e1", 0, 500.0)], "run_id string, peak_id string, time long, area double")
    given["peak_basics_ext"] = external
    assert registry.build("event_coincidences", given, options, keep).where("is_coinc").count() == 0
    elife = spark.createDataFrame([(0, "000000-000005", 20000.0), (1, "000001", 5.0)], "position int, range string, value double")
    areas = jobs.make_corrected(given["event_basics"], given["event_positions"], elife=elife).join(info.select("event_number", "s2_area", "drift_time"), "event_number")
    for r in areas.where("cs2 is not null").collect():
        assert math.isclose(r["cs2"], r["s2_area"] * math.exp(r["drift_time"] / 20000.0), rel_tol=1e-9)
    led = registry.build("led_calibration", {"raw_records": frag.withColumn("record_i", F.lit(0))}, {"records_led": {"n_records": 1}})
    assert led.count() == len(data)
    assert jobs.N_TPC == 5 and peaks.per_class(basics).count() >= 1


def test_checks_inside_the_chain(spark):
    from pyspark.errors import PySparkException

    columns = "run_id string, time long, length int, dt int, channel int, pulse_length int, record_i int, data array<int>"
    one = lambda t, ch=0: ("1", t, 4, 10, ch, 4, 0, [16000, 15990, 16000, 16000])
    good = spark.createDataFrame([one(0), one(40), one(0, 1), one(500)], columns)
    for slab in (30, 100, 10_000):
        assert jobs.make_records(good, samples=1, slab=slab).count() == 4
        late = good.unionByName(spark.createDataFrame([one(539)], columns))
        assert records.check_overlaps(late, slab=slab).select("time", "previous_end").collect() == [(539, 540)]
        with pytest.raises(PySparkException, match="overlap"):
            jobs.make_records(late, samples=1, slab=slab).collect()
    light = spark.createDataFrame([("1", "p", 5.0, [1.0, 2.0, 2.0, 0.0, 0.0])], "run_id string, peak_id string, area double, area_per_channel array<double>")
    assert filters.check_area(light, fail=True).count() == 1
    with pytest.raises(PySparkException, match="fraction"):
        filters.check_area(light.withColumn("area", F.lit(9.0)), fail=True).collect()


def test_parts_of_an_overlap(spark):
    columns = "run_id string, time long, length int, dt int, channel int"
    rows_at = lambda *times: spark.createDataFrame([("1", t, 10, 10, 0) for t in times], columns)
    times = lambda df: sorted((r["time"], r["channel"]) for r in df.collect())
    part = lambda df, kind: times(jobs.safe_part(df, kind, 0, 10_000, safe_break=1000, record_length=10, slab=700))
    quiet = rows_at(0, 200, 8000)
    assert part(quiet, "post") == times(quiet) and part(quiet, "pre") == []
    broken = rows_at(0, 900, 3000, 9500)
    assert part(broken, "post") == [(0, 0), (900, 0)] and part(broken, "pre") == [(3000, 0), (9500, 0)]
    dense = rows_at(*range(0, 10_000, 500))
    assert part(dense, "pre") == [(9000, 799)]
    assert part(dense, "post") == sorted([(t, 0) for t in range(0, 9000, 500)] + [(8900, 799)])
    assert part(rows_at(5).limit(0), "pre") == []


def test_competing_peaks_at_a_far_edge(spark):
    rows_ = [("1", k, t, a) for k, (t, a) in enumerate([(0, 10.0), (5, 6.0), (50, 4.0), (10**15, 8.0), (10**15 + 3, 1.0)])]
    peaks_ = spark.createDataFrame(rows_, "run_id string, peak_id long, time long, area double")
    for bucket in (20, 1000):
        got = {r["peak_id"]: r["n_competing"] for r in intervals.n_competing(peaks_, 10, 0.5, inclusive_edge=True, bucket=bucket).collect()}
        # the slice ends with the first peak at or beyond the right edge, however far
        want = {}
        for _, k, t, a in rows_:
            near = [x for x in rows_ if abs(x[2] - t) <= 10]
            beyond = [x for x in rows_ if x[2] > t + 10][:1]
            want[k] = sum(x[3] > a * 0.5 for x in near + beyond)
        assert got == want


def test_analysis_decorator(spans):
    @registry.analysis("peaks")
    def n(p):
        return p.count()

    assert n({"peaks": spans}, time_range=(0, 100)) == spans.where("endtime > 0 and time < 100").count()


def test_entry_without_the_text_subpackage():
    import subprocess
    import sys
    from pathlib import Path

    code = (
        "import sys\n"
        "class No:\n"
        "    def find_spec(self, name, *a):\n"
        "        if name.startswith('chronopulse.llm') or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(name)\n"
        "sys.meta_path.insert(0, No())\n"
        "import __spark_entry__ as e\n"
        "assert 'j1_containment_join' in e.queries() and not any(k.startswith('op') for k in e.queries())\n"
        "e.oracle_sql()\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parents[1], check=True)
