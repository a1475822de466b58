"""Helpers on flat arrays, competing peaks, sum waveforms and greedy matching against plain Python."""

import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chronopulse.functions import kernels
from chronopulse.operators import catalog, intervals, records


def lists_of(rows, length=None):
    return kernels.Lists(pa.array(rows, pa.list_(pa.float64())), None if length is None else pa.array(length))


def plain_deciles(samples, dt, n):
    total, out = float(np.sum(samples)), np.zeros(n + 1)
    if not total > 0:
        return out
    top = np.maximum.accumulate(np.concatenate(([0.0], np.cumsum(samples))))
    for k in range(n + 1):
        at = min(int(np.searchsorted(top, total * k / n)), len(samples))
        step = top[at] - top[at - 1] if at else 0
        out[k] = 0 if at == 0 else (at - 1 + (total * k / n - top[at - 1]) / step if step > 0 else at) * dt
    return out


def plain_splits(samples, min_height, min_ratio):
    out, top, low, at = [], -np.inf, np.inf, -1
    for k, x in enumerate(samples):
        if at >= 0 and x >= max(low + min_height, min_ratio * low):
            out.append(at)
            top, low, at = x, np.inf, -1
        elif x > top and at < 0:
            top = x
        if x < low and top >= max(x + min_height, min_ratio * x):
            low, at = x, k
    return out


@pytest.fixture(scope="module")
def waves():
    rng = np.random.default_rng(6)
    rows = [rng.integers(-20, 200, rng.integers(0, 90)).astype(float).tolist() for _ in range(300)]
    rows += [[], None, [1.0] * 10, [0.0, 0.0], [-1.0, -2.0], [0, 100, 10, 100, 0], [0, 100, 30, 100, 0], [100, 5, 5, 90, 1, 80], rng.integers(0, 9, 5000).astype(float).tolist()]
    return [w if w is None else [float(x) for x in w] for w in rows]


def test_deciles_and_splits_are_those_of_single_rows(waves):
    length = [None if k % 17 == 5 else max(0, len(w or []) - k % 3) for k, w in enumerate(waves)]
    cut = [np.array((w or [])[: n or 0]) for w, n in zip(waves, length)]
    lists = lists_of(waves, length)
    assert [lists.values[lists.start[k] : lists.start[k + 1]].tolist() for k in range(len(cut))] == [c.tolist() for c in cut]
    dt = np.arange(len(waves)) % 7 + 1.0
    found = kernels.decile_times(lists, dt, 20)
    for k, c in enumerate(cut):
        assert found[k] == pytest.approx(plain_deciles(c, dt[k], 20))
    for height, ratio in ((25.0, 4.0), (5.0, 1.5), (100.0, 0.0)):
        row, place = kernels.split_points(lists, height, ratio)
        assert list(zip(row.tolist(), place.tolist())) == [(k, p) for k, c in enumerate(cut) for p in plain_splits(c, height, ratio)]


def test_known_deciles_and_splits():
    one = lambda x: kernels.split_points(lists_of([x]), 25, 4)[1].tolist()
    assert one([0, 100, 10, 100, 0]) == [2] and one([0, 100, 30, 100, 0]) == [] and one([100, 5, 5, 90, 1, 80]) == [1, 4] and one([]) == []
    assert kernels.decile_times(lists_of([[1.0] * 10, [0.0, 0.0]]), np.array([10.0, 10.0]), 10).tolist() == [[10.0 * k for k in range(11)], [0.0] * 11]


def test_runs_and_cuts(spark, waves):
    rows = [(k, "1", k % 4, k * 10_000, 10, len(w or []), w) for k, w in enumerate(waves)]
    df = spark.createDataFrame(rows, "k int, run_id string, channel int, time long, dt int, length int, data array<double>").repartition(2)
    limits = [20.0, 50.0, 15.0]  # channel 3: 15
    want = []
    for _, _, channel, t, dt, n, w in rows:
        limit, a = (limits[channel] if channel < 3 else 15.0), None
        for i in range(n + 1):
            over = i < n and w[i] >= limit
            if over and a is None:
                a = i
            elif not over and a is not None:
                want.append((t + a * dt, t + i * dt, a, i - a, max(w[a:i]), pytest.approx(sum(w[a:i]))))
                a = None
    got = sorted(tuple(r) for r in kernels.find_hits(df, limits).select("time", "endtime", "left", "length", "height", "area").collect())
    assert got == want
    kept = {r["k"]: r["data"] for r in kernels.cut_outside_hits(df, 60.0, 3, 5).collect()}
    for k, _, _, _, _, n, w in rows:
        near = {j for i in range(n) if w[i] >= 60 for j in range(i - 3, i + 5 + 1)}
        assert kept[k] == [x if j in near else 0 for j, x in enumerate(w or [])]
    assert kernels.find_hits(df.limit(0)).count() == 0 and kernels.peak_widths(df.limit(0)).count() == 0
    assert kernels.peak_widths(df).columns == [*df.columns, "width", "area_decile_from_midpoint"]


def test_fits_are_those_of_the_full_scan(spark):
    rng = np.random.default_rng(3)
    sensors = [{"x": float(x), "y": float(y), "z": 50.0, "qe": 0.2 + 0.01 * k} for k, (x, y) in enumerate(rng.integers(-100, 100, (6, 2)))]
    rows = [(k, rng.integers(0, 40, 6).astype(float).tolist()) for k in range(60)] + [(90, [float("nan"), -3.0, 5.0, None, 0.0, 1.0]), (91, [4.0, 2.0])]
    p = spark.createDataFrame(rows, "peak_id long, area_per_channel array<double>")
    axis = np.linspace(-150, 150, 31)
    grid = [(x, y) for x in axis for y in axis]
    g = np.array([[s["qe"] * s["z"] / ((x - s["x"]) ** 2 + (y - s["y"]) ** 2 + s["z"] ** 2) ** 1.5 for s in sensors] for x, y in grid])
    for method in ("CHI2", "LNLIKE"):
        got = {r["peak_id"]: r for r in kernels.reconstruct_position(p, sensors, method).collect()}
        for k, light in rows:
            n = np.array([v if v is not None and v > 0 else 0.0 for v in [*light, *[0.0] * (6 - len(light))]])
            if method == "CHI2":
                mu = np.sqrt((n**2 / g).sum(1) / g.sum(1))[:, None] * g
                value = ((n - mu) ** 2 / mu).sum(1)
            else:
                mu = (n.sum() / g.sum(1))[:, None] * g
                value = (mu - n * np.log(mu) + kernels._log_factorial(n)).sum(1)
            best = int(np.round(value, 9).argmin())
            assert (got[k]["x"], got[k]["y"]) == grid[best] and got[k]["fit"] == pytest.approx(value[best])


def test_counts_above_are_those_of_all_pairs():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 7, 100, 257):
        values = rng.choice([1.0, 2.0, 3.5, np.nan, 9.0], n) if n % 2 else rng.normal(size=n)
        weights = rng.integers(1, 4, n)
        low, high = rng.integers(0, n + 1, 50), rng.integers(0, n + 1, 50)
        limits = rng.choice([0.5, 2.0, np.nan, 8.0], 50)
        got = intervals.count_above(values, low, high, limits, weights)
        above = lambda v, x: (np.isnan(v) and not np.isnan(x)) or v > x
        assert got.tolist() == [sum(w for v, w in zip(values[a:b], weights[a:b]) if above(v, x)) for a, b, x in zip(low, high, limits)]


@pytest.mark.parametrize("inclusive", [False, True])
def test_competing_peaks_of_runs_that_number_alike(spark, inclusive):
    rng = np.random.default_rng(4)
    rows = [(f"{r}", k, int(t), float(a)) for r in range(3) for k, (t, a) in enumerate(zip(np.sort(rng.integers(0, 900, 120)), rng.integers(1, 30, 120)))]
    rows += [("0", 500, None, 3.0), ("0", 501, 40, None), rows[7], rows[7]]
    df = spark.createDataFrame(rows, "run_id string, peak_id long, time long, area double").repartition(3)
    want = []
    for r, k, t, a in rows:
        others = [] if t is None or a is None else [(x[2], x[3]) for x in rows if x[0] == r and x[2] is not None and x[3] is not None]
        n = sum(x > a * 0.5 for u, x in others if t - 50 <= u < t + 50 or (u == t + 50 and not inclusive))
        edge = min((u for u, _ in others if u >= t + 50), default=None)
        if inclusive and edge is not None:
            n += max(x for u, x in others if u == edge) > a * 0.5
        want.append((r, k, t, a, n))
    for most in (200_000, 40):
        got = intervals.n_competing(df, 50, 0.5, inclusive, most=most)
        assert sorted((tuple(x) for x in got.collect()), key=str) == sorted(want, key=str) and got.columns[-1] == "n_competing"
    assert intervals.n_competing(df.limit(0), 50, 0.5, inclusive).count() == 0


def shuffled_rows(spark):
    """Rows that all stages so far have written to shuffles."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    none, doubles = sc._jvm.java.util.ArrayList(), sc._gateway.new_array(sc._jvm.double, 0)
    stages = sc._jsc.sc().statusStore().stageList(none, False, False, doubles, none)
    return sum(stages.apply(k).shuffleWriteRecords() for k in range(stages.size()))


@pytest.mark.parametrize("inclusive", [False, True])
def test_dense_slabs_are_shuffled_about_once(spark, inclusive):
    """Slabs of far more peaks than a part has; equal peaks, NaN, null areas and a lone peak far beyond."""
    rng, window = np.random.default_rng(6), 100
    n = 2500
    t, area = rng.integers(0, 4000, n), rng.choice(np.append(rng.normal(5, 4, 60), np.nan), n)
    rows = [("a", k, int(x), float(y)) for k, (x, y) in enumerate(zip(t, area))]
    rows += [rows[3], rows[3], ("a", n, 90_000, 4.0), ("a", n + 1, 4_111, None), ("b", 0, 50, 1.0), ("b", 1, None, 1.0), (None, 2, 50, 1.0), ("b", 3, 1750, None), ("b", 4, 1760, 9.0)]
    df = spark.createDataFrame(rows, "run_id string, peak_id long, time long, area double").repartition(3).localCheckpoint()
    above = lambda v, x: v is not None and not np.isnan(x) and (np.isnan(v) or v > x)
    want = []
    for run, k, at, own in rows:
        others = [] if run is None or at is None or own is None else [x for x in rows if x[0] == run and x[2] is not None]
        found = sum(above(x[3], own * 0.5) for x in others if at - window <= x[2] < at + window or (x[2] == at + window and not inclusive))
        edge = min((x[2] for x in others if x[2] >= at + window), default=None)
        want.append((run, k, found + (inclusive and any(above(x[3], own * 0.5) for x in others if x[2] == edge))))
    key = lambda r: tuple(str(x) for x in r)
    before = shuffled_rows(spark)
    got = intervals.n_competing(df, window, 0.5, inclusive, most=25).select("run_id", "peak_id", "n_competing").collect()
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    assert shuffled_rows(spark) - before < 4 * len(rows)
    got = intervals.n_competing(df, window, 0.5, inclusive, most=25, frame=300).select("run_id", "peak_id", "n_competing").collect()
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_counts_in_parts_are_those_of_all_pairs():
    rng = np.random.default_rng(8)
    for n in (0, 1, 30, 257):
        values, weights = rng.choice([1.0, 2.0, 3.5, np.nan, 9.0], n), rng.integers(0, 4, n)
        low = np.sort(rng.integers(0, n + 1, 80))
        high = np.maximum(np.sort(rng.integers(0, n + 1, 80)), low)
        limits = rng.choice([0.5, 2.0, np.nan, 8.0], 80)
        want = intervals.count_above(values, low, high, limits, weights)
        for most in (1, 7, 64, 1000):
            assert intervals.count_in_parts(values, low, high, limits, weights, most).tolist() == want.tolist()


def test_a_burst_takes_no_quadratic_time():
    rng = np.random.default_rng(2)
    n = 100_000
    values = rng.normal(size=n)
    began = time.perf_counter()
    got = intervals.count_above(values, np.zeros(n), np.full(n, n), values * 0.5, np.ones(n, dtype=np.int64))
    assert time.perf_counter() - began < 20
    assert got.tolist() == (n - np.searchsorted(np.sort(values), values * 0.5, "right")).tolist()


@pytest.mark.parametrize("slab", [40, 100, 100_000])
def test_greedy_matching_where_a_cluster_never_ends(spark, slab):
    rng = np.random.default_rng(9)
    left = [("1", k, int(t)) for k, t in enumerate(np.sort(rng.integers(0, 6000, 900)))] + [("2", k, 10 * k) for k in range(50)] + [("3", 1, None)]
    right = [("1", int(t)) for t in np.sort(rng.integers(0, 6000, 850))] + [("2", 10 * k + 3) for k in range(0, 50, 2)] + [("4", 5)]
    a = spark.createDataFrame(left, "run_id string, peak_id long, time long").repartition(3)
    b = spark.createDataFrame(right, "run_id string, time long").repartition(2)
    want = set()
    for run in "12":
        mine, other = sorted((t, i) for r, i, t in left if r == run), np.array(sorted(t for r, t in right if r == run))
        hit = intervals.greedy_match(np.array([t for t, _ in mine]), other, 40)
        want |= {(run, i) for (_, i), h in zip(mine, hit) if h >= 0}
    got = intervals.coincidence_match(a, b, 40, slab=slab)
    assert {(r["run_id"], r["peak_id"]) for r in got.collect() if r["is_coinc"]} == want and got.count() == len(left)
    assert np.diff(np.sort([t for r, _, t in left if r == "1"] + [t for r, t in right if r == "1"])).max() < 40


def test_sum_waveform_adds_arrays(spark):
    rng = np.random.default_rng(5)
    recs = [("1", int(t), 10, int(n), int(c), rng.integers(0, 50, 12).tolist()) for t, n, c in zip(rng.integers(0, 3000, 80), rng.integers(0, 13, 80), rng.integers(0, 4, 80))]
    peaks = [("1", k, int(t), int(t + w)) for k, (t, w) in enumerate(zip(rng.integers(0, 2800, 15), rng.integers(1, 400, 15)))] + [("2", 0, 0, 100)]
    r = spark.createDataFrame(recs, "run_id string, time long, dt int, length int, channel int, data array<int>").repartition(4)
    p = spark.createDataFrame(peaks, "run_id string, peak_id long, time long, endtime long")
    gains = [1.0, 0.5, 2.0]  # channel 3 adds nothing
    got = {(x["run_id"], x["peak_id"]): x for x in records.sum_waveform(p, r, gains, 200).collect()}
    for run, k, t0, t1 in peaks:
        want = np.zeros(-((t0 - t1) // 10))
        met = False
        for run2, t, dt, n, c, d in recs:
            for i in range(n):
                at = t + i * dt
                if run == run2 and t0 <= at < t1:
                    met = True
                    want[(at - t0) // dt] += d[i] * (gains[c] if c < 3 else 0.0)
        assert ((run, k) in got) == met
        if met:
            x = got[run, k]
            assert x["data"] == pytest.approx(want.tolist()) and x["length"] == len(want) and x["area"] == pytest.approx(want.sum())


def test_updates_fold_in_order_of_time(spark):
    runs = spark.sql(
        "select 1 as number, 2 as processing_failed, struct('new' as status, null as host, null as reason, timestamp'2020-01-01' as time) as processing_status, "
        "array(struct('x' as name, 'u' as user, timestamp'2020-01-01' as time), struct('y' as name, 'u' as user, timestamp'2020-01-01' as time)) as tags "
        "union all select 2, null, null, null"
    )
    rows = [(1, "a", 1, None, "T1", None), (1, "b", 2, "lost", None, "x"), (1, "c", 3, None, "T2", "T1"), (1, "d", 4, "gone", "T1", None), (2, "e", 1, "r", "z", "z"), (9, "f", 1, None, None, None)]
    updates = spark.createDataFrame(rows, "number int, status string, h int, reason string, add_tag string, remove_tag string")
    updates = updates.withColumns({"time": F.timestamp_seconds("h"), "host": F.lit("q")}).drop("h").repartition(3)
    got = {r["number"]: r for r in catalog.apply_status_updates(runs, updates).collect()}
    assert [t["name"] for t in got[1]["tags"]] == ["y", "T2", "T1"] and got[1]["processing_failed"] == 4 and got[1]["processing_status"]["status"] == "d"
    assert [t["name"] for t in got[2]["tags"]] == ["z"] and got[2]["processing_failed"] == 1
    assert catalog.apply_status_updates(runs, updates, production=False).count() == 2
