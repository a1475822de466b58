"""Stateful streams over several micro-batches, with a restart from the checkpoint, closing state and late rows."""

from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from chronopulse.streaming import streams as st

SLICE = 40_000  # microseconds of event time a file


def add_slices(spark, at, rows, schema, numbers):
    for k in numbers:
        part = [r for r in rows if r[1] // SLICE == k]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(at)


def read(spark, at, schema):
    return st.event_time(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(at), 1)


def test_baselines_and_numbers_go_on_after_a_restart(spark, tmp_path):
    rng = np.random.default_rng(1)
    times = np.sort(rng.choice(np.arange(SLICE, 9 * SLICE), 160, replace=False)).tolist()
    rows = [(f"r{k % 2}", t, k % 3, int(rng.integers(0, 2)), [int(x) for x in rng.integers(0, 90, 6)]) for k, t in enumerate(times)]
    schema = "run_id string, time long, channel int, record_i int, data array<int>"
    far = [("end", 60 * SLICE, 0, 1, [0])]
    want, last = [], {}
    for run, t, c, i, d in rows:
        if i == 0:
            last[run, c] = float(np.mean(d[:4]))
        want.append((run, c, t, i, pytest.approx(last.get((run, c), 7.0))))
    root = str(tmp_path)
    batches = []
    for numbers in (range(1, 5), range(5, 9)):  # the second part goes on from the checkpoint
        add_slices(spark, f"{root}/in", rows, schema, numbers)
        if 8 in numbers:
            spark.createDataFrame(far, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = st.stream_baseline(read(spark, f"{root}/in", schema), 4, 7.0, "1 milliseconds", 25)
        batches += st.run_to_files(stream, f"{root}/out", f"{root}/state")
    got = sorted((r["run_id"], r["channel"], r["time"], r["record_i"], r["baseline"]) for r in spark.read.parquet(f"{root}/out").collect())
    assert got == sorted(want, key=lambda r: r[:4])
    assert len([b for b in batches if b["numInputRows"]]) >= 8

    numbered = {}
    for numbers in (range(1, 5), range(5, 9)):
        add_slices(spark, f"{root}/in2", [(r[0], r[1], r[1] + 5) for r in rows], "run_id string, time long, endtime long", numbers)
        if 8 in numbers:
            spark.createDataFrame([("end", 60 * SLICE, 60 * SLICE)], "run_id string, time long, endtime long").coalesce(1).write.mode("append").parquet(f"{root}/in2")
        events = read(spark, f"{root}/in2", "run_id string, time long, endtime long")
        st.number_events(st.stream_event_ranks(events, "1 milliseconds", 25), f"{root}/numbers", f"{root}/state2")
    for r in spark.read.parquet(f"{root}/numbers/events").collect():
        numbered.setdefault(r["run_id"], []).append((r["event_number"], r["time"]))
    for run in ("r0", "r1"):
        own = [r[1] for r in rows if r[0] == run]
        assert sorted(numbered[run]) == list(enumerate(own))


def test_windows_close_and_late_rows_stay(spark, tmp_path):
    rows = [(k % 2, SLICE + 1000 * k, 0, 5) for k in range(300)]
    schema = "channel int, time long, record_i int, area long"
    late = [(0, SLICE + 10, 0, 5), (1, SLICE + 270_000, 0, 5)]  # the second is within the delay
    root = str(tmp_path)
    for part in [*[rows[k : k + 50] for k in range(0, 300, 50)], late, [(9, 90 * SLICE, 1, 0)]]:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
    st.split_late(read(spark, f"{root}/in", schema), 60_000, f"{root}/split", f"{root}/s1")
    assert [tuple(r)[:2] for r in spark.read.parquet(f"{root}/split/late").select("channel", "time").collect()] == [(0, SLICE + 10)]
    on_time = spark.readStream.schema(f"{schema}, ts timestamp").option("maxFilesPerTrigger", 1).parquet(f"{root}/split/on_time")
    progress = st.run_to_files(st.stream_pulse_counts(on_time, "20 milliseconds", "60 milliseconds"), f"{root}/out", f"{root}/s2")
    out = spark.read.parquet(f"{root}/out")
    assert out.agg(F.sum("n")).first()[0] == 301 and out.groupBy("start", "channel").count().where("count > 1").count() == 0
    states = [p["stateOperators"][0]["numRowsTotal"] for p in progress if p["stateOperators"]]
    assert max(states) >= 8 and states[-1] <= 1 and sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress) == 0


@pytest.mark.parametrize("delay", [0, 700])
def test_coincidences_keep_few_rows_of_a_dense_side(spark, tmp_path, delay):
    """Far more right rows than buckets; pairs exactly at the delay and at borders of buckets; other runs don't count."""
    rng, root = np.random.default_rng(5), str(tmp_path)
    dense = [("r0", int(t)) for t in np.sort(rng.integers(20_000, 23_000, 3000))] + [("r1", 35_000), ("r1", 70_000), ("r0", 90_300)]
    edges = [("r1", t) for d in (0, 1, 700, 701) for t in (35_000 - d, 70_000 - d)] + [("r1", 35_001), ("r0", 35_000), ("r2", 21_000)]
    lefts = sorted({(run, int(t)) for run, t in [*edges, *[("r0", t) for t in rng.integers(19_000, 24_000, 60)], ("r0", 90_000)]}, key=lambda r: r[1])
    lefts = [(run, k, t) for k, (run, t) in enumerate(lefts)]
    far, right, left = 10**9, "run_id string, time long", "run_id string, row_id long, time long"
    for rows, schema, at in ((dense, right, "right"), (lefts, left, "left")):
        for a, b in ((0, 21_500), (21_500, 40_000), (40_000, far)):  # the dense stretch comes in two micro-batches
            part = [r for r in rows if a <= r[-1] < b]
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{root}/{at}")
        spark.createDataFrame([(f"end of {at}", *([0] if at == "left" else []), far)], schema).coalesce(1).write.mode("append").parquet(f"{root}/{at}")
    stream = st.stream_coincidences(read(spark, f"{root}/left", left), read(spark, f"{root}/right", right), delay, "1 milliseconds")
    progress = st.run_to_files(stream.drop("ts"), f"{root}/out", f"{root}/state")
    want = [k for run, k, t in lefts if any(run == other and t <= x <= t + delay for other, x in dense)]
    got = spark.read.schema(left).parquet(f"{root}/out")
    assert sorted(r["row_id"] for r in got.collect()) == want and 0 < len(want) < len(lefts)
    if delay:
        assert max(s["numRowsTotal"] for p in progress for s in p["stateOperators"]) < 150


class FakeState:
    """The state variables and timers of one key; counts the rows that are read from them."""

    def __init__(self):
        self.kept, self.timers, self.rows_read = {}, set(), 0

    def getValueState(self, name, schema):
        class Value:
            exists = lambda _: name in self.kept
            get = lambda _: self.kept[name]
            update = lambda _, row: self.kept.update({name: row})

        return Value()

    def getListState(self, name, schema):
        rows = self.kept.setdefault(name, [])

        class Rows:
            def get(_):
                self.rows_read += len(rows)
                return iter(list(rows))

            appendList = lambda _, more: rows.extend(more)
            clear = lambda _: rows.clear()
            put = lambda _, new: rows.__setitem__(slice(None), new)

        return Rows()

    def getMapState(self, name, user_key_schema, value_schema):
        entries = self.kept.setdefault(name, {})

        class Entries:
            keys = lambda _: iter(list(entries))
            updateValue = lambda _, key, row: entries.update({key: row})
            removeKey = lambda _, key: entries.pop(key)

            def getValue(_, key):
                self.rows_read += len(entries[key][0])
                return entries[key]

        return Entries()

    def registerTimer(self, at):
        self.timers.add(at)

    def expire(self, carry, key, watermark):
        times = SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark)
        for at in sorted(t for t in self.timers if t <= watermark):
            yield from carry.handleExpiredTimer(key, times, SimpleNamespace(getExpiryTimeInMs=lambda at=at: at))
            self.timers.discard(at)


@pytest.mark.parametrize("slab_ms", [1, 7, 5000])
def test_baselines_read_waiting_rows_about_once(slab_ms):
    """A micro-batch with many slabs, in frames out of order; the watermark closes a part of it."""
    rng, key, batches = np.random.default_rng(3), ("r", 4), 5
    state, carry, got, want, last = FakeState(), st.BaselineCarry(slab_ms, 7.0, 50), [], [], 7.0
    carry.init(state)
    n, span = 400, 2000
    rows = pd.DataFrame({"ts_ms": np.sort(rng.integers(0, batches * span, batches * n))})
    rows["time"] = rows["ts_ms"] * 1000 + rng.integers(0, 1000, len(rows))
    rows = rows.assign(record_i=rng.integers(0, 3, len(rows)), own=rng.integers(1, 99, len(rows)).astype(float))
    rows.loc[rows["record_i"] > 0, "own"] = None
    for k in range(batches):
        part = rows[rows["ts_ms"] // span == k].sample(frac=1, random_state=k)
        assert not list(carry.handleInputRows(key, iter([part[:90], part[90:250], part[250:]]), None))
        frames = list(state.expire(carry, key, max(0, k * span - 300)))
        assert all(len(f) <= 50 for f in frames)
        got += [tuple(r) for f in frames for r in f.itertuples(index=False)]
    got += [tuple(r) for f in state.expire(carry, key, 10**9) for r in f.itertuples(index=False)]
    for t, i, own in rows.sort_values(["time", "record_i"])[["time", "record_i", "own"]].itertuples(index=False):
        last = last if np.isnan(own) else own
        want.append(("r", 4, t, i, last))
    assert got == want and not state.timers and not any(state.kept["waiting"])
    assert state.rows_read <= 3 * len(rows)
