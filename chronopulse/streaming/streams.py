"""Structured Streaming forms of the operators.

Ticks are kept as longs; a microsecond timestamp `ts` derived from them is the event time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..schemas import FRAGMENT


def event_time(df: DataFrame, ticks_per_us: int = 1000) -> DataFrame:
    """Adds ts from time."""
    return df.withColumn("ts", F.timestamp_micros(F.call_function("div", F.col("time"), F.lit(ticks_per_us))))


def stream_fragments(spark: SparkSession, path: str, files_per_trigger: int = 1000, schema: T.StructType = FRAGMENT) -> DataFrame:
    """New chunk files as they appear."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def stream_dedup(df: DataFrame, delay: str, keys=("run_id", "channel", "time", "record_i")) -> DataFrame:
    """Rows that two overlapping parts hold are kept once, as long as both arrive within the delay."""
    return df.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(keys))


def stream_pulse_counts(df: DataFrame, chunk: str = "5 seconds", delay: str = "10 seconds") -> DataFrame:
    """Pulses, fragments and area per chunk interval and channel, in append mode: a window goes out when the watermark
    closes it, and its state ends. Rows later than the delay are dropped; split_late() keeps them."""
    counts = df.withWatermark("ts", delay).groupBy(F.window("ts", chunk), "channel").agg(
        F.count(F.when(F.col("record_i") == 0, 1)).alias("pulse_count"), F.count("*").alias("n"), F.sum("area").alias("pulse_area")
    )
    return counts.select(F.unix_micros("window.start").alias("start"), "channel", "pulse_count", "n", "pulse_area")


def stream_events(triggers: DataFrame, left: int, right: int, ticks_per_us: int = 1000) -> DataFrame:
    """(run_id, time, endtime, n_triggers): build_events() as session windows over trigger peaks.

    The gap, left + right plus the peak's own length, is given per row; sessions merge at exactly the gap, as events do.
    The watermark waits for twice left plus right; in append mode an event goes out when it has passed the event's end.
    """
    us = lambda ticks: -(-ticks // ticks_per_us)
    length = F.call_function("div", F.col("endtime") - F.col("time"), F.lit(ticks_per_us))
    gap = F.concat((length + us(left + right)).cast("string"), F.lit(" microseconds"))
    late = triggers.withWatermark("ts", f"{us(2 * left + right)} microseconds")
    events = late.groupBy(F.session_window("ts", gap), "run_id").agg(
        (F.min("time") - left).alias("time"), (F.max("endtime") + right).alias("endtime"), F.count("*").alias("n_triggers")
    )
    return events.select("run_id", "time", "endtime", "n_triggers")


def stream_coincidences(left: DataFrame, right: DataFrame, max_delay_us: int, lateness: str = "10 seconds") -> DataFrame:
    """left rows (with ts, run_id) that some right row follows within the delay.

    Time falls into buckets of the delay. A left row is followed within the delay if the newest right row of its bucket
    isn't before it, or the oldest one of the next bucket isn't too late; so of the right rows, each shown to its own
    bucket and the one before, a bucket needs these two only. A left row meets one row, however dense the times are. It
    goes out when the watermark has closed its bucket, and the state of the bucket ends on both sides.
    """
    delay, length = F.expr(f"interval {max_delay_us} microseconds"), max(max_delay_us, 1)
    bucket = f"{length} microseconds"
    shown = F.array(F.struct(F.col("ts").alias("at"), F.lit(True).alias("own")), F.struct((F.col("ts") - F.expr(f"interval {bucket}")).alias("at"), F.lit(False).alias("own")))
    b = right.select("ts", F.col("run_id").alias("r_run"), F.explode(shown).alias("s")).select("ts", "r_run", "s.at", "s.own")
    b = b.withWatermark("at", f"{lateness} {bucket}").groupBy(F.window("at", bucket).alias("r_bucket"), "r_run")
    b = b.agg(F.max(F.when(F.col("own"), F.col("ts"))).alias("newest"), F.min(F.when(~F.col("own"), F.col("ts"))).alias("oldest"))
    a = left.withWatermark("ts", lateness).withColumn("bucket", F.window("ts", bucket))
    a = a.withColumn("ts", F.timestamp_micros(F.unix_micros("ts")))  # the bucket carries the watermark, a stream has one such column
    near = (F.col("ts") <= F.col("newest")) | (F.col("oldest") <= F.col("ts") + delay)
    return a.join(b, (F.col("r_run") == F.col("run_id")) & (F.col("r_bucket") == F.col("bucket")) & near, "left_semi").drop("bucket")


def split_late(stream: DataFrame, delay_us: int, path: str, checkpoint: str) -> None:
    """Splits what is available into rows on time (path/on_time) and late ones (path/late): those whose ts is more than
    the delay behind the largest ts of the micro-batches before. Windows over the rows on time then lose nothing.

    A micro-batch writes folders of its own number, and the largest ts so far beside them, so that a batch that runs
    again after a failure writes the same.
    """
    spark = stream.sparkSession

    def each(rows: DataFrame, number: int) -> None:
        seen = spark.read.parquet(f"{path}/seen/batch={number - 1}").first()["ts_us"] if number else None
        late = F.lit(False) if seen is None else F.unix_micros("ts") < seen - delay_us
        for name, condition in (("on_time", ~late), ("late", late)):
            rows.where(F.coalesce(condition, F.lit(False))).write.mode("overwrite").parquet(f"{path}/{name}/batch={number}")
        newest = rows.agg(F.greatest(F.max(F.unix_micros("ts")), F.lit(seen).cast("bigint")).alias("ts_us"))
        newest.write.mode("overwrite").parquet(f"{path}/seen/batch={number}")

    run_batches(stream, checkpoint, each, "append")


def _closing_ms(key_slab: int, slab_ms: int) -> int:
    return (int(key_slab) + 1) * slab_ms


class BaselineCarry(StatefulProcessor):
    """Per channel: rows wait until the watermark closes their slab, then go out in order of time, each with the mean of
    the last first fragment up to it; that mean is the state that stays. A frame has at most `most` rows.

    A frame of rows waits as one entry of arrays under its first slab. A channel has a timer for the first open slab only:
    when it expires, the rows of all slabs that the watermark has closed go out together. An entry is read when its first
    slab is due, and what isn't due of it is put back, so the work grows with the rows, not with rows times slabs."""

    def __init__(self, slab_ms: int, fallback: float, most: int = 10_000):
        self.slab_ms, self.fallback, self.most = slab_ms, fallback, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "mean double")
        self.entries = handle.getValueState("entries", "n long")
        self.waiting = handle.getMapState("waiting", "slab long, number long", "time array<long>, record_i array<int>, own array<double>, slab array<long>")

    def _wait(self, rows: pd.DataFrame, number: int) -> None:
        first = int(rows["slab"].min())
        self.waiting.updateValue((first, number), tuple(rows[c].tolist() for c in ("time", "record_i", "own", "slab")))
        self.handle.registerTimer(_closing_ms(first, self.slab_ms))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        number = self.entries.get()[0] if self.entries.exists() else 0
        for frame in rows:
            if len(frame):
                self._wait(frame.assign(slab=frame["ts_ms"].astype("int64") // self.slab_ms), number)
                number += 1
        self.entries.update((number,))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = timerValues.getCurrentWatermarkInMs() // self.slab_ms  # slabs before it are closed
        due = []
        for slab, number in sorted(tuple(k) for k in self.waiting.keys()):
            if slab >= end:
                self.handle.registerTimer(_closing_ms(slab, self.slab_ms))
                break
            entry = self.waiting.getValue((slab, number))
            self.waiting.removeKey((slab, number))
            rows = pd.DataFrame(dict(zip(("time", "record_i", "own", "slab"), entry, strict=True)))
            closed = rows["slab"] < end
            due.append(rows[closed])
            if not closed.all():
                self._wait(rows[~closed], number)
        if not due:
            return
        out = pd.concat(due).sort_values(["time", "record_i"], ignore_index=True)
        last = self.last.get()[0] if self.last.exists() else self.fallback
        out["baseline"] = out["own"].astype("float64").ffill().fillna(last)
        self.last.update((float(out["baseline"].iloc[-1]),))
        out = out[["time", "record_i", "baseline"]]
        for start in range(0, len(out), self.most):
            yield out.iloc[start : start + self.most].assign(run_id=key[0], channel=int(key[1]))[["run_id", "channel", "time", "record_i", "baseline"]]

    def close(self) -> None:
        pass


def stream_baseline(df: DataFrame, samples: int = 20, fallback: float = 16000.0, delay: str = "10 seconds", slab_ms: int = 10_000) -> DataFrame:
    """(run_id, channel, time, record_i, baseline): the last first fragment's mean of the channel is remembered across
    micro-batches and slabs. Only means travel, no samples; state and timers are in the state store."""
    head = F.slice("data", 1, samples)
    mean = F.try_divide(F.aggregate(head, F.lit(0.0), lambda s, x: s + x.cast("double")), F.size(head))
    rows = df.withWatermark("ts", delay).select(
        "run_id", "channel", "time", "record_i", "ts", F.when(F.col("record_i") == 0, mean).alias("own"), F.unix_millis("ts").alias("ts_ms")
    )
    out = "run_id string, channel int, time long, record_i int, baseline double"
    return rows.groupBy("run_id", "channel").transformWithStateInPandas(BaselineCarry(slab_ms, fallback), out, "append", "EventTime")


class SlabRank(StatefulProcessor):
    """Per slab of a run: its events wait until the watermark closes it, then go out ranked by time, and the state ends."""

    def __init__(self, slab_ms: int, most: int = 10_000):
        self.slab_ms, self.most = slab_ms, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "time long, endtime long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            self.waiting.appendList(list(zip(frame["time"].tolist(), frame["endtime"].tolist(), strict=True)))
        self.handle.registerTimer(_closing_ms(key[1], self.slab_ms))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rows = sorted(tuple(r) for r in self.waiting.get())
        self.waiting.clear()
        for start in range(0, len(rows), self.most):
            part = rows[start : start + self.most]
            yield pd.DataFrame(
                {"run_id": key[0], "slab": int(key[1]), "rank": range(start, start + len(part)), "n": len(rows), "time": [a for a, _ in part], "endtime": [b for _, b in part]}
            )

    def close(self) -> None:
        pass


def stream_event_ranks(events: DataFrame, delay: str = "10 seconds", slab_ms: int = 10_000) -> DataFrame:
    """(run_id, slab, rank, n, time, endtime): events ranked within slabs of time, which close one after the other; slabs
    of a run are ranked by different tasks. number_events() makes numbers of them."""
    rows = events.withWatermark("ts", delay).select("run_id", "time", "endtime", "ts", F.call_function("div", F.unix_millis("ts"), F.lit(slab_ms)).alias("slab"))
    out = "run_id string, slab long, rank long, n long, time long, endtime long"
    return rows.groupBy("run_id", "slab").transformWithStateInPandas(SlabRank(slab_ms), out, "append", "EventTime")


def number_events(ranks: DataFrame, path: str, checkpoint: str) -> None:
    """Writes (run_id, event_number, time, endtime) to path/events: consecutive numbers by run across micro-batches.

    A slab's first number is the count of events in closed slabs before it: one narrow row a slab within the batch, one
    row a run (path/seen) from the batches before. Folders are named by batch, so a batch that runs again writes the same.
    """
    spark = ranks.sparkSession

    def each(rows: DataFrame, number: int) -> None:
        rows = rows.persist()
        slabs = rows.groupBy("run_id", "slab").agg(F.first("n").alias("n"))
        earlier = Window.partitionBy("run_id").orderBy("slab").rowsBetween(Window.unboundedPreceding, -1)
        seen = spark.read.schema("run_id string, seen long").parquet(f"{path}/seen/batch={number - 1}") if number else spark.createDataFrame([], "run_id string, seen long")
        first = slabs.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(seen, "run_id", "left")
        first = first.select("run_id", "slab", (F.col("first") + F.coalesce("seen", F.lit(0))).alias("first"))
        out = rows.join(first, ["run_id", "slab"]).select("run_id", (F.col("first") + F.col("rank")).alias("event_number"), "time", "endtime")
        out.write.mode("overwrite").parquet(f"{path}/events/batch={number}")
        after = slabs.select("run_id", F.col("n").alias("seen")).unionByName(seen).groupBy("run_id").agg(F.sum("seen").alias("seen"))
        after.write.mode("overwrite").parquet(f"{path}/seen/batch={number}")
        rows.unpersist()

    run_batches(ranks, checkpoint, each, "append")


#: The store that keeps state variables and timers; it spills to disk. A join has one store a partition instead of four, and
#: stores don't set aside megabytes of disk that they may not need: there are as many as partitions, however little they keep.
_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def _keep_state(spark: SparkSession) -> None:
    for name, value in _STORE.items():
        spark.conf.set(name, value)


def run_to_files(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> list[dict]:
    """Processes everything available into Parquet files, then stops; returns the progress of its micro-batches."""
    _keep_state(stream.sparkSession)
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return query.recentProgress


def run_batches(stream: DataFrame, checkpoint: str, each, mode: str = "append") -> list[dict]:
    """Processes everything available, handing each micro-batch to `each(df, number)`, then stops; returns the progress."""
    _keep_state(stream.sparkSession)
    query = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return query.recentProgress
