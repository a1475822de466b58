"""Interval operators: sessions, events, containment, overlap, as-of and coincidence joins, competing peaks.

A run can be one long stretch of time, so nothing is partitioned by run alone. Sessions use two levels: times fall
into slabs; a table with one narrow row a slab carries the running maximum and the session counts over; everything
else happens within a slab.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import floor_div
from ..schemas import SLAB_NS
from ..sources.io import stored


def _slabbed(df: DataFrame, slab: int) -> DataFrame:
    return df.withColumn("__slab", floor_div(F.col("time"), slab))


def sessionize(
    df: DataFrame, gap: int, keys: Sequence[str] = ("run_id",), slab: int = SLAB_NS, group: str = "group_id"
) -> DataFrame:
    """Adds the number (from 0, by time, per keys) of the row's session.

    A session starts where time minus the largest endtime before it is at least gap. Ties in time share a session
    whatever their order. slab is the length of a work unit in ticks; the result does not depend on it.
    """
    keys = list(keys)
    rows = _slabbed(df, slab)
    per_slab = rows.groupBy(*keys, "__slab").agg(F.max("endtime").alias("__top"))
    earlier = Window.partitionBy(*keys).orderBy("__slab").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_slab.withColumn("__carry", F.max("__top").over(earlier)).drop("__top")
    stamp = F.struct("time", "endtime")
    local = Window.partitionBy(*keys, "__slab").orderBy(stamp)
    before = F.max("endtime").over(local.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.join(carry, [*keys, "__slab"])
    last = F.greatest(before, F.col("__carry"))
    rows = rows.withColumn("__new", F.when(last.isNull() | (F.col("time") - last >= gap), 1).otherwise(0))
    counts = rows.groupBy(*keys, "__slab").agg(F.sum("__new").alias("__starts"))
    counts = counts.withColumn("__offset", F.coalesce(F.sum("__starts").over(earlier), F.lit(0))).drop("__starts")
    rows = rows.join(counts, [*keys, "__slab"])
    running = F.sum("__new").over(local.rangeBetween(Window.unboundedPreceding, 0))  # ties together, in any order
    return rows.withColumn(group, (F.col("__offset") + running - 1).cast("bigint")).drop("__slab", "__carry", "__new", "__offset")


def sessionize_plain(df: DataFrame, gap: int, keys: Sequence[str] = ("run_id",), group: str = "group_id") -> DataFrame:
    """The same by one window per key; the definition that sessionize() is tested against."""
    order = Window.partitionBy(*keys).orderBy(F.struct("time", "endtime"))
    last = F.max("endtime").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(last.isNull() | (F.col("time") - last >= gap), 1).otherwise(0)
    marked = df.withColumn("__new", new)
    running = F.sum("__new").over(order.rangeBetween(Window.unboundedPreceding, 0))
    return marked.withColumn(group, (running - 1).cast("bigint")).drop("__new")


def build_events(
    triggers: DataFrame, left: int = 500_000, right: int = 50_000, bounds: tuple[int, int] | None = None, slab: int = SLAB_NS
) -> DataFrame:
    """(run_id, event_number, time, endtime, n_triggers): triggers nearer than left + right together, extended.

    Times are clipped to bounds if given; events are numbered by time within their run.
    """
    rows = triggers.select("run_id", "time", "endtime")
    grouped = sessionize(rows, left + right + 1, slab=slab).groupBy("run_id", "group_id")
    events = grouped.agg(
        (F.min("time") - left).alias("time"), (F.max("endtime") + right).alias("endtime"), F.count("*").alias("n_triggers")
    )
    if bounds:
        clip = lambda c: F.least(F.greatest(c, F.lit(bounds[0])), F.lit(bounds[1]))
        events = events.withColumns({"time": clip(F.col("time")), "endtime": clip(F.col("endtime"))})
    return events.select("run_id", F.col("group_id").alias("event_number"), "time", "endtime", "n_triggers")


def break_groups(df: DataFrame, safe_break: int = 1000, not_before: int | Column | None = None, slab: int = SLAB_NS, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """Adds break_group: the stream may be cut between groups, which are safe_break or more of quiet apart.

    Until not_before (a number, or a column that is one value for each of keys) the stream counts as busy: the first
    break is where safe_break of quiet after it, and after all rows so far, ends.
    """
    if not_before is None:
        return sessionize(df, safe_break, keys, slab, "break_group")
    busy = df.withColumns({"__end": F.col("endtime"), "endtime": F.greatest(F.col("endtime"), not_before if isinstance(not_before, Column) else F.lit(not_before))})
    return sessionize(busy, safe_break, keys, slab, "break_group").withColumn("endtime", F.col("__end")).drop("__end").select(*df.columns, "break_group")


def containment_join(peaks: DataFrame, events: DataFrame, keep: Sequence[str] = ("event_number",), slab: int = SLAB_NS) -> DataFrame:
    """Peaks with the columns `keep` of the event that fully contains them; peaks in no event are left out.

    Events of a run are disjoint, so the candidate is the last event that starts at or before the peak: events and
    peaks are united, and the last event is carried forward within a slab and, by a table of one row a slab, across.
    No peak meets more than one event.
    """
    keep = list(keep)
    event = F.struct(F.col("endtime").alias("__event_end"), *keep)
    columns = [c for c in peaks.columns if c not in keep]
    right = events.select("run_id", "time", event.alias("__event"), F.lit(0).alias("__order"))
    left = peaks.select(*columns, F.lit(1).alias("__order"))
    rows = _slabbed(left.unionByName(right, allowMissingColumns=True), slab)
    order = Window.partitionBy("run_id", "__slab").orderBy("time", "__order").rowsBetween(Window.unboundedPreceding, 0)
    by_slab = rows.groupBy("run_id", "__slab").agg(F.max_by("__event", F.when(F.col("__event").isNotNull(), F.col("time"))).alias("__last"))
    earlier = Window.partitionBy("run_id").orderBy("__slab").rowsBetween(Window.unboundedPreceding, -1)
    by_slab = by_slab.select("run_id", "__slab", F.last("__last", ignorenulls=True).over(earlier).alias("__carry"))
    rows = rows.join(by_slab, ["run_id", "__slab"])
    found = F.coalesce(F.last("__event", ignorenulls=True).over(order), F.col("__carry"))
    rows = rows.withColumn("__found", found).where((F.col("__order") == 1) & (F.col("endtime") <= F.col("__found.__event_end")))
    return rows.select(*columns, *[F.col(f"__found.{k}").alias(k) for k in keep])


def overlap_join(left: DataFrame, right: DataFrame, bucket: int, prefix: str = "r_", keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """Pairs of intervals that overlap (touching ends do not), right columns prefixed.

    Both sides go to the buckets of time they touch; a pair is kept in the bucket where the later of both starts, so it
    appears once. bucket should be about the longest usual interval.
    """
    keys = list(keys)

    def spread(df: DataFrame) -> DataFrame:
        first, last = floor_div(F.col("time"), bucket), floor_div(F.greatest(F.col("endtime") - 1, F.col("time")), bucket)
        return df.withColumn("__bucket", F.explode(F.sequence(first, last)))

    other = spread(right)
    other = other.select(*[F.col(c).alias(c if c in (*keys, "__bucket") else prefix + c) for c in other.columns])
    joined = spread(left).join(other, [*keys, "__bucket"])
    both = (F.col("time") < F.col(prefix + "endtime")) & (F.col(prefix + "time") < F.col("endtime"))
    once = F.col("__bucket") == floor_div(F.greatest(F.col("time"), F.col(prefix + "time")), bucket)
    return joined.where(both & once).drop("__bucket")


def coincidence_exists(left: DataFrame, right: DataFrame, max_delay: int, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """left with is_coinc: whether any right row starts in [time, time + max_delay]; null times never do."""
    found = _next_after(left, right, max_delay, keys)
    return found.withColumn("is_coinc", F.col("__next").isNotNull()).drop("__next")


def asof_forward(left: DataFrame, right: DataFrame, tolerance: int, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """left with next_time and delay of the nearest right row at or after its time, at most tolerance later, else null."""
    found = _next_after(left, right, tolerance, keys)
    return found.withColumns({"next_time": F.col("__next"), "delay": F.col("__next") - F.col("time")}).drop("__next")


def _next_after(left: DataFrame, right: DataFrame, reach: int, keys: Sequence[str]) -> DataFrame:
    """left with __next: the earliest right time in [time, time + reach].

    Times fall into slabs at least as long as the reach; each right row is also shown to the slab before its own, so a
    left row finds its next one within its slab. Linear, whatever the density.
    """
    keys, slab = list(keys), max(1, reach) * 64
    times = right.where("time is not null").select(*keys, F.col("time").alias("__at")).distinct()
    near = F.array_distinct(F.array(floor_div(F.col("__at"), slab), floor_div(F.col("__at") - reach, slab)))
    times = times.withColumn("__slab", F.explode(near)).withColumn("__order", F.lit(1))
    rows = left.withColumns({"__at": F.col("time"), "__slab": floor_div(F.col("time"), slab), "__order": F.lit(0)})
    both = rows.unionByName(times, allowMissingColumns=True)
    order = Window.partitionBy(*keys, "__slab").orderBy(F.desc("__at"), F.desc("__order")).rowsBetween(Window.unboundedPreceding, 0)
    nearest = F.last(F.when(F.col("__order") == 1, F.col("__at")), ignorenulls=True).over(order)
    both = both.withColumn("__next", nearest).where("__order = 0")
    both = both.withColumn("__next", F.when(F.col("__next") - F.col("time") <= reach, F.col("__next")))
    return both.drop("__at", "__slab", "__order")


def greedy_match(left: np.ndarray, right: np.ndarray, max_delay: int) -> np.ndarray:
    """For time-ordered arrays, the right index that each left row is paired with, -1 for none.

    Earliest first, one to one: a pair is any left and right row with right - left in [0, max_delay]; both then leave.
    """
    out, i, j = np.full(len(left), -1, dtype=np.int64), 0, 0
    while i < len(left) and j < len(right):
        delay = right[j] - left[i]
        if 0 <= delay <= max_delay:
            out[i], i, j = j, i + 1, j + 1
        elif delay < 0:
            j += 1
        else:
            i += 1
    return out


def coincidence_match(
    left: DataFrame, right: DataFrame, max_delay: int = 100, edge: str = "all", row_id: str = "peak_id", keys: Sequence[str] = ("run_id",), slab: int = SLAB_NS
) -> DataFrame:
    """left with is_coinc: greedy one-to-one forward matching of left and right times.

    Both sides are matched in slabs of time, however dense they are. All that one slab owes to those before it are the
    left rows of the last max_delay that are unmatched at its border; these are carried on. In the first round no slab
    gets any; then the slabs that were given other rows than they were matched with are matched again, in rounds, until
    the borders settle. A slab forgets what it was given as soon as no left row is open in it, so few rounds are usual;
    there are never more than slabs. Rounds are stored, and only slabs that change are computed again.

    edge "reference" ignores the last two rows (by time) of both sides of every key. Null times never match; row_id
    names a column of left that is unique for each value of keys.
    """
    keys, length, kinds = list(keys), max(slab, max_delay), dict(left.dtypes)
    a = left.where("time is not null").select(*keys, "time", F.col(row_id).alias("__id"), F.lit(0).alias("__side"))
    b = right.where("time is not null").select(*keys, "time", F.lit(None).cast(kinds[row_id]).alias("__id"), F.lit(1).alias("__side"))
    both = a.unionByName(b)
    if edge == "reference":
        both = _without_last(both, 2, [*keys, "__side"])
    elif edge != "all":
        raise ValueError("edge is all or reference")
    rows = stored(_slabbed(both, length))
    place = [*keys, "__slab"]

    def match(frame: pd.DataFrame) -> pd.DataFrame:
        at = int(frame["__slab"].iloc[0])
        frame = frame.sort_values(["time", "__side", "__id"], kind="stable")
        mine, other = frame[frame["__side"] == 0], frame[frame["__side"] == 1]
        hit = greedy_match(mine["time"].to_numpy(), other["time"].to_numpy(), max_delay) >= 0
        # unmatched rows that the next slab may still match are handed on
        passed = ~hit & (mine["time"].to_numpy() + max_delay >= (at + 1) * length)
        out = mine.loc[hit | passed, [*keys, "time", "__id"]].assign(__slab=at, __hit=hit[hit | passed])
        return out[[*place, "time", "__id", "__hit"]]

    fields = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + f", __slab bigint, time bigint, __id {kinds[row_id]}, __hit boolean"
    matched = lambda some: stored(some.groupBy(*place).applyInPandas(match, fields))
    given_to = lambda found: found.where("not __hit").withColumn("__slab", F.col("__slab") + 1)
    digest = [F.count("*").alias("__n"), F.sum(F.xxhash64("time", "__id").cast("decimal(38, 0)")).alias("__h")]
    everywhere = stored(rows.groupBy(*place).agg(F.count("*").alias("__rows")).select(*place))
    result = matched(rows)
    used = everywhere.withColumns({"__n": F.lit(0).cast("bigint"), "__h": F.lit(0).cast("decimal(38, 0)")})  # what each slab was matched with
    while True:
        now = given_to(result)
        sums = everywhere.join(now.groupBy(*place).agg(*digest), place, "left")
        sums = sums.select(*place, F.coalesce("__n", F.lit(0)).alias("__n"), F.coalesce("__h", F.lit(0)).cast("decimal(38, 0)").alias("__h"))
        sums = stored(sums)
        changed = stored(sums.join(used, [*place, "__n", "__h"], "left_anti").select(*place))
        if not changed.head(1):
            break
        again = rows.unionByName(now.select(*keys, "time", "__id", F.lit(0).alias("__side"), "__slab")).join(changed, place)
        result, used = stored(result.join(changed, place, "left_anti").unionByName(matched(again))), sums
    hits = result.where("__hit").select(*keys, F.col("__id").alias(row_id), F.lit(True).alias("__hit")).distinct()
    joined = left.join(hits, [*keys, row_id], "left")
    return joined.select(*left.columns, F.coalesce("__hit", F.lit(False)).alias("is_coinc"))


def _without_last(df: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """df without the last n rows by time of every key: found by a bounded array per key, not by an ordered window."""
    stamp = F.struct("time", "__id")
    top = F.slice(F.sort_array(F.collect_list("__s"), asc=False), 1, n)
    salted = df.withColumns({"__s": stamp, "__salt": F.pmod(F.xxhash64("time"), F.lit(64))})
    ranked = salted.withColumn("__r", F.row_number().over(Window.partitionBy(*keys, "__salt").orderBy(F.desc("time"), F.desc("__id"))))
    last = ranked.where(F.col("__r") <= n).groupBy(*keys).agg(top.alias("__last")).withColumn("__limit", F.get("__last", F.lit(n - 1)))
    joined = df.join(F.broadcast(last.drop("__last")), keys, "left")
    return joined.where(F.col("__limit").isNotNull() & (F.struct("time", "__id") < F.col("__limit"))).drop("__limit")


def count_above(values: np.ndarray, low: np.ndarray, high: np.ndarray, limits: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each query, the weight of values[low:high] above its limit (NaN counts as above every number).

    Two-dimensional dominance counting without a loop over rows: values become ranks; level k of a merge-sort tree holds
    the ranks sorted within blocks of 2^k places, so one binary search over the whole level answers for one block of
    every query, and a query's range is two blocks a level at most. n log n places, (n + queries) log^2 n steps.
    """
    n = len(values)
    order = np.argsort(values, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.arange(n)
    first = np.searchsorted(values[order], limits, side="right")  # ranks from here on are above
    out = np.zeros(len(limits), dtype=np.int64)
    low, high = low.astype(np.int64).copy(), np.maximum(high, low).astype(np.int64)

    def add(rows: np.ndarray, block: np.ndarray, level: np.ndarray, sums: np.ndarray, size: int) -> None:
        stop = np.minimum((block + 1) * size, n)
        at = np.searchsorted(level, block * (n + 1) + first[rows])
        out[rows] += sums[stop] - sums[np.minimum(at, stop)]

    size = 1
    open_rows = np.flatnonzero(low < high)
    while len(open_rows):
        level = np.arange(n) // size * (n + 1) + rank
        by = np.argsort(level, kind="stable") if size > 1 else np.arange(n)
        level, sums = level[by], np.concatenate(([0], np.cumsum(weights[by])))
        odd = open_rows[low[open_rows] // size % 2 == 1]
        add(odd, low[odd] // size, level, sums, size)
        low[odd] += size
        odd = open_rows[(high[open_rows] // size % 2 == 1) & (low[open_rows] < high[open_rows])]
        high[odd] -= size
        add(odd, high[odd] // size, level, sums, size)
        size *= 2
        open_rows = open_rows[low[open_rows] < high[open_rows]]
    return out


def count_in_parts(values: np.ndarray, low: np.ndarray, high: np.ndarray, limits: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """count_above() with the values in parts of at most `most`; low and high must ascend.

    The queries that meet a part are neighbours. Those that hold all of it take one binary search among its sorted
    values; count_above() serves those that end within it, which are two parts a query at most.
    """
    out = np.zeros(len(limits), dtype=np.int64)
    for start in range(0, len(values), most):
        stop = min(start + most, len(values))
        v, w = values[start:stop], weights[start:stop]
        rows = np.arange(np.searchsorted(high, start, "right"), np.searchsorted(low, stop, "left"))
        whole = (low[rows] <= start) & (high[rows] >= stop)
        inside, across = rows[~whole], rows[whole]
        if len(across):
            by = np.argsort(v, kind="stable")
            above = np.concatenate((np.cumsum(w[by][::-1])[::-1], [0]))
            out[across] += above[np.searchsorted(v[by], limits[across], "right")]
        if len(inside):
            out[inside] += count_above(v, np.maximum(low[inside], start) - start, np.minimum(high[inside], stop) - start, limits[inside], w)
    return out


def n_competing(
    peaks: DataFrame, window: int, fraction: float = 0.5, inclusive_edge: bool = False, bucket: int | None = None, most: int = 200_000, frame: int = 2_000_000
) -> DataFrame:
    """Adds n_competing: peaks of the run within `window` of time with an area above `fraction` of its own.

    The peak itself counts if it fits. inclusive_edge counts from the first time >= t - window to the first one at or
    beyond t + window, however far, and of that time one peak only, the largest. Null times and areas compete with
    nothing and have no competitors. Runs may number their peaks alike: the count depends on run, time and area only.

    Slabs of `bucket` ticks (above twice the window) go to workers with the peaks within the window of them and, for the
    edge, the first peak beyond; whole rows go once, so there is no join afterwards. A worker counts parts of at most
    `most` peaks. Where a slab and what it is shown have more than `frame` peaks, its rows are divided into parts whose
    pairs go to workers of their own and are summed up, so no worker gets more than about twice `frame` rows at once.
    """
    size = max(bucket or 0, 16 * window, 2 * window + 1)
    time, place, names = F.col("time"), ["run_id", "__slab"], peaks.columns
    home = F.coalesce(floor_div(time, size), F.pmod(F.xxhash64(*[c for c, kind in peaks.dtypes if "map<" not in kind]), F.lit(64)))  # a null time goes anywhere
    reach = F.array_distinct(F.array(home, *[F.coalesce(floor_div(time + d, size), home) for d in (-window, window)]))
    shown = peaks.withColumns({"__home": home, "__slab": F.explode(reach)}).withColumn("__ask", F.col("__home") == F.col("__slab")).drop("__home")
    stamp = F.when(F.col("__ask"), F.struct((-time).alias("t"), F.col("area").cast("double").alias("a")))  # largest: the first time's largest area
    late = F.when(time - F.col("__slab") * size >= window, stamp)
    slabs = stored(shown.where("run_id is not null and time is not null").groupBy(*place).agg(F.count("*").alias("__rows"), F.max(stamp).alias("__first"), F.max(late).alias("__late")))
    rest = {c: F.when(F.col("__ask"), F.col(c)) for c in names if c not in ("run_id", "time", "area")}
    rows = shown.withColumns(rest | {"__m": F.lit(1)})
    if inclusive_edge:
        order = Window.partitionBy("run_id").orderBy("__slab")
        follows = F.lead("__slab").over(order) == F.col("__slab") + 1
        beyond = F.when(follows, F.coalesce(F.lead("__late").over(order), F.lead("__first", 2).over(order))).otherwise(F.lead("__first").over(order))
        edges = slabs.where("__first is not null").select(*place, beyond.alias("__e")).where("__e is not null")
        area = F.col("__e.a").cast(peaks.schema["area"].dataType)
        edges = edges.select(*place, (-F.col("__e.t")).cast(peaks.schema["time"].dataType).alias("time"), area.alias("area"), F.lit(False).alias("__ask"), F.lit(0).alias("__m"))
        rows = rows.unionByName(edges, allowMissingColumns=True)

    def count(key, table):
        column = lambda t, c, kind: t[c].cast(kind).fill_null(0).to_numpy()
        valid = lambda t, c: t[c].is_valid().to_numpy()
        known, asked = table.filter(pc.and_(table["__m"].is_valid(), table["time"].is_valid())), table.filter(table["__ask"])
        by = np.argsort(column(known, "time", pa.int64()), kind="stable")
        t, has_area = column(known, "time", pa.int64())[by], valid(known, "area")[by]
        values = np.where(has_area, column(known, "area", pa.float64())[by], -np.inf)
        weights = np.where(has_area, column(known, "__m", pa.int64())[by], 0)
        counted = np.flatnonzero(valid(asked, "time") & valid(asked, "area") & (key[0].as_py() is not None))
        at, limits = column(asked, "time", pa.int64())[counted], column(asked, "area", pa.float64())[counted] * fraction
        counted, at, limits = (x[np.argsort(at, kind="stable")] for x in (counted, at, limits))
        low, high = np.searchsorted(t, at - window, "left"), np.searchsorted(t, at + window, "left" if inclusive_edge else "right")
        n, edge, edge_area = (np.zeros(asked.num_rows, dtype=k) for k in (np.int64, np.int64, np.float64))
        n[counted] = count_in_parts(values, low, high, limits, weights, most)
        beyond = np.zeros(asked.num_rows, dtype=bool)
        if inclusive_edge and len(t):
            starts = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
            top = np.maximum.reduceat(values, starts)
            here = high < len(t)
            beyond[counted[here]] = True
            edge[counted[here]], edge_area[counted[here]] = t[high[here]], top[np.searchsorted(starts, high[here])]
        out = asked.select(names).append_column("__n", pa.array(n))
        return out.append_column("__et", pa.array(edge, mask=~beyond)).append_column("__ea", pa.array(edge_area, mask=~beyond))

    out = T.StructType([*[T.StructField(f.name, f.dataType) for f in peaks.schema], *[T.StructField(c, k) for c, k in (("__n", T.LongType()), ("__et", T.LongType()), ("__ea", T.DoubleType()))]])
    dense = slabs.where(F.col("__rows") > frame).select(*place, F.ceil(F.col("__rows") / frame).cast("int").alias("__c"))
    some = bool(dense.head(1))
    usual = rows.join(F.broadcast(dense), place, "left_anti") if some else rows
    counts = usual.groupBy(*place).applyInArrow(count, out)
    if some:
        counts = counts.unionByName(_by_pairs_of_parts(rows.join(F.broadcast(dense), place), count, out))
    extra = F.when(F.col("__ea") > F.col("area") * fraction, 1).otherwise(0)
    return counts.select(*names, (F.col("__n") + extra if inclusive_edge else F.col("__n")).alias("n_competing"))


def _by_pairs_of_parts(rows: DataFrame, count, out: T.StructType) -> DataFrame:
    """n_competing() of dense slabs: every part of the queries meets every part of the data; counts are added, and the
    first edge is taken. Equal rows have equal counts and are set apart again by their number."""
    names = out.names[:-3]
    part, c = F.pmod(F.xxhash64("time", "area"), F.col("__c")).cast("int"), F.col("__c")
    pair = lambda i, j: F.struct(i.alias("__i"), j.alias("__j"))
    every = F.sequence(F.lit(0), c - 1)
    queries = rows.where("__ask").withColumn("__p", F.explode(F.transform(every, lambda j: pair(part, j)))).withColumn("__m", F.lit(None).cast("int"))
    data = rows.withColumn("__p", F.explode(F.transform(every, lambda i: pair(i, part)))).withColumn("__ask", F.lit(False))
    both = queries.unionByName(data.withColumns({k: F.lit(None).cast(out[k].dataType) for k in names if k not in ("run_id", "time", "area")}))
    with_c = T.StructType([*out.fields, T.StructField("__c", T.IntegerType())])
    parts = both.select("*", "__p.*").drop("__p").groupBy("run_id", "__slab", "__i", "__j")

    def counted(key, table):
        return count(key, table).append_column("__c", table.filter(table["__ask"])["__c"])

    stamp = F.max(F.when(F.col("__et").isNotNull(), F.struct((-F.col("__et")).alias("t"), F.col("__ea").alias("a")))).alias("__e")
    sums = parts.applyInArrow(counted, with_c).groupBy(*names, "__c").agg(F.sum("__n").alias("__n"), F.count("*").alias("__k"), stamp)
    equal = F.call_function("div", F.col("__k"), c)
    sums = sums.withColumns({"__n": F.call_function("div", F.col("__n"), equal), "__equal": F.explode(F.sequence(F.lit(1), equal))})
    return sums.select(*names, "__n", (-F.col("__e.t")).alias("__et"), F.col("__e.a").alias("__ea"))
