"""Event level: main and alternative S1 and S2, drift times, positions, corrected areas, merged tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import Corrections, EventConfig, SLAB_NS
from .intervals import containment_join

#: Peak columns copied into an event for each of its main and alternative S1 and S2, with their types.
COPIED = {
    "time": "bigint", "center_time": "bigint", "endtime": "bigint", "area": "double", "n_channels": "int", "n_hits": "int", "max_pmt": "int",
    "max_pmt_area": "double", "range_50p_area": "double", "range_90p_area": "double", "rise_time": "double", "area_fraction_top": "double",
    "tight_coincidence": "int", "n_saturated_channels": "int",
}
#: Declared columns of an event that nothing fills: always null.
UNFILLED = {
    **{f"{r}_{k}_diff": "int" for r in ("s1", "alt_s1") for k in ("max", "min")},
    **{f"{r}_{k}": "double" for r in ("s2", "alt_s2") for k in ("x", "y")},
}
KEY = ["run_id", "event_number"]
_ROLES = ("s1", "alt_s1", "s2", "alt_s2")


def peak_index(peaks: DataFrame) -> DataFrame:
    """Adds index: the peak's position by time in its event, from 0."""
    order = Window.partitionBy(*KEY).orderBy("time", "peak_id")
    return peaks.withColumn("index", (F.row_number().over(order) - 1).cast("int"))


def largest_peaks_per_event(peaks: DataFrame, s_type: int, k: int = 2, before_time: str | None = None, min_coincidence: int = 0) -> DataFrame:
    """Adds rank: the k peaks of a type with the largest areas of each event (k 0: all), ties by larger index.

    before_time names a column: only peaks whose time is below it; null there means no limit.
    """
    keep = F.col("type") == s_type
    if before_time:
        keep &= F.col(before_time).isNull() | (F.col("time") < F.col(before_time))
    if min_coincidence:
        keep &= F.col("tight_coincidence") >= min_coincidence
    order = Window.partitionBy(*KEY).orderBy(F.desc("area"), F.desc("index"))
    ranked = peaks.where(keep).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k) if k else ranked


def event_basics(events: DataFrame, peaks: DataFrame, cfg: EventConfig = EventConfig(), contained: DataFrame | None = None, slab: int = SLAB_NS) -> DataFrame:
    """One row per event: n_peaks, main and alternative S1 and S2 with their copied properties and index, drift times,
    delays, area_before_main_s2 and large_s2_before_main_s2.

    peaks in events are found by containment_join unless `contained` has event_number already. After that join a
    single shuffle by event serves all steps: windows give the index and the main S2's time, then one aggregation
    sorts each event's S1s and S2s (areas descending, ties by larger index) and picks from the front. Events without
    peaks have n_peaks 0 and nulls elsewhere.

    Copied are the properties COPIED, null where the peaks lack one, and for both S2s the positions x_<algo>, y_<algo>
    that the peaks have (see peak_positions). The columns UNFILLED are declared and always null.
    """
    inside = contained if contained is not None else containment_join(peaks, events, slab=slab)
    placed = [c for c in inside.columns if c.startswith(("x_", "y_"))]
    lacking = {c: F.lit(None).cast(kind) for c, kind in COPIED.items() if c not in inside.columns}
    inside = inside.withColumns(lacking) if lacking else inside
    copied = [*COPIED, *placed]
    rows = peak_index(inside)
    whole = Window.partitionBy(*KEY)
    largest = F.max(F.when(F.col("type") == 2, F.struct("area", "index", "time"))).over(whole)
    rows = rows.withColumn("__ms2", largest)
    before = F.col("__ms2").isNotNull() & (F.col("time") < F.col("__ms2.time"))
    s1_ok = (F.col("type") == 1) & (F.col("tight_coincidence") >= cfg.s1_min_coincidence)
    if not cfg.allow_posts2_s1s:
        s1_ok &= F.col("__ms2").isNull() | before
    peak = F.struct("area", "index", *[c for c in copied if c != "area"])
    grouped = rows.groupBy(*KEY).agg(
        F.count("*").alias("n_peaks"),
        F.sort_array(F.collect_list(F.when(s1_ok, peak)), asc=False).alias("__s1s"),
        F.sort_array(F.collect_list(F.when(F.col("type") == 2, peak)), asc=False).alias("__s2s"),
        F.sum(F.when(before, F.col("area"))).alias("__before"),
        F.max(F.when(before & (F.col("type") == 2), F.col("area"))).alias("__large"),
    )
    first = lambda c: F.get(c, F.lit(0))
    if cfg.force_alt_s2_in_max_drift_time:
        drift = lambda p: p["center_time"] - first("__s1s")["center_time"]
        fits = F.filter("__s2s", lambda p, i: (i == 0) | ((drift(p) > 0) & (drift(p) < 1.01 * cfg.drift_time_max)))
        limited = (F.size("__s1s") > 0) & (F.size("__s2s") > 1)
        grouped = grouped.withColumn("__s2s", F.when(limited, fits).otherwise(F.col("__s2s")))
    pair = F.slice("__s2s", 1, 2)
    if cfg.force_main_before_alt:
        pair = F.array_sort(pair, lambda a, b: F.when(a["time"] < b["time"], -1).when(a["time"] > b["time"], 1).otherwise(0))
    grouped = grouped.withColumns({"__s1s": F.slice("__s1s", 1, 2), "__s2s": pair})
    role = {"s1": ("__s1s", 0), "alt_s1": ("__s1s", 1), "s2": ("__s2s", 0), "alt_s2": ("__s2s", 1)}
    role = {k: F.get(F.col(c), F.lit(i)) for k, (c, i) in role.items()}
    out = {"n_peaks": F.col("n_peaks")}
    for name in _ROLES:
        shown = copied if name.endswith("s2") else COPIED
        out |= {f"{name}_{c}": role[name][c] for c in ("index", *shown)}
    c1, a1, c2, a2 = (role[n]["center_time"] for n in _ROLES)
    out |= {
        "drift_time": c2 - c1,
        "alt_s1_interaction_drift_time": c2 - a1,
        "alt_s1_delay": F.when(c2.isNotNull(), a1 - c1),
        "alt_s2_interaction_drift_time": a2 - c1,
        "alt_s2_delay": F.when(c1.isNotNull(), a2 - c2),
        "area_before_main_s2": F.when(role["s2"].isNotNull(), F.coalesce("__before", F.lit(0.0))),
        "large_s2_before_main_s2": F.when(role["s2"].isNotNull(), F.coalesce("__large", F.lit(0.0))),
    }
    out |= {c: F.lit(None).cast(kind) for c, kind in UNFILLED.items()}
    basics = grouped.select(*KEY, *[v.alias(k) for k, v in out.items()])
    joined = events.select(*KEY, "time", "endtime").join(basics, KEY, "left")
    return joined.withColumn("n_peaks", F.coalesce("n_peaks", F.lit(0)))


def event_positions(events: DataFrame, gate: float = 3000.0, cathode: float = 39500.0, distance: float = 50.5, algo: str = "corr") -> DataFrame:
    """Adds x, y, r of the main S2, alt_s2_x, alt_s2_y, alt_s2_r (from s2_x_<algo> and so on), and z from the drift time."""
    x, y, ax, ay = (F.col(f"{p}_{k}_{algo}") for p in ("s2", "alt_s2") for k in ("x", "y"))
    z = -distance / (cathode - gate) * (F.col("drift_time") - gate)
    return events.withColumns(
        {"x": x, "y": y, "alt_s2_x": ax, "alt_s2_y": ay, "r": F.sqrt(x * x + y * y), "alt_s2_r": F.sqrt(ax * ax + ay * ay), "z": z}
    )


def corrected_areas(events: DataFrame, c: Corrections = Corrections(), elife: Column | None = None) -> DataFrame:
    """Adds cs1, cs2, alt_cs1, alt_cs2; the alternatives use the main z and drift time. elife may be a column per run."""
    z0, z1, y0, slope = c.s1_z
    light = F.try_divide(F.lit(y0 + slope * (z0 + z1) / 2), y0 + slope * F.col("z"))
    charge = F.exp(F.col("drift_time") / (elife if elife is not None else F.lit(c.elife)))
    return events.withColumns(
        {
            "cs1": F.col("s1_area") * light,
            "cs2": F.col("s2_area") * charge,
            "alt_cs1": F.col("alt_s1_area") * light,
            "alt_cs2": F.col("alt_s2_area") * charge,
        }
    )


def merge_kind(*tables: DataFrame, keys=("run_id", "event_number")) -> DataFrame:
    """Tables of one kind (a row for the same keys) side by side; a column that several have is taken from the first."""

    def add(left: DataFrame, right: DataFrame) -> DataFrame:
        new = [c for c in right.columns if c not in left.columns]
        return left.join(right.select(*keys, *new), list(keys))

    return reduce(add, tables)


def lookup_by_index(events: DataFrame, peaks: DataFrame, columns: tuple[str, ...], roles=_ROLES) -> DataFrame:
    """events with <role>_<column> of the peak at <role>_index; null where there is none.

    peaks have run_id, event_number and index. One aggregation by event, not a join for each role.
    """
    wanted = events.select(*KEY, *[F.coalesce(f"{r}_index", F.lit(-1)).alias(f"__{r}") for r in roles])
    value = F.struct(*columns)
    met = peaks.join(wanted, KEY)
    picked = met.where(reduce(lambda a, b: a | b, [F.col("index") == F.col(f"__{r}") for r in roles]))
    found = picked.groupBy(*KEY).agg(
        *[F.first(F.when(F.col("index") == F.col(f"__{r}"), value), ignorenulls=True).alias(f"__{r}") for r in roles]
    )
    out = events.join(found, KEY, "left")
    return out.withColumns({f"{r}_{c}": F.col(f"__{r}.{c}") for r in roles for c in columns}).drop(*[f"__{r}" for r in roles])


def event_area_per_channel(events: DataFrame, peaks: DataFrame) -> DataFrame:
    """time, endtime, and for each role area_per_channel, length and dt of its peak; s1_n_channels: channels with area."""
    found = lookup_by_index(events.select(*KEY, "time", "endtime", *[f"{r}_index" for r in _ROLES]), peaks, ("area_per_channel", "length", "dt"))
    lit = F.size(F.filter("s1_area_per_channel", lambda a: a > 0))
    return found.withColumn("s1_n_channels", F.when(F.col("s1_area_per_channel").isNotNull(), lit)).drop(*[f"{r}_index" for r in _ROLES])


def event_waveform(events: DataFrame, peaks: DataFrame) -> DataFrame:
    """time, endtime, and for each role data, length and dt of its peak."""
    found = lookup_by_index(events.select(*KEY, "time", "endtime", *[f"{r}_index" for r in _ROLES]), peaks, ("data", "length", "dt"))
    return found.drop(*[f"{r}_index" for r in _ROLES])


def event_coincidences(events: DataFrame, external: DataFrame, max_delay: int = 100, edge: str = "all", centre=511.0, delta=65.0, slab: int = SLAB_NS) -> DataFrame:
    """events with is_coinc: the main S1 is matched to an external peak of the absorption line (see coincidence_match)."""
    from .filters import absorption_window
    from .intervals import coincidence_match

    timed = events.withColumn("__key", F.concat_ws("/", "run_id", "event_number"))
    sides = timed.select("__key", "run_id", F.col("s1_time").alias("time"))
    matched = coincidence_match(sides, absorption_window(external, centre, delta), max_delay, edge, "__key", slab=slab)
    return timed.join(matched.select("__key", "is_coinc"), "__key").drop("__key")
