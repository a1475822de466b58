"""The dataset jobs: raw fragments to event_info, the external detectors, LED calibration."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.kernels import find_hits, peak_widths, split_peaks
from ..operators import events as ev
from ..operators import catalog, filters, intervals, peaks, records
from ..schemas import CHANNEL_MAP, Corrections, EventConfig, PeakConfig, SLAB_NS
from ..sources.io import concat_chunks, stored
from .registry import provides

N_TPC = 5


@provides("raw_records_all", "fragments")
def raw_records_all(
    fragments: DataFrame, run_start_s: float = 0, polarity: DataFrame | None = None, channel_map=None, chunk: int | None = None, overlap: int = 0, **cutting
) -> DataFrame:
    """All fragments once, with the detector and in epoch time. With the ticks of a chunk and of an overlap, overlaps are
    cut at breaks, or with dead time where there is none (see records.safe_parts, which takes the rest); without, what
    two parts both hold is kept once."""
    rows = concat_chunks(fragments) if chunk is None else records.safe_parts(fragments, chunk, overlap, **cutting)
    if polarity is not None:
        rows = filters.apply_polarity(rows, polarity)
    return filters.to_epoch(filters.route_detectors(rows, channel_map), run_start_s)


def safe_part(rows: DataFrame, part: str, start: int, end: int, safe_break: int = 1000, dt: int = 10, record_length: int = 110, slab: int = SLAB_NS) -> DataFrame:
    """What belongs to one side of the cut of an overlap that two chunks cover: post, the end of the one before, has
    what lies before the cut, pre, the beginning of the one after, the rest.

    The cut is safe_break before the end if all is quiet there; else at the first break that no record of the chunk
    before can reach into; else, with data loss, safe_break before the end, with a dead-time row (see insert_dead_time).
    """
    if part not in ("pre", "post"):
        raise ValueError("part is pre or post")
    ended = rows.withColumn("endtime", F.col("time") + F.col("length").cast("bigint") * F.col("dt"))
    grouped = intervals.break_groups(ended, safe_break, start + record_length * dt, slab)
    last, groups = grouped.agg(F.max("endtime"), F.max("break_group")).first()
    if last is None or last + safe_break < end:
        return rows if part == "post" else rows.limit(0)
    if groups:
        side = F.col("break_group") == 0 if part == "post" else F.col("break_group") > 0
        return grouped.where(side).select(*rows.columns)
    cut = end - safe_break
    if part == "pre":
        return records.insert_dead_time(rows, end, cut, dt, "pre")
    kept = ended.where(F.col("endtime") <= cut).select(*rows.columns)
    dead = records.insert_dead_time(rows, cut, cut - record_length * dt, dt, "pre")
    return kept.unionByName(dead)


for _name, _detector in (("raw_records", "tpc"), ("raw_records_ext", "external"), ("raw_records_sipm", "sipm")):
    provides(_name, "raw_records_all")(lambda df, d=_detector: df.where(F.col("detector") == d))


@provides("records", "raw_records")
def make_records(raw: DataFrame, n_tpc: int = N_TPC, samples: int = 20, slab: int = SLAB_NS, check: bool = True, observation: Observation | None = None) -> DataFrame:
    """Baseline-subtracted records of the central detector; with check, overlapping pulses of a channel are an error, or
    counted by run in the observation if one is given."""
    rows = filters.zero_out_of_bounds(filters.keep_tpc(raw, n_tpc))
    rows = records.check_overlaps(rows, fail=True, slab=slab, observation=observation) if check else rows
    return records.integrate(records.baseline(rows, samples, slab=slab))


@provides("records_ext", "raw_records_ext")
def records_ext(raw: DataFrame, samples: int = 20, slab: int = SLAB_NS) -> DataFrame:
    return records.integrate(records.baseline(filters.zero_out_of_bounds(raw), samples, slab=slab))


provides("records_sipm", "raw_records_sipm")(records_ext)


@provides("pulse_counts", "records")
def make_pulse_counts(rows: DataFrame, n_tpc: int = N_TPC, slab: int = SLAB_NS) -> DataFrame:
    return records.pulse_counts(records.lone_pulses(rows, slab), n_tpc)


@provides("peaks", "records")
def make_peaks(
    rows: DataFrame, threshold=15.0, gains=None, gap=300, left=10, right=10, min_area=10.0, min_channels=1, n_channels: int = N_TPC, min_height=25.0, min_ratio=4.0, bucket=100_000
) -> DataFrame:
    """Hits, clusters, sum waveforms, splits, widths; arrays stay with the peaks only here. Hits are needed twice and are
    stored, so that they are found once."""
    hits = stored(records.gain_to_pe(find_hits(rows, threshold), gains))
    clusters = records.build_peaks(hits, n_channels, gap, left, right, min_area, min_channels)
    waves = records.sum_waveform(clusters, rows, gains, bucket)
    parts = split_peaks(waves, min_height, min_ratio)
    parts = parts.withColumn("peak_id", F.concat_ws("/", "run_id", "peak_id", "part"))
    # hits of the parts: those that start within them, per channel
    near = intervals.overlap_join(parts.select("run_id", "peak_id", "time", "endtime"), hits.select("run_id", "time", "endtime", "channel", "area"), bucket)
    inside = near.where((F.col("r_time") >= F.col("time")) & (F.col("r_time") < F.col("endtime")))
    by_channel = inside.groupBy("peak_id", F.col("r_channel").alias("c")).agg(F.sum("r_area").alias("a"), F.count("*").alias("n"))
    light = by_channel.groupBy("peak_id").agg(
        F.map_from_entries(F.collect_list(F.struct("c", "a"))).alias("__m"), F.sum("n").cast("int").alias("n_hits"), F.count("*").cast("int").alias("tight_coincidence")
    )
    per = F.transform(F.sequence(F.lit(0), F.lit(n_channels - 1)), lambda c: F.coalesce(F.try_element_at("__m", c), F.lit(0.0)))
    whole = parts.join(light, "peak_id", "left").withColumn("area_per_channel", F.coalesce(per, F.array_repeat(F.lit(0.0), n_channels)))
    whole = whole.withColumns({"n_hits": F.coalesce("n_hits", F.lit(0)), "tight_coincidence": F.coalesce("tight_coincidence", F.lit(0)), "n_saturated_channels": F.lit(0)})
    return peak_widths(whole.drop("__m", "part"))


provides("peaks_ext", "records_ext")(lambda rows, **o: make_peaks(rows, **({"n_channels": 6} | o)))
provides("peaks_sipm", "records_sipm")(lambda rows, **o: make_peaks(rows, **({"n_channels": 7} | o)))


@provides("peak_basics", "peaks")
def make_peak_basics(rows: DataFrame, cfg: PeakConfig = PeakConfig(), channel_map=None, check: bool = False, observation: Observation | None = None) -> DataFrame:
    """Scalar properties of peaks; with check, an area that its channels do not sum up to is an error, or counted by run
    in the observation if one is given."""
    rows = filters.check_area(rows, channel_map, fail=True, observation=observation) if check else rows
    return peaks.peak_basics(rows, cfg, channel_map or CHANNEL_MAP)


provides("peak_basics_ext", "peaks_ext")(lambda rows, cfg=PeakConfig(): peaks.peak_basics(rows, cfg, mode="aux"))
provides("peak_basics_sipm", "peaks_sipm")(lambda rows, cfg=PeakConfig(): peaks.peak_basics(rows, cfg, mode="aux"))


@provides("peak_positions", "peaks", "peak_basics")
def make_peak_positions(rows: DataFrame, basics: DataFrame, **options) -> DataFrame:
    light = rows.select("peak_id", "area_per_channel")
    wanted = basics.select("run_id", "peak_id", "area", "area_fraction_top").join(light, "peak_id")
    return peaks.peak_positions(wanted, **options).drop("area_per_channel", "area", "area_fraction_top")


@provides("peak_coincidences", "peak_basics", "peak_basics_ext")
def peak_coincidences(basics: DataFrame, external: DataFrame, max_delay: int = 100, edge: str = "all") -> DataFrame:
    found = intervals.coincidence_match(basics, filters.absorption_window(external), max_delay, edge)
    return found.select("run_id", "peak_id", "time", "endtime", "is_coinc")


@provides("events", "peak_basics")
def make_events(basics: DataFrame, cfg: EventConfig = EventConfig(), slab: int = SLAB_NS) -> DataFrame:
    return intervals.build_events(filters.trigger_peaks(basics, cfg.trigger_min_area), cfg.left_extension, cfg.right_extension, slab=slab)


@provides("event_basics", "events", "peak_basics", "peak_positions")
def make_event_basics(rows: DataFrame, basics: DataFrame, positions: DataFrame, cfg: EventConfig = EventConfig(), slab: int = SLAB_NS) -> DataFrame:
    """Peaks with the positions of every algorithm, by event."""
    placed = [c for c in positions.columns if c.startswith(("x_", "y_"))]
    whole = basics.join(positions.select("run_id", "peak_id", *placed), ["run_id", "peak_id"], "left")
    return ev.event_basics(rows, whole, cfg, slab=slab)


@provides("event_positions", "event_basics")
def make_event_positions(rows: DataFrame, **options) -> DataFrame:
    found = ev.event_positions(rows, **options)
    return found.select("run_id", "event_number", "time", "endtime", "x", "y", "alt_s2_x", "alt_s2_y", "r", "alt_s2_r", "z")


@provides("corrected_areas", "event_basics", "event_positions")
def make_corrected(rows: DataFrame, positions: DataFrame, corrections: Corrections = Corrections(), elife: DataFrame | None = None) -> DataFrame:
    """Corrected areas. elife: electron lifetimes as a correction table (position, range, value); each run takes
    the first whose range holds it (see correction_for_run)."""
    rows = rows.join(positions.select("run_id", "event_number", "z"), ["run_id", "event_number"])
    lifetime = None
    if elife is not None:
        known = catalog.correction_for_run(rows.select("run_id").distinct(), elife)
        known = known.select("run_id", F.col("value").cast("double").alias("__elife"))
        rows, lifetime = rows.join(F.broadcast(known), "run_id"), F.col("__elife")
    found = ev.corrected_areas(rows, corrections, lifetime)
    return found.select("run_id", "event_number", "time", "endtime", "cs1", "cs2", "alt_cs1", "alt_cs2")


@provides("event_info", "event_basics", "corrected_areas", "event_positions")
def make_event_info(basics: DataFrame, areas: DataFrame, positions: DataFrame) -> DataFrame:
    return ev.merge_kind(basics.drop("alt_s2_x", "alt_s2_y"), areas, positions)


@provides("event_coincidences", "event_basics", "peak_basics_ext")
def make_event_coincidences(rows: DataFrame, external: DataFrame, max_delay: int = 100, edge: str = "all", slab: int = SLAB_NS) -> DataFrame:
    found = ev.event_coincidences(rows, external, max_delay, edge, slab=slab)
    return found.select("run_id", "event_number", "time", "endtime", "is_coinc")


def _in_events(events: DataFrame, rows: DataFrame, columns: tuple[str, ...], slab: int) -> DataFrame:
    """The peaks with arrays within events, numbered as event_basics numbers them."""
    ended = rows.withColumn("endtime", F.col("time") + F.col("dt").cast("bigint") * F.col("length"))
    narrow = ended.select("run_id", "peak_id", "time", "endtime", "length", "dt", *columns)
    return ev.peak_index(intervals.containment_join(narrow, events, slab=slab))


@provides("event_area_per_channel", "event_basics", "peaks")
def make_event_area_per_channel(rows: DataFrame, waves: DataFrame, slab: int = SLAB_NS) -> DataFrame:
    return ev.event_area_per_channel(rows, _in_events(rows, waves, ("area_per_channel",), slab))


@provides("event_n_channel", "event_area_per_channel")
def make_event_n_channel(rows: DataFrame) -> DataFrame:
    return rows.select("run_id", "event_number", "time", "endtime", "s1_n_channels")


@provides("event_waveform", "event_basics", "peaks")
def make_event_waveform(rows: DataFrame, waves: DataFrame, slab: int = SLAB_NS) -> DataFrame:
    return ev.event_waveform(rows, _in_events(rows, waves, ("data",), slab))


@provides("records_led", "raw_records")
def make_records_led(raw: DataFrame, n_records: int = 2, baseline_window=(0, 50)) -> DataFrame:
    return records.led_pulses(raw, n_records, baseline_window)


@provides("led_calibration", "records_led")
def make_led(rows: DataFrame, led_window=(80, 110), noise_window=(0, 10)) -> DataFrame:
    return records.led_calibration(rows, led_window, noise_window)
