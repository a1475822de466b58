"""The run catalogue: selecting, auditing and updating runs; corrections by run range."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import run_range


def has_data(host: str | None = None, kind: str | None = None, entries: str = "data") -> Column:
    """Whether a run document holds a data entry of a host and type; null or empty data: no."""

    def fits(d: Column) -> Column:
        out = F.lit(True)
        if host is not None:
            out &= d["host"] == host
        if kind is not None:
            out &= d["type"] == kind
        return out

    return F.coalesce(F.exists(entries, fits), F.lit(False))


def has_tag(name: str) -> Column:
    return F.coalesce(F.exists("tags", lambda t: t["name"] == name), F.lit(False))


def runs_with(runs: DataFrame, host=None, kind=None) -> DataFrame:
    return runs.where(has_data(host, kind))


def runs_without(runs: DataFrame, host=None, kind=None) -> DataFrame:
    return runs.where(~has_data(host, kind))


def find_datasets(keys: DataFrame, runs: DataFrame) -> DataFrame:
    """keys (number, type, lineage_hash) with host, location and found of the first matching data entry of the run."""
    entries = runs.select("number", F.posexplode("data").alias("pos", "d"))
    entries = entries.select("number", F.col("d.type").alias("type"), F.col("d.lineage_hash").alias("lineage_hash"), "pos", "d")
    first = entries.groupBy("number", "type", "lineage_hash").agg(F.min_by("d", "pos").alias("d"))
    joined = keys.join(first, ["number", "type", "lineage_hash"], "left")
    return joined.select(*keys.columns, F.col("d.host").alias("host"), F.col("d.location").alias("location"), F.col("d").isNotNull().alias("found"))


def correction_for_run(runs: DataFrame, corrections: DataFrame, missing: str = "error") -> DataFrame:
    """runs (run_id, ...) with value and range of the first correction whose range holds the run.

    corrections (position, range, value): the smallest position wins. The table is a hand-kept file, so it is
    broadcast. A run without correction raises, or gets nulls with missing="null".
    """
    first, last = run_range(F.col("range"))
    table = corrections.select(F.col("position").alias("__p"), F.col("range"), F.col("value"), first.alias("__a"), last.alias("__b"))
    met = runs.select("run_id").distinct().join(F.broadcast(table), (F.col("run_id") >= F.col("__a")) & (F.col("run_id") <= F.col("__b")), "left")
    best = met.groupBy("run_id").agg(F.min_by(F.struct("range", "value"), "__p").alias("__c"))
    value = F.col("__c.value")
    if missing == "error":
        said = F.concat(F.lit("no correction for run "), F.col("run_id"))
        value = F.coalesce(value, F.raise_error(said).cast(dict(corrections.dtypes)["value"]))
    return runs.join(best, "run_id", "left").withColumns({"range": F.col("__c.range"), "value": value}).drop("__c")


def apply_correction_version(runs: DataFrame, index: DataFrame, files: DataFrame) -> DataFrame:
    """One column per name of a global index (name, file, value): a plain value, or the run's value by the named file.

    files (file, position, range, value) holds all correction files; names with neither are left out. All names are
    looked up in one range join of the runs with the files (hand-kept tables, broadcast) and turned into columns by a
    pivot; a name whose files hold no value for a run is null.
    """
    rows = index.where("file is not null or value is not null").collect()  # the hand-kept index of one version: names become columns
    plain = {r["name"]: F.lit(r["value"]) for r in rows if r["file"] is None}
    named = [r["name"] for r in rows if r["file"] is not None]
    if not named:
        return runs.withColumns(plain) if plain else runs
    first, last = run_range(F.col("range"))
    table = files.join(F.broadcast(index.where("file is not null").select("file", "name")), "file")
    table = table.select("name", "position", "value", first.alias("__a"), last.alias("__b"))
    known = runs.select("run_id").distinct()
    met = known.join(F.broadcast(table), (F.col("run_id") >= F.col("__a")) & (F.col("run_id") <= F.col("__b")))
    wide = met.groupBy("run_id").pivot("name", named).agg(F.min_by("value", "position"))
    return runs.join(wide, "run_id", "left").withColumns(plain)


def replica_file_counts(files: DataFrame, hosts: list[str]) -> DataFrame:
    """(run_id, one count per host, safe): files of each run per host; safe if all hosts hold the same number, not 0."""
    counts = files.groupBy("run_id").pivot("host", hosts).agg(F.count(F.lit(1)))
    counts = counts.select("run_id", *[F.coalesce(F.col(f"`{h}`"), F.lit(0)).alias(h) for h in hosts])
    same = reduce(lambda a, b: a & b, [F.col(f"`{h}`") == F.col(f"`{hosts[0]}`") for h in hosts])
    return counts.withColumn("safe", same & (F.col(f"`{hosts[0]}`") > 0))


_RUNNING = ("submitted", "running")


def running_jobs(runs: DataFrame, max_jobs: int = 5) -> DataFrame:
    """One row: running, free (slots left)."""
    n = F.count(F.when(F.col("processing_status.status").isin(*_RUNNING), 1))
    return runs.agg(n.alias("running"), F.greatest(F.lit(max_jobs) - n, F.lit(0)).alias("free"))


def stale_jobs(runs: DataFrame, now: Column, minutes: int = 30) -> DataFrame:
    """Runs submitted or running whose status is older than the limit."""
    old = F.unix_micros(F.col("processing_status.time")) < F.unix_micros(now) - minutes * 60_000_000
    return runs.where(F.col("processing_status.status").isin(*_RUNNING) & old)


def next_runs(runs: DataFrame, most: int, offset: int = 0) -> DataFrame:
    """Newest first: `most` runs after the first `offset`."""
    return runs.orderBy(F.desc("number")).offset(offset).limit(most)


def runs_to_copy(runs: DataFrame, hosts: tuple[str, str], min_number: int = 0, only_primary: bool = False, max_runs: int | None = None, kind: str = "live_data", source: str | None = None) -> DataFrame:
    """Runs whose data are missing on the first host, then on the second (target), each run once, newest first.

    source requires the data to be on that host (the selection this reproduces does not enforce it).
    """
    base = runs.where(F.col("number") >= min_number)
    if source:
        base = base.where(has_data(source, kind))
    parts = [base.where(~has_data(h, kind)).select("number", F.lit(h).alias("target"), F.lit(k).alias("__p")) for k, h in enumerate(hosts[: 1 if only_primary else 2])]
    every = reduce(DataFrame.unionByName, parts)
    once = every.groupBy("number").agg(F.min(F.struct("__p", "target")).alias("__t")).select("number", "__t.target", "__t.__p")
    ordered = once.orderBy("__p", F.desc("number"))
    return (ordered.limit(max_runs) if max_runs is not None else ordered).select("number", "target")


def runs_on_all_hosts(runs: DataFrame, hosts: list[str], kind: str = "live_data", abandoned_tag: str = "abandon") -> DataFrame:
    """Runs whose entries of a type cover all hosts, and abandoned ones."""
    covered = reduce(lambda a, b: a & b, [has_data(h, kind) for h in hosts])
    return runs.where(covered | has_tag(abandoned_tag))


def runs_to_process(runs: DataFrame, since: Column, min_number: int = 0, max_failures: int = 3, live: str = "live_data", raw: str = "raw_records", tag: str = "process") -> DataFrame:
    """Runs with live data that have no raw output yet, did not fail too often, are not running or abandoned, are
    recent and of a sufficient number; or that carry the tag."""
    usual = (
        ~has_data(None, raw)
        & (F.coalesce("processing_failed", F.lit(0)) <= max_failures)
        & ~F.coalesce(F.col("processing_status.status").isin(*_RUNNING), F.lit(False))
        & ~has_tag("abandon")
        & F.coalesce(F.col("start") >= since, F.lit(False))
        & (F.col("number") >= min_number)
    )
    return runs.where(has_data(None, live) & (usual | has_tag(tag)))


_ENTRY_KEY = ("number", "type", "location", "lineage_hash")


def add_data_entries(existing: DataFrame, new: DataFrame) -> DataFrame:
    """existing with the new entries whose (run, type, location, lineage) it lacks; entries given twice come once."""
    cond = reduce(lambda a, b: a & b, [F.col(f"n.{k}").eqNullSafe(F.col(f"e.{k}")) for k in _ENTRY_KEY])
    fresh = new.dropDuplicates(list(_ENTRY_KEY)).alias("n").join(existing.select(*_ENTRY_KEY).alias("e"), cond, "left_anti")
    return existing.unionByName(fresh)


def archive_entries(entries: DataFrame, removed: DataFrame, at: Column, by: str) -> tuple[DataFrame, DataFrame]:
    """(remaining, deleted): entries without those removed, and those, with deleted_at and deleted_by."""
    cond = reduce(lambda a, b: a & b, [F.col(f"e.{k}").eqNullSafe(F.col(f"r.{k}")) for k in _ENTRY_KEY])
    keys = removed.select(*_ENTRY_KEY).distinct().alias("r")
    gone = entries.alias("e").join(keys, cond, "left_semi")
    return entries.alias("e").join(keys, cond, "left_anti"), gone.withColumns({"deleted_at": at, "deleted_by": F.lit(by)})


def apply_status_updates(runs: DataFrame, updates: DataFrame, production: bool = True) -> DataFrame:
    """runs with all updates of each run applied in the order of their times: updates (number, status, time, host,
    reason, add_tag, remove_tag).

    The last update gives the status. Every update first pulls all tags of the name remove_tag, then appends add_tag;
    so a tag that was pulled comes back if a later update adds it. processing_failed grows by the number of updates with
    a reason. Updates of one time go by status, host, reason and tags. A run without updates stays as it is; updates of
    unknown runs are ignored. Not in production, only the changed rows return.
    """
    fields = ("time", "status", "host", "reason", "add_tag", "remove_tag")
    per = updates.groupBy("number").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("__u"))
    joined = runs.join(per, "number", "left" if production else "inner")
    touched, last = F.col("__u").isNotNull(), F.element_at("__u", -1)
    old, kind = F.col("processing_status"), dict(runs.dtypes)["tags"]
    status = F.struct(*[F.when(touched, last[c]).otherwise(old[c]).alias(c) for c in ("status", "host", "reason", "time")])

    def step(tags: Column, u: Column) -> Column:
        left = F.filter(tags, lambda t: ~F.coalesce(t["name"] == u["remove_tag"], F.lit(False)))
        made = F.struct(u["add_tag"].alias("name"), F.lit(None).cast("string").alias("user"), u["time"].alias("time"))
        return F.when(u["add_tag"].isNotNull(), F.concat(left, F.array(made).cast(kind))).otherwise(left)

    tags = F.aggregate("__u", F.coalesce("tags", F.array().cast(kind)), step)
    failures = F.size(F.filter("__u", lambda u: u["reason"].isNotNull()))
    failed = F.coalesce("processing_failed", F.lit(0)) + failures
    out = {"processing_status": status, "processing_failed": F.when(touched, failed).otherwise(F.col("processing_failed")), "tags": F.when(touched, tags).otherwise(F.col("tags"))}
    return joined.withColumns(out).select(*runs.columns)


def run_targets(runs: DataFrame, targets=("peak_basics", "event_info"), led_targets=("led_calibration",)) -> DataFrame:
    """(number, targets): by mode; led calibration runs have their own, _nai runs also the external detector's peaks."""
    usual = F.lit(list(targets))
    mode = F.coalesce("mode", F.lit(""))
    chosen = F.when(mode.contains("_nai"), F.array_union(usual, F.array(F.lit("peak_basics_ext")))).otherwise(usual)
    return runs.select("number", F.when(mode.contains("ledcalibration"), F.lit(list(led_targets))).otherwise(chosen).alias("targets"))


def run_duration(runs: DataFrame, start_ms: str = "start_ms", end_ms: str = "end_ms") -> DataFrame:
    """Adds start, end and duration (seconds) from epoch milliseconds."""
    return runs.withColumns(
        {"start": F.timestamp_millis(start_ms), "end": F.timestamp_millis(end_ms), "duration": (F.col(end_ms) - F.col(start_ms)) / 1000}
    )


def daq_settings(docs: DataFrame) -> DataFrame:
    """Per run: record_length (payload bytes DIV 2), chunk and overlap in ns, start in epoch seconds, reader threads."""
    c = F.col("daq_config")
    ns = lambda x: (x * 1_000_000_000).cast("bigint")
    return docs.select(
        "number",
        F.call_function("div", c["fragment_payload_bytes"], F.lit(2)).cast("int").alias("record_length"),
        ns(c["chunk_length"]).alias("chunk_ns"),
        ns(c["chunk_overlap"]).alias("overlap_ns"),
        F.unix_seconds("start").alias("start_s"),
        c["processing_threads"].alias("threads"),
    )


def chunk_completeness(files: DataFrame, expected: DataFrame) -> DataFrame:
    """(run_id, chunk_i, ready and flags) from files (run_id, chunk_i, kind, thread) and expected (thread, n).

    A part (pre, central, post) is complete if every expected thread wrote its n files; unknown threads and too many
    files are flagged. A chunk is ready if its central part is, and both sides are, or it is the first chunk and post
    is, or it is the last chunk and pre is.
    """
    counts = files.groupBy("run_id", "chunk_i", "kind", "thread").agg(F.count("*").alias("got"))
    parts = files.select("run_id", "chunk_i", "kind").distinct()
    asked = F.broadcast(expected.select("thread", F.col("n").alias("want")))  # one row per reader thread
    threads = [r["thread"] for r in expected.select("thread").collect()]
    grid = parts.withColumn("thread", F.explode(F.lit(threads))).join(asked, "thread")
    full = grid.join(counts, ["run_id", "chunk_i", "kind", "thread"], "full")
    state = full.groupBy("run_id", "chunk_i", "kind").agg(
        F.max(F.col("want").isNull()).alias("unknown"),
        F.max(F.coalesce(F.col("got") > F.col("want"), F.lit(False))).alias("too_many"),
        F.min(F.coalesce(F.coalesce("got", F.lit(0)) >= F.col("want"), F.lit(True))).alias("complete"),
    )
    chunk = state.groupBy("run_id", "chunk_i").agg(
        *[F.coalesce(F.max(F.when(F.col("kind") == k, F.col("complete"))), F.lit(False)).alias(k) for k in ("pre", "central", "post")],
        F.max("unknown").alias("unknown"),
        F.max("too_many").alias("too_many"),
    )
    order = Window.partitionBy("run_id").orderBy("chunk_i")
    first, last = F.lag("chunk_i").over(order).isNull(), F.lead("chunk_i").over(order).isNull()
    chunk = chunk.withColumns({"first": first, "last": last})
    ready = F.col("central") & ((F.col("pre") & F.col("post")) | (F.col("first") & F.col("post")) | (F.col("last") & F.col("pre")))
    return chunk.withColumn("ready", ready)
