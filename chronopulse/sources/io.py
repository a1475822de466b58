"""Readers, writers and inventories. Paths go to Spark's readers only, so any store works that Spark can read."""

from __future__ import annotations

import hashlib
import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import run_key as run_key
from ..schemas import FRAGMENT, RUN_DOCUMENT


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder under the one that the cluster names in spark.checkpoint.dir. Where it is unset, a temporary one
    serves local sessions only: executors of a cluster could not read each other's files there."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{(root or tempfile.mkdtemp(prefix='spark-')).rstrip('/')}/table-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read again: lost executors cost no recomputation of its lineage, and what is
    used several times is computed once."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_fragments(spark: SparkSession, path: str) -> DataFrame:
    """Fragments under run_id=/chunk_i=/kind= folders; only the partitions a filter asks for are read. Not sorted."""
    return spark.read.schema(FRAGMENT).parquet(path)


def concat_chunks(fragments: DataFrame) -> DataFrame:
    """Central parts and both side parts in one; what overlapping parts both hold is kept once."""
    return fragments.dropDuplicates(["run_id", "channel", "time", "record_i"])


def read_run_docs(spark: SparkSession, path: str, fields: list[str] | None = None, number: int | None = None, prefix: str = "") -> DataFrame:
    """Run documents (JSON lines); fields may be nested paths. An absent mode becomes empty.

    prefix stands before the names of some acquisition settings in the files (output_path, fragment_payload_bytes,
    chunk_length, chunk_overlap) and is taken off.
    """
    settings = RUN_DOCUMENT["daq_config"].dataType
    named = ("output_path", "fragment_payload_bytes", "chunk_length", "chunk_overlap")
    stored = T.StructType([T.StructField(prefix + f.name if f.name in named else f.name, f.dataType) for f in settings])
    schema = T.StructType([T.StructField(f.name, stored) if f.name == "daq_config" else f for f in RUN_DOCUMENT])
    docs = spark.read.schema(schema).json(path)
    docs = docs.withColumns({"mode": F.coalesce("mode", F.lit("")), "daq_config": F.col("daq_config").cast(settings)})
    if number is not None:
        docs = docs.where(F.col("number") == number)
    return docs.select(*[F.col(f).alias(f.replace(".", "_")) for f in fields]) if fields else docs


def read_corrections(spark: SparkSession, path: str) -> DataFrame:
    """(file, position, range, value) of correction files {run range: value}; position is the key's place in its file."""
    text = spark.read.text(path, wholetext=True).withColumn("file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    parsed = text.select("file", F.from_json("value", "map<string,string>").alias("m"))
    return parsed.select("file", F.posexplode(F.map_entries("m")).alias("position", "e")).select(
        "file", "position", F.col("e.key").alias("range"), F.col("e.value").alias("value")
    )


def read_correction_index(spark: SparkSession, path: str) -> DataFrame:
    """(name, file, value) of a global index {name: file name or value}; nulls are skipped."""
    rows = read_corrections(spark, path).where("value is not null")
    is_file = F.endswith("value", F.lit(".json"))
    return rows.select(F.col("range").alias("name"), F.when(is_file, F.col("value")).alias("file"), F.when(~is_file, F.col("value")).alias("value"))


def read_run_list(spark: SparkSession, path: str) -> DataFrame:
    """(run_id): one run a line, as six digits; blank lines are skipped."""
    lines = spark.read.text(path).select(F.trim("value").alias("v")).where("v <> ''")
    return lines.select(run_key(F.col("v").cast("int")).alias("run_id"))


def read_measurements(spark: SparkSession, path: str, runs: DataFrame | None = None) -> DataFrame:
    """The lab book CSV (run, notes), with the runs' columns if given (number = run)."""
    book = spark.read.schema("run int, notes string").csv(path, header=True)
    return book if runs is None else book.join(runs, book["run"] == runs["number"], "left")


def config_hash(config: dict) -> str:
    return hashlib.sha1(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()[:10]


def write_dataset(df: DataFrame, root: str, data_type: str, config: dict) -> str:
    """Writes a data type under root/<type>-<config hash>, partitioned by run, zstd; returns the path.

    Only the runs present in df are replaced.
    """
    path = f"{root.rstrip('/')}/{data_type}-{config_hash(config)}"
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    writer.partitionBy("run_id").parquet(path)
    return path


def write_bucketed(df: DataFrame, table: str, buckets: int, keys: tuple[str, ...] = ("run_id", "peak_id")) -> DataFrame:
    """Writes a table of the catalogue in `buckets` files by keys, sorted within, and reads it: types that are stored by
    the same keys and number of buckets (peaks, basics, positions, ...) meet without a shuffle. Replaces the table."""
    spread = df.repartition(buckets, *keys)  # one file a bucket
    spread.write.mode("overwrite").format("parquet").option("compression", "zstd").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return df.sparkSession.table(table)


def missing_runs(wanted: DataFrame, stored: DataFrame) -> DataFrame:
    """Runs of `wanted` that `stored` has no row of."""
    return wanted.join(stored.select("run_id").distinct(), "run_id", "left_anti")


def dataset_inventory(df: DataFrame) -> DataFrame:
    """(run_id, data_type, n_files, mb) of a DataFrame read from files under <type>-<hash>/run_id=<run>/."""
    name = F.col("_metadata.file_path")
    files = df.select(name.alias("file"), F.col("_metadata.file_size").alias("size")).distinct()
    run = F.regexp_extract("file", r"run_id=([^/]+)", 1)
    kind = F.regexp_extract("file", r"/([^/]+)-[0-9a-f]{10}/", 1)
    return files.groupBy(run.alias("run_id"), kind.alias("data_type")).agg(F.count("*").alias("n_files"), (F.sum("size") / 1e6).alias("mb"))


def file_inventory(df: DataFrame) -> DataFrame:
    """(file, n_rows, size) of the files that a DataFrame is read from."""
    return df.groupBy(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), F.col("_metadata.file_size").alias("size")).agg(
        F.count("*").alias("n_rows")
    )
