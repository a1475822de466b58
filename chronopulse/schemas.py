"""Declared schemas and configuration.

Times are longs in ticks of a nanosecond (the operators don't care about the unit). Missing values are null;
with_sentinels() turns them into -1 and NaN for consumers that want those.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Default length of a slab of time, the unit of work that a task takes from a run: ten seconds of nanosecond ticks.
SLAB_NS = 10_000_000_000


def _schema(ddl: str) -> T.StructType:
    fields = []
    kinds = {
        "long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "double": T.DoubleType(),
        "float": T.FloatType(), "timestamp": T.TimestampType(), "shorts": T.ArrayType(T.ShortType()),
        "ints": T.ArrayType(T.IntegerType()), "floats": T.ArrayType(T.FloatType()),
    }
    for part in ddl.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, kinds[kind]))
    return T.StructType(fields)


#: Fixed-length waveform fragments as acquired; kind is pre, central or post.
FRAGMENT = _schema(
    "run_id string, chunk_i int, kind string, thread string, time long, length int, dt int, channel int, "
    "pulse_length int, record_i int, baseline int, data shorts"
)
HIT = _schema("run_id string, time long, endtime long, channel int, area double, height double")
EVENT = _schema("run_id string, event_number long, time long, endtime long")

_ENTRY = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("type", "host", "location", "by", "user", "lineage_hash", "corrections_version")]
    + [T.StructField("time", T.TimestampType()), T.StructField("n_chunks", T.IntegerType()), T.StructField("size_mb", T.DoubleType())]
)
RUN_DOCUMENT = T.StructType(
    [
        T.StructField("number", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("mode", T.StringType()),
        T.StructField("user", T.StringType()),
        T.StructField("comments", T.StringType()),
        T.StructField("start", T.TimestampType()),
        T.StructField("end", T.TimestampType()),
        T.StructField("livetime", T.DoubleType()),
        T.StructField("processing_failed", T.IntegerType()),
        T.StructField(
            "processing_status",
            T.StructType([T.StructField(n, T.StringType()) for n in ("status", "host", "reason")] + [T.StructField("time", T.TimestampType())]),
        ),
        T.StructField(
            "tags",
            T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("user", T.StringType()), T.StructField("time", T.TimestampType())])),
        ),
        T.StructField("data", T.ArrayType(_ENTRY)),
        T.StructField(
            "daq_config",
            T.StructType(
                [
                    T.StructField("output_path", T.StringType()),
                    T.StructField("processing_threads", T.MapType(T.StringType(), T.IntegerType())),
                    T.StructField("registers", T.ArrayType(T.StructType([T.StructField("reg", T.StringType()), T.StructField("val", T.StringType())]))),
                    T.StructField("fragment_payload_bytes", T.IntegerType()),
                    T.StructField("chunk_length", T.DoubleType()),
                    T.StructField("chunk_overlap", T.DoubleType()),
                    T.StructField("compressor", T.StringType()),
                ]
            ),
        ),
    ]
)

#: name -> (first channel, last channel), inclusive.
CHANNEL_MAP = {"bottom": (0, 0), "top": (1, 4), "external": (5, 5), "sipm": (6, 6)}
DEAD_TIME_CHANNEL = 799


@dataclass(frozen=True)
class PeakConfig:
    """Limits of the peak classes; the auxiliary detectors only use areas and widths."""

    s1_min_area: float = 10.0
    s1_min_width: float = 10.0
    s1_max_width: float = 225.0
    s1_max_aft: float = 0.2
    s1_min_channels: int = 5
    s2_min_area: float = 10.0
    s2_min_width: float = 225.0
    s2_min_aft: float = 0.0
    s2_min_channels: int = 5


@dataclass(frozen=True)
class EventConfig:
    """Event building and event basics. drift_time_max follows from the drift length (cm) and velocity (cm/ns)."""

    left_extension: int = 500_000
    right_extension: int = 50_000
    trigger_min_area: float = 10.0
    max_drift_length: float = 10.0
    drift_velocity: float = 1.6e-6
    allow_posts2_s1s: bool = False
    s1_min_coincidence: int = 0
    force_alt_s2_in_max_drift_time: bool = True
    force_main_before_alt: bool = False

    @property
    def drift_time_max(self) -> int:
        return int(self.max_drift_length / self.drift_velocity)


@dataclass(frozen=True)
class Corrections:
    """Electron lifetime (ns) and the light-yield line (z_min, z_max, y0, slope) of the corrected areas."""

    elife: float = 30_000.0
    s1_z: tuple[float, float, float, float] = field(default=(-52.0, 0.0, 700.0, -7.69))


def with_sentinels(df: DataFrame) -> DataFrame:
    """Nulls as -1 in integer columns and NaN in floating ones."""
    out = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.LongType, T.IntegerType, T.ShortType)):
            out[f.name] = F.coalesce(f.name, F.lit(-1).cast(f.dataType))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out[f.name] = F.coalesce(f.name, F.lit(float("nan")).cast(f.dataType))
    return df.withColumns(out) if out else df
