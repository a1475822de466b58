"""What a user calls by name: data types with their parents, and analyses over selected data."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame

from ..operators.filters import select_time


@dataclass(frozen=True)
class DataType:
    """A data type, the types it is made from, and the function that makes it: f(*parents, **options)."""

    name: str
    parents: tuple[str, ...]
    make: Callable[..., DataFrame]


DATA_TYPES: dict[str, DataType] = {}


def provides(name: str, *parents: str):
    def add(f):
        DATA_TYPES[name] = DataType(name, parents, f)
        return f

    return add


def build(name: str, given: dict[str, DataFrame], options: dict[str, dict] | None = None, keep: Callable[[str, DataFrame], DataFrame] | None = None) -> DataFrame:
    """The data type, made from what is given; what lies between is made on the way, each type once.

    keep(name, df) is what becomes of each type made, e.g. its cache or the table it is written to and read from again.
    Types that several others are made from (records, peaks, event_basics) are computed once only if they are kept.
    """
    if name not in given:
        kind = DATA_TYPES[name]
        parents = [build(p, given, options, keep) for p in kind.parents]
        made = kind.make(*parents, **(options or {}).get(name, {}))
        given[name] = keep(name, made) if keep else made
    return given[name]


def analysis(*requires: str):
    """Decorates f(*frames, **kw): called with a dict of frames and time selection keywords (see select_time)."""
    selection = ("time_range", "seconds_range", "time_within", "mode", "predicate", "run_start", "warn_beyond_sec")

    def wrap(f):
        @wraps(f)
        def call(frames: dict[str, DataFrame], **kw):
            ranges = {k: kw.pop(k) for k in selection if k in kw}
            return f(*[select_time(build(r, frames), **ranges) for r in requires], **kw)

        return call

    return wrap
