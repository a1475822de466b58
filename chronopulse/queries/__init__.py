"""Registered queries: the library's operators over the supplied tables, with the same result as SQL."""

from . import aggregations, catalog, filters, functions, joins, streams, windows  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
