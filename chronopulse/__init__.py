"""Spark jobs for time-domain detector data."""

__version__ = "0.1.0"
