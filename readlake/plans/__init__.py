"""Registered queries over the given tables."""

from . import file_queries, interval_queries, pileup_queries, qc_queries, read_queries, source_queries, stat_queries, tracking_queries, variant_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
