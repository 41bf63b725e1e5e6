"""Registered queries (``QUERIES``) and their DuckDB oracles (``ORACLES``)."""

from . import q_align, q_cluster, q_funcs, q_io, q_select, q_shelf, q_stats, q_view  # noqa: F401  (register queries)
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
