"""All registered queries of the time-series engine and their DuckDB equivalents."""

from __future__ import annotations

from . import queries_core, queries_flow, queries_io, queries_model, queries_stream  # noqa: F401  they register themselves
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
