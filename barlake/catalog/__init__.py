"""Named queries over the driver tables, each with its DuckDB oracle text."""

from . import (feature_queries, indicator_queries, io_queries, parse_queries,  # noqa: F401  (register)
               ml_queries, profile_queries, relational_queries, series_queries, stream_queries)
from .registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
