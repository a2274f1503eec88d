"""Registered queries. Importing this package registers every query."""

from nestfold.plans import bundle_queries, flatten_queries, stream_queries, table_queries, text_queries  # noqa: F401
from nestfold.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
