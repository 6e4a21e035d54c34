"""Every operator as a named query over the test tables."""

from mandiscope.catalog import analysis, cleaning, extraction, store  # noqa: F401
from mandiscope.catalog.registry import QUERIES, Query

__all__ = ["QUERIES", "Query"]
