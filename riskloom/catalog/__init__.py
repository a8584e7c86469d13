"""All registered queries."""

from riskloom.catalog import (  # noqa: F401
    analytics_queries,
    feature_queries,
    ingest_queries,
    ops_queries,
    quality_queries,
    stream_queries,
    zones,
)
from riskloom.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
