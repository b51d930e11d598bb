"""Registered queries: each one on Spark, and as SQL for another engine to check."""

from roadpulse.registry import (columns, flow_queries, lake_queries, landing_queries,
                                station_queries, trip_queries)  # noqa: F401
from roadpulse.registry.book import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
