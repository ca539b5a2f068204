"""Registered queries: every operator run over whole driver tables."""

from flowtable.plans import (  # noqa: F401  (modules register their queries)
    catalog_queries,
    column_queries,
    listing_queries,
    raster_queries,
    routing_queries,
    scoring_queries,
    stage_queries,
    stream_queries,
    sync_queries,
    text_queries,
)
from flowtable.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
