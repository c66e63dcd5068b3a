"""Every named query; importing this module fills the registry."""

from larder.plans import (  # noqa: F401
    views,
    drift_queries,
    feature_queries,
    forecast_queries,
    quality_queries,
    sales_queries,
    storage_queries,
)
from larder.plans.registry import QUERIES, Query, Workspace, add_forest_reports

add_forest_reports()

__all__ = ["QUERIES", "Query", "Workspace"]
