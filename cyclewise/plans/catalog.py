"""All registered queries."""

from __future__ import annotations

from cyclewise.plans import (  # noqa: F401
    feature_queries,
    fleet_queries,
    metric_queries,
    model_queries,
    panel_queries,
    quality_queries,
    store_queries,
    stream_queries,
)
from cyclewise.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
