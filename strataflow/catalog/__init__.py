"""The registered queries and their oracle SQL, by area."""

from __future__ import annotations

from strataflow.catalog import (  # noqa: F401  (importing an area registers its queries)
    aggregates,
    changes,
    cleaning,
    event_time,
    facts,
    landing,
    metrics,
    ordered,
    panels,
    quality,
    ranges,
    storage,
    streams,
)
from strataflow.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
