"""All named queries. Importing the query modules registers them."""

from __future__ import annotations

from msgflow.plans import (  # noqa: F401
    boundary_queries,
    capture_queries,
    handler_queries,
    message_queries,
    sink_queries,
    stream_queries,
    stream_state_queries,
    window_queries,
)
from msgflow.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
