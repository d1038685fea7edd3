"""All named queries."""

from __future__ import annotations

from chorale.plans import graph_queries, job_queries, report_queries, stream_queries, text_queries  # noqa: F401
from chorale.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
