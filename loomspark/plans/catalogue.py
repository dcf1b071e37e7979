"""All registered queries."""

from __future__ import annotations

from loomspark.plans import interval_queries, manifest_queries, numeric_queries, preparation_queries, text_queries  # noqa: F401
from loomspark.plans.registry import ORACLES, QUERIES, register

__all__ = ["ORACLES", "QUERIES", "register"]
