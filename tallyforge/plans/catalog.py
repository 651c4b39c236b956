"""All registered queries and oracles."""

from __future__ import annotations

from . import cohort_queries, journal_queries  # noqa: F401  these register their queries
from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
