"""The query catalogue: ``QUERIES`` (Spark) and ``ORACLES`` (DuckDB), by name."""

from __future__ import annotations

from tamarack.plans import corpus, evaluation, ledger, verification  # noqa: F401  registering their queries
from tamarack.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
