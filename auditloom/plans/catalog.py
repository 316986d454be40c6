"""All registered queries and their oracle SQL."""

from __future__ import annotations

from auditloom.plans import ledger_queries, measure_queries, project_queries, retrieval_queries, scan_queries, study_queries  # noqa: F401
from auditloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
