"""Imports every module that registers queries."""

from recogna.plans import allocation_queries, base_queries, contract_queries, journal_queries, report_queries, schedule_queries  # noqa: F401
from recogna.plans.registry import COVERS, ORACLES, QUERIES  # noqa: F401
