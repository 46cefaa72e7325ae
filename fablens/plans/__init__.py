"""Registered queries: each binds an operator to the shared tables, with its check."""

from fablens.plans import drivers, growing, intake, kpis, learned, live, planted, profiles, ranking, risk, timeline, upkeep, validation, warehouse  # noqa: F401
from fablens.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
