"""Queries over the driver's tables, by name."""

from attestry.plans import row_queries
from attestry.plans.queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "row_queries"]
