"""Registered queries and their SQL oracles."""

from tidewater.plans.oracle import ORACLE_SQL
from tidewater.plans.queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
