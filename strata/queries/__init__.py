"""Example queries over the sample tables, each with the SQL that gives the same rows."""

from strata.queries import commits, gold, landing, runs, silver, stream
from strata.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "commits", "gold", "landing", "runs", "silver", "stream"]
