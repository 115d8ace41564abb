"""All queries and their SQL, gathered from the parts of the catalogue."""

from phenoloom.plans import queries_assoc, queries_cohort, queries_eval, queries_facts, queries_learn  # noqa: F401
from phenoloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
