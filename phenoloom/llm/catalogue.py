"""All queries and SQL of the subpackage, the corpus pipeline included."""

from phenoloom.llm import queries  # noqa: F401
from phenoloom.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
