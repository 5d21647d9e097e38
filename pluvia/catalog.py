"""Queries and SQL oracles of the engine's own operators."""

from .plans import blend  # noqa: F401  registers the blend's queries
from .plans.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
