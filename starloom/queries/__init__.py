"""All registered queries."""

from starloom.queries import cleaning, loading, lookups, mapping, operations, sources, stores, targets, windows  # noqa: F401
from starloom.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
