"""Registered queries: each operator on the given tables, with its SQL counterpart."""

from floe.queries import aggregates, cellwise, joins, jobs, learning, sources, timeline, whole_product, windows  # noqa: F401
from floe.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
