"""Queries over the driver's tables, each with the SQL that checks it."""

from workload import columns, continued, flows, graph, streams  # noqa: F401  (register the queries)
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
