"""The registered queries: every operator over the given tables, each next to its SQL."""

from workload import history, scalars, tables, recipes  # noqa: F401  (registers the queries)
from workload.registry import QUERIES

__all__ = ["QUERIES"]
