"""The library run on the supplied test tables, next to the same questions in SQL."""

from verification import aggregates, columns, flows, plans  # noqa: F401  (each registers its queries)
from verification.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
