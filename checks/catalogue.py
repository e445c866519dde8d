"""All registered queries."""

from checks import documents, marts, relational, reports, storage  # noqa: F401
from checks.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
