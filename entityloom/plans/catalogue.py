"""All registered queries and the SQL to check them by."""

from __future__ import annotations

# Importing these registers their queries, the simplest first.
from entityloom.plans import (  # noqa: F401, I001
    join_queries,
    type_queries,
    entity_queries,
    customer_queries,
)
from entityloom.plans.registry import QUERIES, SCHEMAS, SQL

__all__ = ["QUERIES", "SCHEMAS", "SQL"]
