"""All registered queries and their oracle SQL."""

from __future__ import annotations

from casebook.plans import file_queries, graph_queries, scalar_queries, table_queries  # noqa: F401
from casebook.plans.registry import QUERIES, SQL  # noqa: F401
