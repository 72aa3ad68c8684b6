"""Every registered query."""

from cdcflow.plans import cell_queries, log_queries, node_queries, stream_queries, table_queries, text_queries  # noqa: F401
from cdcflow.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
