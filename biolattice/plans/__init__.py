"""Named queries over the survey tables; each may carry SQL that gives the same rows."""
from .registry import REGISTRY, all_queries, all_sql

__all__ = ["REGISTRY", "all_queries", "all_sql"]
