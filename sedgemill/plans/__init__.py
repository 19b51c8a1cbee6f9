"""Queries over the given tables and the SQL that states their results."""

from . import (  # noqa: F401
    archive_queries, feed_queries, function_queries, html_queries, merge_queries, profile_queries, reconcile_queries,
)
from .registry import PLANS, SQL

__all__ = ["PLANS", "SQL"]
