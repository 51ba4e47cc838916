"""All registered queries, by importing the modules that register them."""

from grantlake.plans import queries_flatten, queries_policy, queries_sources, queries_state, queries_tables
from grantlake.plans.registry import QUERIES, SQL

__all__ = [
    "QUERIES",
    "SQL",
    "queries_flatten",
    "queries_policy",
    "queries_sources",
    "queries_state",
    "queries_tables",
]
