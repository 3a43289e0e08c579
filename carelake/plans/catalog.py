"""All registered queries. Importing the query modules fills the registry."""

from carelake.plans import (  # noqa: F401
    batch_queries,
    daily_queries,
    governance_queries,
    history_queries,
    layout_queries,
    ops_queries,
    source_queries,
    stream_queries,
)
from carelake.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
