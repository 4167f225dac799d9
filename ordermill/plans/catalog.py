"""All registered queries."""

from ordermill.plans import customer_queries, sales_queries, scoring_queries, stream_queries  # noqa: F401
from ordermill.plans.registry import REGISTRY, run

__all__ = ["REGISTRY", "run"]
