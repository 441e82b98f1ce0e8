"""Named queries over the given tables."""

from weftline.plans import (  # noqa: F401  (importing registers the queries)
    aggregating,
    changing,
    joining,
    modelling,
    reading,
    shaping,
    streams,
)
from weftline.plans.registry import all_queries, all_sql

__all__ = ["all_queries", "all_sql"]
