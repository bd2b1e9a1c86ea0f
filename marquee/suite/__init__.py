"""The registered queries."""

from marquee.suite import (  # noqa: F401
    audience_queries,
    feature_queries,
    firstview_queries,
    launch_queries,
    learning_queries,
    matrix_queries,
    relational_queries,
    scalar_queries,
)
from marquee.suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
