"""Operators for training-data pipelines. Nothing else in the library imports them."""

from marquee.llm import queries  # noqa: F401
from marquee.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
