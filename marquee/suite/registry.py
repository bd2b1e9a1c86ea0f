"""Registered queries with the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import use_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, wide: Sequence[str] = ()):
    """Registers a query; ``wide`` columns are returned as 64-bit integers."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            rows = build(use_utc(spark), sf_dir)
            return rows.withColumns({c: F.col(c).cast("bigint") for c in wide}) if wide else rows

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def us(column: str | Column) -> Column:
    """Timestamps leave a query as whole microseconds."""
    return F.unix_micros(column)


def iso(column: str | Column) -> Column:
    """Dates leave a query as text."""
    return F.date_format(column, "yyyy-MM-dd")


def rnd(column: str | Column, digits: int = 6) -> Column:
    return F.round(F.col(column) if isinstance(column, str) else column, digits)


def big(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("bigint")
