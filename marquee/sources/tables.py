"""Reading warehouse tables: declared schemas, pruned columns, pushed filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(
    spark: SparkSession,
    path: str,
    schema: str | None = None,
    columns: Sequence[str] | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Parquet scan. Columns and filter are applied so that both reach the reader."""
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


@dataclass(frozen=True)
class ViewershipSource:
    """One platform's viewing table and the first moment it is trusted from."""

    path: str
    floor: str
    schema: str | None = None
    where: str | None = None


def viewership(
    spark: SparkSession, platform: str, sources: Mapping[str, ViewershipSource], time: str
) -> DataFrame:
    """Viewing stream of a platform; the floor is a literal, so files can be skipped."""
    source = sources[platform]
    condition = F.col(time) >= F.lit(source.floor).cast("timestamp")
    if source.where:
        condition = F.expr(source.where) & condition
    return scan(spark, source.path, source.schema, where=condition)


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day, both ends included."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return spark.range(1).select(F.explode(days).alias("seq_date"))


def sample_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """A look at a table; which rows come back is not defined."""
    return df.limit(n)
