"""Incremental batch runs: how far each job got, and rebuilding the unfinished tail."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.sources.files import replace_partitions

STATE_SCHEMA = "job string, platform string, nday int, last_update_date date"


def high_water(recorded: DataFrame, keys: Sequence[str], updated: str) -> DataFrame:
    """Last recorded date per key, in one aggregate for all platforms and days."""
    return recorded.groupBy(*keys).agg(F.max(F.to_date(updated)).alias("last_update_date"))


def due(planned: DataFrame, marks: DataFrame, keys: Sequence[str], end_date: str) -> DataFrame:
    """Planned keys never run, or last run before the end date."""
    end = F.lit(end_date).cast("date")
    return planned.join(marks, list(keys), "left").where(
        F.col("last_update_date").isNull() | (F.col("last_update_date") < end)
    )


def record_empty_run(
    spark: SparkSession, path: str, job: str, platform: str, nday: int, end_date: str
) -> None:
    """A run that found nothing still moves the mark."""
    row = spark.range(1).select(
        F.lit(job).alias("job"),
        F.lit(platform).alias("platform"),
        F.lit(nday).alias("nday"),
        F.lit(end_date).cast("date").alias("last_update_date"),
    )
    row.write.mode("append").parquet(path)


def missing_dates(recorded: DataFrame, date: str, calendar: DataFrame) -> DataFrame:
    """Calendar days without a row in the table."""
    return calendar.join(
        recorded.select(F.col(date).alias("seq_date")).distinct(), "seq_date", "left_anti"
    )


def rebuild_tail(
    spark: SparkSession,
    path: str,
    partition: str,
    build: Callable[[str, str], DataFrame],
    end_date: str,
    days: int = 28,
) -> DataFrame:
    """Rebuilds the partitions from ``days`` before the newest one up to ``end_date``.

    ``build(first, last)`` returns the rows of those dates in one job. Only their
    partitions are replaced, so older ones keep their files.
    """
    newest = spark.read.parquet(path).agg(F.max(F.to_date(partition)).alias("d")).first()["d"]
    if newest is None:
        raise ValueError(f"nothing recorded under {path}")
    first = spark.range(1).select(F.date_sub(F.lit(newest), days).cast("string")).first()[0]
    replace_partitions(build(first, end_date), path, [partition])
    return spark.read.parquet(path)
