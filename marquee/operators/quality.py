"""Data checks and the run log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

RUN_LOG_SCHEMA = (
    "job string, step string, status string, row_count bigint, null_keys bigint, "
    "started_at timestamp, elapsed_seconds double"
)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def check_rules(df: DataFrame, rules: Mapping[str, Column], keys: Sequence[str]) -> DataFrame:
    """Violations per rule in one pass, plus the number of surplus rows per key."""
    sums = [F.sum(F.when(bad, 1).otherwise(0)).alias(name) for name, bad in rules.items()]
    flat = df.agg(*sums)
    pairs = F.array(
        *[
            F.struct(F.lit(n).alias("rule"), F.coalesce(F.col(n), F.lit(0)).cast("long").alias("violations"))
            for n in rules
        ]
    )
    by_rule = flat.select(F.explode(pairs).alias("_r")).select("_r.*")
    surplus = duplicate_keys(df, keys).agg(
        F.lit("unique_key").alias("rule"),
        F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).cast("long").alias("violations"),
    )
    return by_rule.unionByName(surplus)


def logged_write(
    df: DataFrame, path: str, job: str, step: str, key: str, log_path: str, mode: str = "overwrite"
) -> DataFrame:
    """Writes the table and appends one log row; counts come from the write itself."""
    watch = Observation(f"{job}-{step}")
    observed = df.observe(
        watch,
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col(key).isNull().cast("long")).alias("null_keys"),
    )
    started = datetime.now()
    observed.write.mode(mode).parquet(path)
    elapsed = (datetime.now() - started).total_seconds()
    seen = watch.get
    row = [
        (job, step, "SUCCESS", seen["row_count"], seen["null_keys"] or 0, started, elapsed)
    ]
    log = df.sparkSession.createDataFrame(row, RUN_LOG_SCHEMA)
    log.write.mode("append").parquet(log_path)
    return df.sparkSession.read.schema(RUN_LOG_SCHEMA).parquet(log_path)
