"""Join shapes the analytics need beyond a plain equi join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
#: Bytes of input behind one partition where tasks hold rows in memory.
DEALT_BYTES = 10 * 1024 * 1024
#: Estimates from here on stand for rows that have none.
UNKNOWN_BYTES = 1 << 60


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan; no job is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_scan(df: DataFrame) -> bool:
    """Whether the plan only reads, filters and renames, so that it is no larger than its estimate."""
    plain = ("Project", "Filter", "SubqueryAlias", "LogicalRelation", "Range", "LogicalRDD", "LocalRelation")
    node = df._jdf.queryExecution().optimizedPlan()
    while True:
        if node.nodeName() not in plain and not node.nodeName().startswith("Relation"):
            return False
        if not node.children().size():
            return True
        node = node.children().apply(0)


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for plain scans with an estimate under the limit. Estimates of derived
    sides can be far off, and a hint cannot be undone at run time, so those stay unchanged:
    a shuffled join that AQE converts or splits by measured sizes."""
    return F.broadcast(df) if is_scan(df) and estimated_bytes(df) <= limit else df


def partitions_for(df: DataFrame, each: int = DEALT_BYTES) -> int:
    """How many partitions to deal a table over, by the size of the files behind it: a task holds
    as much of a large table as of a small one, whatever number of shuffle partitions is set. At
    least one for each core that the setting lets work; where a size is unknown, the setting."""
    spark = df.sparkSession
    setting = int(spark.conf.get("spark.sql.shuffle.partitions"))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    if size >= UNKNOWN_BYTES:
        return setting
    return max(min(setting, spark.sparkContext.defaultParallelism), -(-size // each), 1)


def band_join(
    facts: DataFrame,
    windows: DataFrame,
    keys: Sequence[str],
    fact_time: str,
    opens: Column,
    closes: Column,
    how: str = "inner",
) -> DataFrame:
    """Equi join on the keys with ``opens <= fact_time <= closes`` as residual."""
    facts, windows = facts.alias("f"), windows.alias("w")
    same = [F.col(f"f.{k}") == F.col(f"w.{k}") for k in keys]
    inside = F.col(f"f.{fact_time}").between(opens, closes)
    condition = inside
    for s in same:
        condition = s & condition
    joined = facts.join(windows, condition, how)
    for k in keys:
        joined = joined.drop(F.col(f"w.{k}"))
    return joined


def one_to_one(mapping: DataFrame, left: str, right: str) -> DataFrame:
    """Keeps pairs whose two sides each have exactly one partner."""
    pairs = mapping.select(left, right).distinct()
    single_left = pairs.groupBy(left).agg(F.count(right).alias("_n")).where("_n < 2").select(left)
    single_right = pairs.groupBy(right).agg(F.count(left).alias("_n")).where("_n < 2").select(right)
    return mapping.join(single_left, left, "left_semi").join(single_right, right, "left_semi")


def new_rows(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not recorded yet. Null keys never match, so they are kept."""
    return df.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def not_in(df: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """SQL ``NOT IN`` over a list without nulls: a null on the left is never kept."""
    values = listed.select(F.col(listed_column).alias(column)).where(F.col(column).isNotNull())
    return df.where(F.col(column).isNotNull()).join(values.distinct(), column, "left_anti")


def merge_features(
    tables: Sequence[DataFrame], key: str, how: str = "inner", first_only: bool = False
) -> DataFrame:
    """N-way merge on one key; ``first_only`` then keeps one row per key."""
    merged = tables[0]
    for table in tables[1:]:
        merged = merged.join(table, key, how)
    if not first_only:
        return merged
    rest = [c for c in merged.columns if c != key]
    row = F.min(F.struct(*rest)).alias("_row")
    return merged.groupBy(key).agg(row).select(key, "_row.*")
