"""Interval operators: chaining, merging, and the next interval for a moment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.segments import (
    DEFAULT_LIMIT,
    HOT,
    SEGMENT,
    SkewLimit,
    next_marked,
    previous,
    running,
    with_segments,
)


def chain_periods(
    periods: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    max_gap_seconds: int = 0,
    limit: SkewLimit | None = DEFAULT_LIMIT,
) -> DataFrame:
    """Chains periods whose start continues the previous end into numbered sessions.

    With the default gap of 0 the start must equal the previous end exactly. A
    larger gap also accepts a start up to that many seconds after it.
    Result: keys, session number, first start, last end.
    """
    rows = with_segments(periods, keys, start, limit)
    rows = previous(rows, [start, end], end, "_previous_end")
    gap = F.unix_micros(start) - F.unix_micros("_previous_end")
    continues = gap.between(0, max_gap_seconds * 1_000_000)
    flag = F.when(continues, 0).otherwise(1)
    rows = running(rows, [F.col(start)], flag, "session_id", peers_equal=True)
    return rows.df.groupBy(*keys, "session_id").agg(
        F.min(start).alias(start), F.max(end).alias(end)
    )


def merge_intervals(
    intervals: DataFrame,
    keys: Sequence[str],
    start: str,
    end: str,
    limit: SkewLimit | None = DEFAULT_LIMIT,
) -> DataFrame:
    """Unions overlapping or touching intervals per key.

    Result: keys, start, end, and ``previous_end``, the end of the island before
    (null for the first). Intervals with a null bound or end < start are left out.
    """
    valid = intervals.where(F.col(end) >= F.col(start)).select(*keys, start, end)
    # equal starts collapse before the shuffle; the longest decides
    valid = valid.groupBy(*keys, start).agg(F.max(end).alias(end))
    rows = with_segments(valid, keys, start, limit)
    order = [F.col(start)]
    rows = running(rows, order, F.col(end), "_reach", "max", include_current=False)
    opens = F.col("_reach").isNull() | (F.col(start) > F.col("_reach"))
    rows = rows.with_df(rows.df.withColumn("_opens", opens))
    rows = running(rows, order, F.col("_opens").cast("int"), "_island")
    return (
        rows.df.groupBy(*keys, "_island")
        .agg(
            F.min(start).alias(start),
            F.max(end).alias(end),
            F.max(F.when(F.col("_opens"), F.col("_reach"))).alias("previous_end"),
        )
        .drop("_island")
    )


def next_interval_start(
    moments: DataFrame,
    islands: DataFrame,
    keys: Sequence[str],
    moment: str,
    start: str,
    end: str,
    out: str,
    limit: SkewLimit | None = DEFAULT_LIMIT,
) -> DataFrame:
    """For each moment the start of the first island of its key that ends at or after it.

    Islands are disjoint, so this is also the island with the earliest start among
    those. One sorted pass over both inputs replaces a join of every moment with
    every island of the key. Rows without such an island get null.
    """
    left = moments.withColumn("_at", F.col(moment)).withColumn(
        "_start", F.lit(None).cast("timestamp")
    )
    right = islands.select(
        *keys,
        F.col(end).alias("_at"),
        F.col(start).alias("_start"),
    )
    both = left.withColumn("_is_island", F.lit(0)).unionByName(
        right.withColumn("_is_island", F.lit(1)), allowMissingColumns=True
    )
    rows = with_segments(both, keys, "_at", limit)
    rows = next_marked(rows, [F.col("_at"), F.col("_is_island")], "_start", out)
    return rows.df.where(F.col("_is_island") == 0).drop("_at", "_start", "_is_island", HOT, SEGMENT)
