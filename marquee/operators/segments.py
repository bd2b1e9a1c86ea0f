"""Ordered windows that stay balanced when one key holds a large part of the rows.

A window function sends every row of a key to one task. That is fine while no
key is large, so ``with_segments`` first finds out by a map-side combined count
per key. Only if some key (null is one) is above the row limit are its rows cut
into time segments. Each segment is then a window partition of its own, and what has to
cross a segment border is carried through a summary with one row per hot key
and segment.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import stored

SEGMENT = "_segment"
HOT = "_hot"
SEGMENT_MICROS = 86_400_000_000


@dataclass(frozen=True)
class SkewLimit:
    """``rows`` a single key may hold before its rows are cut into segments of time."""

    rows: int = 5_000_000
    segment_micros: int = SEGMENT_MICROS


DEFAULT_LIMIT = SkewLimit()


@dataclass(frozen=True)
class Segmented:
    """Rows, their keys, and whether some keys were cut into segments."""

    df: DataFrame
    keys: tuple[str, ...]
    split: bool

    @property
    def partition(self) -> list[str]:
        return [*self.keys, SEGMENT] if self.split else list(self.keys)

    def with_df(self, df: DataFrame) -> Segmented:
        return Segmented(df, self.keys, self.split)


def with_segments(
    df: DataFrame, keys: Sequence[str], time: str, limit: SkewLimit | None = DEFAULT_LIMIT
) -> Segmented:
    """Decides whether hot keys must be cut, and cuts them by time if so.

    ``limit=None`` is for callers whose rows per key have a bound of their own.
    The hot key list is broadcast: it has at most ``total rows / limit.rows`` rows.
    The tagged rows are stored once, as later steps read them more than once.
    """
    keys = tuple(keys)
    if limit is None:
        return Segmented(df, keys, False)
    hot = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > limit.rows)
        .select(*(F.col(k).alias(f"_hot_{k}") for k in keys), F.lit(True).alias(HOT))
    )
    if hot.isEmpty():
        return Segmented(df, keys, False)
    bucket = F.floor(F.unix_micros(time) / F.lit(limit.segment_micros)).cast("long")
    tagged = (
        df.join(F.broadcast(hot), _same(keys, "_hot_"), "left")
        .drop(*(f"_hot_{k}" for k in keys))
        .withColumn(SEGMENT, F.when(F.col(HOT), bucket).otherwise(F.lit(0).cast("long")))
        .withColumn(HOT, F.coalesce(HOT, F.lit(False)))
    )
    return Segmented(stored(tagged), keys, True)


def _same(keys: Sequence[str], prefix: str) -> Column:
    """Equality with the prefixed columns; null keys are equal."""
    return reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys))


def _with_carry(rows: Segmented, df: DataFrame, carry: DataFrame) -> DataFrame:
    """One row per hot key and segment; AQE broadcasts it when it measures small."""
    keys = rows.partition
    carry = carry.withColumnsRenamed({k: f"_carry_{k}" for k in keys})
    return df.join(carry, _same(keys, "_carry_"), "left").drop(*(f"_carry_{k}" for k in keys))


def _earlier(rows: Segmented):
    return Window.partitionBy(*rows.keys).orderBy(SEGMENT)


_AGGREGATES = {"sum": F.sum, "max": F.max}


def running(
    rows: Segmented,
    order: Sequence[Column],
    value: Column,
    out: str,
    how: str = "sum",
    include_current: bool = True,
    peers_equal: bool = False,
) -> Segmented:
    """Running sum or max of ``value`` per key.

    ``peers_equal`` gives rows tied in ``order`` the same result, as the default
    SQL frame does; ties never cross a segment because segments follow time.
    """
    aggregate = _AGGREGATES[how]
    base = Window.partitionBy(*rows.partition).orderBy(*order)
    if peers_equal:
        frame = base.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    else:
        frame = base.rowsBetween(Window.unboundedPreceding, 0 if include_current else -1)
    if not rows.split:
        return rows.with_df(rows.df.withColumn(out, aggregate(value).over(frame)))
    df = rows.df.withColumn("_value", value)
    before = _earlier(rows).rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        df.where(F.col(HOT))
        .groupBy(*rows.partition)
        .agg(aggregate("_value").alias("_total"))
        .select(*rows.partition, aggregate("_total").over(before).alias("_carry"))
    )
    df = _with_carry(rows, df.withColumn("_local", aggregate("_value").over(frame)), carry)
    if how == "sum":
        both = F.coalesce("_local", F.lit(0)) + F.coalesce("_carry", F.lit(0))
        result = F.when(F.col("_local").isNotNull() | F.col("_carry").isNotNull(), both)
    else:
        result = F.greatest("_local", "_carry")
    return rows.with_df(df.withColumn(out, result).drop("_value", "_local", "_carry"))


def previous(rows: Segmented, order: Sequence[str], value: str, out: str) -> Segmented:
    """``lag(value)`` per key; the first row of a segment takes the last of an earlier one."""
    w = Window.partitionBy(*rows.partition).orderBy(*order)
    if not rows.split:
        return rows.with_df(rows.df.withColumn(out, F.lag(value).over(w)))
    last = F.max_by(F.struct(F.col(value).alias("v")), F.struct(*order))
    carry = (
        rows.df.where(F.col(HOT))
        .groupBy(*rows.partition)
        .agg(last.alias("_last"))
        .select(*rows.partition, F.lag("_last").over(_earlier(rows))["v"].alias("_carry"))
    )
    df = rows.df.withColumn("_first", F.row_number().over(w) == 1).withColumn(
        "_local", F.lag(value).over(w)
    )
    result = F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_local"))
    df = _with_carry(rows, df, carry).withColumn(out, result)
    return rows.with_df(df.drop("_first", "_local", "_carry"))


def next_marked(
    rows: Segmented, order: Sequence[Column], payload: str, out: str
) -> Segmented:
    """First non-null ``payload`` at or after each row, in the given order."""
    w = (
        Window.partitionBy(*rows.partition)
        .orderBy(*order)
        .rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    local = F.first(payload, ignorenulls=True).over(w)
    if not rows.split:
        return rows.with_df(rows.df.withColumn(out, local))
    later = _earlier(rows).rowsBetween(1, Window.unboundedFollowing)
    first = F.min_by(
        F.when(F.col(payload).isNotNull(), F.col(payload)),
        F.when(F.col(payload).isNotNull(), F.struct(*order)),
    )
    carry = (
        rows.df.where(F.col(HOT))
        .groupBy(*rows.partition)
        .agg(first.alias("_first"))
        .withColumn("_carry", F.first("_first", ignorenulls=True).over(later))
        .select(*rows.partition, "_carry")
    )
    df = _with_carry(rows, rows.df.withColumn("_local", local), carry)
    return rows.with_df(
        df.withColumn(out, F.coalesce("_local", "_carry")).drop("_local", "_carry")
    )
