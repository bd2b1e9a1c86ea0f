"""Aggregates that combine on the map side and never hold a whole group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mode_per_key(df: DataFrame, keys: Sequence[str], value: str, out: str | None = None) -> DataFrame:
    """Most frequent non-null value per key; of tied values the smallest.

    Counting (key, value) pairs first keeps a hot key spread over many tasks.
    """
    counted = df.groupBy(*keys, value).agg(F.count(value).alias("_n"))
    return mode_from_counts(counted, keys, value, "_n", out or value)


def mode_from_counts(
    counted: DataFrame, keys: Sequence[str], value: str, count: str, out: str
) -> DataFrame:
    best = F.min(F.when(F.col(value).isNotNull(), F.struct((-F.col(count)).alias("n"), F.col(value).alias("v"))))
    return counted.groupBy(*keys).agg(best["v"].alias(out))


def modes_per_key(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Modes of several columns in one pass over long (key, column, value) counts.

    Values are compared as strings, so ties break by text order.
    """
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(v).alias("name"), F.col(v).cast("string").alias("value"))
                for v in values
            ]
        )
    )
    long = df.select(*keys, pairs.alias("_p")).select(*keys, "_p.name", "_p.value")
    counted = long.where("value is not null").groupBy(*keys, "name", "value").agg(
        F.count(F.lit(1)).alias("_n")
    )
    best = counted.groupBy(*keys, "name").agg(
        F.min(F.struct((-F.col("_n")).alias("n"), F.col("value").alias("v")))["v"].alias("_mode")
    )
    picked = [
        F.max(F.when(F.col("name") == v, F.col("_mode"))).cast(df.schema[v].dataType).alias(v)
        for v in values
    ]
    return df.select(*keys).distinct().join(best, list(keys), "left").groupBy(*keys).agg(*picked)


def distinct_list(column: Column, separator: str = "|") -> Column:
    """Distinct values in order, joined; for attributes with a small vocabulary per key."""
    return F.array_join(F.array_sort(F.collect_set(column)), separator)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str]
) -> DataFrame:
    """The row with the greatest ``order`` per key, as an aggregate instead of a window."""
    row = F.max_by(F.struct(*columns), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*")


def share_of_total(df: DataFrame, value: str, out: str) -> DataFrame:
    """Percent of the grand total; the total is one row, so broadcasting it is safe."""
    total = df.agg(F.sum(value).alias("_total"))
    return (
        df.crossJoin(F.broadcast(total))
        .withColumn(out, F.try_divide(100 * F.col(value), F.col("_total")))
        .drop("_total")
    )


PIECE_VALUES = 1_000_000


def percentiles_per_key(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    shares: Mapping[str, float],
    pieces: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Exact percentiles with linear interpolation, without holding a group in one task.
    ``weight``: how many rows a row stands for.

    A sketch cuts each group's values into ``pieces`` ranges. Counts per range say
    which ranges hold the wanted ranks; only those are ordered, on distinct values.
    Without keys the whole table is one group. By default there are enough pieces
    that one holds about PIECE_VALUES distinct values at most, whatever the table's size.
    """
    counted = (
        df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
        .groupBy(*keys, value)
        .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_n"))
    )
    if pieces is None:
        largest = df.groupBy(*keys).agg(F.approx_count_distinct(value).alias("_v")).agg(F.max("_v")).first()[0]
        pieces = max(64, -(-(largest or 0) // PIECE_VALUES))
    grid = F.array(*[F.lit(i / pieces) for i in range(1, pieces)])
    groups = counted.groupBy(*keys).agg(
        F.percentile_approx(value, grid, max(10_000, 20 * pieces)).alias("_cuts"),
        F.sum("_n").alias("_size"),
    )
    # without keys ``groups`` is a single row
    sized = counted.join(groups, list(keys)) if keys else counted.crossJoin(F.broadcast(groups))
    placed = sized.withColumn(
        "_piece", F.size(F.filter("_cuts", lambda c: c < F.col(value)))
    )
    totals = placed.groupBy(*keys, "_piece").agg(
        F.sum("_n").alias("_rows"), F.first("_size").alias("_size")
    )
    by_piece = Window.partitionBy(*keys).orderBy("_piece")
    totals = totals.withColumn(
        "_before", F.sum("_rows").over(by_piece) - F.col("_rows")
    )

    def rank(share: float) -> Column:
        return (F.col("_size") - 1) * F.lit(float(share))

    ranks = [f(rank(s)) for s in shares.values() for f in (F.floor, F.ceil)]
    wanted = None
    for r in ranks:
        inside = (r >= F.col("_before")) & (r < F.col("_before") + F.col("_rows"))
        wanted = inside if wanted is None else wanted | inside
    needed = totals.where(wanted).select(*keys, "_piece", "_before")
    by_value = Window.partitionBy(*keys, "_piece").orderBy(value)
    ordered = placed.join(needed, [*keys, "_piece"]).withColumn(
        "_until", F.col("_before") + F.sum("_n").over(by_value)
    )

    def at(r: Column) -> Column:
        hit = (F.col("_until") > r) & (F.col("_until") - F.col("_n") <= r)
        return F.max(F.when(hit, F.col(value)))

    columns = []
    for name, share in shares.items():
        low, high = at(F.floor(rank(share))), at(F.ceil(rank(share)))
        part = F.max(rank(share) - F.floor(rank(share)))
        columns.append((low + (high - low) * part).alias(name))
    return ordered.groupBy(*keys).agg(*columns)


def with_group_total(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Adds the key's total to each row: combined aggregate, then a join back."""
    totals = df.groupBy(*keys).agg(F.sum(value).alias(out))
    return df.join(totals, list(keys), "left")


def running_by_day(
    changes: DataFrame, keys: Sequence[str], day: str, values: Sequence[str], days: Sequence[int]
) -> DataFrame:
    """Totals of ``values`` up to each of ``days``, from at most one row per key and day.

    A key's changes become one short list, so keys without any need no calendar rows
    and no window has to run over the days.
    """
    listed = changes.groupBy(*keys).agg(
        F.collect_list(F.struct(F.col(day).alias("day"), *values)).alias("_changes")
    )
    spread = listed.withColumn(day, F.explode(F.array(*[F.lit(d) for d in days])))

    def total(name: str) -> Column:
        return F.aggregate(
            F.filter("_changes", lambda c: c["day"] <= F.col(day)),
            F.lit(0).cast("bigint"),
            lambda sum_, c: sum_ + F.coalesce(c[name], F.lit(0)),
        ).alias(name)

    return spread.select(*keys, day, *[total(v) for v in values])


def running_list(changes: Column, day: str, value: str, days: Sequence[int]) -> Column:
    """Totals of ``value`` up to each of ``days`` as one array, from a key's own list of changes
    (any number of them on a day): ``running_by_day`` without a row for each day."""
    zero = F.lit(0).cast("bigint")
    return F.transform(
        F.array(*map(F.lit, days)),
        lambda n: F.aggregate(changes, zero, lambda sum_, c: sum_ + F.when(c[day] <= n, F.coalesce(c[value], zero)).otherwise(zero)),
    )
