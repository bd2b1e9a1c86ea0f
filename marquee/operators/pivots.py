"""Long to wide and back, and encodings of categorical values."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import stored
from marquee.constants import RARE_LABEL_SHARE
from marquee.functions.dates import day_label
from marquee.operators.aggregates import mode_from_counts
from marquee.session import stored


def day_pivot(
    df: DataFrame,
    key: str,
    day: str,
    value: str,
    days: Iterable[int],
    metric: str,
    titles: DataFrame | None = None,
    fill: float | None = None,
    negate: bool = False,
) -> DataFrame:
    """One column ``dayNNN_metric`` per day holding the most frequent value.

    ``negate`` labels days before launch by their distance. With ``titles`` every
    key of that table is kept and missing values become ``fill``.
    """
    days = [abs(d) for d in days]
    number = -F.col(day) if negate else F.col(day)
    counted = df.groupBy(key, number.alias("_day"), value).agg(F.count(value).alias("_n"))
    best = mode_from_counts(counted, [key, "_day"], value, "_n", "_value")
    labelled = best.select(key, day_label(F.col("_day"), metric).alias("_label"), "_value")
    labels = [f"day{d:03d}_{metric}" for d in days]
    wide = labelled.groupBy(key).pivot("_label", labels).agg(F.max("_value"))
    if titles is not None:
        wide = titles.select(key).distinct().join(wide, key, "left")
        if fill is not None:
            wide = wide.fillna(fill, subset=labels)
    return wide


def max_pivot(
    df: DataFrame, key: str, column: str, value: str, names: dict[int, str]
) -> DataFrame:
    """Maximum per listed value, with renamed columns."""
    wide = df.groupBy(key).pivot(column, list(names)).agg(F.max(value))
    return wide.select(key, *[F.col(str(v)).alias(n) for v, n in names.items()])


def unpivot_days(df: DataFrame, keys: Sequence[str], metric: str, value: str) -> DataFrame:
    """Back to ``(keys, day, value)`` from ``dayNNN_metric`` columns."""
    columns = [c for c in df.columns if c.startswith("day") and c.endswith("_" + metric)]
    long = df.unpivot(list(keys), columns, "_label", value)
    return long.select(
        *keys, F.substring("_label", 4, 3).cast("int").alias("day"), value
    )


def label_counts(df: DataFrame, tokens: Column) -> DataFrame:
    """Rows holding each token: ``token``, ``n_rows``."""
    return df.select(F.explode(F.array_distinct(tokens)).alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def common_labels(
    df: DataFrame, tokens: Column, share: float = RARE_LABEL_SHARE, drop: Sequence[str] = ()
) -> DataFrame:
    """Tokens present in at least ``share`` of all rows."""
    total = df.agg(F.count(F.lit(1)).alias("_total"))
    return (
        label_counts(df, tokens)
        .where(~F.col("token").isin(*drop) if drop else F.lit(True))
        .crossJoin(F.broadcast(total))  # one row
        .where(F.col("n_rows") >= F.col("_total") * F.lit(share))
        .drop("_total")
    )


def multi_hot(
    df: DataFrame, key: str, tokens: Column, vocabulary: Sequence[str], prefix: str
) -> DataFrame:
    """One 0/1 column per vocabulary entry, without a shuffle."""
    flags = [
        F.coalesce(F.array_contains(F.col("_tokens"), v).cast("int"), F.lit(0)).alias(
            prefix + v.replace(" ", "_")
        )
        for v in vocabulary
    ]
    return df.withColumn("_tokens", tokens).select(key, *flags)


def one_hot(column: Column, values: Sequence, prefix: str) -> list[Column]:
    """Known values give 0/1; an unknown value gives null in every column."""
    known = column.isin(*values)
    return [
        F.when(known, (column == v).cast("int")).alias(f"{prefix}{v}") for v in values
    ]


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """Codes 0, 1, ... by sorted value. Only the distinct values are numbered: they are sorted
    by range, numbered within their range, and moved by the sizes of the ranges before."""
    classes = df.select(column).where(F.col(column).isNotNull()).distinct()
    ranges = stored(classes.repartitionByRange(column).withColumn("_range", F.spark_partition_id()))
    sizes = ranges.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    # one row per range: as many as the sort had tasks
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(column)) - 1
    return ranges.withColumn("_place", place).join(F.broadcast(before), "_range").select(
        (F.col("_place") + F.col("_before")).alias("code"), column
    )
