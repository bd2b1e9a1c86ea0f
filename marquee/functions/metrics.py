"""Ratios, logs, sentinels and error measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.constants import NEVER_OBSERVED, NOT_REACHED, ZERO_FLOOR


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """0 when the denominator is null, zero or negative."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def or_never_observed(value: Column) -> Column:
    return F.coalesce(value, F.lit(NEVER_OBSERVED))


def log1p_or_never(value: Column) -> Column:
    return F.when(value.isNull() | (value < 0), F.lit(NEVER_OBSERVED)).otherwise(F.log1p(value))


def log1p_unless_never(value: Column) -> Column:
    return F.when(value != NEVER_OBSERVED, F.log1p(value)).otherwise(value)


def log_or_not_reached(value: Column) -> Column:
    return F.when(value > 0, F.log(value)).otherwise(F.lit(NOT_REACHED))


def log_ratio_or_not_reached(value: Column, base: Column) -> Column:
    return F.when((value > 0) & (base > 0), F.log(value / base)).otherwise(F.lit(NOT_REACHED))


def log_zero_is_zero(value: Column) -> Column:
    return F.when(value == 0, F.lit(0.0)).otherwise(F.log(value))


def log_floored(value: Column) -> Column:
    """``ln(x + floor)``; where that is undefined the signal counts as never observed."""
    return F.coalesce(F.log(value + F.lit(ZERO_FLOOR)), F.lit(NEVER_OBSERVED))


def seconds_to_hours(value: Column) -> Column:
    return value / F.lit(3600.0)


def to_millions(value: Column) -> Column:
    return value / F.lit(1_000_000.0)


def capped_hours(streamed: Column, runtime: Column) -> Column:
    """Null runtime gives null: a cap that is not known is not a cap."""
    return F.when(runtime.isNotNull(), F.least(streamed, runtime))


def winsorise(value: Column, cap: float) -> Column:
    return F.when(value > cap, F.lit(cap)).otherwise(value)


def logit(share: Column) -> Column:
    """Null outside the open interval (0, 1)."""
    return F.when((share > 0) & (share < 1), F.log(share / (1 - share)))


def expit(value: Column) -> Column:
    return 1 / (1 + F.exp(-value))


def inverse_log_ratio(prediction: Column, log_day1: Column) -> Column:
    return F.exp(prediction) * F.exp(log_day1)


def non_negative(value: Column) -> Column:
    return F.greatest(value, F.lit(0.0))


def smape(prediction: Column, target: Column) -> Column:
    return F.try_divide(F.abs(prediction - target), (prediction + target) / 2)


def absolute_error(prediction: Column, target: Column) -> Column:
    return F.abs(prediction - target)


def row_sum(columns: Sequence[Column]) -> Column:
    total = F.lit(0.0)
    for column in columns:
        total = total + F.coalesce(column, F.lit(0.0))
    return total


def widest_window(windows: Sequence[tuple[Column, int]], default: int) -> Column:
    """Days of the first non-null column, widest first."""
    return F.coalesce(*[F.when(c.isNotNull(), F.lit(d)) for c, d in windows], F.lit(default))


def tier_adjusted(title: Column, category: Column, tier: Column) -> Column:
    return (
        F.when((category == "Pay1") & (tier == 2), 3)
        .when((category == "Pay1") & (tier == 1), 2)
        .when(title == "Reminiscence", 2)
        .otherwise(tier)
    )


def unit_hash(*keys: Column, seed: str = "") -> Column:
    """Repeatable number in [0, 1) from the first 32 bits of an md5."""
    text = F.concat_ws("|", F.lit(seed), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
