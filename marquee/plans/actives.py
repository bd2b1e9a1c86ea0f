"""Active users since a date, a title's share of them, and its decay multipliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.constants import ACTIVES_DAYS, SERVICE_LAUNCH
from marquee.functions.dates import clamp_start, is_inactive
from marquee.operators.aggregates import percentiles_per_key
from marquee.operators.intervals import merge_intervals
from marquee.operators.segments import DEFAULT_LIMIT, SkewLimit


def cumulative_actives(
    activity: DataFrame,
    user: str,
    day: str,
    first_start: str,
    last_start: str,
    days: int = ACTIVES_DAYS,
) -> DataFrame:
    """Users first seen on each day since each start date, and their running total.

    A user active on day d, and before that on day p, is new on d for exactly the
    start dates after p, at most ``days`` back. So each user-day adds one range of
    start dates; ranges are counted first and spread over dates afterwards.
    """
    seen = activity.select(F.col(user).alias("u"), F.col(day).alias("d")).distinct()
    earlier = F.lag("d").over(Window.partitionBy("u").orderBy("d"))
    ranges = (
        seen.withColumn("_from", F.greatest(F.date_add(earlier, 1), F.date_sub("d", days)))
        .groupBy("d", "_from")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    starts = (
        ranges.withColumn("start_date", F.explode(F.sequence("_from", "d")))
        .where(
            F.col("start_date").between(
                F.lit(first_start).cast("date"), F.lit(last_start).cast("date")
            )
        )
        .groupBy("start_date", F.col("d").alias("end_date"))
        .agg(F.sum("_n").alias("daily_viewing_subs_denom"))
    )
    w = (
        Window.partitionBy("start_date")
        .orderBy("end_date")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return starts.withColumn(
        "cumulative_viewing_subs_denom", F.sum("daily_viewing_subs_denom").over(w)
    ).withColumn("days_after_launch", F.datediff("end_date", "start_date") + 1)


def title_offerings(
    offerings: DataFrame,
    run_ts: Column,
    floor: str = SERVICE_LAUNCH,
    limit: SkewLimit = DEFAULT_LIMIT,
) -> DataFrame:
    """Offer spans per title: clamped to the service start, overlaps merged."""
    keys = ["title_id", "title", "match_id"]
    live = offerings.where(
        F.col("first_offered").isNotNull()
        & (F.col("offer_end") >= F.lit(floor).cast("timestamp"))
        & (F.col("offer_start") <= run_ts)
    ).withColumn("offer_start", clamp_start(F.col("offer_start"), floor))
    spans = merge_intervals(live, keys, "offer_start", "offer_end", limit).drop("previous_end")
    release = live.groupBy("title").agg(F.min("first_offered").alias("first_release_date"))
    return spans.join(release, "title")


def title_state(spans: DataFrame, run_ts: Column) -> DataFrame:
    keys = ["title_id", "title", "match_id"]
    return (
        spans.groupBy(*keys)
        .agg(F.max("offer_end").alias("end_date"))
        .withColumn("is_inactive", is_inactive(F.col("end_date"), run_ts))
    )


def title_pct_actives(
    title_days: DataFrame, titles: DataFrame, denominators: DataFrame, days: int = ACTIVES_DAYS
) -> DataFrame:
    """Percent of active users who watched a title, per day on the platform.

    Titles match case-insensitively. ``title_days`` has title, title_id,
    first_release_date, days_on_platform and cumulative_viewing_subs.
    """
    facts = title_days.where(F.col("days_on_platform").between(1, days)).withColumn(
        "_title", F.lower("title")
    )
    known = titles.select(F.lower("title").alias("_title"), "title_id", "match_id").distinct()
    base = denominators.where(F.col("days_after_launch") <= days).select(
        F.col("start_date").alias("available_date"),
        F.col("days_after_launch").alias("days_on_platform"),
        "cumulative_viewing_subs_denom",
    )
    return (
        facts.join(known, ["_title", "title_id"])
        .withColumn("available_date", F.to_date("first_release_date"))
        .join(base, ["available_date", "days_on_platform"])
        .select(
            "match_id",
            "title",
            "days_on_platform",
            F.try_divide(
                F.col("cumulative_viewing_subs") * 100.0, F.col("cumulative_viewing_subs_denom")
            ).alias("pct_actives"),
        )
        .distinct()
    )


def fit_multipliers(curves: DataFrame, groups: Sequence[str], title: str, day: str, value: str) -> DataFrame:
    """Median ratio of a title's value on one day to its value on another, per group.

    The self join pairs the days of one title, at most days x days rows per title.
    """
    base = curves.select(*groups, title, F.col(day).alias("from_day"), F.col(value).alias("_from"))
    later = curves.select(*groups, title, F.col(day).alias("to_day"), F.col(value).alias("_to"))
    ratios = base.join(later, [*groups, title]).withColumn(
        "multiplier", F.try_divide("_to", "_from")
    )
    return percentiles_per_key(
        ratios, [*groups, "from_day", "to_day"], "multiplier", {"multiplier": 0.5}
    )


def apply_multipliers(
    known: DataFrame, multipliers: DataFrame, groups: Sequence[str], day: str, value: str
) -> DataFrame:
    """Prediction for every later day; null for days before the known one."""
    renamed = multipliers.withColumnRenamed("from_day", day).withColumnRenamed(
        "to_day", "days_after_launch"
    )
    return known.join(renamed, [*groups, day], "left").withColumn(
        "prediction",
        F.when(F.col(day) <= F.col("days_after_launch"), F.col(value) * F.col("multiplier")),
    )
