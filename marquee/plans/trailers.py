"""Trailer reach: share of subscribers who saw a title's trailer before its launch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.constants import (
    MIN_TRAILER_SECONDS,
    TRAILER_DAYS,
    TRAILER_EARLY_DAY,
    TRAILER_LOOKBACK_DAYS,
)
from marquee.functions.dates import add_days, add_minutes, day_ceiling
from marquee.functions.keys import LEGACY_PLATFORM, match_id_platform
from marquee.functions.text import trailer_title, trailer_title_final, without_season
from marquee.operators.aggregates import running_by_day
from marquee.operators.audience import audience_counts
from marquee.operators.joins import band_join, new_rows, small_side
from marquee.session import stored

TITLE = ("title_name", "match_id")


def trailer_assets(assets: DataFrame, edits: DataFrame, offered: str, platform: str) -> DataFrame:
    """Trailers on a platform with the title they advertise."""
    title = trailer_title(F.col("asset_title_short"), F.col("asset_title_long"))
    return (
        assets.where(F.col("asset_title_long").contains("Trailer") & F.col(offered).isNotNull())
        .join(edits.select("viewable_id").distinct(), "viewable_id", "left_semi")
        .select(
            "viewable_id",
            trailer_title_final(title).alias("trailer_title"),
            F.lit(platform).alias("platform_name"),
            F.col(offered).alias("trailer_at"),
        )
        .distinct()
    )


def trailer_links(
    trailers: DataFrame, titles: DataFrame, end_ts: Column, existing: DataFrame | None = None
) -> DataFrame:
    """Trailers offered from 91 days to one minute before the launch of their title."""
    launches = titles.select(
        *TITLE,
        "platform_name",
        "launch",
        without_season(F.col("title_name")).alias("trailer_title"),
    ).distinct()
    linked = band_join(
        trailers,
        launches,
        ["trailer_title", "platform_name"],
        "trailer_at",
        add_days(F.col("launch"), -TRAILER_LOOKBACK_DAYS),
        add_minutes(F.col("launch"), -1),
    ).where(F.col("trailer_at") <= end_ts)
    if existing is not None:
        linked = new_rows(linked, existing, ["match_id"])
    return linked.select(*TITLE, "platform_name", "viewable_id", "trailer_at", "launch")


def trailer_reach(
    views: DataFrame,
    links: DataFrame,
    islands: DataFrame,
    end_ts: Column,
    days: Sequence[int] = TRAILER_DAYS,
    opens_days_before: int | None = 28,
    legacy: str = LEGACY_PLATFORM,
) -> DataFrame:
    """Viewers and eligible subscribers from the first trailer up to each day.

    Every day comes from the first time a user saw any trailer of the title; day
    counts are then accumulated. With ``opens_days_before`` the window opens no
    earlier than that many days before the launch.
    """
    days = sorted(days)
    key = [*TITLE, "platform_name", "opens", "first_trailer", "launch"]
    firsts = links.groupBy("match_id").agg(
        F.min("trailer_at").alias("first_trailer"), F.min("launch").alias("first_launch")
    )
    opens = F.col("first_trailer")
    if opens_days_before is not None:
        opens = F.greatest(opens, add_days(F.col("launch"), -opens_days_before))
    windows = (
        links.drop("launch", "trailer_at")
        .distinct()
        .join(firsts, "match_id")
        .withColumnRenamed("first_launch", "launch")
        .withColumn("opens", opens)
        .where(F.col("first_trailer") < F.col("launch"))
    )
    # one row per trailer, read by the views and by the audience counts
    windows = stored(windows)
    seen = (
        views.where(
            (F.col("stream_seconds") > MIN_TRAILER_SECONDS) & (F.col("stream_at") <= end_ts)
        )
        .select("viewable_id", "user_id", "stream_at")
        .join(small_side(windows), "viewable_id")
        .where(
            F.col("stream_at").between(F.col("opens"), add_days(F.col("launch"), days[-1]))
        )
        .groupBy(*key, "viewable_id", "user_id")
        .agg(F.min("stream_at").alias("first_seen"))
    )

    def entries(who: str, out: str) -> DataFrame:
        first = seen.groupBy(*key, who).agg(F.min("first_seen").alias("first_seen"))
        n = F.greatest(day_ceiling(F.col("first_seen"), F.col("launch")), F.lit(days[0]))
        return first.groupBy(*key, n.alias("n")).agg(F.count(F.lit(1)).alias(out))

    entered = entries("user_id", "_users").unionByName(
        entries("viewable_id", "_trailers"), allowMissingColumns=True
    )
    per_day = entered.groupBy(*key, "n").agg(
        F.coalesce(F.sum("_users"), F.lit(0)).alias("view_count"),
        F.coalesce(F.sum("_trailers"), F.lit(0)).alias("total_trailer_num"),
    )
    totals = running_by_day(per_day, key, "n", ["view_count", "total_trailer_num"], days)
    closes = add_days(F.col("launch"), F.col("n"))
    reached = (
        totals.withColumn("cumulative_day_num", F.datediff(closes, F.col("opens")))
        .where(
            (F.col("view_count") > 0)
            & (closes < end_ts)
            & (F.col("cumulative_day_num") > 0)
        )
    )
    subscribers = audience_counts(
        islands, windows.select("opens", "launch"), days, "starts_at", "ends_at"
    )
    return reached.join(subscribers, ["opens", "launch", "n"], "left").select(
        *TITLE,
        "platform_name",
        F.col("n").alias("nday_before"),
        "cumulative_day_num",
        "total_trailer_num",
        match_id_platform(F.col("platform_name"), F.col("match_id"), legacy).alias(
            "match_id_platform"
        ),
        F.col("first_trailer").alias("first_trailer_offered_timestamp"),
        F.col("launch").alias("title_offered_timestamp"),
        "view_count",
        F.when(F.col("users") > 0, F.col("users")).alias("total_retail_sub_count"),
        end_ts.alias("last_update_timestamp"),
        F.try_divide("view_count", "users").alias("retail_trailer_view_metric"),
    )


def early_trailer_reach(views, links, islands, end_ts, legacy: str = LEGACY_PLATFORM) -> DataFrame:
    """Reach from the first trailer until 28 days before the launch."""
    return trailer_reach(views, links, islands, end_ts, (TRAILER_EARLY_DAY,), None, legacy)
