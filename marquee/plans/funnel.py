"""Launch funnel: who played, viewed and completed a title n days after launch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.constants import (
    CONTENT_CATEGORIES,
    EPISODE_COMPLETE_SHARE,
    FUNNEL_DAYS,
    PRELAUNCH_HORIZON_DAYS,
    SINGLE_EPISODE_VIEW_HOURS,
    TITLE_ASSET_TYPES,
)
from marquee.functions.dates import add_days, day_ceiling, first_public
from marquee.functions.keys import (
    match_id,
    season_number_adj,
    single_episode_ind,
    title_name,
)
from marquee.functions.metrics import capped_hours, seconds_to_hours
from marquee.operators.aggregates import modes_per_key, running_by_day
from marquee.operators.audience import audience_counts
from marquee.operators.intervals import next_interval_start
from marquee.operators.joins import new_rows, small_side

TITLE_KEYS = ("title_name", "match_id")


def asset_titles(assets: DataFrame, offered: str) -> DataFrame:
    """Assets with title keys; ``offered`` is the platform's first-offered column."""
    season = season_number_adj(F.col("content_category"), F.col("season_number"))
    return (
        assets.where(
            F.col(offered).isNotNull()
            & F.col("asset_type").isin(*TITLE_ASSET_TYPES)
            & F.col("content_category").isin(*CONTENT_CATEGORIES)
        )
        .select(
            "series_id",
            "viewable_id",
            first_public(
                F.col("theatrical_release_date"),
                F.col("original_linear_air_date"),
                F.col("first_offered_date_current"),
                F.col("first_offered_date_legacy"),
            ).alias("public_at"),
            season.alias("season_number_adj"),
            title_name(F.col("series_title_long"), season, F.col("asset_title_long")).alias(
                "title_name"
            ),
            match_id(F.col("series_id"), season, F.col("viewable_id")).alias("match_id"),
            "content_category",
            single_episode_ind(F.col("series_id")).alias("single_episode_ind"),
            F.col(offered).alias("offered_at"),
        )
        .where(F.col("title_name").isNotNull())
        .distinct()
    )


def title_launches(titles: DataFrame) -> DataFrame:
    """One row per title: attributes, first and last offer, number of episodes."""
    attributes = ["season_number_adj", "content_category", "single_episode_ind"]
    modes = modes_per_key(titles, TITLE_KEYS, attributes)
    dates = titles.groupBy(*TITLE_KEYS).agg(
        F.min("offered_at").alias("launch"),
        F.max("offered_at").alias("last_offered"),
        F.min("public_at").alias("earliest_public"),
    )
    episodes = titles.groupBy("match_id").agg(
        F.countDistinct("viewable_id").alias("viewable_id_count")
    )
    return dates.join(modes, list(TITLE_KEYS)).join(episodes, "match_id")


def title_views(
    views: DataFrame, titles: DataFrame, launches: DataFrame, edits: DataFrame, days: int = 28
) -> DataFrame:
    """Streams of a title between its launch and ``days`` later, episode already out.

    Catalogue sides are broadcast while their size estimate allows it.
    """
    season_key = F.concat(F.col("series_id"), F.lit("-"), F.col("season_number").cast("string"))
    keyed = views.withColumn("match_id", F.coalesce(season_key, F.col("viewable_id"))).select(
        "match_id", "viewable_id", "edit_id", "user_id", "stream_at", "stream_seconds"
    )
    episode = titles.select("viewable_id", "offered_at").distinct()
    launch = launches.select("title_name", "match_id", "launch", "viewable_id_count", "single_episode_ind")
    runtime = edits.select("viewable_id", "edit_id", "credits_start_time")
    return (
        keyed.join(small_side(launch), "match_id")
        .where(
            (F.col("stream_at") >= F.col("launch"))
            & (F.col("stream_at") <= add_days(F.col("launch"), days))
        )
        .join(small_side(episode), "viewable_id")
        .where(F.col("stream_at") >= F.col("offered_at"))
        .join(small_side(runtime), ["viewable_id", "edit_id"])
        .select(
            *TITLE_KEYS,
            "launch",
            "viewable_id",
            "viewable_id_count",
            "single_episode_ind",
            "user_id",
            "stream_at",
            seconds_to_hours(F.col("credits_start_time")).alias("runtime_hours"),
            seconds_to_hours(F.col("stream_seconds")).alias("stream_hours"),
        )
    )


def viewership_base(title_streams: DataFrame, islands: DataFrame, days: int = 28) -> DataFrame:
    """Streams of users subscribed at some time in the launch window, each kept once."""
    # distinct, so a user holds at most one row per launch time of the catalogue
    pairs = title_streams.select("user_id", "launch").distinct()
    pairs = next_interval_start(
        pairs, islands, ["user_id"], "launch", "starts_at", "ends_at", "eligible_from", None
    )
    pairs = pairs.where(F.col("eligible_from") < add_days(F.col("launch"), days))
    return title_streams.join(
        pairs.select("user_id", "launch", "eligible_from"), ["user_id", "launch"]
    )


def _changes(df: DataFrame, partition: Sequence[str], pairs: dict[str, Column]) -> DataFrame:
    """Each state column minus its value at the partition's previous day."""
    w = Window.partitionBy(*partition).orderBy("n")
    for name, state in pairs.items():
        df = df.withColumn(name, state)
    lagged = {
        name: F.col(name) - F.coalesce(F.lag(name).over(w), F.lit(0)) for name in pairs
    }
    return df.withColumns(lagged)


def user_title_changes(
    title_streams: DataFrame,
    islands: DataFrame,
    last_day: int,
) -> DataFrame:
    """Changes of the played / viewed / completed flags per user, title and day.

    A stream enters at day n0, the first whole day whose window holds it, but not
    before the user's subscription does. State only changes on such days, so a
    user and title need one row per entry day instead of one per calendar day.
    """
    entry = F.greatest(day_ceiling(F.col("stream_at"), F.col("launch")), F.lit(1))
    title = [*TITLE_KEYS, "launch", "viewable_id_count", "single_episode_ind"]
    facts = (
        title_streams.withColumn("n", entry)
        .groupBy(*title, "user_id", "viewable_id", "n")
        .agg(F.sum("stream_hours").alias("hours"), F.max("runtime_hours").alias("runtime"))
    )
    # already combined: a user holds at most episodes x days rows, a catalogue bound
    # that does not grow with the stream
    facts = next_interval_start(
        facts, islands, ["user_id"], "launch", "starts_at", "ends_at", "eligible_from", None
    )
    facts = facts.where(F.col("eligible_from") < add_days(F.col("launch"), last_day))
    joined = F.greatest(F.col("n"), day_ceiling(F.col("eligible_from"), F.col("launch")))
    # rows are partitioned by user here, which serves every step up to the title totals
    facts = (
        facts.withColumn("n", joined)
        .where(F.col("n") <= last_day)
        .groupBy(*title, "user_id", "viewable_id", "n")
        .agg(F.sum("hours").alias("hours"), F.max("runtime").alias("runtime"))
    )
    so_far = (
        Window.partitionBy(*title, "user_id", "viewable_id")
        .orderBy("n")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    streamed, runtime = F.sum("hours").over(so_far), F.max("runtime").over(so_far)
    episodes = facts.withColumn("streamed", streamed).withColumn("run_time", runtime)
    done = F.when(F.col("streamed") > EPISODE_COMPLETE_SHARE * F.col("run_time"), 1).otherwise(0)
    capped = F.coalesce(capped_hours(F.col("streamed"), F.col("run_time")), F.lit(0.0))
    episodes = _changes(
        episodes, [*title, "user_id", "viewable_id"], {"d_hours": capped, "d_done": done}
    )
    per_user = episodes.groupBy(*title, "user_id", "n").agg(
        F.sum("d_hours").alias("d_hours"),
        F.sum("d_done").alias("d_done"),
        F.max("run_time").alias("run_time"),
    )
    user_days = (
        Window.partitionBy(*title, "user_id")
        .orderBy("n")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    per_user = (
        per_user.withColumn("hours", F.sum("d_hours").over(user_days))
        .withColumn("done", F.sum("d_done").over(user_days))
        .withColumn("longest", F.max("run_time").over(user_days))
    )
    counted = F.col("hours") > 0
    single = F.col("single_episode_ind") == 1
    enough = F.col("hours") > F.when(
        F.col("longest").isNotNull(), F.least(F.lit(SINGLE_EPISODE_VIEW_HOURS), F.col("longest"))
    )
    viewed = counted & ((single & enough) | (~single & (F.col("done") > 0)))
    completed = counted & (F.col("done") == F.col("viewable_id_count"))
    flags = {
        "d_played": F.when(counted, 1).otherwise(0),
        "d_viewed": F.when(viewed, 1).otherwise(0),
        "d_completed": F.when(completed, 1).otherwise(0),
    }
    changes = _changes(per_user, [*title, "user_id"], flags)
    return changes.select(*TITLE_KEYS, "launch", "user_id", "n", *flags)


def launch_funnel(
    title_streams: DataFrame,
    launches: DataFrame,
    viewer_islands: DataFrame,
    subscriber_islands: DataFrame,
    end_ts: Column,
    platform: str,
    days: Sequence[int] = FUNNEL_DAYS,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Funnel rows for every title and every day whose window has fully elapsed.

    All days come from one pass: flag changes are counted per title and day, then
    accumulated over the few days of each title.
    """
    last = max(days)
    changes = user_title_changes(title_streams, viewer_islands, last)
    flags = ["played", "viewed", "completed"]
    per_day = changes.groupBy(*TITLE_KEYS, "launch", "n").agg(
        *[F.sum(f"d_{c}").alias(c) for c in flags]
    )
    totals = running_by_day(per_day, [*TITLE_KEYS, "launch"], "n", flags, days).where(
        (add_days(F.col("launch"), F.col("n")) <= end_ts) & (F.col("played") > 0)
    )
    anchors = launches.select(F.col("launch").alias("opens"), "launch")
    subscribers = audience_counts(
        subscriber_islands, anchors, days, "starts_at", "ends_at"
    ).select("launch", "n", F.when(F.col("users") > 0, F.col("users")).alias("total_retail_sub_count"))
    info = launches.drop("launch", "viewable_id_count")
    rows = (
        totals.join(subscribers, ["launch", "n"], "left")
        .join(info, list(TITLE_KEYS))
        .select(
            *TITLE_KEYS,
            "season_number_adj",
            "content_category",
            "single_episode_ind",
            F.lit(platform).alias("platform_name"),
            F.col("launch").alias("earliest_offered_timestamp"),
            F.col("last_offered").alias("last_offered_timestamp"),
            F.col("earliest_public").alias("earliest_public_timestamp"),
            F.col("n").alias("days_since_first_offered"),
            "total_retail_sub_count",
            end_ts.alias("last_update_timestamp"),
            F.col("played").alias("retail_played_count"),
            F.col("viewed").alias("retail_viewed_count"),
            F.col("completed").alias("retail_completion_count"),
            F.try_divide("played", "total_retail_sub_count").alias("retail_played_count_percent"),
            F.try_divide("viewed", "total_retail_sub_count").alias("retail_viewed_count_percent"),
        )
    )
    if existing is None:
        return rows
    return new_rows(rows, existing, ["match_id", "platform_name", "days_since_first_offered"])


def prelaunch_titles(
    titles: DataFrame,
    end_ts: Column,
    platform: str,
    existing: DataFrame,
    horizon: int = PRELAUNCH_HORIZON_DAYS,
) -> DataFrame:
    """Day-0 rows without metrics for titles offered within the next ``horizon`` days."""
    attributes = ["season_number_adj", "content_category", "single_episode_ind"]
    upcoming = (
        titles.groupBy(*TITLE_KEYS, *attributes)
        .agg(
            F.min("offered_at").alias("earliest_offered_timestamp"),
            F.max("offered_at").alias("last_offered_timestamp"),
            F.min("public_at").alias("earliest_public_timestamp"),
        )
        .where(
            F.col("earliest_offered_timestamp").between(end_ts, add_days(end_ts, horizon))
        )
    )
    recorded = existing.where(
        (F.col("days_since_first_offered") == 0) & (F.col("platform_name") == platform)
    )
    counts = ["total_retail_sub_count", "retail_played_count", "retail_viewed_count", "retail_completion_count"]
    shares = ["retail_played_count_percent", "retail_viewed_count_percent"]
    return new_rows(upcoming, recorded, ["match_id"]).select(
        *TITLE_KEYS,
        *attributes,
        F.lit(platform).alias("platform_name"),
        "earliest_offered_timestamp",
        "last_offered_timestamp",
        "earliest_public_timestamp",
        F.lit(0).alias("days_since_first_offered"),
        end_ts.alias("last_update_timestamp"),
        *[F.lit(None).cast("bigint").alias(c) for c in counts],
        *[F.lit(None).cast("double").alias(c) for c in shares],
    )
