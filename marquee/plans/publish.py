"""Dashboard tables and title rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.dates import decade
from marquee.functions.keys import CURRENT_PLATFORM
from marquee.operators.aggregates import latest_per_key


def _latest_prediction(predictions: DataFrame) -> DataFrame:
    """Newest prediction per title and platform; ties go to the larger value."""
    return latest_per_key(
        predictions,
        ["title_name", "platform_name"],
        [F.col("pred_day"), F.col("percent_view_pred"), F.col("match_id")],
        ["match_id", "percent_view_pred", "pred_day"],
    )


def predicted_metrics(
    active_predictions: DataFrame,
    view_predictions: DataFrame,
    funnel: DataFrame,
    current: str = CURRENT_PLATFORM,
    target_day: int = 28,
) -> DataFrame:
    """Latest predictions of both metrics per title, whichever of the two exists."""
    actives = (
        _latest_prediction(active_predictions)
        .where((F.col("platform_name") == 1) & (F.col("pred_day") > 0))
        .select("match_id", F.col("percent_view_pred").alias("percent_actives"))
    )
    known = (
        funnel.where(F.col("platform_name") == current)
        .select("title_name", "match_id", "earliest_offered_timestamp")
        .distinct()
    )
    views = (
        _latest_prediction(view_predictions)
        .where(F.col("platform_name") == 1)
        .join(known, ["title_name", "match_id"])
        .select("title_name", "match_id", (F.col("percent_view_pred") * 100).alias("percent_view"))
    )
    return (
        actives.join(views, "match_id", "full")
        .select(
            "title_name",
            "match_id",
            F.lit(target_day).alias("days_since_first_offered"),
            "percent_actives",
            "percent_view",
            F.lit("prediction").alias("data_type"),
        )
        .distinct()
    )


def actual_metrics(
    actives: DataFrame, funnel: DataFrame, current: str = CURRENT_PLATFORM
) -> DataFrame:
    """Observed metrics of the current platform. Filtering on the funnel side keeps
    every funnel row and only matching actives, so the join starts from the funnel."""
    seen = funnel.where(F.col("platform_name") == current).select(
        "title_name",
        "match_id",
        "days_since_first_offered",
        (F.col("retail_viewed_count_percent") * 100).alias("percent_view"),
    )
    active = actives.select(
        "match_id",
        F.col("days_on_platform").alias("days_since_first_offered"),
        F.col("pct_actives").alias("percent_actives"),
    )
    return seen.join(active, ["match_id", "days_since_first_offered"], "left").select(
        "title_name",
        "match_id",
        "days_since_first_offered",
        "percent_actives",
        "percent_view",
        F.lit("actual").alias("data_type"),
    )


def full_outer_metrics(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join with one coalesced key."""
    return left.join(right, keys, "full")


def decade_rollup(titles: DataFrame, n: int | None = None) -> DataFrame:
    """Titles and mean rating per decade, most titles first."""
    rolled = (
        titles.groupBy(decade(F.col("year")).alias("decade"))
        .agg(F.count("movie_title").alias("movie_count"), F.avg("rating").alias("rating_mean"))
        .orderBy(F.desc("movie_count"), "decade")
    )
    return rolled if n is None else rolled.limit(n)
