"""Encyclopedia page views around a launch, and the list of titles to follow."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.constants import (
    IMDB_ID_LENGTHS,
    PAGEVIEW_AFTER_DAYS,
    PAGEVIEW_BEFORE_DAYS,
)
from marquee.functions.dates import add_days
from marquee.functions.keys import LEGACY_PLATFORM, match_id_platform
from marquee.functions.metrics import or_never_observed
from marquee.functions.text import corrected_title
from marquee.operators.pivots import day_pivot

SERIES_ID_LENGTH = 21


def tracked_titles(
    assets: DataFrame,
    titles: DataFrame,
    catalog: DataFrame,
    first_launch: str,
    legacy: str = LEGACY_PLATFORM,
    series_id_length: int = SERIES_ID_LENGTH,
    id_lengths: tuple[int, ...] = IMDB_ID_LENGTHS,
) -> DataFrame:
    """Titles with an outside id: movies by asset, series by the series part of the key.

    ``catalog`` has viewable_id, title_ref and series_ref. All seasons of a series
    share one outside page.
    """
    recent = titles.where(F.col("launch") >= F.lit(first_launch).cast("timestamp")).select(
        "title_name", "match_id", "platform_name", "launch"
    )
    key = match_id_platform(F.col("platform_name"), F.col("match_id"), legacy)
    movies = (
        recent.join(
            assets.where(F.col("content_category").isin("movies", "special")).select(
                F.col("viewable_id").alias("match_id"), "content_category"
            ),
            "match_id",
        )
        .join(
            catalog.where(F.length("title_ref").isin(*id_lengths)).select(
                F.col("viewable_id").alias("match_id"), F.col("title_ref").alias("outside_id")
            ),
            "match_id",
        )
        .select(
            corrected_title(F.col("title_name")).alias("title_name"),
            key.alias("match_id_platform"),
            "outside_id",
            "launch",
            F.when(F.col("content_category") == "movies", "movie")
            .otherwise(F.col("content_category"))
            .alias("category"),
        )
    )
    series = (
        recent.withColumn("series_id", F.substring("match_id", 1, series_id_length))
        .join(
            assets.where(F.col("content_category") == "series").select("series_id", "viewable_id"),
            "series_id",
        )
        .join(
            catalog.where(F.length("series_ref").isin(*id_lengths)).select(
                "viewable_id", F.col("series_ref").alias("outside_id")
            ),
            "viewable_id",
        )
        .select(
            "title_name",
            key.alias("match_id_platform"),
            "outside_id",
            "launch",
            F.lit("series").alias("category"),
        )
    )
    return movies.unionByName(series).distinct()


def social_title_list(tracked: DataFrame, language: str = "en") -> DataFrame:
    """Search terms per tracked group."""
    return tracked.select(
        F.col("outside_id").alias("tracking_group_id"),
        F.lit(language).alias("language"),
        "category",
        F.col("title_name").alias("query_term"),
    ).distinct()


def page_view_table(
    page_views: DataFrame,
    id_map: DataFrame,
    tracked: DataFrame,
    before: int = PAGEVIEW_BEFORE_DAYS,
    after: int = PAGEVIEW_AFTER_DAYS,
) -> DataFrame:
    """Views per title and day, from 64 days before launch to 28 after.

    Titles with several outside ids, and ids shared by several titles, are left out.
    """
    titles = tracked.select("title_name", "match_id_platform", "outside_id", "launch").distinct()
    articles = id_map.select("outside_id", "article").distinct()
    linked = titles.join(articles.select("outside_id").distinct(), "outside_id", "left_semi")
    pairs = linked.select("match_id_platform", "outside_id").distinct()
    one_id = pairs.groupBy("match_id_platform").count().where("count < 2")
    one_title = pairs.groupBy("outside_id").count().where("count < 2")
    clean = linked.join(one_id, "match_id_platform", "left_semi").join(
        one_title, "outside_id", "left_semi"
    )
    pages = clean.join(articles, "outside_id")
    # page-view dates are text in the source; they are compared as dates. Summed here,
    # a popular article brings one row per day to the join.
    views = page_views.groupBy("article", F.to_date("date").alias("date")).agg(
        F.sum("page_views").alias("page_views")
    )
    return (
        views.join(pages, "article")
        .where(
            (F.col("date") >= add_days(F.col("launch"), -before))
            & (F.col("date") <= add_days(F.col("launch"), after))
        )
        .groupBy(
            "title_name",
            "date",
            F.datediff("date", "launch").alias("days_since_first_offered"),
            "match_id_platform",
            "outside_id",
            "launch",
        )
        .agg(F.sum("page_views").alias("total_page_views"))
    )


def views_before(table: DataFrame, titles: DataFrame) -> DataFrame:
    """Total views more than 27 days before launch, -1 where none were observed."""
    early = (
        table.where(F.col("days_since_first_offered") < -27)
        .groupBy("match_id_platform")
        .agg(F.sum("total_page_views").alias("_total"))
    )
    return (
        titles.select("match_id_platform")
        .distinct()
        .join(early, "match_id_platform", "left")
        .select(
            "match_id_platform",
            or_never_observed(F.col("_total").cast("double")).alias("wiki_befored28_total"),
        )
    )


def _cumulative(table: DataFrame, first: int, last: int) -> DataFrame:
    w = Window.partitionBy("match_id_platform").orderBy("days_since_first_offered")
    # one row per title and day before the window runs
    daily = (
        table.where(F.col("days_since_first_offered").between(first, last))
        .groupBy("match_id_platform", "days_since_first_offered")
        .agg(F.sum("total_page_views").alias("total_page_views"))
    )
    return daily.withColumn("cumulative_views", F.sum("total_page_views").over(w).cast("double"))


def cumulative_views_before(table: DataFrame, titles: DataFrame) -> DataFrame:
    """Columns ``day027_wiki_d28`` .. ``day000_wiki_d28``, days counted back from launch."""
    return day_pivot(
        _cumulative(table, -27, 0),
        "match_id_platform",
        "days_since_first_offered",
        "cumulative_views",
        range(27, -1, -1),
        "wiki_d28",
        titles,
        -1.0,
        negate=True,
    )


def cumulative_views_after(table: DataFrame, titles: DataFrame) -> DataFrame:
    """Columns ``day001_wiki_view`` .. ``day027_wiki_view``."""
    return day_pivot(
        _cumulative(table, 1, 27),
        "match_id_platform",
        "days_since_first_offered",
        "cumulative_views",
        range(1, 28),
        "wiki_view",
        titles,
        -1.0,
    )
