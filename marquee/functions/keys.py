"""Title and platform keys used by every table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

CURRENT_PLATFORM = "current"
LEGACY_PLATFORM = "legacy"


@dataclass(frozen=True)
class PlatformRule:
    """Providers that sell ``platform`` from ``first_day`` on."""

    providers: Sequence[str]
    first_day: str
    platform: str = CURRENT_PLATFORM


DEFAULT_PLATFORM_RULES = (
    PlatformRule(("dtc", "google", "samsung", "apple"), "2020-05-27"),
    PlatformRule(("amazon",), "2020-11-17"),
    PlatformRule(("roku",), "2020-12-17"),
)


def season_number_adj(category: Column, season: Column) -> Column:
    """A series without a season number is its first season."""
    return F.when(category == "series", F.coalesce(season, F.lit(1))).otherwise(season)


def match_id(series_id: Column, season_adj: Column, viewable_id: Column) -> Column:
    """``series-season`` when both are known, else the asset itself."""
    return F.coalesce(F.concat(series_id, F.lit("-"), season_adj.cast("string")), viewable_id)


def match_id_by_category(
    category: Column, series_id: Column, season: Column, viewable_id: Column
) -> Column:
    """Variant that decides by category; a series without an id gives null."""
    season_text = F.coalesce(season, F.lit(1)).cast("string")
    return F.when(category == "series", F.concat(series_id, F.lit("-"), season_text)).otherwise(
        viewable_id
    )


def match_id_from_season_title(title_id: Column, category: Column, season_title: Column) -> Column:
    """Variant for cost files, where the season is the last character of a title."""
    suffix = F.concat(F.lit("-"), F.coalesce(F.right(season_title, F.lit(1)), F.lit("1")))
    return F.concat(title_id, F.when(category == "series", suffix).otherwise(F.lit("")))


def title_name(series_title: Column, season_adj: Column, asset_title: Column) -> Column:
    return F.coalesce(
        F.concat(series_title, F.lit(" S"), season_adj.cast("string")), asset_title
    )


def match_title(series_title: Column, season: Column, asset_title: Column) -> Column:
    """The "Title (Season n)" spelling used by the hours tables."""
    text = F.concat(
        series_title, F.lit(" (Season "), F.coalesce(season, F.lit(1)).cast("string"), F.lit(")")
    )
    return F.when(series_title.isNotNull(), text).otherwise(asset_title)


def platform_flag(platform: Column, legacy: str = LEGACY_PLATFORM) -> Column:
    """0 for the legacy platform, 1 for anything else, an unknown one included."""
    return F.when(platform == legacy, F.lit(0)).otherwise(F.lit(1))


def match_id_platform(platform: Column, match: Column, legacy: str = LEGACY_PLATFORM) -> Column:
    return F.concat(platform_flag(platform, legacy).cast("string"), F.lit("-"), match)


def single_episode_ind(series_id: Column) -> Column:
    return F.when(series_id.isNull(), F.lit(1)).otherwise(F.lit(0))


def subscription_platform(
    provider: Column,
    start: Column,
    rules: Sequence[PlatformRule] = DEFAULT_PLATFORM_RULES,
    legacy: str = LEGACY_PLATFORM,
) -> Column:
    """First matching provider rule; before the earliest first day it is the legacy service."""
    day = F.to_date(start)
    branches = None
    for rule in rules:
        hit = provider.isin(*rule.providers) & (day >= F.lit(rule.first_day).cast("date"))
        branches = (
            F.when(hit, F.lit(rule.platform))
            if branches is None
            else branches.when(hit, F.lit(rule.platform))
        )
    earliest = min(rule.first_day for rule in rules)
    return branches.when(day < F.lit(earliest).cast("date"), F.lit(legacy))
