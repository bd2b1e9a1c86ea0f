"""Title, campaign, genre and company text rules."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.constants import (
    CAMPAIGN_DETAIL_TITLES,
    CAMPAIGN_TITLES,
    GENRE_RULES,
    LICENSOR_RULES,
    TITLE_SPELLING,
    TRAILER_OVERRIDES,
)


def _before(text: Column, delimiter: str) -> Column:
    return F.split_part(text, F.lit(delimiter), F.lit(1))


def mapped(text: Column, table: Mapping[str, str]) -> Column:
    """Exact-match replacement, passthrough otherwise."""
    result = None
    for old, new in table.items():
        hit = text == old
        result = F.when(hit, F.lit(new)) if result is None else result.when(hit, F.lit(new))
    return text if result is None else result.otherwise(text)


def trailer_title(short_title: Column, long_title: Column) -> Column:
    """Title a trailer advertises, from its long title."""
    season = F.btrim(F.btrim(_before(long_title, ": Season")), F.lit('"'))
    plain = F.btrim(_before(_before(_before(long_title, ": Trailer"), "Trailer: "), " Trailer"))
    return F.when(short_title.contains("Season"), season).otherwise(plain)


def trailer_title_final(
    title: Column, overrides: Mapping[str, str] = TRAILER_OVERRIDES
) -> Column:
    result = None
    for part, new in overrides.items():
        hit = title.contains(part)
        result = F.when(hit, F.lit(new)) if result is None else result.when(hit, F.lit(new))
    plain = F.regexp_replace(title, F.lit("Trailer"), F.lit(""))
    return plain if result is None else result.otherwise(plain)


def without_season(title: Column) -> Column:
    """Drops a trailing season mark; a title that only contains " S" is kept."""
    return F.regexp_replace(title, F.lit(r" S[0-9]+$"), F.lit(""))


def before_season_mark(title: Column) -> Column:
    """Text before the first " S", as campaign names are matched."""
    return _before(title, " S")


def corrected_title(title: Column) -> Column:
    return mapped(title, TITLE_SPELLING)


def campaign_title(
    campaign: Column,
    detail: Column,
    umbrella_campaigns: Sequence[str] = ("-",),
    titles: Mapping[str, str] = CAMPAIGN_TITLES,
    detail_titles: Mapping[str, str] = CAMPAIGN_DETAIL_TITLES,
) -> Column:
    """Umbrella campaigns name the title in the detail column."""
    return F.when(campaign.isin(*umbrella_campaigns), mapped(detail, detail_titles)).otherwise(
        mapped(campaign, titles)
    )


def _apply(text: Column, rules: Iterable[tuple[str, str]]) -> Column:
    for pattern, replacement in rules:
        text = F.regexp_replace(text, F.lit(pattern), F.lit(replacement))
    return text


def tokens(text: Column, separator: str, min_length: int = 1) -> Column:
    """Distinct trimmed tokens, sorted, of at least ``min_length`` characters."""
    parts = F.transform(F.split(text, separator), lambda t: F.btrim(t))
    return F.array_sort(F.array_distinct(F.filter(parts, lambda t: F.length(t) >= min_length)))


def genre_tokens(*genre_columns: Column) -> Column:
    """Cleaned genre set; a missing column makes the title "others"."""
    joined = genre_columns[0]
    for column in genre_columns[1:]:
        joined = F.concat(joined, F.lit("|"), column)
    return tokens(_apply(F.coalesce(joined, F.lit("others")), GENRE_RULES), r"\|")


def licensor_tokens(licensor: Column, extra_rules: Iterable[tuple[str, str]] = ()) -> Column:
    rules = [*LICENSOR_RULES, *extra_rules]
    return tokens(_apply(F.coalesce(licensor, F.lit("no data")), rules), ",", min_length=3)


def spaced_genres(text: Column) -> Column:
    """Genre string of the hours tables: spaces around the bar removed."""
    text = F.coalesce(text, F.lit("nan"))
    return F.replace(F.replace(text, F.lit(" |"), F.lit("|")), F.lit("| "), F.lit("|"))


def program_type_flag(program_type: Column) -> Column:
    """original 1, acquired 0, unknown null."""
    return F.when(program_type == "original", 1.0).when(program_type == "acquired", 0.0)


def series_flag(category: Column) -> Column:
    return F.when(category == "series", 1.0).otherwise(0.0)


def first_view_category(title: Column, category: Column, content_category: Column) -> Column:
    """Content category with defaults and recodes; later rules win."""
    from marquee.constants import MOVIE_FIRST_VIEW_CATEGORIES, SPECIAL_FIRST_VIEW_CATEGORIES

    return (
        F.when(title.contains("Harry Potter"), "special")
        .when(category.isin(*MOVIE_FIRST_VIEW_CATEGORIES), "movies")
        .when(category.isin(*SPECIAL_FIRST_VIEW_CATEGORIES), "special")
        .otherwise(F.coalesce(content_category, F.lit("series")))
    )
