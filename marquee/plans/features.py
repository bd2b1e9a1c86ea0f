"""Feature tables for the launch models, kept long until the last step."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.constants import (
    FUNNEL_DAYS,
    NEVER_OBSERVED,
    NOT_REACHED,
    POSTLAUNCH_SIGNALS,
    PRELAUNCH_COST_DAYS,
    SERVICE_LAUNCH_DATE,
    TRAILER_DAYS,
    ZERO_FLOOR,
)
from marquee.functions.dates import (
    add_days,
    add_minutes,
    age_in_years,
    at_release_year,
    day_label,
    day_of_week,
    earliest_or_far_future,
    in_sequential_release,
)
from marquee.functions.keys import (
    CURRENT_PLATFORM,
    LEGACY_PLATFORM,
    match_id,
    match_id_from_season_title,
    match_id_platform,
    platform_flag,
    season_number_adj,
)
from marquee.functions.metrics import (
    guarded_ratio,
    log1p_or_never,
    log1p_unless_never,
    log_floored,
    log_or_not_reached,
    log_ratio_or_not_reached,
    or_never_observed,
    seconds_to_hours,
    to_millions,
)
from marquee.functions.text import before_season_mark, campaign_title
from marquee.operators.aggregates import distinct_list, latest_per_key, modes_per_key
from marquee.operators.pivots import day_pivot

KEY = "match_id_platform"


def titles_of(funnel: DataFrame, legacy: str = LEGACY_PLATFORM) -> DataFrame:
    return funnel.withColumn(
        KEY, match_id_platform(F.col("platform_name"), F.col("match_id"), legacy)
    )


# --- day curves of the funnel table -----------------------------------------


def percent_viewed_feature(funnel: DataFrame, days: Iterable[int] = FUNNEL_DAYS) -> DataFrame:
    """``dayNNN_percent_viewed`` per title, and the last day observed."""
    rows = titles_of(funnel)
    last = rows.groupBy(KEY).agg(
        F.max("days_since_first_offered").alias("max_days_since_first_offered")
    )
    wide = day_pivot(
        rows, KEY, "days_since_first_offered", "retail_viewed_count_percent", days, "percent_viewed"
    )
    return wide.join(last, KEY)


def sub_count_feature(funnel: DataFrame, days: Iterable[int] = FUNNEL_DAYS) -> DataFrame:
    return day_pivot(
        titles_of(funnel), KEY, "days_since_first_offered", "total_retail_sub_count", days, "sub_count"
    )


def viewed_through_feature(funnel: DataFrame, days: Iterable[int] = FUNNEL_DAYS) -> DataFrame:
    """Viewed share over played share, 0 where nothing was played."""
    portion = guarded_ratio(
        F.col("retail_viewed_count_percent"), F.col("retail_played_count_percent")
    )
    rows = titles_of(funnel).withColumn("vtp", F.coalesce(portion, F.lit(0.0)))
    return day_pivot(rows, KEY, "days_since_first_offered", "vtp", days, "vtp")


# --- marketing cost ------------------------------------------------------------


def clean_campaigns(
    spend: DataFrame, products: Sequence[str], umbrella_campaigns: Sequence[str] = ("-",)
) -> DataFrame:
    """Spend rows with the title they advertise; ``spend`` has campaign, detail,
    product, tag, day and media_cost."""
    return (
        spend.where(F.col("product").isin(*products) & F.col("tag").isNull())
        .select(
            campaign_title(F.col("campaign"), F.col("detail"), umbrella_campaigns).alias("campaign_title"),
            F.to_date("day").alias("day"),
            "media_cost",
            "product",
        )
        .distinct()
    )


def _spend_platform(
    current_product: str, current: str, legacy: str, since: str
) -> Column:
    hit = (F.col("product") == current_product) | (F.col("day") >= F.lit(since).cast("date"))
    return F.when(hit, F.lit(current)).otherwise(F.lit(legacy))


def _spend_by_title(
    titles: DataFrame,
    campaigns: DataFrame,
    current_product: str,
    current: str,
    legacy: str,
    since: str,
) -> DataFrame:
    """Spend meets titles on lower-cased name and platform, both ready as columns.

    Spend is summed by name and day first: a heavily advertised title then holds
    one row per day, however many spend rows it has.
    """
    platform = _spend_platform(current_product, current, legacy, since)
    ads = campaigns.groupBy(
        F.lower("campaign_title").alias("_name"), platform.alias("platform_name"), "day"
    ).agg(
        F.sum("media_cost").alias("cost"), F.sum(F.col("media_cost") + 1).alias("cost_plus_ones")
    )
    named = titles.withColumn("_name", F.lower(before_season_mark(F.col("title_name"))))
    return named.join(ads, ["_name", "platform_name"])


def media_cost_curve(
    funnel: DataFrame,
    campaigns: DataFrame,
    current_product: str,
    current: str = CURRENT_PLATFORM,
    legacy: str = LEGACY_PLATFORM,
    since: str = SERVICE_LAUNCH_DATE,
) -> DataFrame:
    """Log of the spend accumulated per day since launch, -1 while none is known."""
    rows = titles_of(funnel, legacy).select(
        "title_name",
        "platform_name",
        KEY,
        F.col("earliest_offered_timestamp").alias("launch"),
        F.col("days_since_first_offered").alias("n"),
    ).distinct()
    titles = rows.drop("n").distinct()
    daily = (
        _spend_by_title(titles, campaigns, current_product, current, legacy, since)
        .where(F.col("day") >= F.col("launch"))
        .groupBy(KEY, F.datediff("day", F.to_date("launch")).alias("n"))
        .agg(F.sum("cost").alias("_spend"))
    )
    observed = rows.where(F.col("n") <= 28).select(KEY, "n").distinct()
    w = Window.partitionBy(KEY).orderBy("n")
    return observed.join(daily, [KEY, "n"], "left").select(
        KEY, "n", log1p_or_never(F.sum("_spend").over(w)).alias("ln_cum_total_media_cost")
    )


def media_cost_feature(curve: DataFrame, days: Iterable[int] = FUNNEL_DAYS) -> DataFrame:
    return day_pivot(curve, KEY, "n", "ln_cum_total_media_cost", days, "mc")


def prelaunch_cost(
    funnel: DataFrame,
    campaigns: DataFrame,
    current_product: str,
    current: str = CURRENT_PLATFORM,
    legacy: str = LEGACY_PLATFORM,
    since: str = SERVICE_LAUNCH_DATE,
    days: int = PRELAUNCH_COST_DAYS,
) -> DataFrame:
    """Log of the sum of (cost + 1) over the 56 days up to a minute before launch."""
    titles = titles_of(funnel, legacy).select(
        "title_name", "platform_name", KEY, F.col("earliest_offered_timestamp").alias("launch")
    ).distinct()
    spent = (
        _spend_by_title(titles, campaigns, current_product, current, legacy, since)
        .where(
            (F.col("day") >= add_days(F.col("launch"), -days))
            & (F.col("day") <= add_minutes(F.col("launch"), -1))
        )
        .groupBy(KEY, "_name")
        .agg(F.log(F.sum("cost_plus_ones")).alias("_ln"))
        .groupBy(KEY)
        .agg(F.max("_ln").alias("_ln"))
    )
    return titles.select(KEY).distinct().join(spent, KEY, "left").select(
        KEY, or_never_observed(F.col("_ln")).alias("ln_total_media_cost_pre_launch")
    )


# --- metadata and cost ----------------------------------------------------------

_PUBLIC_DATES = (
    "first_offered_date_linear",
    "original_linear_air_date",
    "theatrical_release_date",
    "first_offered_date_current",
    "first_offered_date_legacy",
    "premiere_air_date",
)
_LISTS = ("licensor", "descriptive_genre_desc", "wm_enterprise_genres", "navigation_genre_desc")


def metadata_by_title(assets: DataFrame, edits: DataFrame) -> DataFrame:
    """Attributes of a title from its assets: usual type, hours, name lists, first date."""
    run_time = edits.groupBy("viewable_id").agg(
        F.avg("credits_start_time").alias("credits_start_time")
    )
    season = season_number_adj(F.col("content_category"), F.col("season_number"))
    rows = (
        assets.join(run_time, "viewable_id", "left")
        .select(
            match_id(F.col("series_id"), season, F.col("viewable_id")).alias("match_id"),
            F.when(F.col("content_category") == "series", F.coalesce("season_number", F.lit(1)))
            .otherwise(F.coalesce("season_number", F.lit(-1)))
            .alias("season_number_adj"),
            "viewable_id",
            F.coalesce("program_type", F.lit("unknown")).alias("program_type"),
            "content_category",
            "credits_start_time",
            "release_year",
            *_LISTS,
            earliest_or_far_future(*[F.col(c) for c in _PUBLIC_DATES]).alias("public_at"),
        )
        .distinct()
    )
    keys = ["match_id", "season_number_adj"]
    totals = rows.groupBy(*keys).agg(
        or_never_observed(seconds_to_hours(F.sum("credits_start_time"))).alias("total_hours"),
        F.min("release_year").alias("prod_release_year"),
        F.min("public_at").alias("earliest_public_timestamp"),
        *[distinct_list(F.lower(c)).alias(f"{c}_agg") for c in _LISTS],
    )
    return totals.join(modes_per_key(rows, keys, ["program_type", "content_category"]), keys)


def metadata_feature(
    metadata: DataFrame, funnel: DataFrame, legacy: str = LEGACY_PLATFORM
) -> DataFrame:
    """Metadata per title and platform with release flags and age."""
    offered = F.col("earliest_offered_timestamp")
    launches = funnel.select(
        "title_name",
        "match_id",
        "platform_name",
        "earliest_offered_timestamp",
        "last_offered_timestamp",
        "single_episode_ind",
    ).distinct()
    return (
        metadata.join(launches, "match_id")
        .select(
            "title_name",
            "match_id",
            match_id_platform(F.col("platform_name"), F.col("match_id"), legacy).alias(KEY),
            "season_number_adj",
            "earliest_offered_timestamp",
            platform_flag(F.col("platform_name"), legacy).alias("platform_name"),
            "program_type",
            "content_category",
            "single_episode_ind",
            in_sequential_release(offered, F.col("last_offered_timestamp")).alias(
                "in_sequantial_releasing_period"
            ),
            at_release_year(offered, F.col("prod_release_year")).alias("at_release_year"),
            day_of_week(offered).alias("dayofweek_earliest_date"),
            "total_hours",
            "prod_release_year",
            age_in_years(
                F.col("earliest_public_timestamp"), offered, F.col("prod_release_year")
            ).alias("title_age_approx"),
            *[f"{c}_agg" for c in _LISTS],
        )
        .distinct()
    )


def content_cost(costs: DataFrame, funnel: DataFrame) -> DataFrame:
    """Highest recorded cost of a title in millions, -1 if none."""
    per_title = (
        costs.select(
            match_id_from_season_title(
                F.col("title_id"), F.col("content_category"), F.col("season_or_movie_title")
            ).alias("match_id"),
            to_millions(F.col("total_cost")).alias("_cost"),
        )
        .groupBy("match_id")
        .agg(F.max("_cost").alias("_cost"))
    )
    return (
        titles_of(funnel)
        .select(KEY, "match_id")
        .distinct()
        .join(per_title, "match_id", "left")
        .groupBy(KEY)
        .agg(or_never_observed(F.max("_cost")).alias("content_cost"))
    )


def production_budget(
    budgets: DataFrame, catalog: DataFrame, assets: DataFrame, funnel: DataFrame
) -> DataFrame:
    """Largest budget per asset, summed over a title's assets, -1 if none."""
    season = season_number_adj(F.col("content_category"), F.col("season_number"))
    per_asset = (
        budgets.join(catalog.select("viewable_id", "title_ref"), "title_ref")
        .join(
            assets.where(
                F.col("asset_type").isin("FEATURE", "ELEMENT")
                & F.col("first_offered_date_current").isNotNull()
                & F.col("content_category").isNotNull()
            ).select(
                "viewable_id",
                match_id(F.col("series_id"), season, F.col("viewable_id")).alias("match_id"),
            ),
            "viewable_id",
        )
        .groupBy("match_id", "viewable_id")
        .agg(F.max(to_millions(F.col("amount"))).alias("_budget"))
    )
    total = per_asset.groupBy("match_id").agg(F.sum("_budget").alias("_budget"))
    return (
        titles_of(funnel)
        .select(KEY, "match_id")
        .distinct()
        .join(total, "match_id", "left")
        .select(KEY, or_never_observed(F.col("_budget")).alias("total_production_budget_imdb"))
    )


# --- trailers ---------------------------------------------------------------------


def latest_trailer_feature(trailers: DataFrame, funnel: DataFrame) -> DataFrame:
    """Reach on the last recorded day before launch, and its average per day."""
    columns = ["cumulative_day_num", "total_trailer_num", "retail_trailer_view_metric"]
    latest = latest_per_key(
        trailers, [KEY], [F.col("nday_before"), *[F.col(c) for c in columns]], columns
    )
    per_day = F.try_divide("retail_trailer_view_metric", "cumulative_day_num")
    return (
        titles_of(funnel)
        .select(KEY)
        .distinct()
        .join(latest, KEY, "left")
        .select(
            KEY,
            *[or_never_observed(F.col(c).cast("double")).alias(c) for c in columns],
            or_never_observed(per_day).alias("avg_trail_metric_per_day"),
        )
    )


def early_trailer_feature(early: DataFrame, funnel: DataFrame) -> DataFrame:
    """Reach until 28 days before launch from the newest run."""
    columns = ["cumulative_day_num", "retail_trailer_view_metric"]
    latest = latest_per_key(
        early, [KEY], [F.col("last_update_timestamp"), *[F.col(c) for c in columns]], columns
    )
    return (
        titles_of(funnel)
        .select(KEY)
        .distinct()
        .join(latest, KEY, "left")
        .select(
            KEY,
            or_never_observed(F.col("cumulative_day_num").cast("double")).alias(
                "trailer_metric_before28_cumday"
            ),
            or_never_observed(F.col("retail_trailer_view_metric")).alias("trailer_metric_before28"),
        )
    )


def prelaunch_trailer_feature(trailers: DataFrame, funnel: DataFrame) -> DataFrame:
    titles = titles_of(funnel).select(KEY)
    return day_pivot(
        trailers,
        KEY,
        "nday_before",
        "retail_trailer_view_metric",
        sorted(-d for d in TRAILER_DAYS),
        "trailer_metric_d28",
        titles,
        -1.0,
        negate=True,
    )


# --- long day signals ----------------------------------------------------------------


def day_grid(signal: DataFrame, titles: DataFrame, days: Iterable[int]) -> DataFrame:
    """Every title with every day, and the signal's value where there is one."""
    listed = F.array(*[F.lit(d) for d in days])
    return titles.withColumn("day", F.explode(listed)).join(signal, [KEY, "day"], "left")


def _clean(value: Column, reached: Column, floor_zero: bool = True) -> Column:
    filled = F.coalesce(value, F.lit(0.0))
    if floor_zero:
        filled = F.when(filled <= ZERO_FLOOR, F.lit(ZERO_FLOOR)).otherwise(filled)
    return F.when(reached, filled).otherwise(F.lit(NOT_REACHED))


def clean_day_values(grid: DataFrame, value: str, floor_zero: bool = True) -> DataFrame:
    """Days not reached -100, missing values 0, and zeros lifted to the log floor."""
    return grid.withColumn(value, _clean(F.col(value), F.col("day") <= F.col("max_day"), floor_zero))


def clean_day_list(values: Column, max_day: Column) -> Column:
    """``clean_day_values`` of a title's days 1, 2, ... as one array."""
    return F.transform(values, lambda v, i: _clean(v, i + 1 <= max_day))


def log_lists(cleaned: Column) -> tuple[Column, Column]:
    """``log_features`` of a title's cleaned days 1, 2, ... as two arrays: logs, and log ratios
    to day 1."""
    logs = F.transform(cleaned, log_or_not_reached)
    return logs, F.transform(cleaned, lambda v: log_ratio_or_not_reached(v, F.get(cleaned, 0)))


def log_features(cleaned: DataFrame, value: str) -> DataFrame:
    """Log and log ratio to day 1; a title has one row per day, so the window is small."""
    day1 = F.max(F.when(F.col("day") == 1, F.col(value))).over(Window.partitionBy(KEY))
    return cleaned.withColumn("_day1", day1).select(
        KEY,
        "day",
        value,
        log_or_not_reached(F.col(value)).alias("log_value"),
        log_ratio_or_not_reached(F.col(value), F.col("_day1")).alias("log_ratio"),
    )


def latest_signal(
    signal: DataFrame, value: str, days_before: int, towards_launch: bool = True
) -> DataFrame:
    """The signal on the last day at least ``days_before`` days before launch, logged.

    ``day`` counts back from launch, so the wanted day is the smallest allowed one. On
    a grid filled with -1 that is exactly ``days_before``. Trailer columns are listed
    away from launch; with ``towards_launch=False`` the last listed day is the largest.
    """
    eligible = signal.where(F.col("day") >= days_before)
    order = -F.col("day") if towards_launch else F.col("day")
    picked = latest_per_key(eligible, [KEY], [order], ["day", value])
    return picked.select(
        KEY, F.col("day").alias("signal_day"), log_floored(F.col(value)).alias("selected")
    )


def signal_days(signal: DataFrame, value: str, cumulative_days: str, days_before: int) -> DataFrame:
    """28 less the first observed day of a trailer, plus its days beyond those 28.

    Only days known ``days_before`` days ahead of launch count; a signal that was
    never observed has no row.
    """
    observed = signal.where((F.col("day") >= days_before) & (F.col(value) != NEVER_OBSERVED))
    first = observed.groupBy(KEY).agg(
        F.max("day").alias("_first"), F.max(cumulative_days).alias("_days")
    )
    return first.select(
        KEY,
        (F.lit(28) - F.col("_first") + F.greatest(F.col("_days") - 28, F.lit(0))).alias(
            "cumulative_days"
        ),
    )


def page_view_totals(rows: DataFrame) -> DataFrame:
    """Sums of the page-view signals where both parts exist, logged unless never observed."""
    if {"wiki_d28_selected", "wiki_befored28_total"} <= set(rows.columns):
        total = F.col("wiki_d28_selected") + F.col("wiki_befored28_total")
        rows = rows.withColumn("wiki_view_total", log1p_unless_never(total))
    if {"day000_wiki_d28", "wiki_befored28_total"} <= set(rows.columns):
        total = F.col("day000_wiki_d28") + F.col("wiki_befored28_total")
        rows = rows.withColumn("wiki_prelaunch_total", log1p_unless_never(total))
    return rows


def popular_titles(titles: DataFrame, value: str, threshold: DataFrame) -> DataFrame:
    """Titles at or above the threshold on day 1, or not observed yet.

    ``threshold`` is a single row.
    """
    return (
        titles.crossJoin(F.broadcast(threshold))
        .where((F.col(value) >= F.col("threshold")) | (F.col(value) == NOT_REACHED))
        .drop("threshold")
    )


def assemble(
    long_features: DataFrame, metrics: Sequence[str], last_day: int, first_day: int = 1
) -> DataFrame:
    """Wide row per title from ``(key, metric, day, value)`` up to ``last_day``."""
    wanted = [
        f"day{d:03d}_{m}" for m in metrics for d in range(first_day, last_day + 1)
    ]
    labelled = long_features.where(
        F.col("metric").isin(*metrics) & F.col("day").between(first_day, last_day)
    ).withColumn("_label", F.concat_ws("_", F.format_string("day%03d", "day"), "metric"))
    return labelled.groupBy(KEY).pivot("_label", wanted).agg(F.max("value"))


@dataclass(frozen=True)
class FeatureChoice:
    """Which forms of the day signals a model reads when it knows ``last_day`` days."""

    last_day: int
    log_target: bool = True
    log_ratio: bool = True
    raw_log: bool = True
    cumulative_cost: bool = True

    def spans(self, signals: Sequence[str] = POSTLAUNCH_SIGNALS) -> list[tuple[str, int, int]]:
        """``(metric, first day, last day)``; spending is logged already and stays as it is."""
        if self.last_day < 1:
            return []
        shares = [m for m in signals if m != "mc"]
        chosen: list[tuple[str, int, int]] = []
        if not self.log_target:
            chosen += [(m, 1, self.last_day) for m in shares if "percent" in m]
        elif self.log_ratio:
            chosen += [(f"log_{m}", 1, 1) for m in shares]
            chosen += [(f"log_ratio_{m}", 2, self.last_day) for m in shares]
        if self.raw_log or (self.log_target and not self.log_ratio):
            chosen = [c for c in chosen if not (c[0].startswith("log_") and c[1:] == (1, 1))]
            chosen += [(f"log_{m}", 1, self.last_day) for m in shares]
        if "mc" in signals:
            chosen.append(("mc", self.last_day if self.cumulative_cost else 1, self.last_day))
        return [c for c in chosen if c[2] >= c[1]]


def assemble_chosen(long_features: DataFrame, choice: FeatureChoice, signals=POSTLAUNCH_SIGNALS) -> DataFrame:
    """Wide row per title holding the chosen metric and day combinations."""
    spans = choice.spans(signals)
    labels = [f"day{d:03d}_{m}" for m, low, high in spans for d in range(low, high + 1)]
    wanted = F.lit(False)
    for metric, low, high in spans:
        wanted = wanted | ((F.col("metric") == metric) & F.col("day").between(low, high))
    labelled = long_features.where(wanted).withColumn(
        "_label", F.concat_ws("_", F.format_string("day%03d", "day"), "metric")
    )
    return labelled.groupBy(KEY).pivot("_label", labels).agg(F.max("value"))


def originals(rows: DataFrame) -> DataFrame:
    """Original titles only; ``program_type`` is a 0/1 code here."""
    return rows.where(F.col("program_type") == 1)


def with_signal(rows: DataFrame, signals: Sequence[str], all_of_them: bool = False) -> DataFrame:
    """Titles with an observed signal. By default one signal above -1 is enough;
    with ``all_of_them`` a title is dropped as soon as one was never observed."""
    if all_of_them:
        condition = F.lit(True)
        for c in signals:
            condition = condition & (F.col(c) != NEVER_OBSERVED)
    else:
        condition = F.lit(False)
        for c in signals:
            condition = condition | (F.col(c) > NEVER_OBSERVED)
    return rows.where(condition)


def percent_actives_feature(
    actives: DataFrame, metadata: DataFrame, days: Iterable[int] = FUNNEL_DAYS
) -> DataFrame:
    """``dayNNN_percent_actives`` per title; repeated values of a day are averaged."""
    days = list(days)
    keyed = actives.join(metadata.select("match_id", KEY).distinct(), "match_id")
    mean = keyed.groupBy(KEY, "days_on_platform").agg(F.avg("pct_actives").alias("_mean"))
    labelled = mean.where(F.col("days_on_platform").isNotNull()).select(
        KEY, day_label(F.col("days_on_platform"), "percent_actives").alias("_label"), "_mean"
    )
    labels = [f"day{d:03d}_percent_actives" for d in days]
    return labelled.groupBy(KEY).pivot("_label", labels).agg(F.max("_mean"))


def train_and_score(rows: DataFrame, target: str, platform: str) -> tuple[DataFrame, DataFrame]:
    """Titles with a target to learn from, and those of the current platform without."""
    known = F.col(target) != NOT_REACHED
    return rows.where(known), rows.where(~known & (F.col(platform) == 1))


def fully_observed(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a feature whose day is still ahead."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & (F.col(c) != NOT_REACHED)
    return rows.where(condition)


def observed_until(long_features: DataFrame, value: str, day: int, default: int) -> DataFrame:
    """Titles whose last observed day is exactly ``day``."""
    last = F.coalesce(
        F.max(F.when(F.col(value) != NOT_REACHED, F.col("day"))), F.lit(default)
    )
    return long_features.groupBy(KEY).agg(last.alias("last_day")).where(F.col("last_day") == day)
