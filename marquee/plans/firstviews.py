"""First views: what subscribers watch first. Daily grid, references, decay, forecast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.constants import (
    CONTENT_CATEGORIES,
    FEATURED_TYPE,
    FIRST_VIEW_COUNTRIES,
    FIRST_VIEWS_CAP,
    GRID_DAYS,
    MIN_STREAM_SECONDS,
    PREQUEL_CAP,
    PREQUEL_FEATURED_CAP,
    PREQUEL_TYPES,
    REFERENCE_TYPES,
    TITLE_ASSET_TYPES,
)
from marquee.functions.dates import finished_window, month_start, quarter_start
from marquee.functions.metrics import (
    log_zero_is_zero,
    row_sum,
    seconds_to_hours,
    tier_adjusted,
    winsorise,
)
from marquee.operators.aggregates import percentiles_per_key, with_group_total
from marquee.operators.joins import band_join, partitions_for
from marquee.session import stored

TITLE = ("title_id", "title_name", "season_number", "content_category", "category", "tier")
#: Bytes of titles behind one partition of the calendar, where each becomes a row for each day.
CALENDAR_BYTES = 512 * 1024


def base_assets(assets: DataFrame, offers: DataFrame, metadata: DataFrame, floor: str) -> DataFrame:
    """Assets of past titles with premiere dates and the window their views count in.

    ``offers`` is already limited to one brand, territory and channel.
    """
    season = F.coalesce(F.col("season_number"), F.lit(0))
    premiere = F.coalesce(F.col("season_first_offered"), F.col("title_first_offered"))
    kept = assets.where(
        F.col("asset_type").isin(*TITLE_ASSET_TYPES)
        & F.col("content_category").isin(*CONTENT_CATEGORIES)
        & F.col("starts_at").isNotNull()
    ).withColumn("season_number", season)
    dated = offers.where(premiere >= F.lit(floor).cast("timestamp"))
    meta = metadata.withColumn("season_number", season)
    return (
        kept.join(dated, "viewable_id")
        .join(meta, ["title_id", "season_number"])
        .select(
            "title_id",
            "season_number",
            "viewable_id",
            "title_name",
            F.to_date("first_offered").alias("asset_premiere"),
            F.to_date("ends_at").alias("asset_end"),
            F.to_date(premiere).alias("season_premiere"),
            "run_time",
            "content_category",
            "category",
            "tier",
            "effective_start_date",
            "effective_end_date",
        )
        .distinct()
    )


def _of_day(events: DataFrame) -> DataFrame:
    return events.withColumn("request_date", F.to_date("request_at"))


def _countable(dated: DataFrame, assets: DataFrame, run_date: str) -> DataFrame:
    """Rows of an asset's days while it was offered and its title's window was open. Rows come
    combined by asset and day, so a popular title is no large join key."""
    window = assets.select(
        *TITLE, "viewable_id", "asset_premiere", "asset_end", "effective_start_date", "effective_end_date"
    )
    dated = dated.where(F.col("request_date") < F.date_sub(F.lit(run_date).cast("date"), 1))
    return band_join(
        dated,
        window,
        ["viewable_id"],
        "request_date",
        F.greatest("asset_premiere", "effective_start_date"),
        F.least("asset_end", "effective_end_date"),
    )


def daily_first_views(
    first_watched: DataFrame, assets: DataFrame, run_date: str, dedup_by_asset: bool = False
) -> DataFrame:
    """Distinct user and subscription pairs per title and day."""
    allowed = first_watched.where(F.col("country").isin(*FIRST_VIEW_COUNTRIES))
    once = _of_day(allowed).select("viewable_id", "request_date", "user_id", "subscription_id").distinct()
    return (
        _countable(once, assets, run_date)
        .groupBy(*TITLE, "request_date")
        .agg(F.countDistinct("user_id", "subscription_id").alias("first_views"))
    )


def _hours(seconds: Column) -> Column:
    """Hours to three digits; summation noise must not tip a half either way."""
    return F.round(F.round(seconds_to_hours(seconds), 9), 3)


def daily_hours(
    streams: DataFrame, assets: DataFrame, run_date: str, min_seconds: float = MIN_STREAM_SECONDS
) -> DataFrame:
    long_enough = streams.where(F.col("stream_seconds") >= min_seconds)
    daily = _of_day(long_enough).groupBy("viewable_id", "request_date").agg(
        F.sum("stream_seconds").alias("stream_seconds")
    )
    return (
        _countable(daily, assets, run_date)
        .groupBy(*TITLE, "request_date")
        .agg(_hours(F.sum("stream_seconds")).alias("hours_viewed"))
    )


def title_calendar(assets: DataFrame, last_day: str, days: int = GRID_DAYS) -> DataFrame:
    """One row per title and day from its start to 90 days later, inside its window.

    The days of each title are generated from its own bounds; no calendar is joined.
    """
    start = F.coalesce("effective_start_date", "season_premiere", "asset_premiere")
    first = F.greatest(start, F.col("effective_start_date"))
    last = F.least(
        F.date_add(start, days),
        F.col("effective_end_date"),
        F.date_sub(F.lit(last_day).cast("date"), 1),
    )
    on_day = F.col("request_date") == F.col("asset_premiere")
    # dealt before titles become days, so that no task makes and counts the days of too many
    spread = (
        assets.repartition(partitions_for(assets, CALENDAR_BYTES), *TITLE)
        .withColumn("_first", first)
        .withColumn("_last", last)
        .where(F.col("_last") >= F.col("_first"))
        .withColumn("request_date", F.explode(F.sequence("_first", "_last")))
    )
    return spread.groupBy(*TITLE, "effective_start_date", "request_date").agg(
        F.max(F.when(F.col("request_date") == F.col("effective_start_date"), 1).otherwise(0)).alias(
            "premiere_ind"
        ),
        F.count_distinct(F.when(on_day, F.col("viewable_id"))).alias("asset_premiere_count"),
        _hours(F.sum_distinct(F.when(on_day, F.col("run_time")).otherwise(0))).alias(
            "premiering_hours_runtime"
        ),
    )


def daily_grid(
    assets: DataFrame, first_views: DataFrame, hours: DataFrame, run_date: str, last_day: str
) -> DataFrame:
    """Calendar of every title with zero-filled first views and hours."""
    key = ["title_id", "season_number", "request_date", "content_category", "category", "tier"]
    grid = title_calendar(assets, last_day).repartition(partitions_for(assets, CALENDAR_BYTES), *key)
    on_platform = F.datediff(F.lit(run_date).cast("date"), "effective_start_date") - 1
    return (
        grid.join(hours.drop("title_name"), key, "left")
        .join(first_views.drop("title_name"), key, "left")
        .withColumn("first_views", F.coalesce("first_views", F.lit(0)))
        .withColumn("hours_viewed", F.coalesce("hours_viewed", F.lit(0.0)))
        .withColumn("days_since_premiere", F.datediff("request_date", "effective_start_date"))
        .withColumn("days_on_platform", on_platform)
        .withColumn(
            "finished_window_flag",
            finished_window(
                F.col("days_on_platform"), F.col("category"), F.col("effective_start_date")
            ),
        )
    )


def reference_graph(
    titles: DataFrame, names: DataFrame, links: DataFrame, keep_unlinked: bool = False
) -> DataFrame:
    """Titles with what they refer to, and what those refer to.

    ``links`` has title_ref, reference_type, reference_ref; ``names`` title_ref and
    original_title. Edge types are filtered before the joins, and each hop's edges are resolved
    and made distinct by themselves: rows of distinct titles and distinct edges are distinct, so
    the product of the hops is neither sorted nor shuffled to remove repeats. Edges are dealt over
    partitions by the size of ``links``, which need not be distinct.
    """
    n = partitions_for(links)
    named = names.select(
        F.col("title_ref").alias("reference_title_id"), F.col("original_title").alias("reference_title")
    ).distinct()

    def edges(types: Sequence[str], source: str, kind: str, target: str) -> DataFrame:
        """Distinct edges, those to unknown titles as one; keys only, names are added to titles.
        The known titles, one number each, are the side that is held; the links are not sorted."""
        known = names.select(F.col("title_ref").alias(target)).repartition(n, target).distinct().hint("shuffle_hash")
        wanted = links.where(F.col("reference_type").isin(*types)).select(
            F.col("title_ref").alias(source), F.col("reference_type").alias(kind), F.col("reference_ref").alias("_ref")
        )
        resolved = wanted.repartition(n, "_ref").join(known, F.col("_ref") == F.col(target), "left").drop("_ref")
        return resolved.repartition(n, source).distinct()

    first = edges(REFERENCE_TYPES, "title_ref", "reference_type", "reference_title_id")
    second = edges([FEATURED_TYPE], "reference_title_id", "reference_reference_type", "reference_reference_title_id")
    referred = named.join(second, "reference_title_id", "left")
    own = titles.distinct()
    if not keep_unlinked:
        own = own.join(names.select("title_ref"), "title_ref", "left_semi")
    hops = own.join(first, "title_ref", "left" if keep_unlinked else "inner")
    # rows whose reference is unknown meet nothing, so they are dealt by their title
    known = F.col("reference_title_id")
    at = F.coalesce(known, F.xxhash64("title_ref").cast(names.schema["title_ref"].dataType))
    there = referred.withColumnRenamed("reference_title_id", "_there").repartition(n, "_there")
    hops = hops.withColumn("_at", at).repartition(n, "_at").join(there, (F.col("_at") == F.col("_there")) & known.isNotNull(), "left")
    return hops.select(
        "reference_title_id", "title_ref", *[c for c in titles.columns if c != "title_ref"],
        "reference_type", "reference_title", "reference_reference_type", "reference_reference_title_id",
    )


def reference_features(graph: DataFrame, keys: Sequence[str], training: bool = True) -> DataFrame:
    """Prequel counts: distinct references by type, and how often those are featured. The rows
    that count are dealt by their keys once, by the size of the graph, and counted there."""
    of_series = (F.col("content_category") == "series") & (F.col("reference_type") == FEATURED_TYPE)
    of_others = (F.col("content_category") != "series") & F.col("reference_type").isin(*PREQUEL_TYPES)
    edge = ["reference_type", "reference_title_id", "reference_reference_type", "reference_reference_title_id"]
    known = dict.fromkeys([*keys, "content_category", "season_number", *edge])
    dealt = graph.where(of_series | of_others).select(*known).repartition(partitions_for(graph), *keys)
    series = (
        dealt.where(of_series)
        .groupBy(*keys)
        .agg(F.countDistinct("reference_title_id").cast("double").alias("ref_ref_featured_in"))
        .withColumn("prequel_count", F.col("season_number").cast("double"))
    )
    season = F.col("season_number")
    if training:
        # references so far, shared out over the seasons before this one
        adjusted = F.try_divide(F.col("ref_ref_featured_in") * (season - 1), season.cast("double"))
        series = series.withColumn("ref_ref_featured_in", adjusted).withColumn(
            "prequel_featured_count",
            F.when(season > 1, F.col("ref_ref_featured_in") / (season - 1)),
        )
    else:
        series = series.withColumn("prequel_featured_count", F.lit(None).cast("double"))
    others = dealt.where(of_others)
    by_type = (
        others.groupBy(*keys, "reference_type")
        .agg(F.countDistinct("reference_title_id").alias("_n"))
        .groupBy(*keys)
        .pivot("reference_type", list(PREQUEL_TYPES))
        .agg(F.max("_n"))
    )
    featured = (
        others.where(F.col("reference_reference_type") == FEATURED_TYPE)
        .groupBy(*keys)
        .agg(F.countDistinct("reference_reference_title_id").cast("double").alias("ref_ref_featured_in"))
    )
    movies = (
        by_type.join(featured, list(keys), "left")
        .withColumn("prequel_count", row_sum([F.col(t) for t in PREQUEL_TYPES]))
        .withColumn(
            "prequel_featured_count", F.try_divide("ref_ref_featured_in", "prequel_count")
        )
    )
    out = [*keys, "prequel_count", "prequel_featured_count"]
    return series.select(*out).unionByName(movies.select(*out))


def title_training_rows(grid: DataFrame, references: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First views per title with prequel features, zero where none are known."""
    totals = grid.groupBy(*keys).agg(F.sum("first_views").alias("first_views"))
    return (
        totals.join(references, list(keys), "left")
        .fillna(0.0, subset=["prequel_count", "prequel_featured_count"])
        .withColumn("first_views_log", log_zero_is_zero(F.col("first_views").cast("double")))
    )


def prepared(rows: DataFrame, training: bool) -> DataFrame:
    """Winsorised features, adjusted tiers; in training also the capped label."""
    is_series = F.col("content_category") == "series"
    rows = rows.withColumn(
        "prequel_count",
        F.when(is_series, -1.0).otherwise(winsorise(F.col("prequel_count"), PREQUEL_CAP)),
    ).withColumn(
        "prequel_featured_count",
        F.when(is_series, -1.0).otherwise(
            winsorise(F.col("prequel_featured_count"), PREQUEL_FEATURED_CAP)
        ),
    )
    rows = rows.withColumn(
        "tier_adj", tier_adjusted(F.col("title_name"), F.col("category"), F.col("tier"))
    )
    if training:
        rows = rows.withColumn("first_views", winsorise(F.col("first_views"), FIRST_VIEWS_CAP))
    return rows


def decay_curve(daily: DataFrame, title_keys: Sequence[str], group: str, title: str) -> DataFrame:
    """Median cumulative share of first views per group and day, and its daily steps.

    ``daily`` has one row per title and day, so a title's window is bounded by days.
    """
    dealt = daily.repartition(partitions_for(daily), *title_keys)
    total = with_group_total(dealt, title_keys, "first_views", "_total")
    run = (
        Window.partitionBy(*title_keys)
        .orderBy("days_since_premiere")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    shares = stored(
        total.withColumn(
            "first_views_cumpct", F.try_divide(F.sum("first_views").over(run), F.col("_total"))
        ).select(group, title, "days_since_premiere", "first_views_cumpct")
    )
    median = percentiles_per_key(
        shares, [group, "days_since_premiere"], "first_views_cumpct", {"first_views_cumpct": 0.5}
    )
    titles = shares.groupBy(group, "days_since_premiere").agg(
        F.countDistinct(title).alias("title_count_training")
    )
    curve = titles.join(median, [group, "days_since_premiere"], "left")
    before = F.lag("first_views_cumpct").over(
        Window.partitionBy(group).orderBy("days_since_premiere")
    )
    return curve.withColumn(
        "first_views_pct",
        F.when(F.col("days_since_premiere") == 0, F.col("first_views_cumpct")).otherwise(
            F.col("first_views_cumpct") - before
        ),
    )


def apply_decay(
    predictions: DataFrame,
    curve: DataFrame,
    special_curve: DataFrame,
    special: str = "Popcorn",
    fallback: str = "Pay1",
) -> DataFrame:
    """Spreads a title's predicted views over days.

    Categories without a curve use the fallback. The special category keeps its own
    name and takes missing shares from ``special_curve``.
    """
    steps = curve.select(
        F.col("category").alias("decay_category"),
        "days_since_premiere",
        F.col("first_views_pct").alias("_pct"),
    )
    known = steps.select("decay_category").distinct().withColumn("_known", F.lit(True))
    own = special_curve.where(F.col("category") == special).select(
        "category", "days_since_premiere", F.col("first_views_pct").alias("_special")
    )
    tagged = predictions.join(
        known, F.col("category") == F.col("decay_category"), "left"
    ).drop("decay_category")
    chosen = F.when(F.col("_known") | (F.col("category") == special), F.col("category")).otherwise(
        F.lit(fallback)
    )
    spread = tagged.withColumn("decay_category", chosen).join(steps, "decay_category", "left")
    spread = spread.join(own, ["category", "days_since_premiere"], "left")
    share = F.when(
        (F.col("category") == special) & F.col("_pct").isNull(), F.col("_special")
    ).otherwise(F.col("_pct"))
    request = F.date_add("effective_start_date", F.col("days_since_premiere").cast("int"))
    return (
        spread.withColumn("first_views_pct", share)
        .withColumn("first_views_pred_decay", F.col("first_views_pred") * F.col("first_views_pct"))
        .withColumn("request_date", request)
        .withColumn("first_view_month", month_start(F.col("request_date")))
        .withColumn("first_view_quarter", quarter_start(F.col("request_date")))
        .drop("_pct", "_special", "_known")
    )


def monthly_totals(
    decayed: DataFrame, keys: Sequence[str], value: str, period: str = "first_view_month"
) -> DataFrame:
    return decayed.groupBy(*keys, period).agg(F.sum(value).alias(value))
