"""A title's share of all hours watched in the first days after it was offered."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.constants import HOURS_FLOOR, HOURS_WINDOWS, MIN_STREAM_SECONDS
from marquee.functions.keys import match_id_by_category, match_title
from marquee.operators.aggregates import mode_per_key
from marquee.operators.joins import new_rows
from marquee.session import stored


def title_offers(assets: DataFrame, floor: str = HOURS_FLOOR) -> DataFrame:
    """Offer date per title, not before the floor; the usual spelling of its name."""
    features = assets.where((F.col("asset_type") == "FEATURE") & F.col("offered_at").isNotNull())
    keyed = features.select(
        match_id_by_category(
            F.col("content_category"), F.col("series_id"), F.col("season_number"), F.col("viewable_id")
        ).alias("match_id"),
        match_title(
            F.col("series_title_long"), F.col("season_number"), F.col("asset_title_long")
        ).alias("match_title"),
        "offered_at",
    )
    dates = keyed.groupBy("match_id").agg(
        F.greatest(F.to_date(F.min("offered_at")), F.lit(floor).cast("date")).alias("offer_date")
    )
    return dates.join(mode_per_key(keyed, ["match_id"], "match_title"), "match_id")


def unscored_windows(
    offers: DataFrame, recorded: DataFrame, run_date: str, windows: Sequence[int] = HOURS_WINDOWS
) -> DataFrame:
    """Titles and windows that are complete by the run date and not recorded yet."""
    planned = (
        offers.withColumn("window", F.explode(F.array(*[F.lit(w) for w in windows])))
        .withColumn("window_end", F.expr("date_add(offer_date, window)"))
        .where(F.col("window_end") <= F.lit(run_date).cast("date"))
    )
    return new_rows(planned, recorded, ["match_id", "window"])


def daily_seconds(
    streams: DataFrame, floor: str = HOURS_FLOOR, min_seconds: float = MIN_STREAM_SECONDS
) -> DataFrame:
    """Play seconds per title and day: the only pass over the stream."""
    return (
        streams.where(
            (F.col("stream_at") >= F.lit(floor).cast("timestamp"))
            & (F.col("stream_seconds") >= min_seconds)
        )
        .groupBy("match_id", F.to_date("stream_at").alias("day"))
        .agg(F.sum("stream_seconds").alias("seconds"))
    )


def _totals(daily: DataFrame, wanted: DataFrame) -> DataFrame:
    """Seconds of all titles in each window, from a running total by calendar day."""
    per_day = daily.groupBy("day").agg(F.sum("seconds").alias("seconds"))
    bounds = wanted.select(F.col("offer_date").alias("day")).unionByName(
        wanted.select(F.date_sub("window_end", 1).alias("day"))
    )
    # one row per calendar day: small whatever the size of the stream
    spread = per_day.unionByName(bounds.distinct(), allowMissingColumns=True)
    by_day = spread.groupBy("day").agg(F.coalesce(F.sum("seconds"), F.lit(0.0)).alias("seconds"))
    run = by_day.select(
        "day",
        F.sum("seconds").over(Window.orderBy("day")).alias("through"),
        "seconds",
    )
    first = run.select(
        F.col("day").alias("offer_date"), (F.col("through") - F.col("seconds")).alias("_before")
    )
    last = run.select(F.col("day").alias("_last"), F.col("through").alias("_through"))
    return (
        wanted.withColumn("_last", F.date_sub("window_end", 1))
        .join(first, "offer_date")
        .join(last, "_last")
        .select("offer_date", "window", (F.col("_through") - F.col("_before")).alias("total_seconds"))
    )


def hours_share(
    streams: DataFrame,
    offers: DataFrame,
    run_date: str,
    recorded: DataFrame | None = None,
    windows: Sequence[int] = HOURS_WINDOWS,
    floor: str = HOURS_FLOOR,
    min_seconds: float = MIN_STREAM_SECONDS,
) -> DataFrame:
    """Percent of all play seconds in ``[offer, offer + window)`` that went to the title.

    A title only ever needs its own days, so streams meet offers in one equi join;
    the denominator depends on dates alone.
    """
    # title-days are few next to streams, and both sides of the share read them
    daily = stored(daily_seconds(streams, floor, min_seconds))
    offset = F.datediff("day", "offer_date")
    own = daily.join(offers.select("match_id", "offer_date"), "match_id").where(
        (offset >= 0) & (offset < max(windows))
    )
    sums = own.groupBy("match_id", "offer_date").agg(
        *[F.sum(F.when(offset < w, F.col("seconds"))).alias(f"w{w}") for w in windows]
    )
    pairs = F.array(
        *[F.struct(F.lit(w).alias("window"), F.col(f"w{w}").alias("seconds")) for w in windows]
    )
    long = stored(
        sums.select("match_id", "offer_date", F.explode(pairs).alias("_w"))
        .select("match_id", "offer_date", "_w.*")
        .where(F.col("seconds").isNotNull())
        .withColumn("window_end", F.expr("date_add(offer_date, window)"))
        .where(F.col("window_end") <= F.lit(run_date).cast("date"))
    )
    wanted = long.select("offer_date", "window", "window_end").distinct()
    shares = long.join(_totals(daily, wanted), ["offer_date", "window"]).select(
        "match_id",
        "window",
        F.try_divide(100 * F.col("seconds"), F.col("total_seconds")).alias("hourspct"),
    )
    return shares if recorded is None else new_rows(shares, recorded, ["match_id", "window"])
