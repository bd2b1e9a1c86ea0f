"""End-to-end forecasts: 52-week hours share, and first views of future titles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.constants import (
    HOURS_WINDOW_NAMES,
    SEARCH_DRAWS,
    SEARCH_FOLDS,
    SEARCH_ROUNDS,
    SERVICE_LAUNCH_DATE,
    SHARE_INPUTS,
    TRAIN_RECENCY_DAYS,
)
from marquee.functions.dates import add_days, days_since_epoch_day
from marquee.functions.metrics import expit, logit, widest_window
from marquee.functions.text import program_type_flag, series_flag, spaced_genres
from marquee.operators.joins import merge_features
from marquee.operators.pivots import max_pivot
from marquee.plans import firstviews, learning, trials
from marquee.plans.matrix import Vocabulary

MASKED = ("hourspct21d", "hourspct28d", "hourspct8w", "hourspct13w", "hourspct26w")
FINAL = "hourspct52w"
GROWTH = (
    ("hourspct26w", 182),
    ("hourspct13w", 91),
    ("hourspct8w", 56),
    ("hourspct28d", 28),
    ("hourspct21d", 21),
)


def recent_history(rows: DataFrame, newest: str, run_ts: Column, days: int = TRAIN_RECENCY_DAYS) -> DataFrame:
    """Titles to learn from: their newest value must be at least ``days`` old at the run."""
    return rows.where(F.col(newest) <= add_days(run_ts, -days))


def share_features(
    shares: DataFrame, sources: Sequence[DataFrame], epoch: str = SERVICE_LAUNCH_DATE
) -> DataFrame:
    """The inputs of the share forecast, for titles with two weeks of history.

    ``shares``: match_id, window, hourspct. ``sources``: metadata, genres, cost and offer tables
    by match_id, outer-merged, so a title that one of them lacks keeps its row with missing
    values. Adds logits per window, flags, the launch time, and the genre set (array).
    """
    wide = max_pivot(shares, "match_id", "window", "hourspct", HOURS_WINDOW_NAMES)
    rows = merge_features([wide, *sources], "match_id", "outer", first_only=True)
    rows = rows.where(F.col("hourspct7d").isNotNull() & F.col("hourspct14d").isNotNull())
    logits = {f"logit_{c}": logit(F.col(c) / 100) for c in HOURS_WINDOW_NAMES.values()}
    genres = F.split(spaced_genres(F.col("wm_enterprise_genres_agg")), r"\|")
    return (
        rows.withColumns(logits)
        .withColumn("max_window", widest_window([(F.col(c), d) for c, d in GROWTH], 14))
        .withColumn("launch_time", days_since_epoch_day(F.col("earliest_offered_timestamp"), epoch))
        .withColumn("is_original", program_type_flag(F.col("program_type")))
        .withColumn("is_series", series_flag(F.col("content_category")))
        .withColumn("genres", F.array_sort(F.array_distinct(F.filter(genres, lambda g: g != ""))))
    )


def share_inputs(features: DataFrame) -> tuple[DataFrame, list[str]]:
    """The features with one 0/1 column for each genre that occurs, and the names of all inputs."""
    vocabulary = Vocabulary.fit(features, F.col("genres"), "genre_", share=0.0)
    flags = dict(zip(vocabulary.columns, vocabulary.flags(F.col("genres")), strict=True))
    return features.withColumns(flags), [*SHARE_INPUTS, *vocabulary.columns]


def share_training_rows(features: DataFrame) -> DataFrame:
    """Titles with a full year, some early values hidden so the model meets gaps."""
    known = features.where(F.col(FINAL).isNotNull() & (F.col(FINAL) != 0))
    return learning.mask_features(known, "match_id", [f"logit_{c}" for c in MASKED])


def share_forecast(
    features: DataFrame,
    prediction_date: str,
    draws: int = SEARCH_DRAWS,
    folds: int = SEARCH_FOLDS,
    rounds: int = SEARCH_ROUNDS,
    limit: int = trials.FIT_ROWS,
    path: str | None = None,
) -> DataFrame:
    """Predicted 52-week share in percent for titles without one, by the best of the drawn
    settings. Without a title that has a full year there is nothing to learn from: no rows.
    ``path`` keeps the trials, so that a search that was cut off goes on."""
    spark = features.sparkSession
    rows, inputs = share_inputs(features)
    label = f"logit_{FINAL}"
    train = share_training_rows(rows)
    sample = trials.sample_of(train, "match_id", label, inputs, limit=limit)
    best = trials.Boosting()
    if len(sample):
        best, _ = trials.random_search(spark, sample, trials.drawn_settings(draws, rounds=rounds), folds, path)
    models = trials.fitted(spark, sample, [trials.Task(tuple(inputs), best)])
    new = rows.where(F.col(FINAL).isNull())
    scored = trials.scored(new, models, ["match_id", "max_window"], "_model")
    return scored.select(
        "match_id",
        (expit(F.col("prediction")) * 100).alias("predicted_hourspct"),
        F.lit(prediction_date).alias("prediction_date"),
        F.col("max_window").alias("window_days"),
    )


def _typed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.col(c).cast("string") for c in ("tier_adj", "prequel_count")})


def fit_first_views(
    training: DataFrame,
    key: str,
    run_date: str,
    rounds: int = 10,
    rate: float = 0.3,
    depth: int = 6,
    min_gain: float = 1.0,
) -> PipelineModel:
    """Boosted model of log first views on resampled titles that premiered 60 days before the run
    or earlier, with the published settings: the learner's defaults and a least gain of 1. The
    prequel count is a category."""
    run_ts = F.lit(run_date).cast("timestamp")
    known = recent_history(training, "effective_start_date", run_ts)
    drawn = learning.resample(firstviews.prepared(known, True), key, run_date)
    typed = _typed(drawn)
    stages = learning.feature_stages(
        ["prequel_featured_count"], ["prequel_count", "tier_adj", "category", "content_category"], one_hot=True
    )
    model = learning.boosting(
        "first_views_log", rounds=rounds, rate=rate, depth=depth, min_gain=min_gain, absolute_loss=False
    )
    return learning.fit(typed, stages, model)


def first_view_forecast(
    model: PipelineModel, future: DataFrame, curve: DataFrame, special_curve: DataFrame, run_date: str
) -> DataFrame:
    """Predicted first views of future titles by month."""
    rows = _typed(firstviews.prepared(future, False))
    scored = model.transform(rows).select(
        "title_name",
        "season_number",
        "tier",
        "tier_adj",
        "category",
        "content_category",
        "effective_start_date",
        F.exp("prediction").alias("first_views_pred"),
    )
    spread = firstviews.apply_decay(scored, curve, special_curve)
    keys = [
        "title_name",
        "season_number",
        "tier",
        "tier_adj",
        "category",
        "content_category",
        "effective_start_date",
    ]
    return firstviews.monthly_totals(spread, keys, "first_views_pred_decay").withColumn(
        "model_train_date", F.lit(run_date)
    )
