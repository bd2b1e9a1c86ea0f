"""Training, tuning and scoring with Spark ML. Only small result tables reach the driver."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, IsotonicRegression, LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.constants import (
    BACK_CONSIDERATION_DAYS,
    BOOST_DEFAULT_DEPTH,
    BOOST_DEPTH,
    BOOST_FEATURE_FRACTION,
    BOOST_MIN_LEAF,
    BOOST_RATE,
    BOOST_ROUNDS,
    ELASTIC_ALPHA,
    ELASTIC_L1_RATIO,
    EMBARGO_DAYS,
    MASK_SHARE,
    OLD_SHARE,
    RECENT_DAYS,
    RECENT_SHARE,
    SPECIAL_OLD_SHARE,
    SPECIAL_RECENT_SHARE,
)
from marquee.functions.dates import add_days
from marquee.functions.metrics import absolute_error, smape, unit_hash
from marquee.operators.aggregates import percentiles_per_key
from marquee.session import ensure_checkpoint_dir, stored

FEATURES = "features"
PREDICTION = "prediction"
ISOTONIC_STEPS = 1000
FOLD_PIECES = 64
#: Folds that are fitted side by side.
FITS_AT_ONCE = 3


# --- data preparation -----------------------------------------------------------


def mask_features(
    rows: DataFrame, key: str, columns: Sequence[str], share: float = MASK_SHARE, seed: str = "242"
) -> DataFrame:
    """Nulls a share of each column's values, chosen by hash so that reruns agree."""
    hidden = {
        c: F.when(unit_hash(F.col(key), F.lit(c), seed=seed) >= share, F.col(c)) for c in columns
    }
    return rows.withColumns(hidden)


def copies(rate: Column, key: str, seed: str = "58") -> Column:
    """Whole copies of a row for an expected count: the floor, plus one by hash."""
    whole = F.floor(rate)
    extra = F.when(unit_hash(F.col(key), seed=seed) < rate - whole, 1).otherwise(0)
    return (whole + extra).cast("int")


def resample(rows: DataFrame, key: str, run_date: str, special: str = "Popcorn") -> DataFrame:
    """Brings tiers 0-2 and the special category to their shares of the tier-3 count.

    Old and recent titles are drawn apart. Targets are met in expectation, other tiers
    are left out, and tier 3 is kept as it is. Stratum sizes come from one aggregate.
    """
    cut = F.date_sub(F.lit(run_date).cast("date"), RECENT_DAYS)
    # a title without a date counts as old, one without a category as not special
    rows = rows.withColumns(
        {
            "_recent": F.coalesce(F.col("effective_start_date") >= cut, F.lit(False)),
            "_special": F.coalesce(F.col("category") == special, F.lit(False)),
        }
    )
    strata = ["tier", "_special", "_recent"]
    whole = ["_special", "_recent"]
    sizes = rows.groupBy(*strata).agg(F.count(F.lit(1)).alias("_n"))
    tier3 = F.sum(F.when(F.col("tier") == 3, F.col("_n"))).over(Window.partitionBy())
    sizes = sizes.withColumn("_tier3", tier3).withColumn(
        "_n_special", F.sum("_n").over(Window.partitionBy(*whole))
    )
    old, recent = F.round(F.col("_tier3") * OLD_SHARE), F.round(F.col("_tier3") * RECENT_SHARE)
    target = F.when(F.col("_recent"), recent).otherwise(old)
    special_target = F.when(
        F.col("_recent"), F.round(recent * SPECIAL_RECENT_SHARE)
    ).otherwise(F.round(old * SPECIAL_OLD_SHARE))
    rate = (
        F.when(F.col("_special"), special_target / F.col("_n_special"))
        .when(F.col("tier").isin(0, 1, 2), target / F.col("_n"))
        .when(F.col("tier") == 3, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    # a handful of strata, whatever the size of the table
    rates = sizes.select(
        *(F.col(c).alias(f"_of{c}") for c in strata), F.coalesce(rate, F.lit(0.0)).alias("_rate")
    )
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in strata))
    return (
        rows.join(F.broadcast(rates), same)
        .withColumn("_copies", copies(F.col("_rate"), key))
        .where(F.col("_copies") > 0)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .drop("_recent", "_special", "_rate", "_copies", *(f"_of{c}" for c in strata))
    )


# --- folds ------------------------------------------------------------------------


def fold_bounds(
    rows: DataFrame,
    offered: str,
    n_folds: int,
    back_days: int = BACK_CONSIDERATION_DAYS,
    current: Column | None = None,
) -> DataFrame:
    """Edges of the test folds: equal shares of the launches of the last ``back_days``.

    The newest launch is that of the titles for which ``current`` holds (the current
    platform), of all if it is not given. One row per non-empty fold: fold, lower, upper
    (exclusive by a second), and train_before, 28 days ahead of the fold's first launch.
    """
    newest = (rows if current is None else rows.where(current)).agg(F.max(offered).alias("_newest"))
    counts = stored(rows.groupBy(F.col(offered).alias("_at")).agg(F.count(F.lit(1)).alias("_n")))
    recent = counts.crossJoin(F.broadcast(newest)).where(  # one row
        F.col("_at") >= add_days(F.col("_newest"), -back_days)
    )
    shares = {f"_e{i}": i / n_folds for i in range(n_folds + 1)}
    # launches of half a year: their different times are few beside the rows
    recent = recent.select(F.unix_micros("_at").alias("_us"), "_n")
    edges = percentiles_per_key(recent, [], "_us", shares, pieces=FOLD_PIECES, weight="_n")
    pieces = edges.select(F.array(*shares).alias("_edges")).select(
        F.posexplode(F.slice("_edges", 1, n_folds)).alias("fold", "_low"), "_edges"
    ).select(
        "fold",
        F.timestamp_micros(F.col("_low").cast("long")).alias("lower"),
        F.timestamp_micros(
            (F.element_at("_edges", F.col("fold") + 2) - 1_000_000).cast("long")
        ).alias("upper"),
    )
    # at most n_folds rows
    first = (
        counts.join(F.broadcast(pieces), F.col("_at").between(F.col("lower"), F.col("upper")))
        .groupBy("fold", "lower", "upper")
        .agg(F.min("_at").alias("_first"))
    )
    return first.select(
        "fold", "lower", "upper", add_days(F.col("_first"), -EMBARGO_DAYS).alias("train_before")
    )


def fold_sizes(rows: DataFrame, bounds: DataFrame, offered: str) -> DataFrame:
    """Training and test rows of each fold."""
    counts = rows.groupBy(F.col(offered).alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    near = (F.col("_at") <= F.col("upper")) | (F.col("_at") < F.col("train_before"))
    test = F.when(F.col("_at").between(F.col("lower"), F.col("upper")), F.col("_n")).otherwise(0)
    train = F.when(F.col("_at") < F.col("train_before"), F.col("_n")).otherwise(0)
    return (
        counts.join(F.broadcast(bounds), near)
        .groupBy("fold")
        .agg(F.sum(train).alias("n_train"), F.sum(test).alias("n_test"))
    )


# --- models -------------------------------------------------------------------------


def feature_stages(
    numeric: Sequence[str], categorical: Sequence[str] = (), one_hot: bool = False
) -> list:
    """Indexers for categories, median fill for numbers, one vector."""
    filled = [f"{c}__filled" for c in numeric]
    stages: list = []
    if numeric:
        stages.append(Imputer(strategy="median", inputCols=list(numeric), outputCols=filled))
    inputs = list(filled)
    if categorical:
        codes, hot = [f"{c}__code" for c in categorical], [f"{c}__hot" for c in categorical]
        # one look at the rows for all of them
        stages.append(
            StringIndexer(inputCols=list(categorical), outputCols=codes, handleInvalid="keep", stringOrderType="alphabetAsc")
        )
        if one_hot:
            stages.append(OneHotEncoder(inputCols=codes, outputCols=hot, handleInvalid="keep"))
        inputs += hot if one_hot else codes
    stages.append(VectorAssembler(inputCols=inputs, outputCol=FEATURES, handleInvalid="keep"))
    return stages


def boosting(
    label: str,
    rounds: int = BOOST_ROUNDS[0],
    depth: int = BOOST_DEFAULT_DEPTH,
    rate: float = 0.05,
    feature_fraction: float = 1.0,
    min_leaf: int = BOOST_MIN_LEAF,
    min_gain: float = 0.0,
    absolute_loss: bool = True,
    seed: int = 7,
) -> GBTRegressor:
    return GBTRegressor(
        labelCol=label,
        featuresCol=FEATURES,
        maxIter=rounds,
        maxDepth=depth,
        stepSize=rate,
        featureSubsetStrategy="all" if feature_fraction >= 1 else str(feature_fraction),
        minInstancesPerNode=min_leaf,
        minInfoGain=min_gain,
        lossType="absolute" if absolute_loss else "squared",
        seed=seed,
    )


def linear(label: str) -> LinearRegression:
    return LinearRegression(labelCol=label, featuresCol=FEATURES)


def elastic_net(
    label: str, alpha: float = ELASTIC_ALPHA, l1_ratio: float = ELASTIC_L1_RATIO
) -> LinearRegression:
    return LinearRegression(
        labelCol=label,
        featuresCol=FEATURES,
        regParam=alpha,
        elasticNetParam=l1_ratio,
        maxIter=10_000,
        standardization=False,
    )


def with_bins(estimator, prepared: DataFrame, least: int = 64):
    """Trees need a bin for each value of a category; the vector's metadata has their number."""
    if not estimator.hasParam("maxBins"):
        return estimator
    kinds = prepared.schema[FEATURES].metadata.get("ml_attr", {}).get("attrs", {})
    widest = max((len(a.get("vals", ())) for a in kinds.get("nominal", ())), default=0)
    return estimator.copy({estimator.maxBins: max(least, widest + 1)})


def fit(rows: DataFrame, stages: Sequence, estimator) -> PipelineModel:
    ensure_checkpoint_dir(rows.sparkSession)
    before = Pipeline(stages=list(stages)).fit(rows)
    prepared = before.transform(rows)
    return PipelineModel([*before.stages, with_bins(estimator, prepared).fit(prepared)])


def monotone_calibration(
    scored: DataFrame, label: str, signal: str, steps: int = ISOTONIC_STEPS
) -> DataFrame:
    """Optional step after boosting: predictions rising with one signal.

    The curve is fitted to the mean label and weight of at most ``steps`` equal ranges of
    the signal's rank, since its last stage runs on the driver: its points are bounded.
    Rows without a signal are calibrated as the least one.
    """
    cuts = scored.where(F.col(signal).isNotNull()).agg(
        F.percentile_approx(signal, F.array(*[F.lit(i / steps) for i in range(1, steps)]), 10 * steps).alias("_cuts")
    )
    found = sorted({0.0 - float(c) for c in cuts.first()[0] or () if math.isfinite(c)})  # fewer than ``steps``
    edges = [-math.inf, *found, math.inf]
    # a search by halves among the edges, mirrored: a range ends with its edge, a bucket begins with it
    mirror = (F.lit(0.0) - F.nanvl(F.col(signal).cast("double"), F.lit(math.inf))).alias("_mirror")
    mirrored = scored.where(F.col(signal).isNotNull()).select(label, signal, mirror)
    points = stored(
        Bucketizer(splits=edges, inputCol="_mirror", outputCol="_step", handleInvalid="keep").transform(mirrored)
        .groupBy("_step")
        .agg(F.avg(label).alias(label), F.avg(signal).alias(signal), F.count(F.lit(1)).cast("double").alias("_weight"))
    )
    model = IsotonicRegression(
        labelCol=label, featuresCol=signal, predictionCol="calibrated", weightCol="_weight"
    ).fit(points)
    lowest = F.lit(points.agg(F.min(signal)).first()[0])
    kept = scored.withColumn("_signal", F.col(signal)).withColumn(signal, F.coalesce(signal, lowest))
    return model.transform(kept).withColumn(signal, F.col("_signal")).drop("_signal")


def importance(model: PipelineModel, rows: DataFrame, n: int = 20) -> DataFrame:
    """Share of each feature in percent, largest first; one row per vector slot."""
    spark = rows.sparkSession
    weights = model.stages[-1].featureImportances.toArray()
    attrs = model.transform(rows.limit(1)).schema[FEATURES].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for kind in attrs.values() for a in kind}
    total = float(weights.sum()) or 1.0
    table = [(names[i], float(w) / total * 100) for i, w in enumerate(weights)]
    return (
        spark.createDataFrame(table, "feature string, importance double")
        .orderBy(F.desc("importance"), "feature")
        .limit(n)
    )


# --- evaluation and tuning --------------------------------------------------------------


def with_errors(scored: DataFrame, prediction: str, target: str) -> DataFrame:
    p, t = F.col(prediction), F.col(target)
    return scored.withColumn("smape", smape(p, t)).withColumn("mae", absolute_error(p, t))


def evaluate(scored: DataFrame, prediction: str, target: str, original: Column) -> DataFrame:
    """Mean errors over all titles and over originals, in one row."""
    rows = with_errors(scored, prediction, target)
    return rows.agg(
        F.avg("smape").alias("smape_all"),
        F.avg(F.when(original, F.col("smape"))).alias("smape_original"),
        F.avg("mae").alias("mae_all"),
        F.avg(F.when(original, F.col("mae"))).alias("mae_original"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def cross_predict(
    rows: DataFrame,
    bounds: DataFrame,
    offered: str,
    stages: Sequence,
    estimator,
    after: Callable[[Column], Column] = lambda c: c,
) -> DataFrame:
    """Out-of-fold predictions: each fold is scored by a model of earlier titles.

    The loop runs over at most a few fold edges; rows never leave the executors.
    """
    edges = bounds.orderBy("fold").collect()
    oldest = rows.agg(F.min(offered)).first()[0]  # one look instead of one for each fold
    edges = [e for e in edges if oldest is not None and oldest < e["train_before"]]
    if not edges:
        raise ValueError("no fold has earlier titles to learn from")

    def learned(edge) -> PipelineModel:
        return fit(rows.where(F.col(offered) < F.lit(edge["train_before"])), stages, estimator)

    ensure_checkpoint_dir(rows.sparkSession)
    # a fit is many short jobs: some folds at a time, so that one's waits are another's work
    with ThreadPool(FITS_AT_ONCE) as pool:
        models = pool.map(inheritable_thread_target(rows.sparkSession)(learned), edges)
    parts = []
    for edge, model in zip(edges, models, strict=True):
        test = rows.where(F.col(offered).between(F.lit(edge["lower"]), F.lit(edge["upper"])))
        scored = model.transform(test).withColumn(PREDICTION, after(F.col(PREDICTION)))
        parts.append(scored.withColumn("fold", F.lit(edge["fold"])))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def boosting_grid(
    rounds: Iterable[int] = BOOST_ROUNDS,
    fractions: Iterable[float] = BOOST_FEATURE_FRACTION,
    depths: Iterable[int] = BOOST_DEPTH,
    rates: Iterable[float] = BOOST_RATE,
) -> list[dict]:
    names = ("rounds", "feature_fraction", "depth", "rate")
    return [dict(zip(names, c)) for c in itertools.product(rounds, fractions, depths, rates)]


# --- stored models ---------------------------------------------------------------------


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
