"""Many models of one table of labelled titles: tuning, cross prediction, daily scoring.

The labelled rows are prepared once (``labelled``). A trial is a row of a table; each is fitted in a
task of its own, or, where the rows are too many for a task, side by side with others over all of
them (``spread.py``). Results are written in batches, so a run that was cut off goes on with what is
missing. Rows to score are never bounded: models are sent to them.
"""

from __future__ import annotations

import pickle
import random
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.constants import SEARCH_DRAWS, SEARCH_FOLDS, SEARCH_ROUNDS, SEARCH_SPACE
from marquee.functions.metrics import unit_hash
from marquee.plans.spread import Block, Chosen, Spread, boosted, spread_of
from marquee.plans.trees import Boosting, Line
from marquee.session import scratch_path

#: Labelled rows of a sample (``sample_of``), chosen by hash of their key when there are more.
FIT_ROWS = 20_000
#: Values (labelled rows times columns) that a task may hold; beyond them all rows stay on the
#: executors, and models grow side by side over them.
TASK_VALUES = 2**22
#: Trials that are written together.
BATCH = 256


@dataclass
class Sample:
    """Labelled rows as arrays, in the order of their keys' hash."""

    columns: tuple[str, ...]
    x: np.ndarray
    y: np.ndarray
    launch: np.ndarray  # microseconds
    original: np.ndarray

    def __len__(self) -> int:
        return len(self.y)

    @property
    def order(self) -> np.ndarray:
        return np.arange(len(self))

    def places(self, names: Sequence[str]) -> np.ndarray:
        at = {c: i for i, c in enumerate(self.columns)}
        return np.array([at[c] for c in names], np.int64)


def sample_of(
    rows: DataFrame,
    key: str,
    label: str,
    columns: Sequence[str],
    launch: Column | None = None,
    original: Column | None = None,
    limit: int = FIT_ROWS,
    seed: str = "58",
    n_rows: int | None = None,
) -> Sample:
    """At most ``limit`` rows with a label: those whose keys' hashes are least.

    Each task keeps its own first rows, so the driver gets no more than the limit. Where the number
    of rows is known (``n_rows``), labels and columns are computed for rows of low hashes only: for
    about twice the limit, then eight times as many, until enough of them have a label or all rows
    were taken. The sample is the same.
    """
    launch = F.lit(0).cast("timestamp") if launch is None else launch
    u = unit_hash(F.col(key), seed=seed)
    share = 2 * limit / n_rows if n_rows else 1.0
    while True:
        chosen = (
            (rows.where(u < share) if share < 1 else rows)
            .where(F.col(label).isNotNull())
            .select(
                *(F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)),
                F.col(label).cast("double").alias("y"),
                F.unix_micros(launch).alias("launch"),
                F.coalesce(F.lit(False) if original is None else original, F.lit(False)).alias("original"),
                u.alias("u"),
                F.col(key).alias("key"),
            )
            .orderBy("u", "key")
            .limit(limit)
            .toArrow()
        )
        if chosen.num_rows >= limit or share >= 1:
            break
        share *= 8
    values = [chosen.column(f"x{i}").to_numpy().astype(float) for i in range(len(columns))]
    x = np.stack(values, 1) if values else np.zeros((chosen.num_rows, 0))
    y, at = chosen.column("y").to_numpy(), chosen.column("launch").to_numpy()
    return Sample(tuple(columns), x, y, at, chosen.column("original").to_numpy().astype(bool))


def labelled(
    rows: DataFrame,
    key: str,
    label: str,
    columns: Sequence[str],
    launch: Column | None = None,
    original: Column | None = None,
    seed: str = "58",
    ordered: bool = False,
) -> Sample | Spread:
    """All rows with a label: as arrays where these are small, else spread over the executors.
    ``ordered``: in the order of their keys' hashes (arrays always are)."""
    known = rows.where(F.col(label).isNotNull())
    n = known.count()
    if n * max(1, len(columns)) <= TASK_VALUES:
        return sample_of(rows, key, label, columns, launch, original, max(n, 1), seed)
    inputs = known.select(
        *(F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)),
        F.col(label).cast("double").alias("y"),
        F.unix_micros(F.lit(0).cast("timestamp") if launch is None else launch).alias("launch"),
        F.coalesce(F.lit(False) if original is None else original, F.lit(False)).alias("original"),
        *([unit_hash(F.col(key), seed=seed).alias("u"), F.col(key).alias("key")] if ordered else []),
    )
    return spread_of(inputs, columns, ("u", "key") if ordered else ())


def _due(spark: SparkSession, count: int, schema: str, path: str) -> list[int]:
    """The trials that are not in the table at ``path`` yet."""
    spark.createDataFrame([], schema).write.mode("append").parquet(path)
    done = {r.trial for r in spark.read.schema(schema).parquet(path).select("trial").distinct().collect()}
    return [n for n in range(count) if n not in done]


def run_spread(
    spark: SparkSession,
    spread: Spread,
    models: Sequence[tuple[Sequence[str], Boosting, Chosen]],
    result: Callable,
    schema: str,
    path: str | None = None,
    rated: Callable[[Block, int, np.ndarray], Sequence[float]] | None = None,
) -> DataFrame:
    """``run`` for models over spread rows: ``result`` makes the row of a trial from its number,
    the rows learned from, the trees and the sums of ``rated``."""
    path = path or scratch_path(spark)
    due = _due(spark, len(models), schema, path)

    def each(found: list[tuple]) -> None:
        rows = [(due[i], *result(due[i], n, trees, sums)) for i, n, trees, sums in found]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)

    rate = None if rated is None else lambda block, i, predicted: rated(block, due[i], predicted)
    boosted(spark, spread, [models[i] for i in due], rate, each)
    spread.release()
    return spark.read.schema(schema).parquet(path)


def run(
    spark: SparkSession,
    count: int,
    work: Callable[[int], list[tuple]],
    schema: str,
    path: str | None = None,
    batch: int = BATCH,
) -> DataFrame:
    """What ``work`` gives for each trial number, one trial in each task.

    ``schema`` starts with ``trial int``. Batches are appended to ``path``; trials that are in it
    already are not run again.
    """
    path = path or scratch_path(spark)
    due = _due(spark, count, schema, path)

    def each(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.strip().split(" ")[0] for c in schema.split(",")]
        for frame in frames:
            for place in frame["id"]:
                yield pd.DataFrame([(some[place], *r) for r in work(some[place])], columns=names)

    for first in range(0, len(due), batch):
        some = due[first : first + batch]
        spark.range(0, len(some), 1, len(some)).mapInPandas(each, schema).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


# --- folds ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Fold:
    number: int
    lower: int
    upper: int
    train_before: int

    def train(self, sample: Sample | Block) -> np.ndarray:
        return sample.launch < self.train_before

    def test(self, sample: Sample | Block) -> np.ndarray:
        return (sample.launch >= self.lower) & (sample.launch <= self.upper)


def folds_of(bounds: DataFrame) -> list[Fold]:
    """The few rows that ``learning.fold_bounds`` gives."""
    edges = [F.unix_micros(c).alias(c) for c in ("lower", "upper", "train_before")]
    return [Fold(*r) for r in bounds.select("fold", *edges).orderBy("fold").collect()]


def shown(y: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symmetric and absolute error of each row."""
    return np.abs(p - y) / ((np.abs(p) + np.abs(y)) / 2 + 1e-300), np.abs(p - y)


GRID = (
    "trial int, setting int, fold int, n_train long, n_test long, n_original long, smape double, smape_original double, "
    "mae double"
)


def tune(
    spark: SparkSession,
    sample: Sample | Spread,
    folds: Sequence[Fold],
    grid: Sequence[Mapping],
    after: Callable[[np.ndarray], np.ndarray] = lambda v: v,
    path: str | None = None,
) -> tuple[dict, DataFrame]:
    """Grid search by out-of-fold symmetric error; the best setting on originals and a table of
    all settings. Each setting and fold is one trial. A fold that no earlier title precedes has
    none. ``after`` takes labels and predictions back to the measured scale."""
    grid, folds = list(grid), list(folds)
    trains = [f.train for f in folds]

    def work(trial: int) -> list[tuple]:
        setting, fold = divmod(trial, len(folds))
        train, test = folds[fold].train(sample), folds[fold].test(sample)
        n = int(train.sum()), int(test.sum()), int((test & sample.original).sum())
        if not n[0] or not n[1]:
            return [(setting, folds[fold].number, *n, 0.0, 0.0, 0.0)]
        model = Boosting(**grid[setting]).fit(sample.x[train], sample.y[train])
        smape, mae = shown(after(sample.y[test]), after(model.predict(sample.x[test])))
        own = smape[sample.original[test]]
        return [(setting, folds[fold].number, *n, float(smape.sum()), float(own.sum()), float(mae.sum()))]

    def rated(block: Block, trial: int, predicted: np.ndarray) -> list[float]:
        test = folds[trial % len(folds)].test(block)
        smape, mae = shown(after(block.y[test]), after(predicted[test]))
        own = block.original[test]
        return [test.sum(), own.sum(), smape.sum(), smape[own].sum(), mae.sum()]

    def result(trial: int, n: int, trees, sums: np.ndarray) -> tuple:
        setting, fold = divmod(trial, len(folds))
        errors = sums[2:] if n else np.zeros(3)
        return (setting, folds[fold].number, n, int(sums[0]), int(sums[1]), *map(float, errors))

    if isinstance(sample, Spread):
        models = [(sample.columns, Boosting(**g), trains[i]) for g in grid for i in range(len(folds))]
        found = run_spread(spark, sample, models, result, GRID, path, rated)
    else:
        found = run(spark, len(grid) * len(folds), work, GRID, path)
    scored = F.when(F.col("n_train") > 0, F.col("n_test"))
    table = found.groupBy("setting").agg(
        F.sum("n_train").alias("n_train"),
        F.sum("n_test").alias("n_test"),
        F.try_divide(F.sum("smape"), F.sum(scored)).alias("smape_all"),
        F.try_divide(F.sum("smape_original"), F.sum(F.when(F.col("n_train") > 0, F.col("n_original")))).alias("smape_original"),
        F.try_divide(F.sum("mae"), F.sum(scored)).alias("mae_all"),
    )
    names = spark.createDataFrame([(i, str(dict(g))) for i, g in enumerate(grid)], "setting int, params string")
    table = names.join(table, "setting")
    best = table.orderBy(F.col("smape_original").asc_nulls_last(), F.col("smape_all").asc_nulls_last(), "setting").first()
    return dict(grid[best.setting]), table


def drawn_settings(
    draws: int = SEARCH_DRAWS,
    space: Mapping[str, Sequence] = SEARCH_SPACE,
    rounds: int = SEARCH_ROUNDS,
    seed: int = 58,
) -> list[dict]:
    """Settings drawn from the published space."""
    rng = random.Random(seed)
    out = []
    for _ in range(draws):
        pick = {name: rng.choice(values) for name, values in space.items()}
        out.append(
            {
                "rounds": rounds,
                "rate": pick["learning_rate"],
                "depth": pick["max_depth"],
                "min_leaf": pick["min_child_weight"],
                "min_gain": pick["gamma"],
                "feature_fraction": pick["colsample_bytree"],
                "absolute_loss": False,
                "leaves": 0,
            }
        )
    return out


@dataclass(frozen=True)
class Dealt:
    """The rows dealt to a fold in turn, or (``others``) all but these."""

    fold: int
    folds: int
    others: bool

    def __call__(self, rows: Sample | Block) -> np.ndarray:
        return (rows.order % self.folds == self.fold) != self.others


SEARCH = "trial int, draw int, fold int, n_train long, n_test long, squares double"


def random_search(
    spark: SparkSession, sample: Sample | Spread, settings: Sequence[Mapping], folds: int = SEARCH_FOLDS, path: str | None = None
) -> tuple[Boosting, DataFrame]:
    """Cross-validated search: the best setting by mean squared error, and a row for each draw and
    fold. Rows are dealt to folds in the order of their hashes."""
    settings = list(settings)
    tests, trains = ([Dealt(f, folds, others) for f in range(folds)] for others in (False, True))

    def work(trial: int) -> list[tuple]:
        draw, fold = divmod(trial, folds)
        train, test = trains[fold](sample), tests[fold](sample)
        squares = 0.0
        if train.any() and test.any():
            model = Boosting(**settings[draw]).fit(sample.x[train], sample.y[train])
            squares = float(((model.predict(sample.x[test]) - sample.y[test]) ** 2).sum())
        return [(draw, fold, int(train.sum()), int(test.sum()), squares)]

    def rated(block: Block, trial: int, predicted: np.ndarray) -> list[float]:
        test = tests[trial % folds](block)
        return [test.sum(), ((predicted[test] - block.y[test]) ** 2).sum()]

    def result(trial: int, n: int, trees, sums: np.ndarray) -> tuple:
        return (*divmod(trial, folds), n, int(sums[0]), float(sums[1]) if n else 0.0)

    if isinstance(sample, Spread):
        models = [(sample.columns, Boosting(**s), trains[f]) for s in settings for f in range(folds)]
        table = run_spread(spark, sample, models, result, SEARCH, path, rated)
    else:
        table = run(spark, len(settings) * folds, work, SEARCH, path)
    best = table.groupBy("draw").agg(F.sum("squares").alias("squares")).orderBy("squares", "draw").first()
    return Boosting(**settings[best.draw]), table


# --- models by number: folds or days -------------------------------------------------------


@dataclass(frozen=True)
class Task:
    """One model: the rows it learns from (all if None), the columns it reads, and its learner.
    ``settings`` of None is least squares."""

    columns: tuple[str, ...]
    settings: Boosting | None
    train: Chosen | None = field(default=None, compare=False)

    def fit(self, sample: Sample):
        mine = slice(None) if self.train is None else self.train(sample)
        x, y = sample.x[mine][:, sample.places(self.columns)], sample.y[mine]
        return Line.fit(x, y) if self.settings is None else self.settings.fit(x, y)


MODELS = "trial int, columns string, n_rows long, model binary"


def every_row(rows: Sample | Block) -> np.ndarray:
    return np.ones(len(rows), bool)


def fitted(spark: SparkSession, sample: Sample | Spread, tasks: Sequence[Task], path: str | None = None) -> DataFrame:
    """trial, columns, n_rows, model: the store of one model for each task. Models that are in
    ``path`` already stay; a task without rows has no model."""
    tasks = list(tasks)
    if isinstance(sample, Spread):
        if any(t.settings is None for t in tasks):
            raise ValueError("least squares needs rows that fit a task; learning.linear has no bound")
        models = [(t.columns, t.settings, t.train or every_row) for t in tasks]
        result = lambda i, n, trees, sums: (",".join(tasks[i].columns), n, trees and pickle.dumps(trees))
        return run_spread(spark, sample, models, result, MODELS, path).where("model is not null")

    def work(trial: int) -> list[tuple]:
        task = tasks[trial]
        n = len(sample) if task.train is None else int(task.train(sample).sum())
        return [(",".join(task.columns), n, pickle.dumps(task.fit(sample)) if n else None)]

    return run(spark, len(tasks), work, MODELS, path).where("model is not null")


def scored(
    rows: DataFrame,
    models: DataFrame,
    keep: Sequence[str],
    number: str,
    only: Column | None = None,
    ladder: tuple[str, Sequence[float]] | None = None,
) -> DataFrame:
    """Every row by every model of the store: ``keep``, ``number`` (the model's) and prediction.

    Models are sent to the rows: their number and size follow their settings, not the table.
    ``only`` may limit, by the row, which numbers are wanted (an array column). ``ladder``: a column
    and what is added to it (to 0 where it is missing); predictions at all steps come in one row,
    as ``prediction0``, ``prediction1``, ..., so a row is computed and sent once.
    """
    store = {r.trial: (r["columns"].split(",") if r["columns"] else [], r.model) for r in models.collect()}
    every = sorted({c for columns, _ in store.values() for c in columns})
    held = rows.sparkSession.sparkContext.broadcast(store)
    at = {c: i for i, c in enumerate(every)}
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    moved, steps = (None, [None]) if ladder is None else (at.get(ladder[0]), list(ladder[1]))
    names = ["prediction"] if ladder is None else [f"prediction{i}" for i in range(len(steps))]
    limited = only is not None

    def each(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready = {n: (np.array([at[c] for c in columns], np.int64), pickle.loads(m)) for n, (columns, m) in held.value.items()}
        for frame in frames:
            x = np.stack([frame[f"x{i}"].to_numpy(float) for i in range(len(every))], 1) if every else np.zeros((len(frame), 0))
            lists = [None if w is None else set(w) for w in frame["_wanted"]] if limited else []
            for n, (places, model) in ready.items():
                mine = np.array([w is None or n in w for w in lists], bool) if limited else np.ones(len(frame), bool)
                if mine.any():
                    out = frame.loc[mine, list(keep)].copy()
                    out[number] = n
                    for name, step in zip(names, steps, strict=True):
                        own = x[mine]
                        if moved is not None:
                            own[:, moved] = np.where(np.isnan(own[:, moved]), 0.0, own[:, moved]) + step
                        out[name] = model.predict(own[:, places])
                    yield out

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), f"{number} int", *(f"{name} double" for name in names)])
    inputs = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(every)]
    wanted = [only.alias("_wanted")] if limited else []
    return rows.select(*keep, *inputs, *wanted).mapInPandas(each, schema)


def cross_predict(
    spark: SparkSession,
    rows: DataFrame,
    sample: Sample | Spread,
    folds: Sequence[Fold],
    offered: str,
    settings: Boosting,
    keep: Sequence[str],
    path: str | None = None,
) -> DataFrame:
    """Out-of-fold predictions of all rows of the test folds: each fold by a model of the labelled
    titles before it."""
    tasks = [Task(sample.columns, settings, f.train) for f in folds]
    models = fitted(spark, sample, tasks, path)
    at = F.unix_micros(offered)
    listed = F.filter(
        F.array(*(F.when(at.between(f.lower, f.upper), F.lit(i)) for i, f in enumerate(folds))), lambda x: x.isNotNull()
    )
    number = F.element_at(F.array(*(F.lit(f.number) for f in folds)), F.col("_model") + 1)
    inside = rows.where(F.size(listed) > 0)
    return scored(inside, models, keep, "_model", listed).withColumn("fold", number).drop("_model")


def importance(spark: SparkSession, sample: Sample, settings: Boosting) -> DataFrame:
    """Share of each column in the splits of a model, in percent."""
    schema = "trial int, feature string, importance double"

    def work(_: int) -> list[tuple]:
        splits = settings.fit(sample.x, sample.y).splits()
        total = max(int(splits.sum()), 1)
        return [(c, 100.0 * int(n) / total) for c, n in zip(sample.columns, splits, strict=True)]

    return run(spark, 1, work, schema).select("feature", "importance")


# --- one model for each prediction day ------------------------------------------------------

VIEWED_DAYS = tuple(range(-27, 27))
ACTIVES_DAYS = tuple(range(-27, 28))


def viewed_learner(day: int, settings: Boosting = Boosting()) -> Boosting | None:
    """Percent viewed: boosting on every day, squared loss before launch."""
    return replace(settings, absolute_loss=day >= 1)


def actives_learner(day: int, settings: Boosting = Boosting()) -> Boosting | None:
    """Percent actives: least squares before launch and from day 14, boosting in between."""
    return settings if 1 <= day <= 13 else None


def day_tasks(
    days: Sequence[int],
    columns_for: Callable[[int], Sequence[str]],
    learner: Callable[[int], Boosting | None],
    rising: Callable[[int], Sequence[str]] = lambda day: (),
) -> list[Task]:
    """A task for each day: the columns known by then, and the columns along which predictions
    never fall (boosting with squared loss only)."""
    out = []
    for day in days:
        columns, settings = tuple(columns_for(day)), learner(day)
        if settings is not None and not settings.absolute_loss:
            settings = replace(settings, rising=tuple(i for i, c in enumerate(columns) if c in set(rising(day))))
        out.append(Task(columns, settings))
    return out


def score_days(
    new: DataFrame,
    sample: Sample | Spread,
    days: Sequence[int],
    tasks: Sequence[Task],
    keep: Sequence[str],
    path: str | None = None,
) -> DataFrame:
    """``keep``, pred_day and prediction of every new title on every day. The models are the
    store at ``path``: a restart begins with the first day that is missing there."""
    models = fitted(new.sparkSession, sample, tasks, path)
    number = F.element_at(F.array(*(F.lit(d) for d in days)), F.col("_model") + 1)
    return scored(new, models, keep, "_model").withColumn("pred_day", number).drop("_model")
