"""Trees, trials and the model matrix against direct computation."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.functions.metrics import unit_hash
from marquee.operators.aggregates import running_list
from marquee.plans import matrix as mx
from marquee.plans import trials
from marquee.plans.trees import Boosting, Line


def table(n=400, columns=4, seed=3, missing=0.1):
    draw = np.random.default_rng(seed)
    x = draw.normal(size=(n, columns))
    y = 2 * x[:, 0] + np.sin(3 * x[:, 1]) + draw.normal(size=n) * 0.05
    x[draw.random(x.shape) < missing] = np.nan
    return x, y


def best_cut(x, y, min_leaf):
    """The split of least squared error over all columns, cuts and sides for missing values."""
    best = (np.inf, None)
    for c in range(x.shape[1]):
        values = np.unique(x[~np.isnan(x[:, c]), c])
        for cut in [-np.inf, *((values[:-1] + values[1:]) / 2)]:
            for side in (True, False):
                left = np.where(np.isnan(x[:, c]), side, x[:, c] <= cut)
                if min(left.sum(), (~left).sum()) >= min_leaf:
                    loss = sum(((y[p] - y[p].mean()) ** 2).sum() for p in (left, ~left))
                    if loss < best[0] - 1e-9:
                        best = (loss, left)
    return best


@pytest.mark.parametrize("seed", range(6))
def test_first_split_is_the_best_one(seed):
    x, y = table(60, 3, seed, 0.2)
    model = Boosting(rounds=1, depth=1, rate=1.0, absolute_loss=False, cuts=100).fit(x, y)
    loss, left = best_cut(x, y, 5)
    got = model.predict(x)
    assert ((y - got) ** 2).sum() == pytest.approx(loss)
    assert np.allclose(got, np.where(left, y[left].mean(), y[~left].mean()))


def test_absolute_loss_takes_medians():
    x, y = table(50, 2, 1, 0.0)
    model = Boosting(rounds=1, depth=3, rate=1.0).fit(x, y)
    for value in np.unique(model.predict(x)):
        inside = model.predict(x) == value
        assert inside.sum() >= 5
        assert np.median(y[inside]) == pytest.approx(value)


def test_missing_values_are_information():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(300, 2))
    gone = draw.random(300) < 0.3
    y = gone * 3.0
    x[gone, 0] = np.nan
    model = Boosting(rounds=30, rate=0.3, absolute_loss=False).fit(x, y)
    assert np.abs(model.predict(x) - y).max() < 0.01
    assert np.abs(Line.fit(x, y).predict(x) - y).max() < 0.01


def test_predictions_never_fall_along_rising_columns():
    x, y = table(500, 4, 2)
    y = y - 3 * np.nan_to_num(x[:, 2])  # falls along column 2 unless held back
    free, held = (Boosting(rounds=60, absolute_loss=False, rising=r).fit(x, y) for r in ((), (0, 2)))
    ladder = np.repeat(x[:50], 40, axis=0)
    for column, model, falls in ((2, free, True), (2, held, False), (0, held, False)):
        rows = ladder.copy()
        rows[:, column] = np.tile(np.linspace(-3, 3, 40), 50)
        steps = np.diff(model.predict(rows).reshape(50, 40), axis=1)
        assert bool((steps < -1e-9).any()) == falls
    with pytest.raises(ValueError, match="squared"):
        Boosting(rising=(0,)).fit(x, y)


def test_leaves_and_draws_of_columns():
    x, y = table()
    model = Boosting(rounds=5, leaves=6, feature_fraction=0.5).fit(x, y)
    assert all((t.column < 0).sum() <= 6 for t in model.trees)
    again = Boosting(rounds=5, leaves=6, feature_fraction=0.5).fit(x, y)
    assert (model.predict(x) == again.predict(x)).all()
    assert model.splits().sum() == sum((t.column >= 0).sum() for t in model.trees)


def test_line_is_least_squares():
    x, y = table(200, 3, 4, 0.0)
    line = Line.fit(x, y, ridge=0.0)
    a = np.hstack([np.ones((200, 1)), x])
    assert np.allclose(line.predict(x), a @ np.linalg.lstsq(a, y, rcond=None)[0], atol=1e-6)
    assert np.isfinite(Line.fit(np.zeros((5, 2)), np.ones(5)).predict(np.full((2, 2), np.nan))).all()


def test_sample_has_a_bound_and_no_unlabelled_rows(spark):
    rows = spark.range(300).select(
        F.col("id").alias("k"), (F.col("id") * 1.0).alias("a"), F.when(F.col("id") % 3 > 0, F.col("id") * 2.0).alias("y"),
        F.lit(None).cast("double").alias("b"),
    )
    sample = trials.sample_of(rows, "k", "y", ["a", "b"], limit=50)
    assert len(sample) == 50 and np.isnan(sample.x[:, 1]).all()
    assert (sample.y == 2 * sample.x[:, 0]).all() and (sample.x[:, 0] % 3 > 0).all()
    again = trials.sample_of(rows.repartition(7), "k", "y", ["a", "b"], limit=50)
    assert (again.x[:, 0] == sample.x[:, 0]).all()
    assert len(trials.sample_of(rows.where("false"), "k", "y", ["a"])) == 0


@pytest.mark.parametrize(("labelled", "limit"), [(3, 50), (3, 900), (100, 50)])
def test_a_sample_of_known_rows_is_the_same(spark, labelled, limit):
    """Also where labels are too rare for the first share, or for the limit."""
    rows = spark.range(2000).select(
        F.col("id").alias("k"), (F.col("id") * 1.0).alias("a"), F.when(F.col("id") % labelled == 0, F.col("id") * 2.0).alias("y")
    )
    whole = trials.sample_of(rows, "k", "y", ["a"], limit=limit)
    known = trials.sample_of(rows, "k", "y", ["a"], limit=limit, n_rows=2000)
    assert len(whole) == min(limit, -(-2000 // labelled))
    assert np.array_equal(known.x, whole.x) and np.array_equal(known.y, whole.y)


def test_a_sample_computes_columns_of_few_rows(spark):
    low = unit_hash(F.col("k"), seed="58") < 0.2
    rows = spark.range(2000).select(F.col("id").alias("k")).withColumn(
        "y", F.when(low, F.col("k") * 1.0).otherwise(F.raise_error(F.lit("a label of a row that is not needed")).cast("double"))
    )
    assert len(trials.sample_of(rows, "k", "y", ["y"], limit=100, n_rows=2000)) == 100


def test_a_run_goes_on_with_what_is_missing(spark, tmp_path):
    path, calls = str(tmp_path / "trials"), str(tmp_path / "calls")

    def work(n):
        with open(f"{calls}-{n}", "a") as f:
            f.write("x")
        return [(n * n,)]

    schema = "trial int, square long"
    spark.createDataFrame([(3, 9), (4, 16)], schema).write.parquet(path)
    rows = trials.run(spark, 7, work, schema, path, batch=2).collect()
    assert sorted((r.trial, r.square) for r in rows) == [(n, n * n) for n in range(7)]
    ran = {int(p.name.split("-")[1]) for p in tmp_path.glob("calls-*")}
    assert ran == {0, 1, 2, 5, 6}


def test_search_and_folds_against_a_loop(spark):
    x, y = table(120, 3, 5)
    launch = np.arange(120) * 1_000_000
    sample = trials.Sample(("a", "b", "c"), x, y, launch, np.arange(120) % 2 == 0)
    folds = [trials.Fold(0, 0, 29_000_000, -1), trials.Fold(1, 60_000_000, 89_000_000, 50_000_000), trials.Fold(2, 90_000_000, 119_000_000, 80_000_000)]
    grid = [{"rounds": 4, "depth": 2, "rate": 0.3}, {"rounds": 30, "depth": 3, "rate": 0.3}]
    best, found = trials.tune(spark, sample, folds, grid)
    rows = {r.setting: r for r in found.collect()}
    for i, g in enumerate(grid):
        errors, own = [], []
        for f in folds[1:]:
            train, test = launch < f.train_before, (launch >= f.lower) & (launch <= f.upper)
            p = Boosting(**g).fit(x[train], y[train]).predict(x[test])
            e, _ = trials.shown(y[test], p)
            errors += e.tolist()
            own += e[sample.original[test]].tolist()
        assert rows[i].smape_all == pytest.approx(np.mean(errors))
        assert rows[i].smape_original == pytest.approx(np.mean(own))
        assert (rows[i].n_train, rows[i].n_test) == (50 + 80, 90)
    assert best == min(grid, key=lambda g: rows[grid.index(g)].smape_original)
    settings = [{"rounds": r, "absolute_loss": False} for r in (1, 20)]
    chosen, drawn = trials.random_search(spark, sample, settings, folds=4)
    assert chosen.rounds == 20 and drawn.count() == 8
    total = sum(r.squares for r in drawn.where("draw = 1").collect())
    direct = 0.0
    for f in range(4):
        test = np.arange(120) % 4 == f
        direct += ((Boosting(**settings[1]).fit(x[~test], y[~test]).predict(x[test]) - y[test]) ** 2).sum()
    assert total == pytest.approx(direct)


def test_every_day_has_its_model_and_columns(spark, tmp_path):
    x, y = table(80, 3, 6)
    sample = trials.Sample(("a", "b", "c"), x, y, np.zeros(80, int), np.zeros(80, bool))
    columns = {-1: ["a"], 0: ["a", "b"], 2: ["c"]}
    tasks = trials.day_tasks([-1, 0, 2], columns.get, lambda d: Boosting(rounds=3, absolute_loss=d > 0) if d else None, lambda d: ["a"])
    assert tasks[0].settings.rising == (0,) and tasks[1].settings is None and tasks[2].settings.rising == ()
    new = spark.createDataFrame([(i, *(None if np.isnan(v) else float(v) for v in row)) for i, row in enumerate(x[:9])], "k int, a double, b double, c double")
    got = trials.score_days(new, sample, [-1, 0, 2], tasks, ["k"], str(tmp_path / "store")).collect()
    assert len(got) == 27
    for r in got:
        task = tasks[[-1, 0, 2].index(r.pred_day)]
        want = task.fit(sample).predict(x[r.k : r.k + 1][:, sample.places(task.columns)])[0]
        assert r.prediction == pytest.approx(want)
    assert trials.score_days(new.where("false"), sample, [-1], tasks[:1], ["k"]).count() == 0


def test_vocabulary_of_unseen_and_null_sets(spark):
    rows = spark.createDataFrame([(1, ["a", "b"]), (2, ["a", "x y"]), (3, None), (4, []), (5, ["a", "b"])], "k int, s array<string>")
    v = mx.Vocabulary.fit(rows, F.col("s"), "t_", 0.4, ["x y"])
    assert v.labels == ("a", "b") and v.columns == ["t_a", "t_b"]
    new = spark.createDataFrame([(1, ["b", "zz"]), (2, None), (3, ["q"])], "k int, s array<string>")
    got = new.select("k", *v.flags(F.col("s")), v.slots(F.col("s")).alias("p"), v.unseen(F.col("s")).alias("u")).orderBy("k").collect()
    assert [tuple(r) for r in got] == [(1, 0, 1, [1], 1), (2, 0, 0, None, 0), (3, 0, 0, [], 1)] or [tuple(r)[:3] for r in got] == [(1, 0, 1), (2, 0, 0), (3, 0, 0)]
    none = mx.Vocabulary.fit(rows.where("false"), F.col("s"), "t_")
    assert none.labels == () and new.select(none.slots(F.col("s"))).count() == 3


def test_columns_known_by_a_day():
    registry = mx.Registry(
        (mx.Field("n"), mx.Field("early", known=mx.BEFORE), mx.Field("late", known=mx.AFTER)), ("percent_viewed", "mc"), ahead=("wiki",)
    )
    matrix = mx.Matrix(registry)
    assert matrix.columns(-5) == ["n", "early", "before005_wiki"] and matrix.rising(-5) == ["before005_wiki"]
    assert matrix.columns(0)[-1] == "before000_wiki"
    assert matrix.columns(2) == ["n", "late", "day002_log_ratio_percent_viewed", "day001_log_percent_viewed", "day002_log_percent_viewed", "day002_mc"]
    assert matrix.rising(2) == []


def test_missing_values_keep_their_flag_in_vectors(spark):
    rows = spark.createDataFrame([(1, None, 2.0), (2, 0.0, None)], "k int, a double, b double")
    got = mx.vectors(rows, ["a", "b"]).orderBy("k").collect()
    assert [r.features.toArray().tolist() for r in got] == [[-1.0, 2.0, 1.0, 0.0], [0.0, -1.0, 0.0, 1.0]]


def test_wide_rows_are_a_projection_of_the_titles(spark):
    """Days, labels and codes of a title come from its own row: no shuffle, no long table."""
    registry = mx.Registry(
        (mx.Field("tags", mx.LABELS, prefix="tag_"), mx.Field("kind", mx.CATEGORY)), signals=("v",), last_day=3, ahead=("wiki",), first_day=-2
    )
    matrix = mx.Matrix(registry, {"tags": mx.Vocabulary("tag_", ("a b", "c"))}, {"kind": ("x", "y")})
    rows = [("A", ["c", "z", None], "y", [1.0, 2.0, 3.0], [4.0, 5.0, 6.0]), ("B", None, "new", None, None), ("C", ["a b", "c"], None, [7.0], [8.0])]
    titles = spark.createDataFrame(rows, "match_id_platform string, tags array<string>, kind string, f array<double>, b array<double>")
    wide = matrix.wide(titles, {"log_v": "f", "log_ratio_v": "f"}, {"wiki": "b"}, ["f"])
    assert "Exchange" not in wide._jdf.queryExecution().executedPlan().toString()
    got = {r.match_id_platform: r for r in wide.collect()}
    pick = lambda k: (got[k]["tag_a_b"], got[k]["tag_c"], got[k]["kind"], got[k]["day003_log_v"], got[k]["day002_log_ratio_v"], got[k]["before000_wiki"])
    assert pick("A") == (0, 1, 1, 3.0, 2.0, 4.0) and pick("B") == (0, 0, mx.UNSEEN, None, None, None)
    assert pick("C") == (1, 1, mx.UNSEEN, None, None, 8.0) and got["C"]["f"] == [7.0]


def test_running_list_adds_up_the_days(spark):
    rows = spark.createDataFrame([([(3, 5), (1, 2), (3, None), (None, 9)],), ([],)], "c array<struct<day:int, v:bigint>>")
    assert [r.t for r in rows.select(running_list(F.col("c"), "day", "v", [1, 2, 3, 4]).alias("t")).collect()] == [[2, 2, 7, 7], [0, 0, 0, 0]]


@pytest.mark.parametrize("leaves", [1, 6, 32])
def test_leaf_masks_give_the_walked_predictions(leaves):
    x, y = table(700, 4, 8, 0.2)
    model = Boosting(rounds=20, leaves=leaves, min_leaf=1, absolute_loss=False).fit(x, y)
    other = table(5000, 4, 9, 0.3)[0]
    assert model._tests is not None and np.array_equal(model.predict(other), model._walked(other))
    deep = Boosting(rounds=3, leaves=0, depth=9, min_leaf=1, absolute_loss=False).fit(x, y)
    assert deep._tests is None and np.array_equal(deep.predict(x), deep._walked(x))


def test_a_ladder_is_scored_from_one_row(spark):
    x, y = table(80, 2, 6)
    sample = trials.Sample(("a", "b"), x, y, np.zeros(80, int), np.zeros(80, bool))
    task = trials.Task(("a", "b"), Boosting(rounds=4, absolute_loss=False))
    models = trials.fitted(spark, sample, [task])
    rows = spark.createDataFrame([(i, *(None if np.isnan(v) else float(v) for v in row)) for i, row in enumerate(x[:30])], "k int, a double, b double")
    got = trials.scored(rows, models, ["k"], "m", ladder=("b", (-1.0, 0.5))).collect()
    assert len(got) == 30
    for r in got:
        for i, step in enumerate((-1.0, 0.5)):
            own = x[r.k : r.k + 1].copy()
            own[0, 1] = np.nan_to_num(own[0, 1]) + step
            assert r[f"prediction{i}"] == task.fit(sample).predict(own)[0]


def spread(spark, x, y, launch, original, parts=3):
    """The same rows as arrays and over three tasks, in the order of their keys' hashes."""
    names = tuple("abcdefg"[: x.shape[1]])
    data = [(i, *(None if np.isnan(v) else float(v) for v in row), float(y[i]), int(launch[i]), bool(original[i])) for i, row in enumerate(x)]
    kinds = "k int, " + ", ".join(f"{c} double" for c in names) + ", y double, l long, o boolean"
    rows = spark.createDataFrame(data, kinds).repartition(parts).withColumn("l", F.timestamp_micros("l"))
    arguments = (rows, "k", "y", names, F.col("l"), F.col("o"))
    held, trials.TASK_VALUES = trials.TASK_VALUES, 0
    try:
        wide = trials.labelled(*arguments, ordered=True)
    finally:
        trials.TASK_VALUES = held
    return trials.labelled(*arguments), wide


def spread_table(n=900):
    x, y = table(n, 4, 11)
    x[:, 1] = np.round(np.nan_to_num(x[:, 1]) * 20)  # few values, ties
    x[:, 2] = x[:, 2] > 0.5  # a label
    return x, y, np.arange(n) * 1_000_000, np.arange(n) % 2 == 0


def test_spread_rows_give_the_trees_of_one_task(spark, monkeypatch):
    from marquee.plans import spread as sp
    from marquee.plans.spread import Spread, boosted

    monkeypatch.setattr(sp, "ROUNDS", 2)  # predictions are written on the way
    small, wide = spread(spark, *spread_table())
    assert isinstance(wide, Spread) and len(wide) == len(small) == 900
    fold = trials.Fold(0, 600_000_000, 899_000_000, 500_000_000)
    settings = [
        Boosting(rounds=5), Boosting(rounds=4, absolute_loss=False, rising=(0,), depth=4),
        Boosting(rounds=3, leaves=0, depth=6, feature_fraction=0.5, absolute_loss=False),
    ]
    found = []
    models = [(("a", "b", "c", "d"), s, t) for s in settings for t in (trials.every_row, fold.train)] + [(("d", "c"), settings[0], fold.train)]
    boosted(spark, wide, models, lambda block, number, p: [p.sum(), len(p)], found.extend)
    assert [f[0] for f in found] == list(range(7))
    for (columns, s, train), (_, n, trees, sums) in zip(models, found, strict=True):
        mine, places = train(small), small.places(columns)
        want = s.fit(small.x[mine][:, places], small.y[mine])
        assert n == mine.sum() and len(trees.trees) == len(want.trees)
        predicted = want.predict(small.x[:, places])
        assert np.allclose(trees.predict(small.x[:, places]), predicted)
        assert sums == pytest.approx([predicted.sum(), 900])


def test_search_tuning_and_scores_over_spread_rows_are_those_of_one_task(spark, tmp_path):
    x, y, launch, original = spread_table(300)
    folds = [trials.Fold(0, 0, 50_000_000, -1), trials.Fold(1, 200_000_000, 299_000_000, 180_000_000)]
    grid = [{"rounds": 2, "depth": 2, "rate": 0.3}, {"rounds": 4, "depth": 2, "rate": 0.3}]
    small, wide = spread(spark, x, y, launch, original)
    one, other = trials.tune(spark, small, folds, grid), trials.tune(spark, wide, folds, grid)
    assert one[0] == other[0]
    for a, b in zip(one[1].orderBy("setting").collect(), other[1].orderBy("setting").collect(), strict=True):
        assert tuple(b)[:4] == tuple(a)[:4] and tuple(b)[4:] == pytest.approx(tuple(a)[4:])
    searched = [{"rounds": r, "absolute_loss": False} for r in (1, 3)]
    rows = [trials.random_search(spark, s, searched, folds=4)[1].orderBy("trial").collect() for s in (small, wide)]
    for a, b in zip(*rows, strict=True):
        assert tuple(b)[:5] == tuple(a)[:5] and b.squares == pytest.approx(a.squares)
    tasks = [trials.Task(small.columns, Boosting(rounds=3), f.train) for f in folds]
    path = str(tmp_path / "store")
    stores = [trials.fitted(spark, s, tasks, p).collect() for s, p in ((small, None), (wide, path), (wide, path))]
    assert [[(r.trial, r.n_rows) for r in s] for s in stores] == [[(1, 180)]] * 3 and stores[1] == stores[2]


def test_exact_ranks_of_odd_values(spark):
    from marquee.plans import spread as sp

    values = np.array([0.0, -0.0, -1.5, 3.0, 3.0, 1e300, -1e-300, np.inf] * 40)
    draw = np.random.default_rng(1).normal(size=700) * np.exp(np.arange(700) % 9)
    blocks = spark.sparkContext.parallelize([values[:100], values[100:]], 2)
    few = sp.FEW
    try:
        for sp.FEW in (few, 0):
            cells = lambda v: [(4, np.zeros(len(v), np.uint64), v), (9, (np.arange(700) % 2).astype(np.uint64), draw)]
            got = sp.ranked(blocks, cells, {4: {0: np.arange(320)}, 9: {1: np.array([0, 5, 699]), 0: np.array([300])}})
            assert np.array_equal(got[4][0], np.sort(values))
            twice = [np.sort(np.tile(draw[i::2], 2)) for i in (0, 1)]
            assert np.array_equal(got[9][1], twice[1][[0, 5, 699]]) and got[9][0][0] == twice[0][300]
    finally:
        sp.FEW = few


@pytest.mark.parametrize(
    ("query", "operator"),
    [("_crossed", "cross_predict"), ("_searched", "random_search"), ("score_days", "score_days"), ("tune_grid", "tune")],
)
def test_models_learn_from_every_labelled_title(spark, monkeypatch, query, operator):
    from marquee.suite import matrix_queries as mq

    rows = spark.range(1500).select(
        F.concat(F.lit("O"), "id").alias("match_id_platform"), F.timestamp_seconds("id").alias("launch"), (F.col("id") % 2 == 0).alias("original"),
        F.when(F.col("id") % 9 > 0, F.col("id") * 1.0).alias("target"), (F.col("id") * 1.0).alias("n"),
    )
    learned = []
    monkeypatch.setattr(mq, "_matrix", lambda spark, d: (mx.Matrix(mx.Registry((mx.Field("n"),))), rows))
    monkeypatch.setattr(mq, "bounds_of", lambda spark, d: None)
    monkeypatch.setattr(trials, "folds_of", lambda bounds: [])
    monkeypatch.setattr(trials, operator, lambda *a, **k: learned.extend(len(x) for x in a if isinstance(x, trials.Sample)) or [None, None])
    getattr(mq, query)(spark, f"made for {query}")
    assert learned == [rows.where("target is not null").count()] == [1333]
