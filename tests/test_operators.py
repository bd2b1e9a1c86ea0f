"""Aggregates, pivots, texts, neighbours and sources on small fixtures."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.functions import dates, metrics, text
from marquee.operators.aggregates import mode_per_key, percentiles_per_key, running_by_day, share_of_total
from marquee.operators.joins import new_rows, not_in, one_to_one, small_side
from marquee.operators.pivots import common_labels, day_pivot, multi_hot, one_hot, unpivot_days
from marquee.plans import actives, features, learning
from marquee.plans.neighbors import _closest, trend_neighbours
from marquee.sources import files
from marquee.streaming import incremental


def first(df):
    return df.collect()[0]


def test_percentiles_match_numpy(spark):
    rng = random.Random(4)
    rows = [(0, round(rng.expovariate(0.1), 2)) for _ in range(3000)]  # a hot, skewed group
    rows += [(1, float(rng.randrange(4))) for _ in range(200)] + [(2, 7.0), (3, 1.0), (3, 2.0)]
    df = spark.createDataFrame(rows, "k int, v double")
    shares = {"p50": 0.5, "p80": 0.8, "p0": 0.0, "p100": 1.0, "p333": 0.333}
    for row in percentiles_per_key(df, ["k"], "v", shares, pieces=16).collect():
        values = [v for k, v in rows if k == row.k]
        for name, share in shares.items():
            assert row[name] == pytest.approx(np.quantile(values, share))


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([(1, 3), (1, 3), (1, 2), (1, 2), (1, None), (2, None)], "k int, v int")
    assert {r.k: r.v for r in mode_per_key(df, ["k"], "v").collect()} == {1: 2, 2: None}


def test_running_by_day_fills_days(spark):
    df = spark.createDataFrame([("a", 2, 5), ("a", 4, -1)], "k string, n int, v int")
    got = {r.n: r.v for r in running_by_day(df, ["k"], "n", ["v"], [1, 2, 3, 4, 5]).collect()}
    assert got == {1: 0, 2: 5, 3: 5, 4: 4, 5: 4}


def test_share_sums_to_hundred(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 9)], "k int, v double")
    assert first(share_of_total(df, "v", "s").agg(F.sum("s").alias("s"))).s == pytest.approx(100)


def test_not_in_and_new_rows_null_handling(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(2,), (None,)], "k int")
    assert [r.k for r in not_in(left, "k", right, "k").collect()] == [1]
    assert sorted(str(r.k) for r in new_rows(left, right, ["k"]).collect()) == ["1", "None"]


def test_one_to_one(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 4), ("d", 4)], "l string, r int")
    assert [r.l for r in one_to_one(df, "l", "r").collect()] == ["a"]


def test_small_side_leaves_large_inputs_alone(spark):
    assert "ResolvedHint" in small_side(spark.range(10))._jdf.queryExecution().analyzed().toString()
    big = spark.range(10_000_000_000)
    assert "ResolvedHint" not in small_side(big)._jdf.queryExecution().analyzed().toString()


def test_genres_of_the_published_fixture(spark):
    df = spark.createDataFrame([("comedy|teens", "comedy | romance")], "a string, b string")
    tokens = first(df.select(text.genre_tokens(F.col("a"), F.col("b")).alias("t"))).t
    assert tokens == ["comedy", "romance", "teens"]
    wide = multi_hot(df.withColumn("k", F.lit(1)), "k", text.genre_tokens(F.col("a"), F.col("b")), ["comedy"], "tag_")
    assert wide.columns == ["k", "tag_comedy"] and first(wide).tag_comedy == 1


def test_licensor_suffixes_match_whole_words(spark):
    df = spark.createDataFrame([("princess films inc., lp, lionsgate/ab",)], "a string")
    assert first(df.select(text.licensor_tokens(F.col("a")).alias("t"))).t == ["lion gate", "princess films"]


def test_licensor_extra_rules(spark):
    df = spark.createDataFrame([("my brand east,my brand west",)], "a string")
    rules = [("my brand (east|west)", "my brand")]
    assert first(df.select(text.licensor_tokens(F.col("a"), rules).alias("t"))).t == ["my brand"]


def test_season_suffix_of_multi_word_titles(spark):
    df = spark.createDataFrame([("The Long Show S12",), ("Big Summer Story",)], "t string")
    assert [r.x for r in df.select(text.without_season(F.col("t")).alias("x")).collect()] == ["The Long Show", "Big Summer Story"]


def test_day_ceiling_around_zero(spark):
    base = datetime(2024, 1, 1)
    moments = [timedelta(0), timedelta(microseconds=1), timedelta(microseconds=-1), timedelta(days=-1), timedelta(days=2)]
    df = spark.createDataFrame([(base + m, base) for m in moments], "m timestamp, a timestamp")
    got = [r.n for r in df.select(dates.day_ceiling(F.col("m"), F.col("a")).alias("n")).collect()]
    assert got == [0, 1, 0, -1, 2]


def test_capped_hours_keeps_unknown_runtime_unknown(spark):
    df = spark.createDataFrame([(2.0, None), (2.0, 1.0)], "h double, r double")
    assert [r.x for r in df.select(metrics.capped_hours(F.col("h"), F.col("r")).alias("x")).collect()] == [None, 1.0]


def test_never_observed_and_not_reached_stay_apart(spark):
    titles = spark.createDataFrame([("a", 2)], "match_id_platform string, max_day int")
    signal = spark.createDataFrame([("a", 1, 0.5)], "match_id_platform string, day int, v double")
    grid = features.clean_day_values(features.day_grid(signal, titles, range(1, 4)), "v")
    assert {r.day: r.v for r in grid.collect()} == {1: 0.5, 2: 1e-10, 3: -100.0}


def test_pivot_there_and_back(spark):
    df = spark.createDataFrame([("a", 1, 0.5), ("a", 3, 0.7), ("b", 2, 0.1)], "k string, d int, v double")
    wide = day_pivot(df, "k", "d", "v", [1, 2, 3], "m", df, -1.0)
    assert wide.columns == ["k", "day001_m", "day002_m", "day003_m"]
    back = {(r.k, r.day): r.v for r in unpivot_days(wide, ["k"], "m", "v").collect()}
    assert back[("a", 1)] == 0.5 and back[("b", 1)] == -1.0 and len(back) == 6


def test_common_labels_threshold_is_inclusive(spark):
    df = spark.createDataFrame([(i, ["x"] if i < 2 else ["y", "others"]) for i in range(10)], "i int, t array<string>")
    got = {r.token for r in common_labels(df, F.col("t"), 0.2, ["others"]).collect()}
    assert got == {"x", "y"}


def test_one_hot_unknown_is_null(spark):
    df = spark.createDataFrame([("a",), ("z",)], "c string")
    rows = df.select(*one_hot(F.col("c"), ("a", "b"), "c_")).collect()
    assert tuple(rows[0]) == (1, 0) and tuple(rows[1]) == (None, None)


def test_cumulative_actives_matches_loop(spark):
    rng = random.Random(2)
    start = datetime(2024, 1, 1).date()
    seen = [(rng.randrange(15), start + timedelta(days=rng.randrange(40))) for _ in range(120)]
    df = spark.createDataFrame(seen, "u int, d date")
    got = {
        (r.start_date, r.end_date): (r.daily_viewing_subs_denom, r.cumulative_viewing_subs_denom)
        for r in actives.cumulative_actives(df, "u", "d", "2024-01-01", "2024-02-09").collect()
    }
    want = {}
    for offset in range(40):
        s = start + timedelta(days=offset)
        firsts = {}
        for u, d in sorted(seen, key=lambda x: x[1]):
            if s <= d <= s + timedelta(days=28):
                firsts.setdefault(u, d)
        total = 0
        for day in sorted(set(firsts.values())):
            n = sum(1 for d in firsts.values() if d == day)
            total += n
            want[(s, day)] = (n, total)
    assert got == want


def test_neighbours_match_numpy_across_blocks(spark):
    rng = np.random.default_rng(1)
    base = datetime(2024, 1, 1)
    rows = [
        (str(i), base + timedelta(days=int(rng.integers(0, 120))), [float(x) for x in rng.normal(size=5)],
         float(i) if i % 3 else None)
        for i in range(60)
    ]
    df = spark.createDataFrame(rows, "id string, launched_at timestamp, curve array<double>, target double")
    got = {}
    for r in trend_neighbours(df, 3, block_rows=16).collect():
        got.setdefault(r.id, {})[r["rank"]] = r.neighbour_target
    for key, when, curve, _ in rows:
        usable = [r for r in rows if r[3] is not None and r[1] + timedelta(days=28) < when]
        usable.sort(key=lambda r: (np.linalg.norm(np.array(r[2]) - np.array(curve)), r[0]))
        assert got.get(key, {}) == {i + 1: r[3] for i, r in enumerate(usable[:3])}


def test_resample_reaches_targets(spark):
    day = datetime(2024, 1, 1).date()
    rows = [(i, i % 4, "Popcorn" if i % 10 == 0 else "Library", day - timedelta(days=i % 260)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id int, tier int, category string, effective_start_date date")
    drawn = learning.resample(df, "id", "2024-01-01")
    target = sum(1 for r in rows if r[1] == 3)
    counts = {r.tier: r["count"] for r in drawn.where("category <> 'Popcorn'").groupBy("tier").count().collect()}
    for tier in (0, 1, 2):
        assert counts[tier] == pytest.approx(target, rel=0.1)
    assert drawn.where("tier = 3 and category <> 'Popcorn'").groupBy("id").count().where("count > 1").isEmpty()


def test_cross_prediction_respects_the_embargo(spark):
    day = datetime(2024, 1, 1)
    rows = [(i, day + timedelta(days=i), float(i % 7), float(i % 7) * 2) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, at timestamp, x double, label double")
    bounds = learning.fold_bounds(df, "at", 3)
    for edge in bounds.collect():
        assert edge.train_before <= edge.lower - timedelta(days=28)
    scored = learning.cross_predict(df, bounds, "at", learning.feature_stages(["x"]), learning.linear("label"))
    assert scored.groupBy("id").count().where("count > 1").isEmpty()
    assert first(scored.agg(F.max(F.abs(F.col("prediction") - F.col("label"))).alias("e"))).e < 1e-6


def test_boosting_takes_wide_categories(spark):
    rows = [(i, f"c{i % 200}", float(i % 200)) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, kind string, label double")
    model = learning.fit(df, learning.feature_stages([], ["kind"]), learning.boosting("label", rounds=1, depth=2))
    assert model.transform(df).count() == 600


def test_calibration_rises_with_the_signal(spark):
    rows = [(i, float(i % 50) if i % 11 else None, float((i % 50) + (i * 7) % 13)) for i in range(800)]
    df = spark.createDataFrame(rows, "id int, x double, label double")
    got = learning.monotone_calibration(df, "label", "x", steps=20).orderBy("x").collect()
    assert len(got) == 800
    values = [r.calibrated for r in got if r.x is not None]
    assert values == sorted(values)


def test_resampling_keeps_titles_without_category(spark):
    rows = [(i, 3, None if i % 2 else "Drama", datetime(2023, 12, 1).date()) for i in range(20)]
    df = spark.createDataFrame(rows, "id int, tier int, category string, effective_start_date date")
    assert learning.resample(df, "id", "2024-01-01").count() == 20


def test_csv_nulls_names_and_bad_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b", None), (2, None, None)], "K int, NAME string, NONE string")
    files.write_csv(df, str(tmp_path / "x"), quoted=True)
    back = files.read_csv_folder(spark, str(tmp_path / "x"), key="k", excluded_keys=[2])
    assert back.columns == ["k", "name"] and [tuple(r) for r in back.collect()] == [(1, "a,b")]


def test_replace_partitions_keeps_others(spark, tmp_path):
    path = str(tmp_path / "t")
    files.replace_table(spark.createDataFrame([(1, "a"), (2, "a")], "k int, v string"), path, ["k"])
    files.replace_partitions(spark.createDataFrame([(2, "b")], "k int, v string"), path, ["k"])
    assert {r.k: r.v for r in spark.read.parquet(path).collect()} == {1: "a", 2: "b"}


def test_empty_run_moves_the_mark(spark, tmp_path):
    path = str(tmp_path / "state")
    incremental.record_empty_run(spark, path, "trailers", "current", -3, "2024-01-05")
    marks = incremental.high_water(spark.read.parquet(path), ["platform", "nday"], "last_update_date")
    planned = spark.createDataFrame([("current", -3), ("current", -2)], "platform string, nday int")
    assert [r.nday for r in incremental.due(planned, marks, ["platform", "nday"], "2024-01-05").collect()] == [-2]
    assert incremental.due(planned, marks, ["platform", "nday"], "2024-01-06").count() == 2


def test_feature_choice_by_mode():
    choice = features.FeatureChoice
    assert choice(-5).spans() == []
    assert choice(3, raw_log=False).spans(["percent_viewed", "mc"]) == [
        ("log_percent_viewed", 1, 1), ("log_ratio_percent_viewed", 2, 3), ("mc", 3, 3),
    ]
    assert choice(3).spans(["percent_viewed"]) == [("log_ratio_percent_viewed", 2, 3), ("log_percent_viewed", 1, 3)]
    assert choice(2, log_ratio=False, raw_log=False, cumulative_cost=False).spans(["vtp", "mc"]) == [
        ("log_vtp", 1, 2), ("mc", 1, 2),
    ]
    assert choice(2, log_target=False, raw_log=False).spans(["percent_viewed", "vtp"]) == [("percent_viewed", 1, 2)]


def test_unquoted_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi"'), (2, None)], "k int, name string")
    files.write_csv(df, str(tmp_path / "x"), single_file=True)
    text_rows = [r.value for r in spark.read.text(str(tmp_path / "x")).collect()]
    assert text_rows[0] == "k,name" and sorted(text_rows[1:]) == ['1,say "hi"', "2,\\N"]


def test_closest_rows_are_exact_and_ties_keep_their_order():
    draw = np.random.default_rng(4)
    left, right = draw.normal(size=(40, 6)).round(1), draw.normal(size=(90, 6)).round(1)
    right[50:60] = right[40:50]  # equal distances
    left[:5] = right[:5] + 1e7  # large numbers round away in the product
    allowed = draw.random((40, 90)) < 0.7
    allowed[3] = False
    row, place, distance = _closest(left, right, allowed, 4)
    for i in range(40):
        exact = np.sqrt(((right - left[i]) ** 2).sum(1))
        want = sorted((exact[j], j) for j in range(90) if allowed[i, j])[:4]
        assert [(d, p) for d, p in zip(distance[row == i], place[row == i])] == want


def test_calibration_places_rows_by_a_search_among_edges(spark, monkeypatch):
    """Ranges end with their edge, zeros of either sign are one, and no row is compared to every edge."""
    rows = [(float(x), 2.0 * (x % 7)) for x in range(-20, 21)] + [(-0.0, 1.0), (None, 3.0)]
    df = spark.createDataFrame(rows, "x double, label double")
    with monkeypatch.context() as m:  # the comparison with every edge was a filter of them all
        m.setattr(learning.F, "filter", None)
        got = learning.monotone_calibration(df, "label", "x", steps=5)
    known = df.where("x is not null")
    cuts = known.agg(F.percentile_approx("x", F.array(*[F.lit(i / 5) for i in range(1, 5)]), 50)).first()[0]
    sizes = {}
    for x, y in rows:
        if x is not None:
            sizes.setdefault(sum(c < x for c in cuts), []).append((x, y))
    points = sorted((sum(x for x, _ in g) / len(g), sum(y for _, y in g) / len(g), len(g)) for g in sizes.values())
    blocks = []
    for x, y, n in points:  # pool adjacent violators
        blocks.append([y, n, [x]])
        while len(blocks) > 1 and blocks[-2][0] > blocks[-1][0]:
            (b, m, xs), (a, k, ys) = blocks.pop(), blocks.pop()
            blocks.append([(a * k + b * m) / (k + m), k + m, ys + xs])
    low = blocks[0][0]
    values = {r.x: r.calibrated for r in got.collect()}
    assert abs(values[-20.0] - low) < 1e-9 and abs(values[20.0] - blocks[-1][0]) < 1e-9 and abs(values[None] - low) < 1e-9
    assert values[-0.0] == values[0.0]


def test_folds_are_fitted_side_by_side(spark, monkeypatch):
    import threading

    both, fit = threading.Barrier(2, timeout=60), learning.fit
    monkeypatch.setattr(learning, "fit", lambda *a: (both.wait(), fit(*a))[1])
    day = lambda n: datetime(2024, 1, 1) + timedelta(days=n)
    df = spark.createDataFrame([(day(n), float(n), 2.0 * n) for n in range(100)], "at timestamp, x double, label double")
    bounds = spark.createDataFrame([(0, day(50), day(59), day(30)), (1, day(60), day(69), day(40))], "fold int, lower timestamp, upper timestamp, train_before timestamp")
    got = learning.cross_predict(df, bounds, "at", learning.feature_stages(["x"]), learning.linear("label")).collect()
    assert len(got) == 20 and {r.fold for r in got} == {0, 1} and all(abs(r.prediction - r.label) < 1e-6 for r in got)
