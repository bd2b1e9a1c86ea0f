"""Launch funnel edges, and the one-pass plan against a loop over days."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marquee.operators.intervals import merge_intervals
from marquee.plans.funnel import (
    asset_titles,
    launch_funnel,
    prelaunch_titles,
    title_launches,
    user_title_changes,
    viewership_base,
)

L = datetime(2024, 1, 1, 7)
STREAM = (
    "title_name string, match_id string, launch timestamp, viewable_id string, viewable_id_count bigint, "
    "single_episode_ind int, user_id int, stream_at timestamp, runtime_hours double, stream_hours double"
)
TITLE = (
    "title_name string, match_id string, launch timestamp, last_offered timestamp, earliest_public timestamp, "
    "season_number_adj int, content_category string, single_episode_ind int, viewable_id_count bigint"
)
PERIOD = "user_id int, starts_at timestamp, ends_at timestamp"


def at(days=0.0, seconds=0.0):
    return L + timedelta(days=days, seconds=seconds)


def stream(user, when, hours, runtime=1.0, episode="e1", title="t", single=1, episodes=1, launch=L):
    return (title, title, launch, episode, episodes, single, user, when, runtime, hours)


def run(spark, streams, periods, end=datetime(2024, 3, 1), days=tuple(range(1, 29))):
    titles = {}
    for s in streams:
        titles[s[0]] = (s[0], s[1], s[2], s[2], s[2], 1, "movies" if s[5] else "series", s[5], s[4])
    islands = merge_intervals(spark.createDataFrame(periods, PERIOD), ["user_id"], "starts_at", "ends_at")
    rows = launch_funnel(
        spark.createDataFrame(streams, STREAM),
        spark.createDataFrame(list(titles.values()), TITLE),
        islands,
        islands,
        F.lit(end),
        "current",
        days,
    ).collect()
    return {
        (r.title_name, r.days_since_first_offered): (
            r.total_retail_sub_count, r.retail_played_count, r.retail_viewed_count, r.retail_completion_count,
        )
        for r in rows
    }


ALWAYS = (datetime(2023, 1, 1), datetime(2025, 1, 1))


def test_day_edges_are_inclusive_to_the_microsecond(spark):
    users = [(1, *ALWAYS), (2, *ALWAYS), (3, *ALWAYS)]
    got = run(
        spark,
        [
            stream(1, at(0), 0.5),  # exactly at launch
            stream(2, at(3), 0.5),  # exactly three days later
            stream(3, at(3) + timedelta(microseconds=500_000), 0.5),  # half a second past
        ],
        users,
    )
    assert [got[("t", n)][1] for n in (1, 2, 3, 4)] == [1, 1, 2, 3]


def test_two_minute_and_ninety_percent_rules(spark):
    users = [(u, *ALWAYS) for u in range(1, 6)]
    got = run(
        spark,
        [
            stream(1, at(0.1), 2 / 60),  # exactly two minutes: played, not viewed
            stream(2, at(0.1), 2 / 60 + 0.001),
            stream(3, at(0.1), 0.9, title="s", single=0, episodes=1),  # exactly 90 %
            stream(4, at(0.1), 0.91, title="s", single=0, episodes=1),
            stream(5, at(0.1), 5.0, runtime=None, title="n"),  # unknown runtime
        ],
        users,
    )
    assert got[("t", 1)][1:] == (2, 1, 0)
    assert got[("s", 1)][1:] == (2, 1, 1)
    assert not [k for k in got if k[0] == "n"]


def test_overlapping_periods_do_not_multiply_streams(spark):
    periods = [(1, at(-5), at(2)), (1, at(-1), at(9)), (1, at(0), at(1))]
    got = run(spark, [stream(1, at(0.5), 0.5)], periods)
    assert got[("t", 1)] == (1, 1, 1, 0)  # 0.5 h once is no completion, twice would be


def test_user_counts_from_the_day_of_subscription(spark):
    got = run(spark, [stream(1, at(0.5), 0.5), stream(1, at(20), 0.5)], [(1, at(4.5), at(30))])
    assert [n for (_, n) in sorted(got)] == list(range(5, 29))
    assert got[("t", 5)] == (1, 1, 1, 0)
    assert got[("t", 20)] == (1, 1, 1, 1)


def test_expired_before_launch_is_never_counted(spark):
    got = run(spark, [stream(1, at(0.5), 0.5), stream(2, at(0.5), 0.5)], [(1, at(-9), at(-1)), (2, *ALWAYS)])
    assert got[("t", 1)] == (1, 1, 1, 0)


def test_only_elapsed_windows_are_emitted(spark):
    got = run(spark, [stream(1, at(0.5), 0.5)], [(1, *ALWAYS)], end=at(3))
    assert sorted(n for (_, n) in got) == [1, 2, 3]


def by_day(streams, periods, n):
    """The definition, one day at a time."""
    result = {}
    for title in {s[0] for s in streams}:
        mine = [s for s in streams if s[0] == title]
        launch, episodes, single = mine[0][2], mine[0][4], mine[0][5]
        closes = launch + timedelta(days=n)
        eligible = {u for u, a, b in periods if b >= launch and a <= closes}
        played = viewed = completed = 0
        for user in {s[6] for s in mine} & eligible:
            total, done, longest = 0.0, 0, 0.0
            for episode in {s[3] for s in mine}:
                seen = [s for s in mine if s[6] == user and s[3] == episode and launch <= s[7] <= closes]
                if not seen:
                    continue
                runtime, hours = max(s[8] for s in seen), sum(s[9] for s in seen)
                total += min(hours, runtime)
                done += hours > 0.9 * runtime
                longest = max(longest, runtime)
            if total > 0:
                played += 1
                viewed += (total > min(2 / 60, longest)) if single else done > 0
                completed += done == episodes
        if played:
            result[title] = (len(eligible), played, viewed, completed)
    return result


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_one_pass_equals_a_loop_over_days(spark, seed):
    rng = random.Random(seed)
    streams, periods = [], []
    for user in range(12):
        for _ in range(rng.randrange(1, 4)):
            start = rng.uniform(-20, 30)
            periods.append((user, at(start), at(start + rng.choice([1, 4, 15]))))
    for i in range(250):
        title = rng.choice(["a", "b", "c"])
        launch = L + timedelta(days={"a": 0, "b": 1.25, "c": 3}[title])
        single = int(title == "a")
        episode = "a1" if single else f"{title}{rng.randrange(2)}"
        when = launch + timedelta(days=rng.uniform(0, 28))
        # the runtime grows with the edit seen, so completion can be lost again
        streams.append(
            stream(rng.randrange(12), when, rng.choice([0.01, 0.3, 0.61]), rng.choice([0.5, 1.0]), episode, title,
                   single, 1 if single else 2, launch)
        )
    got = run(spark, streams, periods)
    for n in range(1, 29):
        assert {t: v for (t, d), v in got.items() if d == n} == by_day(streams, periods, n)


def test_base_keeps_each_stream_once(spark):
    streams = [stream(1, at(0.5), 0.5), stream(2, at(1), 0.5), stream(3, at(1), 0.5)]
    periods = [(1, at(-5), at(2)), (1, at(-1), at(9)), (2, at(28), at(40))]
    islands = merge_intervals(spark.createDataFrame(periods, PERIOD), ["user_id"], "starts_at", "ends_at")
    base = viewership_base(spark.createDataFrame(streams, STREAM), islands)
    # user 2 starts exactly 28 days after launch: the bound is strict
    assert [r.user_id for r in base.collect()] == [1]
    assert user_title_changes(spark.createDataFrame(streams, STREAM), islands, 28).count() == 1


ASSET = (
    "viewable_id string, series_id string, season_number int, series_title_long string, asset_title_long string, "
    "content_category string, asset_type string, theatrical_release_date timestamp, original_linear_air_date timestamp, "
    "first_offered_date_current timestamp, first_offered_date_legacy timestamp"
)


def asset(viewable, offered, series=None, season=None, category="movies", kind="FEATURE", cinema=None, legacy=None):
    title = f"Show {series}" if series else None
    return (viewable, series, season, title, f"Asset {viewable}", category, kind, cinema, None, offered, legacy)


def test_title_keys_and_first_public_date(spark):
    rows = [
        asset("v1", at(0), "s1", None, "series", legacy=at(-9)),  # no season: the first
        asset("v2", at(4), "s1", 1, "series", cinema=at(-90)),
        asset("v3", at(1)),
        asset("v4", None),  # not on this platform
        asset("v5", at(1), kind="TRAILER"),
        asset("v6", at(1), category=None),
    ]
    titles = asset_titles(spark.createDataFrame(rows, ASSET), "first_offered_date_current")
    got = {r.match_id: r for r in title_launches(titles).collect()}
    assert sorted(got) == ["s1-1", "v3"]
    series = got["s1-1"]
    assert (series.title_name, series.viewable_id_count, series.single_episode_ind) == ("Show s1 S1", 2, 0)
    assert (series.launch, series.last_offered, series.earliest_public) == (at(0), at(4), at(-90))


def test_prelaunch_rows_within_ninety_days_and_not_recorded(spark):
    rows = [asset("a", at(0)), asset("b", at(90)), asset("c", at(91)), asset("d", at(-1)), asset("e", at(5))]
    titles = asset_titles(spark.createDataFrame(rows, ASSET), "first_offered_date_current")
    recorded = spark.createDataFrame(
        [("e", "current", 0), ("a", "legacy", 0), ("b", "current", 3)],
        "match_id string, platform_name string, days_since_first_offered int",
    )
    got = prelaunch_titles(titles, F.lit(L), "current", recorded).collect()
    assert sorted(r.match_id for r in got) == ["a", "b"]
    assert all(r.retail_played_count is None and r.days_since_first_offered == 0 for r in got)


def test_recorded_rows_are_not_repeated(spark):
    streams, periods = [stream(1, at(0.5), 0.5)], [(1, *ALWAYS)]
    islands = merge_intervals(spark.createDataFrame(periods, PERIOD), ["user_id"], "starts_at", "ends_at")
    launches = spark.createDataFrame([("t", "t", L, L, L, 1, "movies", 1, 1)], TITLE)
    recorded = spark.createDataFrame(
        [("t", "current", 1), ("t", "legacy", 2)], "match_id string, platform_name string, days_since_first_offered int"
    )
    rows = launch_funnel(
        spark.createDataFrame(streams, STREAM), launches, islands, islands, F.lit(at(3)), "current", existing=recorded
    )
    assert sorted(r.days_since_first_offered for r in rows.collect()) == [2, 3]
