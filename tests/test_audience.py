"""Audience counts against the window-by-user definition."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from marquee.operators import audience
from marquee.operators.audience import audience_counts, events_up_to, gaps_inside
from marquee.operators.intervals import merge_intervals

T0 = datetime(2024, 1, 1)


def m(minutes: float) -> datetime:
    return T0 + timedelta(minutes=minutes)


def test_events_up_to(spark):
    rng = random.Random(3)
    events = [(m(rng.randrange(0, 3000)),) for _ in range(400)]
    points = [(m(rng.randrange(0, 3000)),) for _ in range(40)] + [events[0], (m(-500),), (m(9000),)]
    left = spark.createDataFrame(events, "e timestamp")
    right = spark.createDataFrame(points, "p timestamp")
    for inclusive in (True, False):
        got = {r.p: r.n_events for r in events_up_to(left, "e", right, "p", inclusive).collect()}
        for (p,) in points:
            assert got[p] == sum(1 for (e,) in events if (e <= p if inclusive else e < p))


@pytest.mark.parametrize("edges", [0, 10_000])
def test_counts_match_definition(spark, monkeypatch, edges):
    monkeypatch.setattr(audience, "EDGES", edges)  # 0: no window set is small enough to place directly
    rng = random.Random(11)
    day = 24 * 60
    periods = []
    for _ in range(300):
        start = rng.randrange(0, 60 * day)
        periods.append((rng.randrange(40), m(start), m(start + rng.choice([60, day, 4 * day, 12 * day]))))
    anchors = []
    for _ in range(25):
        launch = rng.randrange(10 * day, 55 * day)
        anchors.append((m(launch - rng.choice([0, 3 * day, 400])), m(launch)))
    # an edge exactly on a period's start and end
    anchors.append((periods[0][2], periods[0][2]))
    anchors.append((periods[1][1], periods[1][1]))
    df = spark.createDataFrame(periods, "user_id int, starts_at timestamp, ends_at timestamp")
    islands = merge_intervals(df, ["user_id"], "starts_at", "ends_at")
    for days in ([1, 2, 5, 9], [-2, -1, 0], [-2]):
        frame = spark.createDataFrame(anchors, "opens timestamp, launch timestamp")
        got = {
            (r.opens, r.launch, r.n): r.users
            for r in audience_counts(islands, frame, days, "starts_at", "ends_at").collect()
        }
        for opens, launch in anchors:
            for n in days:
                closes = launch + timedelta(days=n)
                if closes < opens:
                    assert (opens, launch, n) not in got
                    continue
                users = {u for u, s, e in periods if e >= opens and s <= closes}
                assert got[(opens, launch, n)] == len(users)


def test_rows_do_not_grow_with_gaps_times_windows(spark):
    """Four times the windows over the same gaps: no join makes more than a few rows for each."""
    rng = random.Random(5)
    gaps = [(m(t), m(t + rng.randrange(1, 9000))) for t in (rng.randrange(0, 60 * 1440) for _ in range(4000))]
    df = spark.createDataFrame(gaps, "a timestamp, b timestamp")
    for n in (20, 80):
        grid = [(m(60 * i + 7), m(60 * i + 7 + 1440 * k)) for i in range(n) for k in (1, 5)]
        frame = gaps_inside(df, spark.createDataFrame(grid, "opens timestamp, closes timestamp"), "a", "b")
        got = {(r.opens, r.closes): r.n_gaps for r in frame.collect()}
        for opens, closes in grid[:6]:
            assert got[opens, closes] == sum(1 for a, b in gaps if a >= opens and b <= closes)
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
