"""Interval operators against brute force, with and without hot-key segments."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from marquee.operators.intervals import chain_periods, merge_intervals, next_interval_start
from marquee.operators.segments import SkewLimit
from marquee.plans.subscriptions import active_islands

T0 = datetime(2024, 1, 1)
SPLIT = SkewLimit(rows=3, segment_micros=86_400_000_000)
LIMITS = [None, SPLIT, SkewLimit(rows=3, segment_micros=7 * 86_400_000_000)]


def h(hours: float) -> datetime:
    return T0 + timedelta(hours=hours)


def random_intervals(seed: int, keys: int = 4, rows: int = 120):
    rng = random.Random(seed)
    out = []
    for _ in range(rows):
        key = 0 if rng.random() < 0.5 else rng.randrange(keys)  # key 0 is hot
        start = rng.randrange(0, 2400)
        out.append((key, h(start), h(start + rng.choice([0, 1, 5, 24, 100]))))
    return out


def islands_of(intervals):
    result, reach = [], None
    for start, end in sorted(intervals):
        if reach is None or start > reach:
            result.append([start, end, reach])
        result[-1][1] = max(result[-1][1], end)
        reach = end if reach is None else max(reach, end)
    return [tuple(r) for r in result]


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("seed", [1, 2])
def test_merge_matches_brute_force(spark, seed, limit):
    rows = random_intervals(seed)
    df = spark.createDataFrame(rows, "k int, s timestamp, e timestamp")
    got = sorted(
        (r.k, r.s, r.e, r.previous_end) for r in merge_intervals(df, ["k"], "s", "e", limit).collect()
    )
    want = []
    for key in {r[0] for r in rows}:
        want += [(key, *island) for island in islands_of([(a, b) for k, a, b in rows if k == key])]
    assert got == sorted(want)


def test_merge_touching_nested_disjoint(spark):
    rows = [(1, h(0), h(2)), (1, h(2), h(3)), (1, h(5), h(9)), (1, h(6), h(7)), (1, h(20), h(21)), (1, h(30), h(29))]
    df = spark.createDataFrame(rows, "k int, s timestamp, e timestamp")
    got = sorted((r.s, r.e) for r in merge_intervals(df, ["k"], "s", "e").collect())
    assert got == [(h(0), h(3)), (h(5), h(9)), (h(20), h(21))]


def chained(rows, gap_seconds):
    """Sessions by definition: rows in start order, ties share the highest count."""
    out = {}
    for key in {r[0] for r in rows}:
        mine = sorted((a, b) for k, a, b in rows if k == key)
        count, numbers, before = 0, [], None
        for a, b in mine:
            joined = before is not None and 0 <= (a - before).total_seconds() <= gap_seconds
            count += 0 if joined else 1
            numbers.append(count)
            before = b
        for i, (a, b) in enumerate(mine):
            number = max(n for (x, _), n in zip(mine, numbers) if x == a)
            lo, hi = out.get((key, number), (a, b))
            out[(key, number)] = (min(lo, a), max(hi, b))
    return sorted((k, n, lo, hi) for (k, n), (lo, hi) in out.items())


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("gap", [0, 7200])
def test_chain_matches_definition(spark, gap, limit):
    rng = random.Random(gap)
    rows = []
    for _ in range(150):
        key = 0 if rng.random() < 0.5 else rng.randrange(3)
        start = rng.randrange(0, 300)
        rows.append((key, h(start), h(start + rng.choice([1, 2, 24]))))
    df = spark.createDataFrame(rows, "k int, s timestamp, e timestamp")
    got = chain_periods(df, ["k"], "s", "e", gap, limit).collect()
    assert sorted((r.k, r.session_id, r.s, r.e) for r in got) == chained(rows, gap)


def test_chain_exact_renewal_gap_and_tie(spark):
    second = timedelta(seconds=1)
    rows = [
        (1, h(0), h(24)), (1, h(24), h(48)),  # exact renewal
        (1, h(48) + second, h(72)),  # one second late
        (2, h(0), h(10)), (2, h(0), h(12)),  # tied start
    ]
    df = spark.createDataFrame(rows, "k int, s timestamp, e timestamp")
    got = sorted((r.k, r.s, r.e) for r in chain_periods(df, ["k"], "s", "e").collect())
    assert got == [(1, h(0), h(48)), (1, h(48) + second, h(72)), (2, h(0), h(12))]


@pytest.mark.parametrize("limit", LIMITS)
def test_next_interval_start(spark, limit):
    rows = random_intervals(5)
    df = spark.createDataFrame(rows, "k int, s timestamp, e timestamp")
    islands = merge_intervals(df, ["k"], "s", "e")
    rng = random.Random(9)
    moments = [(i, rng.randrange(5), h(rng.randrange(0, 2600))) for i in range(80)]
    left = spark.createDataFrame(moments, "id int, k int, at timestamp")
    got = {
        r.id: r.found
        for r in next_interval_start(left, islands, ["k"], "at", "s", "e", "found", limit).collect()
    }
    for i, key, at in moments:
        spans = islands_of([(a, b) for k, a, b in rows if k == key])
        want = min((s for s, e, _ in spans if e >= at), default=None)
        assert got[i] == want


def test_islands_by_platform(spark):
    rows = [(1, "a", h(0), h(5)), (1, "b", h(4), h(9))]
    df = spark.createDataFrame(rows, "user_id int, platform_name string, starts_at timestamp, ends_at timestamp")
    assert active_islands(df).count() == 1
    assert active_islands(df, "b").collect()[0].starts_at == h(4)
