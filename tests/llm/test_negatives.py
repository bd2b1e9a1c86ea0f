"""Hard negatives against scores taken one by one."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import given as given_rows
from hypothesis import settings
from hypothesis import strategies as st

from marquee.llm import negatives

from . import cases

SCHEMA = "vec_id long, embedding array<double>, label int, anchor long, place int, found long, vector string, number int"
MOST = 2**63 - 1


def table(spark, rows):
    return spark.createDataFrame([(*r, *[None] * 5) for r in rows], SCHEMA).repartition(3)


def direct(rows, every=100):
    kept = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10 if label >= 0 else -((-label - 1) % 10)
        kept.append((vec_id, label, [negatives.whole(x) for x in vector]))
    out = []
    for a_id, a_label, a in kept:
        if a_id is None or a_id % every:
            continue
        scored = []
        for vec_id, label, v in kept:
            if vec_id != a_id:
                score = sum(x * y for x, y in zip(a, v, strict=False))
                scored.append((-max(-MOST, min(MOST, score)), MOST if vec_id is None else vec_id, vec_id, label))
        scored.sort(key=lambda x: x[:2])
        same = [s for s in scored if s[3] == a_label][:5]
        for p, _, positive, _ in same:
            hard = [s for s in scored if s[3] != a_label and 30 * -p <= 100 * -s[0] <= 90 * -p]
            out += [(a_id, positive, i + 1, s[2], -p, -s[0]) for i, s in enumerate(hard[:10])]
    return out


def check(spark, rows, every=100, **settings_):
    got = negatives.hard_negatives(table(spark, rows), anchor_every=every, **settings_).collect()
    expected = direct(rows, every)
    assert cases.same(got, expected)
    return expected


def vectors(n, dims, seed, scale=1.0):
    source = random.Random(seed)
    return [(i, [source.gauss(0, scale) for _ in range(dims)], source.randrange(4)) for i in range(n)]


def test_given_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in docs.collect()]
    got = negatives.hard_negatives(docs).collect()
    expected = direct(rows)
    assert len(expected) > 100
    assert cases.same(got, expected)


@pytest.mark.parametrize("wave_bytes", [1, 2000, 1 << 20])
def test_waves_agree(spark, wave_bytes):
    assert len(check(spark, vectors(300, 6, 1), every=40, wave_bytes=wave_bytes)) > 50


def test_rows_that_take_no_part_and_ties(spark):
    rows = vectors(60, 4, 2)
    rows += [
        (100, None, 1),
        (200, [1.0, None, 0.0, 0.0], 1),
        (300, [math.nan, 0.0, 0.0, 0.0], 1),
        (400, [math.inf, 0.0, 0.0, 0.0], 1),
        (500, [1.0, 1.0, 1.0, 1.0], None),
        (600, [], 1),
        (700, [0.5], -3),
        (None, [1.0, 1.0, 1.0, 1.0], 1),
        (None, [0.3, 0.4, 0.2, 0.1], 2),
        (1100, [1.0, 1.0, 1.0, 1.0], 1),
        (1100, [1.0, 1.0, 1.0, 1.0], 1),
        *[(2001 + i, [1.0, 1.0, 1.0, 1.0], 1) for i in range(12)],
        *[(3001 + i, [0.5, 0.5, 0.5, 0.5], 2) for i in range(30)],
    ]
    rows += rows[:5]
    assert check(spark, rows)


@pytest.mark.parametrize("scale", [1e4, 1e9, 1e300])
def test_large_components_go_by_wide_integers(spark, scale):
    check(spark, vectors(80, 3, 3, scale), every=20)


def test_empty_tables(spark):
    assert negatives.hard_negatives(table(spark, [])).count() == 0
    assert negatives.hard_negatives(table(spark, [(1, [1.0], 1)])).count() == 0
    assert negatives.hard_negatives(table(spark, [(0, [], 1), (1, [], 1)]), anchor_every=1).collect() == []


@settings(max_examples=200, deadline=None)
@given_rows(
    st.integers(0, 60).flatmap(
        lambda bits: st.lists(
            st.lists(st.floats(-(2.0**bits), 2.0**bits, width=64), min_size=3, max_size=3), min_size=1, max_size=9
        )
    )
)
def test_unpacked_scores_are_exact(rows):
    rows = [np.array(r) for r in rows]
    ints = [[negatives.whole(x) for x in r] for r in rows]
    low, high = min(0, *(min(r) for r in ints)), max(0, *(max(r) for r in ints))
    fields = negatives.Fields(rows, low, high, 3)
    got = fields.scores(np.arange(len(rows)), fields.pack(rows))
    for i, a in enumerate(ints):
        for j, b in enumerate(ints):
            exact = sum(x * y for x, y in zip(a, b, strict=True))
            assert got[i, j] == max(-MOST, min(MOST, exact))
    assert fields.slots or fields.width > negatives.EXACT_BITS


def test_several_candidates_share_a_number():
    fields = negatives.Fields([np.ones(64)], -150, 150, 64)
    assert fields.slots == 2
    assert len(fields.pack([np.ones(64)] * 9)[0][0]) == 5
