"""The source audit against direct counting."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest

from marquee.llm import divergence

from . import cases

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def direct(docs, min_docs=3, top=200):
    rows = [(r.lang or "", r.source or "", r.text or "") for r in docs.select("lang", "source", "text").collect()]
    counts, held, every = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOWER))
        counts[lang, source].update(terms)
        held[lang].update(set(terms))
        every[lang].update(terms)
    kept = {lang: [t for t, n in c.items() if n >= min_docs] for lang, c in held.items()}
    share = lambda c, lang, n, v: 1 + 10**9 * (c + 1) // (n + v)
    p = {}
    for (lang, source), c in counts.items():
        n = sum(c[t] for t in kept[lang])
        p[lang, source] = {t: share(c[t], lang, n, len(kept[lang])) for t in kept[lang]}
    out = []
    gap = lambda a, b: (a - b) ** 2 // b
    for (lang, source), mine in p.items():
        pairs = [
            (other, sum(gap(mine[t], theirs[t]) for t in mine))
            for (same, other), theirs in p.items()
            if same == lang and other != source
        ]
        total = sum(every[lang][t] for t in kept[lang])
        q = {t: share(every[lang][t], lang, total, len(kept[lang])) for t in kept[lang]}
        terms = [(t, gap(mine[t], q[t])) for t in mine if counts[lang, source][t] and mine[t] > q[t]]
        for part, items in (("pair", pairs), ("term", terms)):
            items.sort(key=lambda x: (-x[1], x[0].encode()))
            items = items[:top] if part == "term" else items
            out += [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(items)]
    return out


@pytest.mark.parametrize("make", [cases.edge, cases.given])
def test_whole_result(spark, make):
    docs = make(spark)
    assert cases.same(divergence.source_divergence(docs).collect(), direct(docs))


def test_bounds_are_parameters(spark):
    docs = cases.edge(spark)
    got = divergence.source_divergence(docs, min_docs=1, top_terms=3)
    assert cases.same(got.collect(), direct(docs, 1, 3))


def test_vocabulary_in_many_fits(spark):
    docs = cases.given(spark)
    one, many = divergence.kept_counts(docs), divergence.kept_counts(docs, fit_terms=divergence.distinct_terms(docs) // 4)
    assert one[0].count() > 1000
    assert all(cases.same(a.collect(), b.collect()) for a, b in zip(one, many, strict=True))


@pytest.mark.parametrize("make", [cases.edge, cases.given])
def test_lists_of_bins(spark, make):
    docs = make(spark)
    dealt = divergence.term_lists(docs, 7).collect()
    expected = Counter()
    for r in docs.collect():
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r.text or "").translate(LOWER))
        expected.update((r.source or "", f"{t} {r.lang or ''}") for t in found)
    assert Counter((r.source, t) for r in dealt for t in r.terms) == expected
    of = defaultdict(set)
    for r in dealt:
        for t in r.terms:
            of[t].add(r.bin)
    assert all(len(b) == 1 for b in of.values())
    assert len({r.bin for r in dealt}) > 3
    assert abs(divergence.distinct_terms(docs) - len(of)) <= 0.2 * len(of)


def test_no_terms_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string"
    rows = [(1, None, "x", "a"), (2, "1 2 3", "x", "b"), (3, "word", "x", None), (4, "one", None, None)]
    got = divergence.source_divergence(spark.createDataFrame(rows, schema))
    assert cases.same(got.collect(), direct(spark.createDataFrame(rows, schema)))
    assert {r.value for r in got.collect()} == {0}
    assert divergence.source_divergence(cases.empty(spark)).count() == 0


def test_counts_beyond_a_product_of_64_bits(spark):
    from marquee.llm.divergence import _share

    row = spark.sql("select 20000000000L as n, 30000000000L as total").select(_share("n", "total").alias("p")).first()
    assert row.p == 1 + 10**9 * (20000000000 + 1) // 30000000000
