"""The Jaccard join and order fingerprints against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from marquee.llm import components, jaccard, ordermh
from marquee.llm.hashing import shingle_sets

from . import cases


def sets_of(text: str) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(docs) -> list[tuple]:
    """(doc_id, class_id, copy_id, n_links) of rows that have distinct ids."""
    rows = [(d, sets_of(t)) for d, t in cases.texts(docs)]
    root = {d: d for d, _ in rows}
    links, copy = Counter(), {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(rows):
        for b, y in rows[:i]:
            if x and y and 5 * len(x & y) >= 4 * len(x | y):
                links[a] += 1
                links[b] += 1
                low, high = sorted((find(a), find(b)))
                root[high] = low
                if x == y:
                    copy[a], copy[b] = min(a, copy[b], copy[a]), min(b, copy[a], copy[b])
    return [(d, find(d), copy[d], links[d]) for d, _ in rows]


def test_given_documents(spark):
    docs = cases.given(spark)
    assert cases.same(jaccard.near_duplicates(docs).collect(), brute(docs))


def chain(spark):
    words = [f"w{i}" for i in range(220)]
    rows = []
    for i in range(160):  # near copies of one text, each with its own changes, and copies of some
        some = list(words)
        some[(7 * i) % 220] = f"x{i}"
        if i % 3 == 0:
            some[(11 * i + 5) % 220] = f"y{i}"
        rows.append((1000 + i, " ".join(some)))
    rows += [(3000 + i, rows[i % 4][1]) for i in range(60)]
    shared = " ".join(words[:12])
    rows += [(5000 + i, shared + " " + " ".join(f"z{i}_{j}" for j in range(80))) for i in range(150)]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_large_buckets_are_split_and_blocked(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LEAF", 8)
    monkeypatch.setattr(jaccard, "BLOCK", 32)
    docs = chain(spark)
    assert cases.same(jaccard.near_duplicates(docs).collect(), brute(docs))


def test_edge_cases(spark):
    rows = jaccard.near_duplicates(cases.edge(spark)).collect()
    assert len(rows) == len(cases.rows())
    of = defaultdict(list)
    for r in rows:
        of[r.doc_id].append(r)
    assert {(r.class_id, r.n_links) for r in of[7]} == {(6, 4)}  # 6, 7 twice, 8 and one without an id
    assert {(r.class_id, r.n_links) for r in of[1] + of[2] + of[3]} == {(1, 0), (2, 0), (3, 0)}
    assert {r.class_id for r in of[None]} == {6, None}
    assert jaccard.near_duplicates(cases.empty(spark)).count() == 0


def test_one_document_of_each_class_stays(spark):
    docs = cases.edge(spark)
    kept = [(r.doc_id, r.text) for r in jaccard.one_of_each(docs).collect()]
    assert len([1 for _, t in kept if t in (cases.TEXTS[5], cases.TEXTS[7])]) == 1
    assert (6, cases.TEXTS[5]) in kept and len(kept) == len(set(kept))
    given = cases.given(spark)
    stay = {d for d, c, _, _ in brute(given) if d == c}
    assert {r.doc_id for r in jaccard.one_of_each(given).collect()} == stay


def test_rows_are_told_apart_by_id_and_text(spark):
    def words(name: str, changed: int = -1) -> str:
        return " ".join(f"{name}{k}" if k != changed else "other" for k in range(120))

    rows = [
        (1, words("a")), (None, words("a", 60)),  # a near copy without an id
        (None, words("b")), (None, None),  # unique, without an id
        (2, words("a")), (2, words("c")),  # one id: a copy and a unique text
        (None, words("d")), (None, words("d", 60)), (None, words("d") + " "),  # a class with only null ids
        (3, words("e")), (3, words("e")),  # a repeated row
    ]
    docs = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = [(r.doc_id, r.text) for r in jaccard.one_of_each(docs).collect()]
    of_d = [k for k in kept if k[1] and k[1].startswith("d0 ")]
    assert len(of_d) == 1 and of_d[0][0] is None
    assert cases.same([k for k in kept if k not in of_d], [(1, words("a")), (None, words("b")), (None, None), (2, words("c")), (3, words("e"))])


def test_recall_follows_the_target():
    assert jaccard.runs_for(0.999) > jaccard.runs_for(0.9)
    for level in range(1, jaccard.LEVELS + 1):
        assert 1 - (1 - jaccard.survival(level)) ** jaccard.runs_for() >= jaccard.RECALL


def test_components(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, 100), (200, 201), (201, 205), (205, 200)] + [(300, 300 + i) for i in range(1, 30)]
    edges = spark.createDataFrame(pairs, "a long, b long")
    roots = {r.node: r.root for r in components.components(edges).collect()}
    assert {roots[i] for i in range(1, 41)} == {1}
    assert {roots[i] for i in (200, 201, 205)} == {200}
    assert {roots[i] for i in range(300, 330)} == {300}


def test_sets_do_not_reach_over_texts():
    texts = ["a b c d e f", "", "f g", "a  b\tc\nd e f "]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    sets = shingle_sets(data, np.cumsum([0, *map(len, texts)]))
    assert [len(s) for s in sets] == [2, 0, 1, 2]
    assert sets[0].tolist() == sets[3].tolist()


def plain_fingerprint(text: str) -> list[tuple]:
    """The picked elements of each part, with no shortcut."""
    element, place = ordermh.numbered_kmers(np.frombuffer(text.encode("utf-32-le"), np.uint32))
    out = []
    for factor in ordermh.multipliers():
        values = element.astype(np.uint32) * factor
        least = np.argsort(values, kind="stable")[: ordermh.PICKED]
        out.append(tuple(element[sorted(least, key=lambda i: place[i])].tolist()))
    return out


def test_fingerprint_parts_are_the_picked_elements_in_text_order():
    factors = ordermh.multipliers()
    texts = [cases.prose(80), cases.prose(80, 3), cases.prose(79), "abcabcabc" * 30, "short", "x"]
    for a in texts:
        for b in texts:
            plain = np.mean([x == y for x, y in zip(plain_fingerprint(a), plain_fingerprint(b), strict=True)])
            assert ordermh.likeness(ordermh.fingerprint(a, factors), ordermh.fingerprint(b, factors)) == plain
    moved = " ".join(cases.prose(200).split(" ")[100:] + cases.prose(200).split(" ")[:100])
    assert ordermh.likeness(*(ordermh.fingerprint(t, factors) for t in (cases.prose(200), moved))) < 0.9


def test_elements_are_numbered():
    text = "abcabcabcabcabcabc" * 4
    element, _ = ordermh.numbered_kmers(np.frombuffer(text.encode("utf-32-le"), np.uint32))
    assert len(set(element.tolist())) == len(text) - ordermh.KMER + 1


@pytest.mark.parametrize("make", [cases.edge, cases.given])
def test_edited_fingerprints(spark, make, monkeypatch):
    from marquee.llm import common

    monkeypatch.setattr(common, "RANGE_ROWS", 5)
    docs = make(spark)
    rows = sorted(cases.texts(docs), key=lambda r: (-r[0] if r[0] is not None else 1 << 62, r[1]))
    factors = ordermh.multipliers()
    expected = []
    for (doc, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        a, b, c = (ordermh.fingerprint(t, factors) for t in (text, edited, after))
        expected.append(
            (doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), ordermh.written(a), ordermh.written(b),
             ordermh.likeness(a, b), ordermh.likeness(a, c))
        )
    assert cases.same(ordermh.digest(docs).collect(), expected)
    assert ordermh.digest(cases.empty(spark)).count() == 0
