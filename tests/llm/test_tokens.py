"""Byte pairs, packing and shards against the tokenizers library and direct counting."""

from __future__ import annotations

import bisect
import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given as given_text
from hypothesis import settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marquee.llm import bpe, packing, sharding

from . import cases

BYTES, WORDS = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ALPHABET = st.text(
    st.one_of(
        st.sampled_from(list("aeinorst THE.,'!?0123\n\t\r ́　<|>\x1c\x85ΣσİéЖ東\U0001f600")), st.characters(codec="utf-8")
    ),
    max_size=60,
)


def library(path: str) -> Tokenizer:
    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


@pytest.fixture(scope="module")
def pairs():
    return bpe.BytePairs(bpe.read_vocabulary(BYTES))


@pytest.fixture(scope="module")
def byte_library():
    return library(BYTES)


@pytest.fixture(scope="module")
def word_library():
    return library(WORDS)


@pytest.fixture(scope="module")
def words():
    return packing.WordIds(bpe.read_vocabulary(WORDS))


@settings(max_examples=400, deadline=None)
@given_text(text=ALPHABET)
def test_backtracking_gives_the_librarys_ids(pairs, byte_library, text):
    ids = np.frombuffer(pairs.encode(text), "<u4")
    assert ids.tolist() == byte_library.encode(text, add_special_tokens=False).ids
    assert pairs.decode(ids).decode() == text


@settings(max_examples=300, deadline=None)
@given_text(word=st.text("abcdeinorst", min_size=1, max_size=40))
def test_long_words(pairs, byte_library, word):
    assert np.frombuffer(pairs.encode(word), "<u4").tolist() == byte_library.encode(word, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given_text(text=ALPHABET)
def test_word_ids_are_the_librarys(words, word_library, text):
    assert np.frombuffer(words.ids([text])[0], "<u4").tolist() == word_library.encode(text, add_special_tokens=False).ids


def test_simple_letters_and_marks_are_the_librarys(word_library):
    """Every letter that skips the library's rules, every mark, and both after words are forgotten."""
    few = packing.WordIds(bpe.read_vocabulary(WORDS), remembered=60)
    letters = [chr(c) for c in range(32, 0x250) if chr(c).isalpha()]
    assert sum(bool(packing.SIMPLE.fullmatch(c)) for c in letters) > 200
    rows = [f"{c} a{c} {c}b {c}{c}. Ab{c}cd" for c in letters]
    rows += [f"end{a}{b} {a}{b} A{a}{b}{a} it's{a} x{a}y 'T{b}" for a in packing.MARKS for b in packing.MARKS[::7] + "'"]
    for at in range(0, len(rows), 50):
        some = rows[at : at + 50]
        expected = [c.ids for c in word_library.encode_batch(some, add_special_tokens=False)]
        assert [np.frombuffer(c, "<u4").tolist() for c in few.ids(some)] == expected


def test_simple_words_do_not_go_by_the_rules(monkeypatch):
    few = packing.WordIds(bpe.read_vocabulary(WORDS))
    asked = []
    monkeypatch.setattr(few, "_ask", lambda words: asked.extend(words) or [b"" for _ in words])
    monkeypatch.setattr(few, "tokenizer", None)
    assert few.ids(["some words, Other w\u00f6rds... plus%%"])[0]
    assert set(asked) <= {"", ",", "...", "%%"}


def test_remembered_words_have_a_bound(word_library):
    """The bound is a worker's own; ids do not depend on it."""
    few = packing.WordIds(bpe.read_vocabulary(WORDS), remembered=40)
    for first in range(0, 2000, 20):
        text = " ".join(f"{'abcdefghij'[n % 10] * 3}{n}, the{n % 7}." for n in range(first, first + 20))
        coded = few.ids([text])[0]
        assert np.frombuffer(coded, "<u4").tolist() == word_library.encode(text, add_special_tokens=False).ids
        assert len(few.known) <= 40 and len(few.older) <= 40 + 3 * 40


def test_texts_are_taken_apart_in_small_slices(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "some words " * 20_000) for i in range(8)], "doc_id long, text string")
    given = []
    monkeypatch.setattr(packing, "slices", lambda batches, limit=4 << 20: given.append(limit) or iter(()))
    monkeypatch.setattr(packing, "texts_of", lambda docs: type("Rows", (), {"mapInArrow": lambda self, run, schema: list(run([]))})())
    packing.token_pieces(docs, WORDS, at_once=1 << 19)
    assert given == [1 << 19]


@pytest.mark.parametrize("make", [cases.edge, cases.given])
def test_round_trip(spark, byte_library, make):
    docs = make(spark)
    expected = []
    for doc, text in cases.texts(docs):
        ids = byte_library.encode(text, add_special_tokens=False).ids
        coded = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        back = byte_library.decode(ids, skip_special_tokens=False)
        expected.append((doc, len(ids), coded, hashlib.sha256(back.encode()).hexdigest()))
    assert cases.same(bpe.round_trip(docs, BYTES).collect(), expected)


def test_empty_tables(spark):
    docs = cases.empty(spark)
    assert bpe.round_trip(docs, BYTES).count() == 0
    assert packing.best_fit(packing.token_pieces(docs, WORDS)).count() == 0
    assert sharding.shard_digest(docs).count() == 0


@pytest.mark.parametrize("make", [cases.edge, cases.given])
def test_packing(spark, word_library, make):
    docs = make(spark)
    expected = []
    for doc, text in cases.texts(docs):
        ids = [*word_library.encode(text, add_special_tokens=False).ids, 1]
        for n, at in enumerate(range(0, len(ids), 4096)):
            some = ids[at : at + 4096]
            expected.append((doc, n, at, len(some), zlib.crc32(np.array(some, "<u4").tobytes())))
    rows = packing.best_fit(packing.token_pieces(docs, WORDS)).collect()
    assert cases.same([r[:5] for r in rows], expected)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        ends = 0
        for offset, length in sorted(places):
            assert offset == ends
            ends += length
        assert ends <= 4096


@settings(max_examples=60, deadline=None)
@given_text(lengths=st.lists(st.integers(1, 100), max_size=300))
def test_rounds_place_every_rank_once_and_pack_as_tight_as_one_by_one(lengths):
    rounds = packing.Rounds(dict(Counter(lengths)), 100)
    placed = rounds.run()
    seen = Counter()
    fill = defaultdict(list)
    for p in placed:
        for i in range(p.count):
            seen[p.length, p.rank + i] += 1
            fill[p.first + i].append((p.offset, p.length))
    assert seen == Counter({(n, r): 1 for n, c in Counter(lengths).items() for r in range(c)})
    for places in fill.values():
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(places), sorted(places)[1:], strict=False))
        assert sum(n for _, n in places) <= 100
    gaps, count = [], 0
    for n in sorted(lengths, reverse=True):
        at = bisect.bisect_left(gaps, n)
        room = gaps.pop(at) if at < len(gaps) else 100
        count += room == 100
        if room > n:
            bisect.insort(gaps, room - n)  # never 100, so a room of 100 is a new sequence
    assert rounds.sequences <= count * 1.1 + 1


@pytest.mark.parametrize("make", [cases.edge, cases.given])
def test_shards(spark, make):
    docs = make(spark)
    rows = sharding.shard_digest(docs).collect()
    expected = [(d, len(t.encode()) + 1, zlib.crc32(t.encode())) for d, t in cases.texts(docs)]
    assert cases.same([(r.doc_id, r.size, r.text_crc32) for r in rows], expected)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}


def test_buckets_are_shuffled_and_runs_agree(spark, tmp_path):
    docs = cases.given(spark)
    first, again = (
        sharding.shuffle_to_shards(docs, str(tmp_path / n), bucket_bytes=20000).select("doc_id", "shard", "slot").collect()
        for n in "ab"
    )
    assert cases.same(first, again)
    order = [r.doc_id for r in sorted(first, key=lambda r: (r.shard, r.slot))]
    assert sorted(order) != order
    assert sorted(sharding.fisher_yates(50, 1, 2).tolist()) == list(range(50))
