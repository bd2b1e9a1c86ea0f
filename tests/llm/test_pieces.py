"""SentencePiece ids and texts against the library."""

from __future__ import annotations

import hashlib
import time

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given as given_text
from hypothesis import settings
from hypothesis import strategies as st

from marquee.llm import sentencepieces

from . import cases

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = list("aeinorst THE.,'!?0123\n\t\r\0 ́　<|>\x1c\x85ΣσİéЖ東ゼ²\U0001f600▁") + ["  ", "    ", "<s>", "</s>", "<0x41>", "ing"]
TEXT = st.lists(st.one_of(st.sampled_from(LETTERS), st.characters(codec="utf-8")), max_size=50).map("".join)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def pieces():
    return sentencepieces.MergePieces(sentencepieces.read_model(MODEL))


@settings(max_examples=1500, deadline=None)
@given_text(text=TEXT)
def test_ids_and_text(pieces, library, text):
    ids = library.encode(text, add_bos=True, add_eos=True)
    assert np.frombuffer(pieces.encode(text), "<u4").tolist() == ids
    assert pieces.decode(np.array(ids)) == library.decode(ids)


@settings(max_examples=600, deadline=None)
@given_text(word=st.text("abcdeinorst▁", min_size=1, max_size=60))
def test_long_words(pieces, library, word):
    assert np.frombuffer(pieces.encode(word), "<u4").tolist() == library.encode(word, add_bos=True, add_eos=True)


@settings(max_examples=600, deadline=None)
@given_text(ids=st.lists(st.one_of(st.integers(0, 258), st.integers(0, 31999)), max_size=14))
def test_any_ids_decode_as_the_library_does(pieces, library, ids):
    assert pieces.decode(np.array(ids, np.int64)) == library.decode(ids)


@settings(max_examples=300, deadline=None)
@given_text(word=st.text("abeinort", min_size=1, max_size=24))
def test_rows_of_compatible_tokens_are_the_merges(pieces, word):
    """Merging the whole text step by step, with no row of longest matches and no backtracking."""
    parts = list(word)
    while True:
        found = [(pieces.cost[a + b][0], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in pieces.cost]
        if not found:
            break
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    assert pieces.merged(word) == parts
    assert all(pieces.compatible(a, b) for a, b in zip(parts, parts[1:]))


@pytest.mark.parametrize("unit", ["a", "ab", " ", "the", "\n", "\0x", "東", "Zq7."])
def test_long_texts_take_linear_time(pieces, library, unit):
    text = unit * 100000
    began = time.perf_counter()
    ids = np.frombuffer(pieces.encode(text), "<u4")
    assert time.perf_counter() - began < 10
    assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True)
    assert pieces.decode(ids) == text


def test_forgotten_units_come_out_the_same(library, monkeypatch):
    monkeypatch.setattr(sentencepieces, "REMEMBERED_WORDS", 5)
    monkeypatch.setattr(sentencepieces, "REMEMBERED_PAIRS", 5)
    pieces = sentencepieces.MergePieces(sentencepieces.read_model(MODEL))
    for n in range(40):
        text = cases.prose(20, n + 1)
        assert np.frombuffer(pieces.encode(text), "<u4").tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_other_kinds_of_models_are_refused():
    trainer = b"\x12\x02\x18\x01"  # a later trainer message that names another kind
    with pytest.raises(ValueError, match="merge-type"):
        sentencepieces.MergePieces(sentencepieces.read_model(MODEL) + trainer)


@pytest.mark.parametrize("make", [cases.edge, cases.given])
def test_round_trip(spark, library, make):
    docs = make(spark)
    expected = []
    for doc, text in cases.texts(docs):
        ids = library.encode(text, add_bos=True, add_eos=True)
        coded = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        expected.append((doc, len(ids), coded, hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert cases.same(sentencepieces.round_trip(docs, MODEL).collect(), expected)


def test_empty_table(spark):
    assert sentencepieces.round_trip(cases.empty(spark), MODEL).count() == 0
