"""Packing of token pieces into sequences by bulk-synchronous best fit.

Pieces are range-sorted by length and ranked within their length; sequences with room are
gaps. In a round every waiting piece looks for its successor, the smallest gap that holds
it; pieces that want the same gap are resolved by rank, each gap takes at most one, all
gaps are updated and the next round follows. Pieces of equal length are interchangeable,
and so are gaps of equal size, so a round works on runs (length, count) instead of rows:
never more than ``capacity`` runs of pieces, whatever the corpus. The rounds decide which
ranks of a length go to which run of sequences; every row then finds its own place from
its rank, in parallel.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.bpe import read_vocabulary
from marquee.llm.common import SLICE_BYTES, slices, stored, texts_of

if TYPE_CHECKING:
    from tokenizers import Tokenizer

CAPACITY = 4096
END_OF_DOCUMENT = 1
BAND = 0.85
REMEMBERED_WORDS = 500_000
REMEMBERED_CHARS = 20_000_000
#: Small words of these letters are one word each by the vocabulary's rules, which change none of their letters.
SIMPLE = re.compile("[a-z\u00df-\u00f6\u00f8-\u024f]+")
#: Marks of which any run behind letters is a word of its own by the vocabulary's rules; an apostrophe is none.
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
#: Simple words that make one text for the library.
TOGETHER = 100


class WordIds:
    """Ids by the tokenizers library, asked once for each distinct word. A space or a line
    break ends a word in this vocabulary's rules, so ids of words join to ids of the text.
    Plain words are letters, perhaps with marks behind. Their letters are asked for together:
    in the answer each ends with a token that ends a word. Simple ones skip the rules for
    normal forms and word ends, which would find the same."""

    def __init__(self, source: str, remembered: int = REMEMBERED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.by_space = Tokenizer(self.tokenizer.model)
        self.by_space.pre_tokenizer = Sequence([Split(" ", "removed"), ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.remembered = remembered
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.chars = 0

    def _ask(self, words: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(c.ids, "<u4").tobytes() for c in coded]

    def _ask_plain(self, words: list[str], tokenizer: Tokenizer) -> list[bytes]:
        texts = [" ".join(words[at : at + TOGETHER]) for at in range(0, len(words), TOGETHER)]
        coded = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = b"".join(np.array(c.ids, "<u4").tobytes() for c in coded)
        last = np.flatnonzero(self.ends[np.frombuffer(ids, "<u4")]) + 1
        if len(last) != len(words):  # a letter that the library takes for something else
            return self._ask(words)
        cuts = [0, *(4 * last).tolist()]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def _learn(self, words: set[str]) -> None:
        known, older = self.known, self.older
        again = older.keys() & words
        known.update({w: older[w] for w in again})
        new = words - again if again else words
        self.chars += sum(map(len, words))
        # Most new words are letters without a capital or a mark: they are stems themselves.
        stems = {w for w in new if w.isalpha() and w.islower()}
        plain: list[str] = []
        stem_of: list[str] = []
        mark_of: list[str] = []
        other = []
        for word in new - stems:
            letters = word.rstrip(MARKS)
            stem = letters.lower()
            if stem.isalpha() and "\u03a3" not in word:  # the library lowers a sigma by another rule
                plain.append(word)
                stem_of.append(stem)
                mark_of.append(word[len(letters) :])
            else:
                other.append(word)
        stems.update(set(stem_of).difference(known).difference(older))
        other = list(set(other).union(set(mark_of).difference(known).difference(older)))
        simple = set(filter(SIMPLE.fullmatch, stems))
        for some, tokenizer in ((list(simple), self.by_space), (list(stems - simple), self.tokenizer)):
            if some:
                known.update(zip(some, self._ask_plain(some, tokenizer), strict=True))
        if other:
            known.update(zip(other, self._ask(other), strict=True))
        parts = [(known.get(s) or older[s]) + (known[m] if m in known else older[m]) for s, m in zip(stem_of, mark_of, strict=True)]
        known.update(zip(plain, parts, strict=True))

    def ids(self, texts: list[str]) -> list[bytes]:
        words = [text.replace("\n", " ").split(" ") for text in texts]
        # difference, not minus: it looks up the new words instead of walking over all known ones
        if new := set().union(*words).difference(self.known):
            self._learn(new)
        out = [b"".join(map(self.known.__getitem__, some)) for some in words]
        if len(self.known) > self.remembered or self.chars > REMEMBERED_CHARS:
            # What is not met again is forgotten, and so are words without end.
            keep = self.chars <= 2 * REMEMBERED_CHARS
            self.older, self.known, self.chars = (self.known if keep else {}), {}, 0
        return out


@lru_cache(maxsize=2)
def word_ids(source: str, remembered: int = REMEMBERED_WORDS) -> WordIds:
    return WordIds(source, remembered)


def token_pieces(
    docs: DataFrame,
    vocabulary_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_OF_DOCUMENT,
    with_ids: bool = False,
    remembered: int = REMEMBERED_WORDS,
    at_once: int = SLICE_BYTES,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every whole text and its end id.

    Only documents over the capacity are cut; null and empty texts give the end id alone. A worker
    holds the ids of at most about twice ``remembered`` words; with fewer it asks more often.
    ``at_once``: bytes of text that it takes apart at a time, each word being an object for a while.
    """
    source = read_vocabulary(vocabulary_path)
    end = np.array([end_id], "<u4").tobytes()
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(source, remembered)
        step = 4 * capacity
        for part in slices(batches, at_once):
            rows: list[tuple] = []
            coded_texts = words.ids(part.column("text").to_pylist())
            for doc, coded in zip(part.column("doc_id").to_pylist(), coded_texts, strict=True):
                coded += end
                for n, at in enumerate(range(0, len(coded), step)):
                    ids = coded[at : at + step]
                    rows.append((doc, n, at // 4, len(ids) // 4, zlib.crc32(ids), *[ids] * with_ids))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), *[pa.binary()] * with_ids]
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return texts_of(docs).mapInArrow(run, schema)


@dataclass(frozen=True)
class Run:
    """Sequences ``first`` to ``first + count - 1``, all with the same room."""

    first: int
    count: int


@dataclass(frozen=True)
class Placement:
    """Ranks from ``rank`` on of one length, one in each sequence from ``first`` on, at ``offset``."""

    length: int
    rank: int
    count: int
    first: int
    offset: int


class Rounds:
    def __init__(self, runs: dict[int, int], capacity: int):
        if any(not 0 < n <= capacity for n in runs):
            raise ValueError("lengths must lie between 1 and the capacity")
        self.capacity = capacity
        self.waiting = dict(runs)
        self.next_rank: dict[int, int] = dict.fromkeys(runs, 0)
        self.gaps: dict[int, list[Run]] = defaultdict(list)
        self.sequences = 0
        self.placed: list[Placement] = []

    def sweep(self, lengths: list[int]) -> bool:
        """One round over the waiting pieces of these lengths, longest first. Going down, gaps
        are stacked as they come in reach, so the top is always the smallest that still fits."""
        sizes = sorted((s for s, runs in self.gaps.items() if runs), reverse=True)
        stack: list[tuple[int, Run]] = []
        changed: dict[int, list[Run]] = defaultdict(list)
        after = 0
        moved = False
        for length in lengths:
            while after < len(sizes) and sizes[after] >= length:
                stack += [(sizes[after], r) for r in reversed(self.gaps.pop(sizes[after]))]
                after += 1
            while self.waiting[length] and stack:
                room, run = stack.pop()
                n = min(self.waiting[length], run.count)
                if n < run.count:
                    stack.append((room, Run(run.first + n, run.count - n)))
                rank = self.next_rank[length]
                self.placed.append(Placement(length, rank, n, run.first, self.capacity - room))
                self.next_rank[length] += n
                self.waiting[length] -= n
                if room > length:
                    changed[room - length].append(Run(run.first, n))
                moved = True
        for room, run in stack:
            changed[room].append(run)
        for room, runs in changed.items():
            self.gaps[room] = self._joined(self.gaps[room] + runs)
        return moved

    @staticmethod
    def _joined(runs: list[Run]) -> list[Run]:
        out: list[Run] = []
        for run in sorted(runs, key=lambda r: r.first):
            if out and out[-1].first + out[-1].count == run.first:
                out[-1] = Run(out[-1].first, out[-1].count + run.count)
            else:
                out.append(run)
        return out

    def open(self, lengths: list[int]) -> None:
        """Sequences for what no gap holds: as many as the waiting tokens need at least, and
        one for each piece over half the capacity."""
        tokens = sum(n * self.waiting[n] for n in lengths)
        large = sum(self.waiting[n] for n in lengths if 2 * n > self.capacity)
        count = max(-(-tokens // self.capacity), large)
        self.gaps[self.capacity] = self._joined([*self.gaps[self.capacity], Run(self.sequences, count)])
        self.sequences += count

    def run(self) -> list[Placement]:
        """Bands of lengths from the longest down; in each, rounds until all are placed."""
        lengths = sorted(self.waiting, reverse=True)
        while lengths:
            least = lengths[0] * BAND
            band = [n for n in lengths if n >= least]
            lengths = lengths[len(band) :]
            while band:
                if not self.sweep(band):
                    self.open(band)
                band = [n for n in band if self.waiting[n]]
        return self.placed


def best_fit(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32).

    Every row is placed, repeated rows and null ids too; ties of length go by doc_id and
    piece. An empty table gives no rows. What passes through the driver has at most one row
    for each length and each task of the sorted table.
    """

    def ranked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, seen = -1, 0
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            if not len(lengths):
                continue
            starts = np.flatnonzero(np.concatenate([[True], lengths[1:] != lengths[:-1]]))
            rank = np.arange(len(lengths)) - np.repeat(starts, np.diff([*starts, len(lengths)]))
            if lengths[0] == last:
                rank[: starts[1] if len(starts) > 1 else len(rank)] += seen
            last, seen = lengths[-1], rank[-1] + 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(rank), part, np.int32)), pa.array(rank.astype(np.int64))],
                [*batch.schema.names, "sorted_part", "rank"],
            )

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    order = [F.col("length").desc(), F.col("doc_id"), F.col("piece")]
    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long, sorted_part int, rank long"
    pieces = stored(pieces.select(*columns))  # range sorting reads its input twice
    rows = stored(
        pieces.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(ranked, kinds)
    )
    shares = rows.groupBy("length", "sorted_part").count().collect()
    runs: dict[int, int] = defaultdict(int)
    base: dict[tuple[int, int], int] = {}
    for r in sorted(shares, key=lambda r: (r["length"], r["sorted_part"])):
        base[r["length"], r["sorted_part"]] = runs[r["length"]]
        runs[r["length"]] += r["count"]
    placed = sorted(Rounds(runs, capacity).run(), key=lambda p: (p.length, p.rank))
    wide = 1 << 40  # ranks lie below, so (length, rank) is one sortable number
    starts = np.array([p.length * wide + p.rank for p in placed], np.int64)
    table = np.array([(p.rank, p.first, p.offset) for p in placed], np.int64).reshape(-1, 3)
    of_part = {k: np.int64(v) for k, v in base.items() if v}

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            parts = batch.column("sorted_part").to_numpy()
            pairs, back = np.unique(np.stack([lengths, parts.astype(np.int64)]), axis=1, return_inverse=True)
            before = np.array([of_part.get((a, b), 0) for a, b in pairs.T.tolist()], np.int64)
            rank = batch.column("rank").to_numpy() + (before[back.reshape(-1)] if len(before) else 0)
            at = table[np.searchsorted(starts, lengths * wide + rank, side="right") - 1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(at[:, 1] + rank - at[:, 0]), pa.array(at[:, 2])],
                [*columns, "sequence_id", "offset"],
            )

    return rows.mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
