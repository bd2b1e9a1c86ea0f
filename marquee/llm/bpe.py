"""Byte-pair encoding by backtracking over longest matches, and decoding by an offset table.

A segmentation into tokens is the one that the merge rules give exactly when every two
neighbours are compatible: merging their bytes alone would keep them apart. The encoder
takes the longest token at each place (found for all places by one Aho-Corasick pass),
keeps it if it is compatible with its predecessor, else tries its next shorter prefix, and
steps back when no prefix fits. Places found to be dead ends are marked, so no place is
tried twice and the time stays linear. Word results are remembered in a bounded table.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache
from struct import pack

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import slices, texts_of

# Fixed value: how the byte-level vocabulary cuts a text into words before merging.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
REMEMBERED_WORDS = 200_000
REMEMBERED_LENGTH = 64


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1
    bytes stand for themselves, the others follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class BytePairs:
    """Tables of one vocabulary. Token ids must follow the merge order after the 256 bytes."""

    def __init__(self, source: str):
        spec = json.loads(source)
        letters = byte_letters()
        vocabulary = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces = {i: bytes(letters[c] for c in t) for t, i in vocabulary.items() if t not in self.special}
        self.base = 256
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.merged: dict[tuple[int, int], int] = {}
        last = self.base - 1
        for merge in spec["model"]["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            made = vocabulary[a + b]
            if made <= last:
                raise ValueError("token ids must follow the order of the merges")
            last = made
            self.left[made], self.right[made] = vocabulary[a], vocabulary[b]
            self.merged[vocabulary[a], vocabulary[b]] = made
        by_piece = {p: i for i, p in self.pieces.items()}
        self.shorter = {
            i: next((by_piece[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in by_piece), -1)
            for i, p in self.pieces.items()
        }
        self.size = {i: len(p) for i, p in self.pieces.items()}
        self.automaton = ahocorasick.Automaton()
        for i, p in self.pieces.items():
            self.automaton.add_word(p.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.words = regex.compile(WORDS)
        self.splitter = regex.compile("|".join(regex.escape(s) for s in self.special)) if self.special else None
        self.pair_table: dict[tuple[int, int], bool] = {}
        self.remembered: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # Offset table: token i is blob[starts[i] : starts[i] + sizes[i]].
        count = max([*self.pieces, *self.special.values()]) + 1
        every = {**self.pieces, **{i: s.encode() for s, i in self.special.items()}}
        self.sizes = np.array([len(every.get(i, b"")) for i in range(count)], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.blob = np.frombuffer(b"".join(every.get(i, b"") for i in range(count)), np.uint8)

    def compatible(self, a: int, b: int) -> bool:
        """Whether a and b stay apart when their joined bytes are merged: going back in time,
        no right end of a and left end of b that touch may have a merge due before the one
        that absorbs either of them."""
        known = self.pair_table.get((a, b))
        if known is None:
            known = self._stay_apart(a, b)
            if len(self.pair_table) > 4 * REMEMBERED_WORDS:
                self.pair_table.clear()
            self.pair_table[a, b] = known
        return known

    def _stay_apart(self, a: int, b: int) -> bool:
        before = len(self.sizes)
        while True:
            if self.merged.get((a, b), before) < before:
                return False
            if a > b:  # a was made later: undo it
                if a < self.base:
                    return True
                before, a = a, self.right[a]
            else:  # equal merges run from the left, so b is the later one
                if b < self.base:
                    return True
                before, b = b + 1, self.left[b]

    def encode_word(self, word: bytes) -> list[int]:
        letters = word.decode("latin-1")
        find, size, shorter, compatible = self.automaton.iter_long, self.size, self.shorter, self.compatible
        # Longest matches in a row, as the search below would take them while all are compatible.
        row = [token for _, token in find(letters)]
        good = 1
        known = self.pair_table
        for pair in zip(row, row[1:]):
            fits = known.get(pair)
            if not (compatible(*pair) if fits is None else fits):
                break
            good += 1
        if good >= len(row):
            return row
        out, token = row[:good], row[good]
        at = sum(size[t] for t in out)
        dead = bytearray(len(word) + 1)
        while at < len(word):
            end = at + size[token]
            if not dead[end] and (not out or compatible(out[-1], token)):
                out.append(token)
                at = end
                if at < len(word):
                    token = next(find(letters, at))[1]
            elif shorter[token] >= 0:
                token = shorter[token]
            else:
                dead[at] = 1
                token = out.pop()
                at -= size[token]
        return out

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.splitter is None or not (marks := self.splitter.findall(text)):
            return self._encode_plain(text)
        parts = [self._encode_plain(p) for p in self.splitter.split(text)]
        out = [parts[0]]
        for mark, part in zip(marks, parts[1:], strict=True):
            out += [np.array([self.special[mark]], "<u4").tobytes(), part]
        return b"".join(out)

    def _encode_plain(self, text: str) -> bytes:
        known, older = self.remembered, self.older
        words = self.words.findall(text)
        for word in set(words).difference(known):
            coded = older.get(word)
            if coded is None:
                ids = self.encode_word(word.encode())
                coded = pack(f"<{len(ids)}I", *ids)
            known[word] = coded
        out = b"".join(map(known.__getitem__, words))
        if len(known) > REMEMBERED_WORDS:  # words not met since the last time are forgotten
            self.older = {w: c for w, c in known.items() if len(w) <= REMEMBERED_LENGTH}
            self.remembered = {}
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        out = []
        for first in range(0, len(ids), 1 << 20):
            part = ids[first : first + (1 << 20)]
            sizes = self.sizes[part]
            shift = self.starts[part] - np.concatenate([[0], np.cumsum(sizes)[:-1]])
            out.append(self.blob[np.repeat(shift, sizes) + np.arange(sizes.sum())].tobytes())
        return b"".join(out)


@lru_cache(maxsize=2)
def tables(source: str) -> BytePairs:
    """Built once in each Python worker."""
    return BytePairs(source)


def read_vocabulary(path: str) -> str:
    """Read on the driver and sent with the tasks: executors need no copy of the file."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit) of every whole text.

    Null and empty texts give no ids; the strings of special tokens in a text become those
    tokens. Rows are independent: repeated rows and ids stay, an empty table gives no rows.
    """
    source = read_vocabulary(vocabulary_path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = tables(source)
        for part in slices(batches):
            ids = [pairs.encode(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return texts_of(docs).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, ids and the decoded text (invalid UTF-8 becomes the replacement character)."""
    source = read_vocabulary(vocabulary_path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = tables(source)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                rows = (np.frombuffer(b or b"", "<u4") for b in part.column("ids").to_pylist())
                out = [pairs.decode(r).decode("utf-8", "replace") for r in rows]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def round_trip(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Digest of ids and of the decoded text for every document."""
    decoded = decode(encode(docs, vocabulary_path), vocabulary_path)
    return decoded.select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
