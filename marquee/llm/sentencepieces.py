"""Merge-type SentencePiece encoding by backtracking, and decoding by an offset table.

Pieces are merged by score, the leftmost of equal ones first. A row of pieces is the one that
the merges give exactly when each is what its own text merges to and no merge across two
neighbours would come before both are done; that is found by merging the two again. The
encoder takes the longest piece at each place (one Aho-Corasick pass), keeps it if it is
compatible with its predecessor, else tries the next shorter piece, and steps back when none
fits; a bitfield of failed positions keeps it from trying a place twice.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator
from functools import lru_cache
from struct import pack, unpack

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import slices, texts_of

# Fixed values of the model file's format: field numbers, kinds of pieces, the sign of a space.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
TEXT, SCORE, KIND = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
MODEL_TYPE, BPE, BEGIN_ID, END_ID, UNKNOWN_TEXT = 3, 2, 41, 42, 44
NORMALIZER_NAME, CHARSMAP, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES = 1, 2, 3, 4, 5
SPACE = "▁"

REMEMBERED_WORDS = 200_000
REMEMBERED_LENGTH = 64
REMEMBERED_PAIRS = 800_000


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a message in the protocol-buffer wire format."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}[key & 7] if key & 7 != 2 else number()
        yield key >> 3, data[at : at + size]
        at += size


class MergePieces:
    """Tables of one merge-type model with byte fallback."""

    def __init__(self, model: bytes):
        self.texts: list[str] = []
        kinds, scores = [], []
        trainer, normalizer = {}, {}
        for field, value in fields(model):
            if field == PIECES:
                part = dict(fields(value))
                self.texts.append(part[TEXT].decode())
                scores.append(unpack("<f", part[SCORE])[0] if SCORE in part else 0.0)
                kinds.append(part.get(KIND, NORMAL))
            elif field == TRAINER:
                trainer = dict(fields(value))
            elif field == NORMALIZER:
                normalizer = dict(fields(value))
        if trainer.get(MODEL_TYPE, 1) != BPE or not {*kinds} <= {NORMAL, UNKNOWN, CONTROL, BYTE} or BYTE not in kinds:
            raise ValueError("a merge-type model with byte fallback and no user-defined pieces is needed")
        if normalizer.get(CHARSMAP) or normalizer.get(REMOVE_SPACES, 1) or not normalizer.get(ESCAPE_SPACES, 1):
            raise ValueError("a model that leaves characters and spaces as they are is needed")
        self.dummy = SPACE if normalizer.get(DUMMY_PREFIX, 1) else ""
        self.begin = pack("<I", trainer.get(BEGIN_ID, 1))
        self.end = pack("<I", trainer.get(END_ID, 2))
        #: Cost and id of every piece that merges may form; the least cost merges first.
        self.cost = {t: (-s, i) for i, (t, s, k) in enumerate(zip(self.texts, scores, kinds, strict=True)) if k == NORMAL}
        byte_ids = {int(t[3:5], 16): i for i, (t, k) in enumerate(zip(self.texts, kinds, strict=True)) if k == BYTE}
        self.of_byte = [pack("<I", byte_ids[b]) for b in range(256)]
        #: Every character that some piece holds can take part in merges, alone it may be no piece.
        self.known = set("".join(self.cost))
        self.automaton = ahocorasick.Automaton()
        tokens = {**dict.fromkeys(self.known), **dict.fromkeys(self.cost)}
        for t in tokens:
            self.automaton.add_word(t, t)
        self.automaton.make_automaton()
        self.tokens = tokens
        self.longest = max(map(len, tokens))
        self.coded = {t: pack("<I", self.cost[t][1]) if t in self.cost else self._bytes(t) for t in tokens}
        self.prefixes: dict[str, str | None] = {}
        self.histories: dict[str, list | None] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.remembered: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.units = regex.compile(self._units())
        # Offset table: piece i is blob[starts[i] : starts[i] + sizes[i]].
        unknown = trainer.get(UNKNOWN_TEXT, " ⁇ ".encode())
        own = {NORMAL: lambda t: t.replace(SPACE, " ").encode(), UNKNOWN: lambda t: unknown, CONTROL: lambda t: b""}
        every = [bytes([int(t[3:5], 16)]) if k == BYTE else own[k](t) for t, k in zip(self.texts, kinds, strict=True)]
        self.sizes = np.array([len(x) for x in every], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.blob = np.frombuffer(b"".join(every), np.uint8)
        self.is_byte = np.array([k == BYTE for k in kinds])
        self.is_control = np.array([k == CONTROL for k in kinds])
        self.opens = np.array([k == NORMAL and t.startswith(SPACE) for t, k in zip(self.texts, kinds, strict=True)])

    def _units(self) -> str:
        """Where a text may be cut ahead of merging, as seen from the pieces: around characters
        that stand in no piece with others; before spaces, if no piece goes on with a space
        after another character; between ASCII letters and signs, if no piece joins them."""
        joined = {c for t in self.cost if len(t) > 1 for c in t}
        alone = "".join(regex.escape(chr(c)) for c in range(128) if chr(c) not in joined)
        if any(SPACE in t.lstrip(SPACE) for t in self.cost):
            return f"[{alone}]|[^{alone}]+"
        letters = string.ascii_letters
        signs = "".join(regex.escape(chr(c)) for c in range(128) if chr(c) in joined and chr(c) not in letters)
        pairs = {pair for t in self.cost for pair in zip(t, t[1:], strict=False)}
        apart = not any((a in letters and b in signs) or (a in signs and b in letters) for a, b in pairs)
        plain = rf"{SPACE}*(?:[a-zA-Z]++|[{signs}]++)(?![^\x00-\x7F])|" if apart else ""
        return f"[{alone}]|{plain}{SPACE}*[^{SPACE}{alone}]+|{SPACE}+"

    def history(self, token: str) -> list[tuple[float, int, str, str]] | None:
        """The merges that form a token, in their order: cost, place, and the first and last
        part of the token after each. None if its text merges to something else."""
        if token not in self.histories:
            parts, out = list(token), []
            while len(parts) > 1:
                costs = [self.cost.get(a + b, (None,))[0] for a, b in zip(parts, parts[1:], strict=False)]
                found = [(c, i) for i, c in enumerate(costs) if c is not None]
                if not found:
                    break
                cost, i = min(found)
                place = sum(map(len, parts[:i]))
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                out.append((cost, place, parts[0], parts[-1]))
            self.histories[token] = out if len(parts) == 1 else None
        return self.histories[token]

    def compatible(self, a: str, b: str) -> bool:
        """Whether a and b stay apart when their joined text is merged again."""
        known = self.pairs.get((a, b))
        if known is None:
            known = self._stay_apart(a, b)
            if len(self.pairs) > REMEMBERED_PAIRS:
                self.pairs.clear()
            self.pairs[a, b] = known
        return known

    def _stay_apart(self, a: str, b: str) -> bool:
        ours, theirs = self.history(a), self.history(b)
        if ours is None or theirs is None:
            return False
        last, first, width = a[-1], b[0], len(a)
        i = j = 0
        while True:
            across = self.cost.get(last + first)
            left = ours[i][:2] if i < len(ours) else None
            right = (theirs[j][0], theirs[j][1] + width) if j < len(theirs) else None
            due = min((x for x in (left, right) if x is not None), default=None)
            if across is not None and (due is None or (across[0], width - len(last)) < due):
                return False
            if due is None:
                return True
            if due == left:
                last = ours[i][3]
                i += 1
            else:
                first = theirs[j][2]
                j += 1

    def shorter(self, token: str) -> str | None:
        if token not in self.prefixes:
            self.prefixes[token] = next((token[:n] for n in range(len(token) - 1, 0, -1) if token[:n] in self.tokens), None)
        return self.prefixes[token]

    def merged(self, letters: str) -> list[str]:
        """The tokens of a text whose characters are all known."""
        find, compatible, known, longest = self.automaton.iter_long, self.compatible, self.pairs, self.longest
        # Longest matches in a row, as the search below would take them while all are compatible.
        row = [token for _, token in find(letters)]
        good = int(self.history(row[0]) is not None)
        if good:
            for pair in zip(row, row[1:], strict=False):
                fits = known.get(pair)
                if not (compatible(*pair) if fits is None else fits):
                    break
                good += 1
        if good == len(row):
            return row
        out, token = row[:good], row[good]
        at = sum(map(len, out))
        failed = bytearray(len(letters) // 8 + 1)
        while at < len(letters):
            end = at + len(token)
            fits = compatible(out[-1], token) if out else self.history(token) is not None
            if fits and not failed[end >> 3] >> (end & 7) & 1:
                out.append(token)
                at = end
                if at < len(letters):
                    token = next(find(letters[at : at + longest]))[1]
                continue
            token = self.shorter(token)
            while token is None:
                failed[at >> 3] |= 1 << (at & 7)
                token = out.pop()
                at -= len(token)
                token = self.shorter(token)
        return out

    def _coded(self, letters: str) -> bytes:
        return b"".join(map(self.coded.__getitem__, self.merged(letters)))

    def _bytes(self, text: str) -> bytes:
        return b"".join(self.of_byte[b] for b in text.encode())

    def unit(self, letters: str) -> bytes:
        if self.known.issuperset(letters):
            return self._coded(letters)
        out, first = [], 0
        for i, c in enumerate(letters):
            if c not in self.known:
                out += [self._coded(letters[first:i]) if i > first else b"", self._bytes(c)]
                first = i + 1
        return b"".join([*out, self._coded(letters[first:]) if first < len(letters) else b""])

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, with begin and end."""
        if not text:
            return self.begin + self.end
        known, older = self.remembered, self.older
        units = self.units.findall(self.dummy + text.replace(" ", SPACE))
        for unit in set(units).difference(known):
            known[unit] = older.get(unit) or self.unit(unit)
        out = b"".join([self.begin, *map(known.__getitem__, units), self.end])
        if len(known) > REMEMBERED_WORDS:  # units not met since the last time are forgotten
            self.older = {u: c for u, c in known.items() if len(u) <= REMEMBERED_LENGTH}
            self.remembered = {}
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; a byte piece outside a whole character becomes the replacement character."""
        ids = ids[~self.is_control[ids]]
        if not len(ids):
            return ""
        out = []
        for first in range(0, len(ids), 1 << 20):
            part = ids[first : first + (1 << 20)]
            sizes = self.sizes[part]
            shift = self.starts[part] - np.concatenate([[0], np.cumsum(sizes)[:-1]])
            out.append(self.blob[np.repeat(shift, sizes) + np.arange(sizes.sum())].tobytes())
        skip = int(bool(self.dummy) and bool(self.opens[ids[0]]))
        try:
            return b"".join(out).decode()[skip:]
        except UnicodeDecodeError:
            return self._repaired(ids)[skip:]

    def _repaired(self, ids: np.ndarray) -> str:
        edges = np.flatnonzero(np.diff(self.is_byte[ids])) + 1
        out = []
        for run in np.split(ids, edges):
            data = b"".join(self.blob[self.starts[i] : self.starts[i] + self.sizes[i]].tobytes() for i in run)
            while data:
                try:
                    out.append(data.decode())
                    break
                except UnicodeDecodeError as error:
                    out += [data[: error.start].decode(), "�"]
                    data = data[error.start + 1 :]
        return "".join(out)


@lru_cache(maxsize=2)
def tables(model: bytes) -> MergePieces:
    """Built once in each Python worker."""
    return MergePieces(model)


def read_model(path: str) -> bytes:
    """Read on the driver and sent with the tasks: executors need no copy of the file."""
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids (binary, little-endian unsigned 32-bit, begin and end included) of every text.

    Null and empty texts give begin and end alone; characters that no piece holds become the
    pieces of their bytes; the names of control pieces in a text are ordinary text. Very long
    texts take time in proportion to their length. Rows are independent: repeated rows and ids
    stay, an empty table gives no rows, columns but doc_id and text are not read.
    """
    model = read_model(model_path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = tables(model)
        for part in slices(batches):
            ids = [pieces.encode(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return texts_of(docs).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids and the decoded text; null ids give an empty text."""
    model = read_model(model_path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = tables(model)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                out = [pieces.decode(np.frombuffer(b or b"", "<u4")) for b in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """Digest of ids and of the decoded text for every document."""
    decoded = decode(encode(docs, model_path), model_path)
    return decoded.select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
