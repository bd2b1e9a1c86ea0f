"""Order MinHash fingerprints: signatures that follow edit distance.

Every k-mer of a text gets its occurrence number, so repeated k-mers are elements of their
own. Each of the fingerprint's hash functions selects the few numbered k-mers with the least
values, puts them back into text order and hashes the tuple. Two texts agree in a part of the
fingerprint when they share the selected k-mers and their order; the share of equal parts is
their likeness, which falls with edit distance, also when blocks only move.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import documents_by_id, slices
from marquee.llm.hashing import A, B, mixed, power_tables, running_hashes

KMER = 12
PARTS = 32
PICKED = 2
SEED = 20
BLOCK = 1 << 20

def multipliers(parts: int = PARTS) -> np.ndarray:
    """One odd number for each part; numbered k-mers are ordered by hash times it, modulo 2^32."""
    return (mixed(np.arange(SEED, SEED + parts, dtype=np.uint64)) | np.uint64(1)).astype(np.uint32)


def numbered_kmers(codes: np.ndarray, k: int = KMER) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the (k-mer, occurrence) elements and their places. A text shorter than k has
    one element, the whole text; an empty one has none."""
    n = len(codes)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    width = min(k, n)
    sums = running_hashes(codes)
    _, inverse = power_tables(n)
    hashes = (sums[width:] - sums[: n - width + 1]) * inverse[: n - width + 1]
    hashes ^= hashes >> np.uint64(29)
    hashes *= B
    if n >= 1 << 31:
        raise ValueError("texts of 2^31 code points and more are not supported")
    # The high half of the hash and the place in one number: sorting it brings equal k-mers
    # together in text order, which numbers them.
    order = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    order.sort()
    kmer = order >> np.uint64(32)
    element = kmer * A
    again = np.flatnonzero(kmer[1:] == kmer[:-1]) + 1
    if len(again):  # runs of places in a row, counted from 1 on
        starts = np.flatnonzero(np.diff(again, prepend=-1) != 1)
        lengths = np.diff(starts, append=len(again))
        element[again] += (np.arange(1, len(again) + 1) - np.repeat(starts, lengths)).astype(np.uint64)
    return mixed(element), (order & np.uint64(0xFFFFFFFF)).astype(np.int64)


def fingerprint(text: str, factors: np.ndarray, picked: int = PICKED) -> np.ndarray:
    """One unsigned 32-bit number for each factor; zeros for an empty text."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    element, place = numbered_kmers(codes)
    parts = len(factors)
    if not len(element):
        return np.zeros(parts, np.uint32)
    short = element.astype(np.uint32)
    take = min(picked, len(short))
    best = np.empty((parts, take), np.int64)
    rows = max(1, BLOCK // len(short))
    for first in range(0, parts, rows):
        values = short[None, :] * factors[first : first + rows, None]
        line = np.arange(len(values))
        for j in range(take):
            least = values.argmin(axis=1)
            best[first : first + rows, j] = least
            values[line, least] = np.uint32(0xFFFFFFFF)
    in_order = np.take_along_axis(best, np.argsort(place[best], axis=1), axis=1)
    out = np.zeros(parts, np.uint64)
    for j in range(take):
        out = mixed(out * A + element[in_order[:, j]] + np.uint64(1))
    return np.maximum((out >> np.uint64(32)).astype(np.uint32), np.uint32(1))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float(np.mean(a == b))


def written(parts: np.ndarray) -> str:
    return parts.astype(">u4").tobytes().hex()


@dataclass
class Row:
    bucket: int
    own: bool
    doc: int | None
    text: str
    parts: np.ndarray


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint: the operator alone, without neighbours. Null texts count as empty;
    empty texts have the fingerprint of zeros. Rows are independent of each other."""
    factors = multipliers()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out = [written(fingerprint(t, factors)) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "fingerprint"])

    text = F.coalesce("text", F.lit("")).alias("text")
    return docs.select("doc_id", text).mapInArrow(run, "doc_id long, fingerprint string")


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and its likeness to the next one.

    The edited text has its last third replaced by the start of the next document, descending
    doc_id (null last, equal ids by text), after the last the first. A table of one row is its
    own next document. Repeated rows stay; an empty table gives no rows. The likeness of two
    empty texts is 1.
    """
    factors = multipliers()
    schema = (
        "doc_id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def answer(row: Row, after: Row) -> tuple:
        n = len(row.text)
        cut = n // 3
        edited = row.text[: n - cut] + after.text[:cut] if cut else row.text
        parts = fingerprint(edited, factors)
        return (
            row.doc, n, edited, written(row.parts), written(parts),
            likeness(row.parts, parts), likeness(row.parts, after.parts),
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: Row | None = None
        for part in slices(batches):
            out = []
            columns = (part.column(c).to_pylist() for c in ("bucket", "own", "doc_id", "text"))
            for bucket, own, doc, text in zip(*columns, strict=True):
                row = Row(bucket, own, doc, text, fingerprint(text, factors))
                if before is not None and before.own and before.bucket == bucket:
                    out.append(answer(before, row))
                before = row
            if out:
                kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
                arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return documents_by_id(docs).mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    rows = edited_fingerprints(docs)
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )
