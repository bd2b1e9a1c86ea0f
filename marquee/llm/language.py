"""Language identification as inference over mixtures of languages.

Each language is a distribution over hashed letter trigrams, counted over all labelled
documents. A document is a mixture of languages: expectation-maximisation finds the
proportions that make its trigrams likeliest. Which languages belong to it is decided by
penalised likelihood: from the likeliest downwards, one more language must raise the
likelihood by more than its penalty. The document's language is the one with the largest
proportion.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import slices

BUCKETS = 1 << 15
SMOOTHING = 0.5
STEPS = 12
#: Trigrams overlap, so each counts for about a third of an independent observation.
OVERLAP = 3.0
PENALTY = 2.0
UNKNOWN = "und"

LETTER = regex.compile(r"\p{L}")


def trigrams(text: str) -> np.ndarray:
    """Bucket of every byte trigram of the lower-cased text; digits, ASCII marks and spaces
    count as one kind of space, and runs of it as one."""
    data = np.frombuffer(b" " + text.lower().encode() + b" ", np.uint8)
    plain = (data >= 97) & (data <= 122) | (data >= 128)
    keep = plain.copy()
    keep[0] = True
    keep[1:] |= plain[:-1]
    data = np.where(plain, data, 32)[keep].astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.uint32)
    code = data[:-2] << np.uint32(16) | data[1:-1] << np.uint32(8) | data[2:]
    return (code * np.uint32(0x9E3779B1)) >> np.uint32(17)


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    counts = np.bincount(trigrams(text), minlength=BUCKETS)
    kinds = np.flatnonzero(counts)
    return kinds, counts[kinds]


def trigram_counts(labelled: DataFrame) -> DataFrame:
    """lang, bucket, n over all labelled rows; each task sums its own rows first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part in slices(batches):
            for text, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist(), strict=True):
                if lang not in sums:
                    sums[lang] = np.zeros(BUCKETS, np.int64)
                sums[lang] += np.bincount(trigrams(text), minlength=BUCKETS)
        for lang, counts in sums.items():
            kinds = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(kinds), pa.string()), pa.array(kinds.astype(np.int32)), pa.array(counts[kinds])],
                ["lang", "bucket", "n"],
            )

    rows = labelled.mapInArrow(run, "lang string, bucket int, n long")
    return rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


class Languages:
    """Trigram distributions of the learned languages."""

    def __init__(self, counts: list[tuple[str, int, int]]):
        self.names = sorted({lang for lang, _, _ in counts})
        of = {lang: i for i, lang in enumerate(self.names)}
        table = np.full((BUCKETS, max(len(self.names), 1)), SMOOTHING)
        for lang, bucket, n in counts:
            table[bucket, of[lang]] += n
        self.table = (table / table.sum(axis=0)).astype(np.float32)

    def mixture(self, likely: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, float]:
        """Proportions by expectation-maximisation, and the log-likelihood they give."""
        total = counts.sum()
        shares = np.full(likely.shape[1], 1 / likely.shape[1], np.float32)
        for _ in range(STEPS if likely.shape[1] > 1 else 0):
            shares = shares * ((counts / (likely @ shares)) @ likely) / total
        return shares, float(counts @ np.log(likely @ shares))

    def predict(self, text: str) -> tuple[str, float]:
        if not self.names or not LETTER.search(text):
            return UNKNOWN, 0.0
        kinds, counts = counted(text)
        if not len(kinds):
            return self.names[0], 1.0 / len(self.names)
        likely, counts = self.table[kinds], counts.astype(np.float32)
        # Any language alone, then mixtures of the strongest of the full mixture.
        alone = counts @ np.log(likely)
        chosen, shares, reached = [int(alone.argmax())], np.ones(1), float(alone.max())
        order = np.argsort(-self.mixture(likely, counts)[0], kind="stable").tolist()
        penalty = PENALTY * OVERLAP * 0.5 * math.log(float(counts.sum()) + 1)
        for size in range(2, len(order) + 1):
            some, value = self.mixture(likely[:, order[:size]], counts)
            if value - penalty * (size - 1) <= reached:
                break
            chosen, shares, reached = order[:size], some, value - penalty * (size - 1)
        best = int(np.argmax(shares))
        return self.names[chosen[best]], float(min(max(shares[best], 0.0), 1.0))


def identify(docs: DataFrame, learn_from: DataFrame) -> DataFrame:
    """doc_id, lang_pred, score of every whole text; score is the language's proportion.

    ``learn_from`` has text and lang; rows without a language teach nothing. Null texts and
    texts without a letter are ``und`` with score 0, and so is every text when there is nothing
    to learn from. Ties go to the language that sorts first. Repeated rows and null ids stay.
    The driver holds one number for each language and trigram bucket.
    """
    labelled = learn_from.where(F.col("lang").isNotNull()).select(F.coalesce("text", F.lit("")).alias("text"), "lang")
    counts = [(r["lang"], r["bucket"], r["n"]) for r in trigram_counts(labelled).toLocalIterator()]
    model = Languages(counts)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            out = [model.predict(t) for t in part.column("text").to_pylist()]
            names, scores = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    text = F.coalesce("text", F.lit("")).alias("text")
    return docs.select("doc_id", text).mapInArrow(run, "doc_id long, lang_pred string, score double")


def fold(modulus: int):
    """crc32 of the id as text, modulo; null ids count as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def held_out_prediction(docs: DataFrame) -> DataFrame:
    """Learns from four fifths of the documents and predicts all."""
    rows = identify(docs, docs.where(fold(5) != 0))
    return rows.select("doc_id", (fold(5) == 0).alias("held_out"), "lang_pred", "score")
