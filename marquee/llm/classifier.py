"""Quality classifier: a byte-level convolutional network in numpy.

The bytes of a text are cut into chunks that overlap, so that no filter window is lost and
the chunks cover the whole document. Bytes are embedded, learned filters run over each chunk,
their largest response in the chunk is kept, and the mean of the chunks' responses is combined
into one probability. It is fitted by gradient descent on chunks of a bounded sample of
labelled documents; every document is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from marquee.llm.common import slices, utf8
from marquee.llm.language import fold

CHUNK = 512
WIDTH = 8
STRIDE = 2
STEP = CHUNK - WIDTH + STRIDE  # the next chunk begins with the first window that does not fit
EMBEDDING = 8
FILTERS = 24
PAD = 256
BLOCK = 128
#: Text that is scored at once; its chunks and their places take many times as much memory.
SCORE_BYTES = 1 << 20

#: Bounds of the fit: labelled documents, and chunks of each (spread over the whole text).
FIT_ROWS = 2000
FIT_CHUNKS = 6
EPOCHS = 6
LEAST_STEPS = 800
BATCH = 64
RATE = 0.01
SEED = 5
THRESHOLD = 0.7


def chunks(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunk rows of byte codes, padded at the end of a text, and the first chunk of each text.
    Every text has at least one chunk; an empty text's is all padding."""
    sizes = np.diff(bounds)
    each = np.maximum(1, -(-(sizes - (CHUNK - STEP)) // STEP))
    first = np.concatenate([[0], np.cumsum(each)])
    doc = np.repeat(np.arange(len(sizes)), each)
    start = bounds[doc] + (np.arange(first[-1]) - first[doc]) * STEP
    at = start[:, None] + np.arange(CHUNK)
    inside = at < bounds[doc + 1][:, None]
    known = data[np.minimum(at, max(len(data) - 1, 0))].astype(np.uint16) if len(data) else np.uint16(0)
    codes = np.where(inside, known, np.uint16(PAD))
    return codes, first


class Network:
    def __init__(self, seed: int = SEED):
        draw = np.random.default_rng(seed)
        self.embedding = draw.normal(0, 0.5, (PAD + 1, EMBEDDING)).astype(np.float32)
        self.embedding[PAD] = 0
        self.filters = draw.normal(0, (2 / (WIDTH * EMBEDDING)) ** 0.5, (WIDTH * EMBEDDING, FILTERS)).astype(np.float32)
        self.offset = np.zeros(FILTERS, np.float32)
        self.weights = draw.normal(0, 0.1, FILTERS).astype(np.float32)
        self.bias = np.zeros(1, np.float32)

    def parts(self) -> list[np.ndarray]:
        return [self.embedding, self.filters, self.offset, self.weights, self.bias]

    def windows(self, codes: np.ndarray) -> np.ndarray:
        """(chunks, windows, WIDTH * EMBEDDING) of embedded bytes, without a copy."""
        embedded = self.embedding[codes].reshape(len(codes), -1)
        view = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH * EMBEDDING, axis=1)
        return view[:, :: STRIDE * EMBEDDING]

    def responses(self, codes: np.ndarray) -> np.ndarray:
        """Largest response of every filter in every chunk."""
        out = np.empty((len(codes), FILTERS), np.float32)
        for first in range(0, len(codes), BLOCK):
            windows = self.windows(codes[first : first + BLOCK])
            values = windows.reshape(-1, WIDTH * EMBEDDING) @ self.filters
            out[first : first + BLOCK] = values.reshape(*windows.shape[:2], FILTERS).max(axis=1)
        return np.maximum(out + self.offset, 0)

    def logits(self, pooled: np.ndarray) -> np.ndarray:
        return pooled @ self.weights + self.bias[0]

    def score(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        codes, first = chunks(data, bounds)
        pooled = np.add.reduceat(self.responses(codes), first[:-1], axis=0) / np.diff(first)[:, None]
        return 1 / (1 + np.exp(-np.clip(self.logits(pooled).astype(np.float64), -30, 30)))

    def gradients(self, codes: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        windows = self.windows(codes)
        values = windows.reshape(-1, WIDTH * EMBEDDING) @ self.filters
        values = values.reshape(*windows.shape[:2], FILTERS)
        best = values.argmax(axis=1)
        peak = np.take_along_axis(values, best[:, None], axis=1)[:, 0] + self.offset
        pooled = np.maximum(peak, 0)
        error = (1 / (1 + np.exp(-self.logits(pooled))) - labels) / len(labels)
        at_peak = np.outer(error, self.weights) * (peak > 0)
        lines = np.arange(len(codes))[:, None]
        chosen = windows[lines, best]  # chunk, filter, window
        to_filters = np.einsum("cf,cfw->wf", at_peak, chosen)
        to_window = (at_peak[:, :, None] * self.filters.T).reshape(len(codes), FILTERS, WIDTH, EMBEDDING)
        bytes_at = codes[lines[:, :, None], (best * STRIDE)[:, :, None] + np.arange(WIDTH)]
        to_embedding = np.zeros_like(self.embedding)
        np.add.at(to_embedding, bytes_at.reshape(-1), to_window.reshape(-1, EMBEDDING))
        to_embedding[PAD] = 0
        return [to_embedding, to_filters, at_peak.sum(axis=0), pooled.T @ error, error.sum(keepdims=True)]

    def fit(self, codes: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> None:
        """Adam on the logistic loss of single chunks, in a seeded order."""
        draw = np.random.default_rng(seed)
        share = labels.mean() if len(labels) else 0.5
        self.bias[:] = np.log((share + 0.01) / (1.01 - share))
        means = [np.zeros_like(p) for p in self.parts()]
        squares = [np.zeros_like(p) for p in self.parts()]
        step = 0
        epochs = max(epochs, -(-LEAST_STEPS * BATCH // max(len(labels), 1)))
        for epoch in range(epochs):
            rate = RATE * (1 - epoch / epochs)
            order = draw.permutation(len(labels))
            for first in range(0, len(order), BATCH):
                some = order[first : first + BATCH]
                step += 1
                for p, g, m, s in zip(
                    self.parts(), self.gradients(codes[some], labels[some]), means, squares, strict=True
                ):
                    m += 0.1 * (g - m)
                    s += 0.01 * (g * g - s)
                    p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)).astype(np.float32)


def fit_sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, per_row: int = FIT_CHUNKS) -> DataFrame:
    """quality and at most ``per_row`` chunks of each of at most ``rows`` labelled documents, the
    ones with the least hash of the id. The sample's ids are a bounded table; of an id that
    several rows have, the text that sorts first teaches."""
    marked = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .withColumn("draw", F.xxhash64(F.lit(SEED), "doc_id"))
        .orderBy("draw", "doc_id")
        .limit(rows)
        .select("doc_id", "quality")
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows_in = texts.join(F.broadcast(marked), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            data, bounds = utf8(part.column("text"))
            codes, first = chunks(data, bounds)
            spread = [
                first[i] + np.unique(np.linspace(0, n - 1, min(n, per_row)).astype(int))
                for i, n in enumerate(np.diff(first).tolist())
            ]
            of = np.repeat(np.arange(len(spread)), [len(s) for s in spread])
            out = [codes[i].tobytes() for i in np.concatenate(spread)]
            ids = part.column("doc_id").take(pa.array(of))
            quality = part.column("quality").take(pa.array(of))
            yield pa.RecordBatch.from_arrays([ids, quality, pa.array(out, pa.binary())], ["doc_id", "quality", "chunk"])

    return rows_in.mapInArrow(run, "doc_id long, quality int, chunk binary")


def fitted(docs: DataFrame, labels: DataFrame) -> Network:
    """Without labelled documents the network stays at its start and calls all alike."""
    network = Network()
    sample = sorted(map(tuple, fit_sample(docs, labels).collect()))
    if not sample:
        network.weights[:] = 0
        return network
    codes = np.stack([np.frombuffer(c, np.uint16) for _, _, c in sample])
    network.fit(codes, np.array([q for _, q, _ in sample], np.float32))
    return network


def with_score(rows: DataFrame, network: Network) -> DataFrame:
    """Adds score to rows that have a non-null text; all other columns pass through."""
    schema = StructType([*rows.schema.fields, StructField("score", DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, SCORE_BYTES):
            score = network.score(*utf8(part.column("text")))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], [*part.schema.names, "score"])

    return rows.mapInArrow(run, schema)


def learnable(labels: DataFrame) -> DataFrame:
    return labels.where(fold(4) != 2)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every whole text.

    Null and empty texts have one chunk of padding and get its score. Labels teach only
    outside the held-out fold; rows without a label or an id teach nothing, repeated labels
    count once (the larger). Repeated rows and null ids stay; an empty table gives no rows.
    """
    network = fitted(docs, learnable(labels))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return with_score(rows, network).select(
        "doc_id",
        (fold(4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents (columns doc_id, text, lang, source, n_chars) of good quality. Null texts
    are scored as empty ones and come back null if they are kept."""
    network = fitted(docs, learnable(labels))
    rows = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang", "source", "n_chars", F.col("text").isNull().alias("_null")
    )
    kept = with_score(rows, network).where(F.col("score") >= THRESHOLD)
    text = F.when(~F.col("_null"), F.col("text")).alias("text")
    return kept.select("doc_id", text, "lang", "source", "n_chars")
