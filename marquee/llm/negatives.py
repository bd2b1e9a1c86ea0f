"""Hard negatives by exact scores from Kronecker-packed products.

Components are whole numbers. Biased to be no less than 0, those of several candidates stand in
separate fields of one wide number, wide enough that sums never run over; one multiplication
with an anchor's component multiplies all fields, and the sum over components is taken apart
into the candidates' exact scores. Where two fields or one fit the 53 exact bits of a double
the products are one matrix product; where not, the wide number is a Python integer that holds
a whole block of candidates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import scratch_path, stored

# Fixed values of the task: the factor of components, and the share of the positive's score, in
# tenths, between which a negative is hard.
FACTOR = 256.0
EASIEST, HARDEST = 3, 9

POSITIVES, NEGATIVES = 5, 10
#: Bytes of anchors that are scored at a time: what the driver holds and sends with the tasks.
WAVE_BYTES = 8 << 20
#: Scores that a task holds at a time.
TILE = 1 << 21
EXACT_BITS = 53
MOST = 2**63 - 1


def whole(x: float) -> int:
    """floor(FACTOR * x) of any finite double."""
    return int(np.floor(FACTOR * x)) if abs(x) < 2.0**900 else int(x) * int(FACTOR)


class Fields:
    """Exact inner products of a block of anchors with blocks of candidates."""

    def __init__(self, anchors: list[np.ndarray], low: int, high: int, dims: int):
        self.low, self.dims = low, dims
        self.width = max(1, (dims * (high - low) ** 2).bit_length())
        self.slots = EXACT_BITS // self.width
        self.size = -(-self.width // 8)  # bytes of a field in a Python integer
        self.anchors = self._biased(anchors)
        self.base = self.anchors.sum(axis=1) * low + dims * low**2

    def _biased(self, rows: list[np.ndarray]) -> np.ndarray:
        """Rows by components, each component less ``low``; missing ones at the end are 0."""
        out = np.full((len(rows), self.dims), -self.low, np.float64 if self.slots else object)
        for at, row in enumerate(rows):
            out[at, : len(row)] = np.floor(FACTOR * row) - self.low if self.slots else [whole(x) - self.low for x in row]
        return out

    def pack(self, rows: list[np.ndarray]) -> tuple:
        """Wide numbers by components, what corrects the bias of each candidate, and their number."""
        biased = self._biased(rows)
        fix = biased.sum(axis=1) * self.low
        if self.slots:
            wide = np.zeros((self.dims, -(-len(rows) // self.slots)))
            for slot in range(self.slots):
                part = biased[slot :: self.slots]
                wide[:, : len(part)] += part.T * 2.0 ** (self.width * slot)
        else:
            join = lambda column: b"".join(u.to_bytes(self.size, "little") for u in column)
            wide = [int.from_bytes(join(column), "little") for column in biased.T]
        return wide, fix, len(rows)

    def scores(self, which: np.ndarray, packed: tuple) -> np.ndarray:
        """Anchors by candidates. A score beyond 64 bits is the nearest that fits."""
        wide, fix, count = packed
        rows, base = self.anchors[which], self.base[which]
        if self.slots:
            total = (rows @ wide).astype(np.int64)
            out = np.empty((len(rows), count), np.int64)
            for slot in range(self.slots):
                held = out[:, slot :: self.slots]
                held[:] = (total >> (self.width * slot))[:, : held.shape[1]] & ((1 << self.width) - 1)
            out += base.astype(np.int64)[:, None] + fix.astype(np.int64)[None, :]
            return out
        out = np.empty((len(rows), count), np.int64)
        for at, row in enumerate(rows):
            total = sum(a * w for a, w in zip(row, wide, strict=True)).to_bytes(self.size * count, "little")
            for i in range(count):
                score = int.from_bytes(total[self.size * i : self.size * (i + 1)], "little") + base[at] + fix[i]
                out[at, i] = max(-MOST, min(MOST, score))
        return out


def first_of_each(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k of each row by higher score, then smaller id, grouped by row."""
    order = np.lexsort((ids, -scores, rows))
    ordered = rows[order]
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < k]


class Best:
    """The first k candidates so far of each search, and the score that a new one must reach."""

    def __init__(self, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        self.rows, self.scores, self.ids = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(rows):
            return
        rows, scores, ids = np.append(self.rows, rows), np.append(self.scores, scores), np.append(self.ids, ids)
        keep = first_of_each(rows, scores, ids, self.k)
        self.rows, self.scores, self.ids = rows[keep], scores[keep], ids[keep]
        full = np.flatnonzero(np.bincount(self.rows, minlength=len(self.least))[self.rows] == self.k)
        last = full[self.k - 1 :: self.k]  # a row's places follow each other: every k-th is its last
        self.least[self.rows[last]] = self.scores[last]

    def batch(self, per: int) -> pa.RecordBatch:
        columns = [self.rows // per, self.rows % per, self.ids, self.scores]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "place", "found", "score"])


FOUND = "anchor long, place long, found long, score long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


class Wave:
    """A bounded block of anchors that every task holds."""

    def __init__(self, anchors: pa.Table, low: int, high: int, dims: int):
        self.ids = anchors.column("vec_id").to_numpy()
        self.labels = anchors.column("label").to_numpy()
        self.fields = Fields([np.array(v, np.float64) for v in anchors.column("vector").to_pylist()], low, high, dims)

    def blocks(self, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        """Ids (those missing last of all), labels and vectors of each batch."""
        for batch in batches:
            if batch.num_rows:
                column = batch.column("vector")
                values = column.flatten().to_numpy(zero_copy_only=False)
                edges = np.cumsum([0, *pa.compute.list_value_length(column).to_pylist()])
                rows = [values[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
                ids = batch.column("vec_id").fill_null(MOST).to_numpy(zero_copy_only=False)
                yield ids, batch.column("label").to_numpy(zero_copy_only=False), rows

    def tiles(self, which: np.ndarray, packed: tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = max(1, TILE // packed[2])
        for first in range(0, len(which), step):
            some = which[first : first + step]
            yield some, self.fields.scores(some, packed)

    def positives(self, k: int) -> Callable:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = Best(k, np.full(len(self.ids), -MOST))
            for ids, labels, rows in self.blocks(batches):
                for label in np.intersect1d(labels, self.labels):
                    mine = np.flatnonzero(labels == label)
                    packed = self.fields.pack([rows[i] for i in mine])
                    for some, scores in self.tiles(np.flatnonzero(self.labels == label), packed):
                        other = ids[mine][None, :] != self.ids[some][:, None]
                        at, to = np.nonzero(other & (scores >= best.least[some][:, None]))
                        best.add(some[at], scores[at, to], ids[mine][to])
            yield best.batch(1)

        return run

    def negatives(self, positives: dict[tuple[int, int], int], k: int, per: int) -> Callable:
        """``positives``: score by anchor and place among its positives."""
        lows, highs = np.full(len(self.ids) * per, MOST), np.full(len(self.ids) * per, -MOST)
        for (anchor, place), score in positives.items():
            lows[anchor * per + place] = -(-EASIEST * score // 10)
            highs[anchor * per + place] = HARDEST * score // 10

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = Best(k, lows)
            for ids, labels, rows in self.blocks(batches):
                for some, scores in self.tiles(np.arange(len(self.ids)), self.fields.pack(rows)):
                    other = labels[None, :] != self.labels[some][:, None]
                    for place in range(per):
                        search = some * per + place
                        good = (scores >= best.least[search][:, None]) & (scores <= highs[search][:, None])
                        at, to = np.nonzero(good & other)
                        best.add(search[at], scores[at, to], ids[to])
            yield best.batch(per)

        return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "found")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def prepared(vectors: DataFrame) -> DataFrame:
    """vec_id, label (changed where the id is divisible by 7) and vector, of rows that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    label = F.col("label").cast("long")
    return vectors.where(F.col("label").isNotNull() & F.forall("embedding", finite)).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )


def hard_negatives(
    vectors: DataFrame,
    anchor_every: int = 100,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    wave_bytes: int = WAVE_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id is divisible by ``anchor_every``. They go in waves of
    ``wave_bytes``, which follow their number: in each, every task scores its own candidates
    against the wave, first those of equal label for the positives, then the others within each
    positive's range, and returns the first few of each search; vectors are never shuffled.

    Rows with a null label, vector or component, or a component that is not finite, take no
    part; empty vectors score 0. Vectors of unequal length are compared as if the shorter one
    ended in zeros. A row of the anchor's own id is no partner of it; otherwise repeated rows
    count as often as they stand, as anchors too. Rows without id come last among equal scores
    and give a null id. Scores beyond 64 bits count as the nearest that fits. An empty table or
    one without anchors gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    rows = stored(prepared(vectors))
    ends = rows.agg(
        F.min(F.array_min("vector")).alias("low"), F.max(F.array_max("vector")).alias("high"), F.max(F.size("vector")).alias("dims")
    ).first()
    low, high = min(whole(ends.low or 0.0), 0), max(whole(ends.high or 0.0), 0)
    dims = max(ends.dims or 0, 1)
    numbered = rows.where(F.col("vec_id") % anchor_every == 0).withColumn("number", F.monotonically_increasing_id())
    anchors = stored(numbered)
    waves = -(-anchors.count() * dims * 8 // wave_bytes)
    path = scratch_path(spark)
    spark.createDataFrame([], RESULT).write.parquet(path)
    for turn in range(waves):
        table = anchors.where(F.pmod(F.xxhash64("number"), F.lit(waves)) == turn).toArrow()
        wave = Wave(table, low, high, dims)
        own = _ranked(rows.mapInArrow(wave.positives(positives), FOUND), positives).toArrow().to_pylist()
        of = {(r["anchor"], r["rank"] - 1): r for r in own}
        found = rows.mapInArrow(wave.negatives({k: r["score"] for k, r in of.items()}, negatives, positives), FOUND)
        known = pa.table(
            {
                "anchor": pa.array([a for a, _ in of], pa.int64()),
                "place": pa.array([p for _, p in of], pa.int64()),
                "anchor_id": pa.array([int(wave.ids[a]) for a, _ in of], pa.int64()),
                "positive_id": pa.array([r["found"] for r in of.values()], pa.int64()),
                "positive_score": pa.array([r["score"] for r in of.values()], pa.int64()),
            }
        )
        id_of = lambda c: F.when(F.col(c) < MOST, F.col(c)).alias(c)
        result = _ranked(found, negatives).join(F.broadcast(spark.createDataFrame(known)), ["anchor", "place"])
        result = result.withColumnsRenamed({"found": "negative_id", "score": "negative_score"})
        result = result.select("anchor_id", id_of("positive_id"), "rank", id_of("negative_id"), "positive_score", "negative_score")
        result.write.mode("append").parquet(path)
    return spark.read.schema(RESULT).parquet(path)
