"""Helpers shared by the document operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import scratch_path, stored, use_utc

__all__ = [
    "ORACLES",
    "QUERIES",
    "documents",
    "documents_by_id",
    "query",
    "scratch_path",
    "sifted",
    "slices",
    "stored",
    "texts_of",
    "utf8",
]

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SLICE_BYTES = 4 << 20


def query(name: str, sql: str | None = None):
    """Registers a query of this subpackage and, where SQL can express it, its SQL."""

    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: build(use_utc(spark), sf_dir)
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts_of(docs: DataFrame, *columns: str) -> DataFrame:
    """doc_id, the text (null as empty) and the named columns; all others are left out,
    so no column of the input can clash with one that an operator adds."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *columns)


def slices(
    batches: Iterable[pa.RecordBatch], limit: int = SLICE_BYTES, column: str = "text"
) -> Iterator[pa.RecordBatch]:
    """Cuts batches into runs of whole rows with about ``limit`` bytes of text: a task's
    working memory follows the limit or its longest text, not the batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = utf8(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column without nulls; row i is data[offsets[i]:offsets[i + 1]]."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


SIEVE_BITS = 1 << 26


def sifted(rows: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """Adds ``maybe``: false only for rows whose key (``columns``, the same in both) is surely not
    among the keys. A bit for each hash value of a key, 8 MB at most however many keys there
    are, goes to all tasks; so what a join then has to shuffle are the keys' own rows and the
    share of others that meet a set bit, not all rows."""
    place = F.pmod(F.xxhash64(*columns), F.lit(SIEVE_BITS)) + 1
    bucket, bit = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    bits = keys.groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    maybe = F.coalesce(F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1, F.lit(False))
    names = rows.columns
    rows = rows.withColumns({"_place": bucket, "_bit": bit}).join(F.broadcast(bits), F.col("_place") == F.col("_bucket"), "left")
    return rows.select(*names, maybe.alias("maybe"))


RANGE_ROWS = 2000
MOST_RANGES = 4096


def range_of(place: str, edges: list[int]) -> Column:
    """How many of the sorted edges are not above the place, found in two steps of about
    the square root of their number."""
    if not edges:
        return F.lit(0)
    width = max(1, int(len(edges) ** 0.5))
    rows = [edges[i : i + width] for i in range(0, len(edges), width)]
    below = lambda line: F.size(F.filter(line, lambda e: e <= F.col(place)))
    line = F.greatest(below(F.array(*(F.lit(r[0]) for r in rows))) - 1, F.lit(0))
    table = F.array(*(F.array(*map(F.lit, r)) for r in rows))
    return line * width + below(F.get(table, line))


def documents_by_id(docs: DataFrame) -> DataFrame:
    """Documents in descending doc_id, each row directly before its successor.

    Returns bucket, own, doc_id, text, every bucket's rows together and in order. A bucket is a
    range of ids and ends with a copy (``own`` false) of the first row of the next bucket; the
    last one ends with a copy of the first row of all. Only ids are read to find the ranges;
    the texts are shuffled once, and a task can stream its rows. The driver holds one id for
    each range, of which there are at most MOST_RANGES. Rows of one id stay in one bucket,
    ordered by text; null ids come last.
    """
    key = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    place = (-(key + 1)).alias("place")  # ascending in the order wanted
    ids = docs.select(place)
    count = min(MOST_RANGES, ids.count() // RANGE_ROWS)
    shares = [i / count for i in range(1, count)]
    edges = sorted({int(e) for e in ids.approxQuantile("place", shares, 0.2 / count)}) if shares else []
    firsts = ids.groupBy(range_of("place", edges).alias("bucket")).agg(F.min("place")).collect()
    firsts = sorted(map(tuple, firsts))
    guests = [(firsts[i][0], firsts[(i + 1) % len(firsts)][1]) for i in range(len(firsts))]
    heads = docs.sparkSession.createDataFrame(guests, "guest_of int, head long")  # a row for each range
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), place)
    rows = rows.withColumn("home", range_of("place", edges)).join(
        F.broadcast(heads), F.col("place") == F.col("head"), "left"
    )
    at = lambda bucket, own: F.struct(F.col(bucket).alias("bucket"), F.lit(own).alias("own"))
    both = F.when(F.col("guest_of").isNull(), F.array(at("home", True))).otherwise(
        F.array(at("home", True), at("guest_of", False))
    )
    rows = rows.select(F.inline(both), "doc_id", "text", "place")
    rows = rows.repartition("bucket").sortWithinPartitions("bucket", F.col("own").desc(), "place", "text")
    return rows.select("bucket", "own", "doc_id", "text")
