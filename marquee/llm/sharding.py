"""Two-pass external shuffle into shards.

Pass one scatters the records uniformly into memory-sized buckets by a seeded hash. Pass two
puts each bucket into a canonical order, shuffles it by a seeded Fisher-Yates shuffle and
writes it. The buckets one after the other are a uniform shuffle of all records; cut into
equal runs they are the shards, so the shards' row counts are at most one apart.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import scratch_path

BUCKET_BYTES = 24 << 20


def fisher_yates(n: int, seed: int, bucket: int) -> np.ndarray:
    """A uniformly drawn order of n records: numpy's permutation swaps each place, from the
    last on, with one drawn among those up to it."""
    return np.random.Generator(np.random.PCG64([seed, bucket])).permutation(n)


def shuffle_to_shards(
    docs: DataFrame, path: str, shards: int = 8, seed: int = 1, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """Writes doc_id, text, size, slot under ``path``, one folder for each shard, and returns them.

    size is the text's UTF-8 bytes plus 1, null texts count as none and stay null. Every row
    is kept, also repeated ones; copies of a text under other ids spread over all buckets, only
    rows equal in doc_id and text share one. Reruns give the same shards. Memory for a task is
    about ``bucket_bytes``, or the longest text. The driver holds one count for each bucket.
    An empty table gives no rows.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    sized = docs.select(
        "doc_id", "text", (F.octet_length(F.coalesce("text", F.lit(""))).cast("long") + 1).alias("size")
    )
    total = sized.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    keyed = sized.withColumn("key", F.xxhash64(F.lit(seed), "doc_id", "text"))
    keyed = keyed.withColumn("bucket", F.expr(f"cast(pmod(key, {buckets}) as int)"))
    counts = np.zeros(buckets, np.int64)
    for r in keyed.groupBy("bucket").count().collect():
        counts[r["bucket"]] = r["count"]
    before = np.concatenate([[0], np.cumsum(counts)])
    rows = int(before[-1])
    edges = np.array([-(-s * rows // shards) for s in range(shards + 1)], np.int64)

    def shuffle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield from shuffled(pa.Table.from_batches(held)).to_batches(max_chunksize=10_000)

    def shuffled(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        order = pc.sort_indices(table, [("key", "ascending"), ("doc_id", "ascending")])
        place = np.empty(table.num_rows, np.int64)
        place[fisher_yates(table.num_rows, seed, bucket)] = np.arange(table.num_rows)
        # Row order[i] of the bucket goes to place[i]; taken in the order of places.
        taken = table.take(order.take(pa.array(np.argsort(place))))
        position = before[bucket] + np.arange(table.num_rows)
        shard = np.searchsorted(edges, position, side="right") - 1
        return (
            taken.select(["doc_id", "text", "size"])
            .append_column("slot", pa.array(position - edges[shard]))
            .append_column("shard", pa.array(shard.astype(np.int32)))
        )

    # Each bucket is a partition of its own, so a task holds one bucket however many there are.
    keyed.repartitionById(buckets, "bucket").mapInArrow(
        shuffle, "doc_id long, text string, size long, slot long, shard int"
    ).write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema("doc_id long, text string, size long, slot long, shard int").parquet(path)


def shard_digest(docs: DataFrame, shards: int = 8) -> DataFrame:
    """The shards' records without their texts."""
    written = shuffle_to_shards(docs, scratch_path(docs.sparkSession), shards)
    return written.select(
        "doc_id",
        "size",
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
