"""N-gram Jaccard join by chosen paths.

Texts are sets of runs of five words. In each of several independent runs a set samples a few
of its elements by a shared hash, each with a chance in inverse proportion to its size, so
that two sets at the threshold expect more than one sampled element in common. Sets that
sampled the same element meet in a bucket. A large bucket is split again by sampled elements
of the sets' fixed-size embedding, until it is small or its members are alike; such leaf
buckets are compared by brute force, in blocks. Runs are repeated until the target recall. A pair
counts in the least leaf that its members share, so no pair is counted twice and none needs
to be written down: a task returns link counts and a spanning star for its bucket.

Texts with equal sets are one class from the start. Candidates pass a filter on the embedding
whose margin is several standard deviations; all others are compared by their whole sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import sifted, slices, stored, texts_of, utf8
from marquee.llm.components import components
from marquee.llm.hashing import mixed, shingle_sets

WIDTH = 5
#: The similarity threshold as a fraction, so that comparisons are exact.
OVER, UNDER = 4, 5
SAMPLED = 1.4  # expected common samples of two sets at the threshold
RECALL = 0.999
LEAF = 256
LEVELS = 4
DENSE = 0.5  # a bucket whose members agree so much with one of them is not split further
BLOCK = 1024
BINS = 64
MARGIN = 4.5


def survival(level: int, sampled: float = SAMPLED) -> float:
    """Chance that two sets at the threshold share a path down to this level in one run."""
    chance = 1.0
    for _ in range(level):
        chance = 1 - math.exp(-sampled * chance)
    return chance


def runs_for(recall: float = RECALL, level: int = LEVELS) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - survival(level)))


def embedding(some: np.ndarray) -> np.ndarray:
    """One byte for each of 64 ranges of hash values: of the least element in it, or of the next
    range that has one. Two sets agree in about their Jaccard similarity of the bytes."""
    edges = np.arange(BINS, dtype=np.uint64) << np.uint64(58)
    at = np.searchsorted(some, edges)
    end = np.append(at[1:], len(some))
    full = np.flatnonzero(at < end)
    values = (mixed(some[at[full]] + np.uint64(1)) & np.uint64(255)).astype(np.int64)
    places = np.arange(BINS)
    nearest = np.searchsorted(full, places)
    away = np.where(nearest < len(full), full[nearest % len(full)], full[0] + BINS) - places
    return ((values[nearest % len(full)] + 37 * away) & 255).astype(np.uint8)


def class_of(some: np.ndarray) -> bytes:
    return hashlib.blake2b(some.tobytes(), digest_size=16).digest()


def text_key() -> Column:
    """Digest of the text, empty for a null one. With the doc_id it tells rows apart whose id is
    null or met with several texts; rows with both the same are copies."""
    return F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("")).alias("text_key")


def summaries(docs: DataFrame, runs: int) -> DataFrame:
    """doc_id, text_key, node (digest of the set, null without words), size, sketch, paths."""
    salts = mixed(np.arange(1, runs + 1, dtype=np.uint64))
    share = SAMPLED * UNDER / OVER

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = shingle_sets(*utf8(part.column("text")), WIDTH)
            sizes = np.array([len(s) for s in sets], np.int64)
            every = np.concatenate(sets)
            doc = np.repeat(np.arange(len(sets)), sizes)
            least = np.minimum(share / np.maximum(sizes, 1), 1.0) * 2.0**63
            limit = np.repeat(least.astype(np.uint64), sizes)
            found, owner = [], []
            for r, salt in enumerate(salts):
                drawn = mixed(every ^ salt)
                at = np.flatnonzero((drawn >> np.uint64(1)) < limit)
                found.append(mixed(drawn[at] + np.uint64(r)))
                owner.append(doc[at])
            owners = np.concatenate(owner)
            order = np.argsort(owners, kind="stable")
            offsets = np.searchsorted(owners[order], np.arange(len(sets) + 1)).astype(np.int32)
            paths = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)[order].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("text_key"),
                    pa.array([class_of(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array(sizes.astype(np.int32)),
                    pa.array([embedding(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                    paths,
                ],
                ["doc_id", "text_key", "node", "size", "sketch", "paths"],
            )

    rows = texts_of(docs.select("doc_id", "text", text_key()), "text_key")
    return rows.mapInArrow(run, "doc_id long, text_key string, node binary, size int, sketch binary, paths array<long>")


def leaves(nodes: DataFrame) -> DataFrame:
    """leaf, node, members: the leaf buckets that hold two or more classes."""
    entries = nodes.select(F.explode("paths").alias("path"), "node")
    chance = int(2**31 * SAMPLED * UNDER / OVER / BINS)
    out = None
    for level in range(1, LEVELS + 1):
        counts = entries.groupBy("path").agg(F.count("*").alias("members")).where("members > 1")
        rows = stored(entries.join(counts, "path"))
        last = (F.col("members") <= LEAF) | F.lit(level == LEVELS)
        leaf = rows.where(last).select(F.col("path").alias("leaf"), "node", "members")
        out = leaf if out is None else out.union(leaf)
        large = rows.where(~last)
        if level == LEVELS or large.isEmpty():
            return out
        large = stored(large.join(nodes.select("node", "sketch"), "node"))
        pivot = large.groupBy("path").agg(F.min_by("sketch", "node").alias("pivot"))
        agreement = large.join(pivot, "path").groupBy("path").agg(F.avg(agreeing("sketch", "pivot")).alias("share"))
        dense = agreement.where(F.col("share") >= DENSE).select("path")
        alike = large.join(dense, "path", "left_semi").select(F.col("path").alias("leaf"), "node", "members")
        out = out.union(alike)
        split = large.join(dense, "path", "left_anti")
        drawn = F.filter(
            F.sequence(F.lit(0), F.lit(BINS - 1)),
            lambda i: F.xxhash64("path", i, F.lit(level)).bitwiseAND(F.lit(2**31 - 1)) < chance,
        )
        split = split.withColumn("place", F.explode(drawn))
        path = F.xxhash64("path", "place", F.expr("substring(sketch, place + 1, 1)"))
        entries = split.select(path.alias("path"), "node")
    return out


def agreeing(a: str, b: str) -> Column:
    """Share of equal bytes of two embeddings."""
    same = F.expr(f"filter(sequence(1, {BINS}), i -> substring({a}, i, 1) = substring({b}, i, 1))")
    return F.size(same) / BINS


def blocked(rows: DataFrame) -> DataFrame:
    """Adds key and side: a bucket of up to BLOCK members has one key; a larger one is cut into
    blocks, with a key for every two blocks, whose rows are on side 0 and 1, and one for each
    block with itself (side 2). Each row comes once for every block."""
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    key = F.xxhash64("leaf", F.least("own", "other"), F.greatest("own", "other"))
    return rows.withColumn("side", side.cast("int")).withColumn("key", key).drop("own", "other")


def groups(batches: Iterable[pa.RecordBatch], key: str = "key") -> Iterator[pa.Table]:
    """Tables of all rows of one key, from rows sorted by it."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        keys = batch.column(key).to_numpy()
        cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else []
        for first, last in zip(cuts, [*cuts[1:], len(keys)], strict=True):
            if held and keys[first] != current:
                yield pa.Table.from_batches(held)
                held = []
            current = keys[first]
            held.append(batch.slice(first, last - first))
    if held:
        yield pa.Table.from_batches(held)


def counted_here(leaf: np.ndarray, lists: list[list[int]], side: np.ndarray) -> np.ndarray:
    """Which pairs this bucket counts: those of its blocks that share no lesser leaf."""
    n = len(lists)
    lesser = [[x for x in line if x < leaf] for line in lists]
    flat = np.array([x for line in lesser for x in line], np.int64)
    own = np.triu(np.ones((n, n), bool), 1)
    if (side != 2).any():
        own &= side[:, None] != side[None, :]
    if len(flat):
        values, column = np.unique(flat, return_inverse=True)
        line = np.repeat(np.arange(n), [len(x) for x in lesser])
        for first in range(0, len(values), 4096):
            here = (column >= first) & (column < first + 4096)
            matrix = np.zeros((n, min(4096, len(values) - first)), np.float32)
            matrix[line[here], column[here] - first] = 1
            own &= (matrix @ matrix.T) == 0
    return own


def likely(sketches: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Pairs that may reach the threshold, by size and by agreement of their embeddings."""
    n = len(sizes)
    small, large = np.minimum(sizes[:, None], sizes[None, :]), np.maximum(sizes[:, None], sizes[None, :])
    out = UNDER * small >= OVER * large
    share = OVER / UNDER
    least = share - MARGIN * np.sqrt(share * (1 - share) / np.minimum(small, BINS))
    step = max(1, (1 << 22) // (n * BINS))
    for first in range(0, n, step):
        agree = (sketches[first : first + step, None, :] == sketches[None, :, :]).mean(axis=2)
        out[first : first + step] &= agree >= least[first : first + step]
    return out


def common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    n = len(sets)
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    line = np.repeat(np.arange(n), [len(s) for s in sets])
    place = np.cumsum(times > 1) - 1
    keep = times[column] > 1
    line, column = line[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    line, column = line[order], column[order]
    out = np.zeros((n, n), np.float64)
    width = max(256, min(8192, (1 << 24) // n))
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [first, first + width])
        matrix = np.zeros((n, width), np.float32)
        matrix[line[a:b], column[a:b] - first] = 1
        out += matrix @ matrix.T
    return out


def stars(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix the least row of its component."""
    label = np.arange(len(linked))
    while True:
        least = np.where(linked, label[None, :], len(linked)).min(axis=1)
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def candidates(rows: DataFrame) -> DataFrame:
    """key, leaf, side, node, list of the members that have a likely pair which counts here."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.Table] = []
        size = 0
        for group in groups(batches):
            if group.num_rows < 2:
                continue
            sketches = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(-1, BINS)
            pairs = likely(sketches, group.column("size").to_numpy())
            side = group.column("side").to_numpy()
            pairs &= np.triu(np.ones(pairs.shape, bool), 1)
            if not pairs.any():
                continue
            pairs &= counted_here(group.column("leaf")[0].as_py(), group.column("list").to_pylist(), side)
            some = pairs.any(axis=0) | pairs.any(axis=1)
            if some.any():
                kept.append(group.select(["key", "leaf", "side", "node", "list"]).take(np.flatnonzero(some)))
                size += kept[-1].num_rows
            if size > 5000:
                yield from pa.concat_tables(kept).combine_chunks().to_batches()
                kept, size = [], 0
        if kept:
            yield from pa.concat_tables(kept).combine_chunks().to_batches()

    return sorted_by_key(rows).mapInArrow(run, "key long, leaf long, side int, node binary, list array<long>")


def sorted_by_key(rows: DataFrame) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions("key", "node")


def verified(rows: DataFrame) -> DataFrame:
    """node, links, peer: for members with a link in a bucket the number of documents linked to
    them there, and the least class they hang together with."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches):
            if group.num_rows < 2:
                continue
            sets = [np.frombuffer(b, np.uint64) for b in group.column("elements").to_pylist()]
            sizes = np.array([len(s) for s in sets], np.float64)
            both = common(sets)
            linked = UNDER * both >= OVER * (sizes[:, None] + sizes[None, :] - both)
            linked &= counted_here(
                group.column("leaf")[0].as_py(), group.column("list").to_pylist(), group.column("side").to_numpy()
            )
            linked |= linked.T
            some = np.flatnonzero(linked.any(axis=1))
            if not len(some):
                continue
            links = linked @ group.column("copies").to_numpy()
            node = group.column("node").combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [node.take(some), pa.array(links[some].astype(np.int64)), node.take(stars(linked)[some])],
                ["node", "links", "peer"],
            )

    return sorted_by_key(rows).mapInArrow(run, "node binary, links long, peer binary")


def elements_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, elements: the sets of the wanted classes (doc_id, text_key, node), from one text of each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            sets = shingle_sets(*utf8(part.column("text")), WIDTH)
            nodes = part.column("node").to_pylist()
            hits = [(n, s.tobytes()) for n, s in zip(nodes, sets, strict=True) if len(s) and class_of(s) == n]
            names, out = zip(*hits, strict=True) if hits else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(out, pa.binary())], ["node", "elements"])

    rows = texts_of(docs.select("doc_id", "text", text_key()), "text_key")
    rows = sifted(rows, wanted, ["doc_id", "text_key"]).where("maybe")
    wanted = wanted.withColumnsRenamed({"doc_id": "_doc", "text_key": "_key"})
    rows = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_key") == F.col("_key"))).select("node", "text")
    return rows.mapInArrow(run, "node binary, elements binary").groupBy("node").agg(F.first("elements").alias("elements"))


def classes_of(docs: DataFrame, recall: float) -> tuple[DataFrame, DataFrame]:
    """The summaries, and for each set node, the least doc_id (null only if all are) with its
    text_key, copies, links and root, the node that names its class."""
    rows = stored(summaries(docs, runs_for(recall)))
    nodes = (
        rows.where("node is not null")
        .groupBy("node")
        .agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("least"),
            F.count("*").alias("copies"),
            F.first("size").alias("size"),
            F.first("sketch").alias("sketch"),
            F.first("paths").alias("paths"),
        )
    )
    nodes = stored(nodes.select("node", "least.doc_id", "least.text_key", "copies", "size", "sketch", "paths"))
    leaf = stored(leaves(nodes.select("node", "sketch", "paths")))
    lists = leaf.groupBy("node").agg(F.sort_array(F.collect_list("leaf")).alias("list"))
    carried = nodes.select("node", "size", "sketch").join(lists, "node")
    chosen = stored(candidates(blocked(leaf.join(carried, "node"))))
    wanted = stored(nodes.select("doc_id", "text_key", "node").join(chosen.select("node").distinct(), "node"))
    sets = stored(elements_of(docs, wanted))
    bodies = sets.join(nodes.select("node", "copies"), "node")
    links = stored(verified(chosen.join(bodies, "node")))
    root = components(links.select(F.col("node").alias("a"), F.col("peer").alias("b")))
    totals = links.groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.select("node", "doc_id", "text_key", "copies").join(totals, "node", "left").join(root, "node", "left")
    return rows, stored(named.withColumn("root", F.coalesce("root", "node")))


def near_duplicates(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id, copy_id, n_links for every document.

    Documents are linked when the Jaccard similarity of their sets is 0.8 or more. n_links is
    the number of other documents linked to it, copies among them; copy_id the least doc_id with
    the same set; class_id the least doc_id that links lead to, over any number of steps.
    A text of one to four words is one run of all its words. Null texts and texts without words
    link to nothing and are classes of their own. Repeated rows are documents of their own. A
    class whose ids are all null has a null id. An empty table gives no rows. Very long texts
    are sets of as many elements as they have runs; their row must fit a task.
    """
    rows, named = classes_of(docs, recall)
    least = named.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    classes = named.join(least, "root").select(
        "node",
        "class_id",
        F.col("doc_id").alias("copy_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    alone = rows.where("node is null").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_id"), F.lit(0).cast("long").alias("n_links")
    )
    joined = rows.where("node is not null").select("doc_id", "node").join(classes, "node")
    return joined.select("doc_id", "class_id", "copy_id", "n_links").union(alone)


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents (columns doc_id, text, lang, source, n_chars) of which one stays for each
    class: the one with the least doc_id (null comes last), and of rows with that id and one
    text any. Rows are told apart by id and text, never by id alone. Texts without words are
    classes of their own; of such rows with one id and one text one stays."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    rows, named = classes_of(docs, RECALL)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node", "text_key")
    stays = named.groupBy("root").agg(F.min(place).alias("least"))
    stays = stays.select(F.col("least.doc_id").alias("_doc"), F.col("least.text_key").alias("_key"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("text_key") == F.col("_key"))
    every = rows.where("node is not null").select("doc_id", "text_key").distinct()
    drop = stored(every.join(stays, same, "left_anti"))
    again = stored(rows.groupBy("doc_id", "text_key").count().where("count > 1").drop("count"))
    key = ["doc_id", "text_key"]
    found = sifted(docs.select(*columns, text_key()), drop.union(again), key)
    names = {"doc_id": "_doc", "text_key": "_key"}
    kept = found.where("maybe").drop("maybe").join(drop.withColumnsRenamed(names), same, "left_anti")
    if not again.isEmpty():
        again = again.withColumnsRenamed(names)
        kept = kept.join(again, same, "left_anti").union(kept.join(again, same, "left_semi").dropDuplicates(key))
    return found.where("not maybe").drop("maybe").union(kept).select(*columns)
