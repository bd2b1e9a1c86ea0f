"""How far the sources of a language differ in the words they use.

A CountVectorizer fit gives each language the vocabulary of all terms that at least
``MIN_DOCS`` of its documents hold, and every document its exact sparse counts. Group sums of
those vectors feed an evaluation of pairs of sources that visits only counts above zero: what
all terms without a count in a group would add is one number for the group.
"""

from __future__ import annotations

import contextlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marquee.llm.common import scratch_path, slices, stored, utf8
from marquee.llm.hashing import mixed, power_tables, running_hashes

# Fixed value: the unit of a share.
UNIT = 1_000_000_000

MIN_DOCS = 3
MOST_TERMS = 2**31 - 1
TOP_TERMS = 200
#: Terms, told apart by language, that one fit may meet: what bounds the vocabulary that a fit
#: holds on the driver and sends with its tasks.
FIT_TERMS = 1_500_000
#: Bytes of text that are taken apart at a time: arrays small enough to stay in cache.
SLICE_BYTES = 1 << 19
#: Bytes of sums that a task holds before it hands them on.
SUM_BYTES = 128 << 20


#: What a byte of a text becomes: capitals their small letters, all that separates a space.
LETTERS = np.full(256, 32, np.uint8)
LETTERS[128:] = np.arange(128, 256)
for _first in (65, 97):
    LETTERS[_first : _first + 26] = np.arange(97, 123)


def _terms(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, first and last places of all terms of a batch, the row of each, and its hash."""
    data, bounds = utf8(part.column("text"))
    data = LETTERS[data]
    inside = data != 32
    before, after = np.roll(inside, 1), np.roll(inside, -1)
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    before[edges], before[:1] = False, False
    after[edges - 1], after[-1:] = False, False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    rows = np.searchsorted(bounds, starts, side="right") - 1
    sums = running_hashes(data)
    hashes = mixed((sums[ends] - sums[starts]) * power_tables(len(data))[1][starts])
    langs = {lang: np.uint64(zlib.crc32(lang.encode()) + 1) for lang in set(part.column("lang").to_pylist())}
    salts = np.array([langs[lang] for lang in part.column("lang").to_pylist()], np.uint64)
    return data, starts, ends, rows, mixed(hashes ^ mixed(salts[rows]))


def _lists(part: pa.RecordBatch, bins: int) -> pa.RecordBatch:
    """A row for each row and bin that has terms, every term followed by a space and its lang."""
    data, starts, ends, rows, hashes = _terms(part)
    group = rows * bins + (hashes % np.uint64(bins)).astype(np.int64)
    order = np.argsort(group, kind="stable") if bins > 1 else np.arange(len(group))
    group, starts, ends, rows = group[order], starts[order], ends[order], rows[order]
    # Copies of all terms and tails in one buffer: term i goes to place at[i], its tail behind it.
    tails, edges = utf8(pa.array([f" {lang}" for lang in part.column("lang").to_pylist()]))
    pools = np.concatenate([data, tails])
    firsts = np.stack([starts, len(data) + edges[rows]], axis=1).ravel()
    sizes = np.stack([ends - starts, edges[rows + 1] - edges[rows]], axis=1).ravel()
    at = np.concatenate([[0], np.cumsum(sizes)])
    buffer = pools[np.repeat(firsts - at[:-1], sizes) + np.arange(at[-1])]
    words = pa.LargeStringArray.from_buffers(len(rows), pa.py_buffer(at[::2].astype(np.int64)), pa.py_buffer(buffer))
    new = np.flatnonzero(np.diff(group, prepend=-1))
    lists = pa.LargeListArray.from_arrays(pa.array(np.append(new, len(group)), pa.int64()), words)
    source = part.column("source").take(pa.array(rows[new]))
    return pa.RecordBatch.from_arrays(
        [source, pa.array((group[new] % bins).astype(np.int32)), lists.cast(pa.list_(pa.string()))], ["source", "bin", "terms"]
    )


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))


def term_lists(docs: DataFrame, bins: int = 1) -> DataFrame:
    """source, bin and terms of each text: its terms by bins of their hash, each followed by a
    space and the lang of the text. Texts without terms have no row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, SLICE_BYTES):
            yield _lists(part, bins)

    return _rows(docs).mapInArrow(run, "source string, bin int, terms array<string>")


def distinct_terms(docs: DataFrame) -> int:
    """About how many terms there are, those of each lang for themselves."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, SLICE_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_terms(part)[4]).view(np.int64))], ["term"])

    return _rows(docs).mapInArrow(run, "term long").agg(F.approx_count_distinct("term")).first()[0]


def _summed(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Sums of sparse vectors by source: rows of places and sums, handed on when they take
    SUM_BYTES. ``size``: how many places there are."""
    held: dict[str, np.ndarray] = {}

    def rows() -> pa.RecordBatch:
        filled = {s: np.flatnonzero(x) for s, x in held.items()}
        places = pa.ListArray.from_arrays(
            pa.array(np.cumsum([0, *map(len, filled.values())]).astype(np.int32)),
            pa.array(np.concatenate([*filled.values(), np.zeros(0, np.int64)]).astype(np.int32)),
        )
        sums = np.concatenate([*(held[s][x] for s, x in filled.items()), np.zeros(0, np.int64)])
        sums = pa.ListArray.from_arrays(places.offsets, pa.array(sums))
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), places, sums], ["source", "place", "n"])

    for batch in batches:
        codes = batch.column("source").dictionary_encode()
        of_row = np.asarray(codes.indices)
        edges = np.asarray(batch.column("places").offsets)
        of = np.repeat(of_row, np.diff(edges))
        places = np.asarray(batch.column("places").flatten())
        values = np.asarray(batch.column("counts").flatten())
        for code, source in enumerate(codes.dictionary.to_pylist()):
            mine = of == code
            if source not in held:
                held[source] = np.zeros(size, np.int64)
            held[source] += np.bincount(places[mine], values[mine], size).astype(np.int64)
            if len(held) * size * 8 > SUM_BYTES:
                yield rows()
                held.clear()
    if held:
        yield rows()


def _group_sums(lists: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """lang, source, term, n over the documents' vectors of one fit, n never being 0; and how
    many terms it keeps for each lang."""
    spark = lists.sparkSession
    # The estimator refuses an empty vocabulary: documents of one mark, no term, keep it from that.
    marks = spark.range(min_docs).select(F.array(F.lit("")).alias("terms"))
    estimator = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_docs), vocabSize=MOST_TERMS)
    model = estimator.fit(lists.select("terms").unionByName(marks))
    saved = scratch_path(spark)
    model.save(saved)  # executors read the vocabulary from there: the driver holds it once
    data = spark.read.parquet(f"{saved}/data")
    size = data.select(F.size("vocabulary")).first()[0]
    vocabulary = data.select(F.posexplode("vocabulary").alias("place", "word"))
    vector = F.unwrap_udt("vector")
    sums = (
        model.transform(lists)
        .select("source", vector["indices"].alias("places"), vector["values"].alias("counts"))
        .mapInArrow(lambda batches: _summed(batches, size), "source string, place array<int>, n array<long>")
        .select("source", F.inline(F.arrays_zip("place", "n")))
        .groupBy("source", "place")
        .agg(F.sum("n").alias("n"))
    )
    lang = F.expr("substr(word, instr(word, ' ') + 1)").alias("lang")
    term = F.substr("word", F.lit(1), F.instr("word", " ") - 1).alias("term")
    kept = vocabulary.where("word <> ''").groupBy(lang).agg(F.count("*").alias("kept"))
    return sums.join(vocabulary, "place").select(lang, "source", term, "n"), kept


@contextlib.contextmanager
def _setting(spark: SparkSession, name: str, value: object) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def kept_counts(docs: DataFrame, min_docs: int = MIN_DOCS, fit_terms: int = FIT_TERMS) -> tuple[DataFrame, DataFrame]:
    """lang, source, term, n: occurrences of each kept term in each group that has it; and
    lang, kept: how many terms each lang keeps, for the langs that keep any.

    The lang is a part of every fitted term, so each lang has a vocabulary of its own however
    many share a fit. Terms are dealt over as many fits as their number asks for (at about
    ``fit_terms`` each); the lists of a fit lie in files of their own, so each is read by its
    fit alone.
    """
    spark = docs.sparkSession
    bins = max(1, -(-distinct_terms(docs) // fit_terms))
    path, dealt = scratch_path(spark), scratch_path(spark)
    with _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", bins):  # else whole tasks are sorted by bin
        # Most terms are rare in a file: a dictionary of them would cost more than it saves.
        term_lists(docs, bins).write.option("parquet.enable.dictionary", "false").partitionBy("bin").parquet(dealt)
    lists = spark.read.schema("source string, terms array<string>, bin int").parquet(dealt)
    for turn in range(bins):  # one after the other: the driver holds one vocabulary at a time
        sums, kept = _group_sums(lists.where(F.col("bin") == turn), min_docs)
        sums.write.mode("append").parquet(f"{path}/sums")
        kept.write.mode("append").parquet(f"{path}/kept")
    totals = spark.read.parquet(f"{path}/kept").groupBy("lang").agg(F.sum("kept").alias("kept"))
    return spark.read.parquet(f"{path}/sums"), totals


def _share(n: str, total: str) -> Column:
    """1 + floor(UNIT * (n + 1) / total), exact beyond 64 bits."""
    wide = f"{UNIT} * (cast({n} as decimal(28, 0)) + 1) div {total}"
    return F.expr(f"1 + case when {n} < {2**63 // UNIT - 1} then {UNIT} * ({n} + 1L) div {total} else {wide} end")


def _gap(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


def _pairs(shares: DataFrame, counts: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value for every two sources of a lang.

    With p0 for the share of a term that a group does not have, the sum over all terms is what
    each side's own terms give against the other's p0 (by how many terms have each count), plus
    (v - terms of both) times the gap of the two p0, plus a correction for each shared term.
    ``counts`` are the shares dealt by lang and term.
    """
    side = lambda x: groups.select("lang", *(F.col(c).alias(f"{x}_{c}") for c in ("source", "p0", "terms", "v")))
    every = side("a").join(side("b"), "lang").where("a_source <> b_source")

    sizes = shares.groupBy("lang", "source", "p").agg(F.count("*").alias("k"))
    own = (
        sizes.select("lang", F.col("source").alias("x"), "p", "k")
        .join(groups.select("lang", F.col("source").alias("y"), "p0"), "lang")
        .where("x <> y")
        .groupBy("lang", "x", "y")
        .agg(F.expr(f"sum(k * {_gap('p', 'p0')})").alias("ahead"), F.expr(f"sum(k * {_gap('p0', 'p')})").alias("behind"))
    )
    one = lambda x: counts.select("lang", "term", *(F.col(c).alias(f"{x}_{c}") for c in ("source", "p", "p0")))

    def corrected(a: str, b: str) -> Column:
        p, q, p0, q0 = f"{a}_p", f"{b}_p", f"{a}_p0", f"{b}_p0"
        return F.expr(f"sum({_gap(p, q)} - {_gap(p, q0)} - {_gap(p0, q)} + {_gap(p0, q0)})")

    shared = (
        one("a")
        .join(one("b"), ["lang", "term"])
        .where("a_source < b_source")
        .groupBy("lang", "a_source", "b_source")
        .agg(corrected("a", "b").alias("ab"), corrected("b", "a").alias("ba"))
        .select(
            "lang",
            F.inline(
                F.array(
                    F.struct(F.col("a_source"), F.col("b_source"), F.col("ab").alias("fix")),
                    F.struct(F.col("b_source").alias("a_source"), F.col("a_source").alias("b_source"), F.col("ba").alias("fix")),
                )
            ),
        )
    )
    first = own.select("lang", F.col("x").alias("a_source"), F.col("y").alias("b_source"), "ahead")
    second = own.select("lang", F.col("y").alias("a_source"), F.col("x").alias("b_source"), "behind")
    keys = ["lang", "a_source", "b_source"]
    total = f"ahead + behind + (a_v - a_terms - b_terms) * {_gap('a_p0', 'b_p0')} + fix"
    return (
        every.join(first, keys, "left")
        .join(second, keys, "left")
        .join(shared, keys, "left")
        .fillna(0, ["ahead", "behind", "fix"])
        .select(
            "lang",
            F.col("a_source").alias("source"),
            F.lit("pair").alias("part"),
            F.col("b_source").alias("item"),
            F.expr(f"case when a_v = 0 then 0L else {total} end").alias("value"),
        )
    )


def source_divergence(
    docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, fit_terms: int = FIT_TERMS
) -> DataFrame:
    """lang, source, part, item, value, rank for every (lang, source) group.

    Part ``pair`` compares the group with every other source of its lang over all kept terms;
    part ``term`` lists the kept terms that it uses more than its lang does, to rank
    ``top_terms``. Null text, lang and source are ''; groups without kept terms have their
    pairs (0 where the lang keeps none) and no term rows; equal values rank by item in UTF-8
    order. Each row is a document, so repeated rows and ids count as often as they stand; very
    long texts are one list of terms in their row; an empty table gives no rows; no column but
    the three is read. Sums stay in 64 bits: a lang's shares add to at most UNIT plus its terms.
    """
    found, kept = kept_counts(docs, min_docs, fit_terms)
    empty = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    sums = found.groupBy("lang", "source").agg(F.count("*").alias("terms"), F.sum("n").alias("total"))
    groups = (
        docs.select(empty("lang"), empty("source"))
        .distinct()
        .join(kept.withColumnRenamed("kept", "v"), "lang", "left")
        .join(sums, ["lang", "source"], "left")
        .fillna(0, ["v", "terms", "total"])
        .withColumn("lang_total", F.sum("total").over(Window.partitionBy("lang")))  # one row for each source
        .withColumn("p0", F.when(F.col("v") > 0, _share("0", "nullif(total + v, 0)")))
    )
    groups = stored(groups)
    shares = found.join(groups, ["lang", "source"]).withColumn("p", _share("n", "(total + v)"))
    shares = shares.select("lang", "source", "term", "n", "p", "p0", "v", "lang_total")
    counts = shares.repartition("lang", "term")  # shuffled once for both parts
    of_term = Window.partitionBy("lang", "term")
    terms = (
        counts.withColumn("lang_n", F.sum("n").over(of_term))  # one row for each source
        .withColumn("q", _share("lang_n", "(lang_total + v)"))
        .where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(_gap("p", "q")).alias("value"))
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = terms.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    return _pairs(shares, counts, groups).withColumn("rank", F.row_number().over(order)).unionByName(ranked)
