"""Language and quality models on held-out documents, and the pipeline against its operators."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marquee.llm import classifier, jaccard, language, quality, secrets
from marquee.llm.common import stored

from . import cases


def crc(doc) -> int:
    return zlib.crc32(b"" if doc is None else str(doc).encode())


def labels(spark, sf: str):
    return spark.read.parquet(f"/root/testdata/sf{sf}/labels.parquet")


def test_language_of_held_out_documents(spark):
    docs = cases.given(spark, "0.01")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = [r for r in language.held_out_prediction(docs).collect() if r.held_out]
    assert {r.doc_id for r in rows} == {d for d in truth if crc(d) % 5 == 0}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_of_a_mixture(spark):
    docs = cases.given(spark, "0.01")
    counts = [tuple(r) for r in language.trigram_counts(docs.where("lang is not null").select("text", "lang")).collect()]
    model = language.Languages(counts)
    some = {r.lang: r.text for r in docs.where("length(text) between 2500 and 4000").collect()}
    name, score = model.predict(some["en"][:2000] + " " + some["de"][:1000])
    assert name == "en" and 0.5 < score < 0.8
    assert model.predict("12 !! ٠") == ("und", 0.0)


def test_language_edge_cases(spark):
    docs = cases.edge(spark)
    rows = language.held_out_prediction(docs).collect()
    assert len(rows) == docs.count()
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 3)} == {"und"}
    assert {r.held_out for r in rows if r.doc_id is None} == {crc(None) % 5 == 0}
    assert language.held_out_prediction(cases.empty(spark)).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.held_out_prediction(unlabelled).collect()} == {"und"}


def test_chunks_cover_every_window():
    for n in (0, 1, 7, 8, 511, 512, 513, 1018, 1019, 3000):
        data = np.arange(n) % 251
        codes, first = classifier.chunks(data.astype(np.uint8), np.array([0, n, n]))
        assert first[-1] == len(codes) and np.diff(first).min() >= 1
        seen = {
            tuple(line[i : i + classifier.WIDTH].tolist())
            for line in codes[: first[1]]
            for i in range(0, classifier.CHUNK - classifier.WIDTH + 1, classifier.STRIDE)
        }
        for i in range(0, n - classifier.WIDTH + 1, classifier.STRIDE):
            assert tuple(data[i : i + classifier.WIDTH].tolist()) in seen


def test_gradients_are_the_slopes():
    network = classifier.Network()
    network.embedding, network.filters = network.embedding.astype(np.float64), network.filters.astype(np.float64)
    network.weights, network.bias = network.weights.astype(np.float64), network.bias.astype(np.float64)
    network.offset = network.offset.astype(np.float64) + 0.3
    codes = np.random.default_rng(1).integers(60, 70, (5, classifier.CHUNK)).astype(np.uint16)
    goal = np.array([1, 0, 1, 1, 0], float)

    def loss() -> float:
        values = network.windows(codes) @ network.filters
        z = network.logits(np.maximum(values.max(axis=1) + network.offset, 0))
        return float(np.mean(np.log1p(np.exp(z)) - goal * z))

    for part, slope in zip(network.parts(), network.gradients(codes, goal), strict=True):
        at = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        before, step = part[at], 1e-5
        part[at] = before + step
        high = loss()
        part[at] = before - step
        low = loss()
        part[at] = before
        assert abs((high - low) / (2 * step) - slope[at]) < 1e-4 * max(1, abs(slope[at]))


def test_quality_of_held_out_documents(spark):
    docs, marks = cases.given(spark, "0.01"), labels(spark, "0.01")
    truth = {r.doc_id: r.quality for r in marks.collect()}
    rows = classifier.quality_scores(docs, marks).collect()
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 and r.held_out == (crc(r.doc_id) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    good, bad = ([r.score for r in held if truth[r.doc_id] == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([g >= 0.7 for g in good]) > 0.97


def test_quality_edge_cases(spark):
    docs, marks = cases.edge(spark), spark.createDataFrame([(6, 1, 0), (9, 0, 0), (9, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = classifier.quality_scores(docs, marks).collect()
    assert len(rows) == docs.count()
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    assert classifier.quality_scores(cases.empty(spark), marks).count() == 0
    assert {r.score for r in classifier.quality_scores(docs, marks.limit(0)).collect()} == {0.5}


def test_pipeline_stages(spark):
    """Each stage keeps what its operator's own rows say of the stage's input."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "quality classifier", "n-gram Jaccard join", "secret scans", "best-fit packing"]
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, sf))
        before, after = (sorted(map(cases.key, d.collect())) for d in (docs, out))
        if name == "quality rules":
            kept = {r.doc_id for r in quality.quality_rules(docs).collect() if r.kept}
        elif name == "quality classifier":
            marks = spark.read.parquet(f"{sf}/labels.parquet")
            kept = {r.doc_id for r in classifier.quality_scores(docs, marks).collect() if r.predicted}
        elif name == "n-gram Jaccard join":
            kept = {r.doc_id for r in jaccard.near_duplicates(docs).collect() if r.doc_id == r.class_id}
        elif name == "secret scans":
            assert [r[0] for r in before] == [r[0] for r in after]
            spans = {r.doc_id: r.spans for r in secrets.secret_digest(docs).collect()}
            old = {r.doc_id: r.text for r in docs.collect()}
            assert all((r.text == old[r.doc_id]) == (not spans[r.doc_id]) for r in out.collect())
            assert not any(r.spans for r in secrets.secret_digest(out).collect())
            docs = out
            continue
        else:
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}
            break
        assert out.columns == columns
        assert after == [r for r in before if r[0][1] in kept]
        docs = out


def test_pipeline_takes_edge_cases(spark):
    docs = cases.edge(spark)
    for make in (cases.edge, cases.empty):
        docs = make(spark)
        for _, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, "/root/testdata/sf0.001"))
        assert docs.count() >= 0


def plain_score(network, text: str) -> float:
    """The network's probability by loops over bytes, windows and filters."""
    data = list(text.encode())
    starts, pooled = [0], []
    while starts[-1] + classifier.CHUNK < len(data):
        starts.append(starts[-1] + classifier.STEP)
    for start in starts:
        codes = [data[i] if i < len(data) else classifier.PAD for i in range(start, start + classifier.CHUNK)]
        peaks = [-math.inf] * classifier.FILTERS
        for at in range(0, classifier.CHUNK - classifier.WIDTH + 1, classifier.STRIDE):
            window = [float(v) for c in codes[at : at + classifier.WIDTH] for v in network.embedding[c]]
            for f in range(classifier.FILTERS):
                value = sum(w * float(x) for w, x in zip(window, network.filters[:, f], strict=True))
                peaks[f] = max(peaks[f], value)
        pooled.append([max(p + float(o), 0.0) for p, o in zip(peaks, network.offset, strict=True)])
    mean = [sum(column) / len(pooled) for column in zip(*pooled, strict=True)]
    z = sum(m * float(w) for m, w in zip(mean, network.weights, strict=True)) + float(network.bias[0])
    return 1 / (1 + math.exp(-z))


def test_scores_are_the_plain_convolutions(spark):
    docs = cases.edge(spark).where("doc_id in (1, 4, 6, 12, 13)")
    marks = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 12)], "doc_id long, quality int, toxic int")
    network = classifier.fitted(docs, classifier.learnable(marks))
    got = {}
    for r in classifier.quality_scores(docs, marks).collect():
        got.setdefault(r.doc_id, []).append(r.score)
    for doc, text in cases.texts(docs):
        assert got[doc] == [pytest.approx(plain_score(network, text), abs=1e-3)]


def test_rows_of_one_labelled_id_teach_once(spark):
    schema = "doc_id long, text string"
    rows = [(1, "good prose " * 40), (2, "bad #### " * 40)]
    marks = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    many = spark.createDataFrame(rows + rows[:1] * 500, schema)
    once = spark.createDataFrame(rows, schema)
    samples = [sorted(map(tuple, classifier.fit_sample(d, marks).collect())) for d in (once, many)]
    assert samples[0] == samples[1]


def plain_mixture(model, counts: dict[int, int]) -> tuple[str, float]:
    """Mixtures by loops: full expectation-maximisation ranks the languages, then one more is
    taken while the penalised likelihood rises."""
    table = model.table.astype(float)
    languages = range(len(model.names))
    total = sum(counts.values())

    def mixed(some):
        shares = [1 / len(some)] * len(some)
        for _ in range(language.STEPS if len(some) > 1 else 0):
            new = [0.0] * len(some)
            for kind, n in counts.items():
                whole = sum(table[kind][l] * s for l, s in zip(some, shares, strict=True))
                for i, l in enumerate(some):
                    new[i] += n * shares[i] * table[kind][l] / whole
            shares = [x / total for x in new]
        value = sum(n * math.log(sum(table[k][l] * s for l, s in zip(some, shares, strict=True))) for k, n in counts.items())
        return shares, value

    alone = [mixed([l])[1] for l in languages]
    chosen, shares, reached = [alone.index(max(alone))], [1.0], max(alone)
    full = mixed(list(languages))[0]
    order = sorted(languages, key=lambda l: -full[l])
    penalty = language.PENALTY * language.OVERLAP * 0.5 * math.log(total + 1)
    for size in range(2, len(order) + 1):
        some, value = mixed(order[:size])
        if value - penalty * (size - 1) <= reached:
            break
        chosen, shares, reached = order[:size], some, value - penalty * (size - 1)
    best = shares.index(max(shares))
    return model.names[chosen[best]], min(max(shares[best], 0.0), 1.0)


def test_predictions_are_the_plain_mixtures(spark):
    docs = cases.given(spark)
    learn = docs.where(language.fold(5) != 0)
    counts = [tuple(r) for r in language.trigram_counts(learn.where("lang is not null").select(F.coalesce("text", F.lit("")).alias("text"), "lang")).collect()]
    model = language.Languages(counts)
    got = {r.doc_id: r for r in language.held_out_prediction(docs).collect()}
    for doc, text in cases.texts(docs.where("length(text) < 1500"))[:60]:
        if not language.LETTER.search(text):
            assert got[doc].lang_pred == "und"
            continue
        kinds = Counter(language.trigrams(text).tolist())
        name, score = plain_mixture(model, kinds)
        assert got[doc].lang_pred == name and abs(got[doc].score - score) < 1e-3


def test_scoring_holds_a_bounded_part_of_a_batch(spark):
    """A task scores at most SCORE_BYTES of text at once, a longer text alone."""

    class Sizes:
        def score(self, data, bounds):
            return np.full(len(bounds) - 1, float(len(data)))

    rows = spark.range(60).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 100_000).alias("text")).coalesce(1)
    most = classifier.with_score(rows, Sizes()).agg(F.max("score"), F.count("*")).first()
    assert 100_000 <= most[0] <= classifier.SCORE_BYTES and most[1] == 60
