"""Quality rules with adaptive thresholds.

Four ratios of each text are summarised by mergeable quantile (KLL) sketches for each language
and source. The sketches of small groups are not trusted: they take the thresholds of their
language, whose sketches are merged from its groups', or of the whole corpus. A ratio is out
of range when it lies far from its group's quartiles. The limits, one row for each group, are
joined back to the rows. Only native functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import stored, texts_of

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
SHINGLE = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

SKETCH_K = 2048
MIN_GROUP = 100
#: A ratio over q75 + REACH * max(q75 - q25, least spread) is out of range.
REACH = 6.0
#: Ratio: least spread, so that a group of near-equal values rejects no ordinary text. Where
#: texts hardly repeat themselves, the limit of repeats lies at 0.12, well below the fixed 0.3.
LEAST_SPREAD = {"symbols": 0.05, "word_length": 0.5, "dup_lines": 0.05, "repeats": 0.02}
#: Ratios that are also too low below q25 - REACH * spread.
TWO_SIDED = ("word_length",)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def with_counts(df: DataFrame) -> DataFrame:
    """Adds the counts of a non-null ``text``."""
    keep = df.columns
    df = df.withColumn("_words", F.array_remove(F.split("text", SPACE), ""))
    df = df.withColumns(
        {
            "_lines": F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
            "_hashes": F.transform("_words", lambda w: F.xxhash64(w)),
            "_chars": F.length(F.array_join("_words", "")),
        }
    )
    windows = F.transform(
        F.sequence(F.lit(0), F.size("_hashes") - SHINGLE),
        lambda i: F.xxhash64(*(F.get("_hashes", i + k) for k in range(SHINGLE))),
    )
    df = df.select(
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        F.col("_chars").cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.when(F.size("_words") >= SHINGLE, windows).alias("_windows"),
    )
    repeated = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_sorted", F.when(repeated, placed)).drop("_windows")
    twice = F.filter(
        F.sequence(F.lit(0), F.size("_sorted") - 1),
        lambda k: (F.get("_sorted", k)["h"] == F.get("_sorted", k - 1)["h"])
        | (F.get("_sorted", k)["h"] == F.get("_sorted", k + 1)["h"]),
    )
    df = df.withColumn(
        "_places",
        F.when(
            F.col("_sorted").isNotNull(), F.sort_array(F.transform(twice, lambda k: F.get("_sorted", k)["i"]))
        ),
    ).drop("_sorted")
    # Each repeated window covers its eight words, or as many as lie before the next one.
    covered = F.aggregate(
        F.sequence(F.lit(0), F.size("_places") - 1),
        F.lit(0),
        lambda a, k: a + F.least(F.lit(SHINGLE), F.coalesce(F.get("_places", k + 1), F.lit(2**31 - 1)) - F.get("_places", k)),
    )
    return df.withColumn(
        "n_repeat_words", F.when(F.col("_places").isNull(), 0).otherwise(covered).cast("long")
    ).drop("_places")


def ratios() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "symbols": F.col("n_symbols") / words,
        "word_length": F.col("word_chars") / words,
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeats": F.col("n_repeat_words") / words,
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def limits(counted: DataFrame) -> DataFrame:
    """lang, source and the limits of each ratio, one row for each group (null is a group)."""
    names = list(LEAST_SPREAD)
    own = stored(
        counted.select("lang", "source", *(r.alias(n) for n, r in ratios().items()))
        .groupBy("lang", "source")
        .agg(F.count("*").alias("rows"), *(F.kll_sketch_agg_double(n, SKETCH_K).alias(n) for n in names))
    )

    def merged(rows: DataFrame, keys: list[str], suffix: str) -> DataFrame:
        return rows.groupBy(*keys).agg(
            F.sum("rows").alias(f"rows{suffix}"),
            *(F.kll_merge_agg_double(n, SKETCH_K).alias(f"{n}{suffix}") for n in names),
        )

    by_lang = merged(own, ["lang"], "_lang").withColumnRenamed("lang", "_lang")
    overall = merged(own, [], "_all")  # one row
    rows = own.join(by_lang, own["lang"].eqNullSafe(by_lang["_lang"]), "left").crossJoin(F.broadcast(overall))

    def chosen(name: str) -> Column:
        return (
            F.when(F.col("rows") >= MIN_GROUP, F.col(name))
            .when(F.col("rows_lang") >= MIN_GROUP, F.col(f"{name}_lang"))
            .otherwise(F.col(f"{name}_all"))
        )

    rows = rows.select("lang", "source", *(chosen(n).alias(n) for n in names))
    out = []
    for n, least in LEAST_SPREAD.items():
        low, high = (F.kll_sketch_get_quantile_double(n, F.lit(q)) for q in (0.25, 0.75))
        spread = REACH * F.greatest(high - low, F.lit(least))
        out.append((high + spread).alias(f"max_{n}"))
        if n in TWO_SIDED:
            out.append((low - spread).alias(f"min_{n}"))
    return stored(rows.select("lang", "source", *out))


def judged(counted: DataFrame, bounds: DataFrame) -> DataFrame:
    """Adds base_failed and kept. ``bounds`` is a written table, so its size is known and
    Spark broadcasts it only when small."""
    bounds = bounds.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    rows = counted.join(
        bounds, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left"
    )
    out = F.lit(False)
    for n, r in ratios().items():
        out = out | (r > F.col(f"max_{n}"))
        if n in TWO_SIDED:
            out = out | (r < F.col(f"min_{n}"))
    failed = base_failed()
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & ~F.coalesce(out, F.lit(False)))


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept for every document.

    Null and empty texts have no words and fail. Null languages and sources are groups of
    their own. Rows are judged one by one: repeated rows and null ids stay. An empty table
    gives no rows. The counts are written once, since sketches and verdicts both read them.
    """
    counted = stored(with_counts(texts_of(docs, "lang", "source")).drop("text"))
    rows = judged(counted, limits(counted))
    return rows.select("doc_id", *(c for c in COUNTS if c != "n_lines"), "base_failed", "kept")


def passing(docs: DataFrame) -> DataFrame:
    """The documents (columns doc_id, text, lang, source, n_chars) that the rules keep; null
    texts fail. The rows are written once with their counts, which limits and verdicts read."""
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    counted = stored(with_counts(texts_of(docs, "lang", "source", "n_chars")))
    return judged(counted, limits(counted)).where("kept").select(*columns)
