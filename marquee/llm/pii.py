"""Personal data: fixed patterns, and terms that reveal whom they stand beside.

Every match of a pattern is a mention of a protected entity. The words around it are its
context; over all distinct texts of the corpus the pointwise mutual information of a term
and an entity, as a share of the entity's own information, says how much of the entity the
term discloses: 1 when the term occurs in no text without standing beside the entity. Terms
over the upper threshold are removed, those over the lower one generalised, wherever they
stand in the corpus. Copies of a text count once, and a term must be met beside the entity in
several distinct contexts. Only native functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import stored, texts_of
from marquee.llm.spans import SPAN, Kind, count_of, joined, replaced, with_spans


def _luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = 2 * digit
        return F.when(i % 2 == 0, digit).when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda a, i: a + value(i))
    return total % 10 == 0


def _card(hit: Column) -> Column:
    digits = F.regexp_replace(hit, r"[\x20-]", "")
    return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(F.lit(False))


#: The fixed patterns. They begin where a run of their characters begins (or the last match
#: ended) and never give back what they took, which finds the same matches in linear time.
BASE = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda hit: F.lit(True),
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda hit: hit.rlike(r"^(0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])(\.|$)){4}$"),
    ),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", _card),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda hit: F.length(F.regexp_replace(hit, r"[^0-9]", "")).between(10, 15),
    ),
)

REACH = 60  # code points of context on either side
TERM = r"\p{L}[\p{L}\p{N}'-]{2,}+"
SUPPORT = 3
GENERALISED, REMOVED = 0.75, 0.95
ADDED = ("general", "removed")


def base_spans(docs: DataFrame, *columns: str) -> DataFrame:
    """doc_id, text, the named columns and base, the sorted spans of the fixed patterns."""
    df = texts_of(docs, *columns)
    keep = df.columns
    df = with_spans(df, BASE)
    return df.select(*keep, F.sort_array(F.concat(*(f"_s_{k.name}" for k in BASE))).alias("base"))


def contexts(rows: DataFrame) -> DataFrame:
    """text_key, entity, context, term, start, end: the words around each mention, with their
    places in the text. Equal texts are looked at once. ``rows``: text_key, mentions."""
    once = rows.where(F.size("mentions") > 0).groupBy("text_key").agg(F.first("mentions").alias("mentions"))
    each = once.select("text_key", F.inline("mentions"))
    terms = with_spans(each, [Kind("term", TERM, lambda hit: F.lit(True))], text="before", prefix="_b")
    terms = with_spans(terms, [Kind("term", TERM, lambda hit: F.lit(True))], text="after", prefix="_a")
    first = F.col("start") - F.length("before")
    # A word cut by the far edge of the context is not a term.
    left = F.transform(
        F.filter("_b_term", lambda s: (s["start"] > 0) | (first == 0)),
        lambda s: F.struct(F.lower(s["hit"]).alias("term"), (first + s["start"]).alias("at"), (first + s["end"]).alias("to")),
    )
    right = F.transform(
        F.filter("_a_term", lambda s: (s["end"] < REACH)),
        lambda s: F.struct(
            F.lower(s["hit"]).alias("term"), (F.col("end") + s["start"]).alias("at"), (F.col("end") + s["end"]).alias("to")
        ),
    )
    context = F.md5(F.concat_ws("\u0000", "entity", "before", "after")).alias("context")
    return terms.select("text_key", "entity", context, F.inline(F.concat(left, right)))


def words_of(texts: DataFrame) -> DataFrame:
    """text_key, term: the different terms of each text. ``texts``: text_key, text."""
    every = F.transform(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)), F.lower)
    return texts.select("text_key", F.explode(F.array_distinct(every)).alias("term"))


def disclosures(terms: DataFrame, texts: DataFrame) -> DataFrame:
    """term, level ("general" or "removed") of the terms that disclose too much of any entity.
    ``terms``: what ``contexts`` gives. ``texts``: text_key, text of all distinct texts, over
    which the terms are counted, whether or not they stand beside a mention."""
    of_entity = terms.groupBy("entity").agg(F.count_distinct("text_key").alias("n_entity"))
    total = texts.agg(F.count("*").alias("n"))  # one row
    of_term = words_of(texts).groupBy("term").agg(F.count("*").alias("n_word"))
    seen = terms.groupBy("entity", "term").agg(
        F.count_distinct("context").alias("n_contexts"), F.count_distinct("text_key").alias("n_both")
    )
    both = seen.where(F.col("n_contexts") >= SUPPORT)
    rows = both.join(of_entity, "entity").join(of_term, "term", "left").crossJoin(F.broadcast(total))
    # A part of a word that a mention cuts is a term beside it and no word of the text.
    n_term = F.greatest("n_word", "n_both")
    information = F.log2(F.col("n") / F.col("n_entity"))
    mutual = F.log2(F.col("n_both") * F.col("n") / (n_term * F.col("n_entity")))
    share = F.when(information > 0, mutual / information)
    highest = rows.select("term", share.alias("share")).groupBy("term").agg(F.max("share").alias("share"))
    level = F.when(F.col("share") >= REMOVED, "removed").when(F.col("share") >= GENERALISED, "general")
    return highest.select("term", level.alias("level")).where("level is not null")


def added_spans(terms: DataFrame, texts: DataFrame) -> DataFrame:
    """text_key, added: the sorted spans of disclosing terms of each text that has any, at every
    place in the text. Places are looked for only in texts that have such a term."""
    levels = stored(disclosures(terms, texts))
    pairs = F.map_from_entries(F.collect_list(F.struct("term", "level"))).alias("levels")
    told = stored(words_of(texts).join(levels, "term").groupBy("text_key").agg(pairs))
    rows = with_spans(texts.join(told, "text_key"), [Kind("term", TERM, lambda hit: F.lit(True))])
    level_of = lambda s: F.try_element_at("levels", F.lower(s["hit"]))
    # Not a column of spans: Spark would infer a filter on it and repeat all of its expressions.
    here = F.transform(
        F.filter("_s_term", lambda s: level_of(s).isNotNull()),
        lambda s: F.struct(F.lower(s["hit"]).alias("term"), s["start"].alias("at"), s["end"].alias("to"), level_of(s).alias("level")),
    )
    places = rows.select("text_key", F.inline(here))
    beside = terms.join(levels, "term").select("text_key", "term", "at", "to", "level")
    hits = places.union(beside)
    order = len(BASE) + F.when(F.col("level") == "removed", 1).otherwise(0)
    span = F.struct(
        F.col("at").alias("start"), order.alias("ord"), F.col("level").alias("kind"), F.col("to").alias("end"), F.col("term").alias("hit")
    )
    return hits.groupBy("text_key").agg(F.sort_array(F.collect_set(span)).cast(SPAN).alias("added"))


def found(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, base and spans of every whole text.

    Null and empty texts have no spans. Repeated rows and null ids stay, an empty table gives no
    rows. Added spans never replace base ones. Kinds of added spans: general and removed.
    """
    rows = base_spans(docs)
    mention = F.transform(
        "base",
        lambda s: F.struct(
            F.lower(s["hit"]).alias("entity"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.substring(
                F.col("text"), F.greatest(s["start"] - REACH, F.lit(0)) + 1, F.least(s["start"], F.lit(REACH))
            ).alias("before"),
            F.substring(F.col("text"), s["end"] + 1, F.lit(REACH)).alias("after"),
        ),
    )
    rows = stored(rows.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_key"), "base", mention.alias("mentions")))
    keyed = texts_of(docs).select(F.md5(F.col("text").cast("binary")).alias("text_key"), "text")
    texts = stored(keyed.groupBy("text_key").agg(F.first("text").alias("text")))
    added = added_spans(stored(contexts(rows.select("text_key", "mentions"))), texts)
    none = F.expr(f"cast(array() as {SPAN})")
    return rows.join(added, "text_key", "left").select(
        "doc_id", "text_key", "base", F.sort_array(F.concat("base", F.coalesce("added", none))).alias("spans")
    )


def private_digest(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, digest of the base spans, and all spans."""
    return found(docs).select(
        "doc_id",
        *(count_of("base", k.name) for k in BASE),
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def sanitised(docs: DataFrame) -> DataFrame:
    """doc_id and the text with mentions and generalised terms replaced by ``<kind>`` and
    disclosing terms left out. Null texts stay null."""
    spans = found(docs).groupBy("text_key").agg(F.first("spans").alias("spans"))
    rows = docs.select("doc_id", "text", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_key"))
    label = lambda s: F.when(s["kind"] == "removed", "").otherwise(F.concat(F.lit("<"), s["kind"], F.lit(">")))
    return rows.join(spans, "text_key").select("doc_id", replaced(F.col("text"), F.col("spans"), label).alias("text"))
