"""Secret scan: fixed patterns, and windows of high Shannon entropy in candidate strings.

A candidate is a whole run of 20 or more characters that keys are written in. Stretches that an
allow-list names (placeholders, runs of one character, counting) suppress the windows that
touch them: they cut the run into parts. A part's class sets the alphabet and the threshold:
lower-case hex, upper-case hex, letters without a digit, or any (base64 and alike). A window of
20 characters slides over it; the counts of the window's characters, and with them the sum of
c*log2(c), change by the character that enters and the one that leaves. What the windows over
the threshold cover is a span, unless the part as a whole is harmless. Only native functions run.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import texts_of
from marquee.llm.spans import SPAN, Kind, bound, count_of, joined, replaced, with_spans

BASE = (
    Kind(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda value: F.length(value) >= 6,
        group=2,
    ),
    Kind("access", r"AKIA[A-Z0-9]{16,}", lambda hit: F.lit(True)),
    Kind("hex", r"[0-9a-f]{24,}", lambda hit: F.lit(True)),
)

WINDOW = 20
COUNTS = 8  # counts of characters that share a number, eight bits each
SIGNS = "A-Za-z0-9+/_=-"
#: Class: its test, alphabet and least bits a character in a window. Letters alone must look
#: more random than letters with digits: words joined in mixed case come near.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CLASSES = (
    ("entropy_hex", r"^[0-9a-f]+$", "0123456789abcdef", 3.0),
    ("entropy_upper_hex", r"^[0-9A-F]+$", "0123456789ABCDEF", 3.0),
    ("entropy_letters", r"^[^0-9]+$", LETTERS, 4.05),
    ("entropy_any", None, LETTERS, 3.75),
)
#: Stretches whose windows are suppressed, besides eight and more equal characters.
QUIET = r"(?i:example|sample|placeholder|dummy|changeme|your[_-]?key|abcdefgh|01234567|12345678|qwerty)"
#: Harmless parts: numbers with separators, UUIDs, file paths and slugs of plain words, each in
#: lower case, upper case or capitalised, with a number at the end.
ALLOWED = (
    r"^[0-9/_=+-]+$",
    r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^[/_=+-]*+(?:(?:[A-Z]?[a-z]++|[A-Z]++)[/_=+-]++)*+(?:[A-Z]?[a-z]++|[A-Z]++)?[/_=+-]?[0-9]{0,4}$",
)


def quiet(group: int) -> str:
    """Stretches that suppress; ``group`` is the number that the capturing group in it gets."""
    return rf"{QUIET}|([{SIGNS}])\{group}{{7,}}"


#: The parts of a long run one by one, suppressing stretches among them: from the start of the
#: run, or from the end of the part before.
PART = rf"(?:(?<![{SIGNS}])(?=[{SIGNS}]{{{WINDOW}}})|\G(?<=[{SIGNS}]))(?:{quiet(1)}|(?:(?!{quiet(2)})[{SIGNS}])++)"


def entropy_span(hit: Column, alphabet: str, least: float, window: int = WINDOW) -> Column:
    """struct(first, last): start of the first and end of the last window over ``least`` bits;
    first is -1 when there is none. The string is taken apart once; each step changes the
    counts of the character that enters and the one that leaves."""
    share = [c * math.log2(c) if c else 0.0 for c in range(window + 2)]
    table = F.array(*(F.lit(x) for x in share))
    zeros = F.array_repeat(F.lit(0).cast("long"), -(-len(alphabet) // COUNTS))
    start = F.struct(
        zeros.alias("counts"), F.lit(0.0).alias("sum"), F.lit(-1).alias("first"), F.lit(-1).alias("last")
    )
    shift = lambda name, value, bits: F.call_function(name, value, bits)

    def steps(codes: Column) -> Column:
        def step(code: Column, i: Column) -> Column:
            left = F.when(i >= window, F.get(codes, i - window)).otherwise(-COUNTS)  # a word that is not there
            parts = {"in": code, "out": left}
            words = [F.shiftright(c, 3).alias(f"{n}_word") for n, c in parts.items()]
            bits = [F.shiftleft(c.bitwiseAND(COUNTS - 1), 3).alias(f"{n}_bits") for n, c in parts.items()]
            return F.struct(*words, *bits, i.alias("i"))

        return F.transform(codes, step)

    def slid(a: Column, x: Column) -> Column:
        count = lambda n: shift("shiftright", F.get(a["counts"], x[f"{n}_word"]), x[f"{n}_bits"]).bitwiseAND(255).cast("int")
        unit = lambda n: shift("shiftleft", F.lit(1).cast("long"), x[f"{n}_bits"])
        moved = lambda n, j: F.when(j == x[f"{n}_word"], unit(n)).otherwise(0)
        gone = count("out")  # null while nothing leaves
        same = (x["in_word"] == x["out_word"]) & (x["in_bits"] == x["out_bits"])
        had = count("in") - same.cast("int")
        total = a["sum"] - F.coalesce(F.get(table, gone) - F.get(table, gone - 1), F.lit(0.0)) + F.get(table, had + 1) - F.get(table, had)
        counts = F.transform(a["counts"], lambda c, j: c + moved("in", j) - moved("out", j))
        return F.struct(counts.alias("counts"), total.alias("sum"), a["first"], a["last"])

    def marked(a: Column, x: Column) -> Column:
        high = (x["i"] >= window - 1) & (F.lit(math.log2(window)) - a["sum"] / window >= least)
        return F.struct(
            a["counts"],
            a["sum"],
            F.when(high & (a["first"] < 0), x["i"] - window + 1).otherwise(a["first"]).alias("first"),
            F.when(high, x["i"] + 1).otherwise(a["last"]).alias("last"),
        )

    codes = F.transform(F.split(hit, ""), lambda c: F.instr(F.lit(alphabet), c) - 1)
    return F.aggregate(
        bound(codes, steps),
        start,
        lambda a, x: bound(slid(a, x), lambda new: marked(new, x)),
        lambda a: F.struct(a["first"], a["last"]),
    )


def allowed(hit: Column) -> Column:
    out = F.lit(False)
    for pattern in ALLOWED:
        out = out | hit.rlike(pattern)
    return out


def rated(part: Column) -> Column:
    """Whether a part is long enough, does not suppress and is not harmless as a whole."""
    return (F.length(part) >= WINDOW) & ~part.rlike(f"^(?:{quiet(1)})$") & ~allowed(part)


def scan(docs: DataFrame, *columns: str) -> DataFrame:
    """doc_id, text, the named columns, ``base`` and ``spans``: sorted arrays of spans.

    Null texts count as empty; both give no spans. Rows are independent: repeated rows and
    null ids stay, an empty table gives no rows. Whole texts are scanned, very long texts and
    candidates in time that grows with their length. Added spans may overlap base ones, which
    always stay.
    """
    df = texts_of(docs, *columns)
    keep = df.columns
    df = with_spans(df, [*BASE, Kind("candidate", PART, rated)])
    found = F.col("_s_candidate")
    rates = F.transform(found, lambda s: F.struct(s.alias("s"), rate(s["hit"]).alias("r")))
    df = df.withColumn("_rated", F.when(F.size(found) > 0, rates))
    high = F.transform(
        F.filter("_rated", lambda x: x["r"]["at"]["first"] >= 0),
        lambda x: F.struct(
            (x["s"]["start"] + x["r"]["at"]["first"]).alias("start"),
            x["r"]["ord"].alias("ord"),
            x["r"]["kind"].alias("kind"),
            (x["s"]["start"] + x["r"]["at"]["last"]).alias("end"),
            x["s"]["hit"].alias("hit"),
        ),
    ).cast(SPAN)
    base = F.concat(*(f"_s_{k.name}" for k in BASE))
    return df.select(
        *keep,
        F.sort_array(base).alias("base"),
        F.sort_array(F.concat(base, F.coalesce(high, F.expr(f"cast(array() as {SPAN})")))).alias("spans"),
    )


def rate(hit: Column) -> Column:
    """Class of a candidate and where its windows are over the class's threshold."""
    out = None
    for order, (name, test, alphabet, least) in reversed(list(enumerate(CLASSES, len(BASE)))):
        one = F.struct(
            F.lit(order).alias("ord"), F.lit(name).alias("kind"), entropy_span(hit, alphabet, least).alias("at")
        )
        out = one if test is None else F.when(hit.rlike(test), one).otherwise(out)
    return out


def secret_digest(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, digest of the base spans, and all spans."""
    rows = scan(docs)
    return rows.select(
        "doc_id",
        *(count_of("base", k.name) for k in BASE),
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """doc_id, text with every span replaced by ``<kind>``, lang, source and n_chars (of the new
    text). Null texts stay null."""
    rows = scan(docs.withColumn("_null", F.col("text").isNull()), "lang", "source", "_null")
    text = replaced(F.col("text"), F.col("spans"), lambda s: F.concat(F.lit("<"), s["kind"], F.lit(">")))
    rows = rows.select("doc_id", F.when(~F.col("_null"), text).alias("text"), "lang", "source")
    return rows.withColumn("n_chars", F.length("text").cast("long"))
