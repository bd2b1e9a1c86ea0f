"""Pattern spans by native functions: where the matches of a regular expression lie in a text.

Spark returns matches without their places. Splitting the text by the same expression gives
the stretches between the matches, and running sums over the lengths of both give the places,
in code points.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,ord:int,kind:string,end:int,hit:string>>"
BLOCK = 256


@dataclass(frozen=True)
class Kind:
    """Matches of ``pattern`` (leftmost, non-overlapping) whose ``group`` satisfies ``keep``."""

    name: str
    pattern: str
    keep: Callable[[Column], Column]
    group: int = 0


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of the value, which is computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def running(values: Column, size: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For each place what ``join`` makes of 0 and all values before it. It runs in blocks, and
    over the blocks' own results, so long arrays cost little more than their length."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((size - 1) / BLOCK).cast("int")),
        lambda b: F.slice(values, b * BLOCK + 1, F.lit(BLOCK)),
    )
    empty = F.expr("cast(array() as array<int>)")

    def prefix(items: Column, step: Callable[[Column], Column]) -> Column:
        start = F.struct(F.lit(0).alias("total"), empty.alias("out"))
        return F.aggregate(
            items,
            start,
            lambda a, x: F.struct(
                join(a["total"], step(x)).alias("total"), F.concat(a["out"], F.array(a["total"])).alias("out")
            ),
            lambda a: a["out"],
        )

    def total(block: Column) -> Column:
        return F.aggregate(block, F.lit(0), join)

    inner = F.transform(blocks, lambda b: prefix(b, lambda x: x))
    return F.flatten(
        F.zip_with(inner, prefix(blocks, total), lambda block, before: F.transform(block, lambda x: join(before, x)))
    )


def running_sums(values: Column, size: Column) -> Column:
    """For each place the sum of all values before it."""
    return running(values, size, lambda a, x: a + x)


def with_spans(df: DataFrame, kinds: Sequence[Kind], text: str = "text", prefix: str = "_s") -> DataFrame:
    """Adds ``<prefix>_<kind>`` columns: arrays of spans, in order. Texts must not be null."""
    empty = F.expr(f"cast(array() as {SPAN})")
    names = {k.name: f"{prefix}_{k.name}" for k in kinds}
    keep = [c for c in df.columns]
    df = df.withColumns(
        {f"{n}_h": F.regexp_extract_all(text, F.lit(k.pattern), F.lit(0)) for k in kinds for n in [names[k.name]]}
    )
    more = {}
    for k in kinds:
        n = names[k.name]
        some = F.size(f"{n}_h") > 0
        more[f"{n}_g"] = F.when(some, F.split(text, k.pattern, -1))
        more[f"{n}_e"] = (
            F.when(some, F.regexp_extract_all(text, F.lit(k.pattern), F.lit(k.group))) if k.group else F.col(f"{n}_h")
        )
    df = df.withColumns(more)
    df = df.withColumns(
        {
            f"{n}_l": F.when(
                F.size(f"{n}_h") > 0,
                F.zip_with(
                    F.slice(f"{n}_g", F.lit(1), F.size(f"{n}_h")), f"{n}_h", lambda g, h: F.length(g) + F.length(h)
                ),
            )
            for n in names.values()
        }
    )
    df = df.withColumns(
        {
            f"{n}_r": F.when(F.size(f"{n}_h") > 0, running_sums(F.col(f"{n}_l"), F.size(f"{n}_h")))
            for n in names.values()
        }
    )

    def span(order: int, kind: Kind) -> Column:
        n = names[kind.name]

        def at(i: Column) -> Column:
            hit, start = F.get(f"{n}_h", i), F.get(f"{n}_r", i) + F.length(F.get(f"{n}_g", i))
            return F.struct(
                start.alias("start"),
                F.lit(order).alias("ord"),
                F.lit(kind.name).alias("kind"),
                (start + F.length(hit)).alias("end"),
                hit.alias("hit"),
            )

        kept = F.filter(
            F.sequence(F.lit(0), F.size(f"{n}_h") - 1), lambda i: kind.keep(F.get(f"{n}_e", i))
        )
        return F.when(F.size(f"{n}_h") > 0, F.transform(kept, at)).otherwise(empty).cast(SPAN)

    return df.select(*keep, *(span(i, k).alias(names[k.name]) for i, k in enumerate(kinds)))


def count_of(spans: str, kind: str) -> Column:
    """n_<kind>: how many of the spans are of the kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def joined(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def replaced(text: Column, spans: Column, label: Callable[[Column], Column]) -> Column:
    """The text with each span replaced by its label; of overlapping spans the later part of a
    second one goes without a label of its own. Spans must be sorted by start. The text is cut
    into blocks once, so that the cost of a span does not grow with its place."""

    def between(blocks: Column, first: Column, last: Column) -> Column:
        at = F.floor(first / BLOCK).cast("int")
        some = F.slice(blocks, at + 1, F.floor((last - 1) / BLOCK).cast("int") - at + 1)
        return F.when(first >= last, "").otherwise(F.substring(F.array_join(some, ""), first - at * BLOCK + 1, last - first))

    def built(blocks: Column, spans: Column, ends: Column) -> Column:
        parts = F.zip_with(
            spans,
            ends,
            lambda s, at: F.when(s["start"] >= at, F.concat(between(blocks, at, s["start"]), label(s))).otherwise(""),
        )
        last = F.array_max(F.transform(spans, lambda s: s["end"]))
        return F.concat(F.array_join(parts, ""), between(blocks, last, F.greatest(last, F.length(text))))

    cut = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % BLOCK), F.lit(0))  # noqa: UP031
    after = lambda spans: running(F.transform(spans, lambda s: s["end"]), F.size(spans), lambda a, x: F.greatest(a, x))
    whole = bound(cut, lambda b: bound(spans, lambda s: bound(after(s), lambda at: built(b, s, at))))
    return F.when(F.size(spans) == 0, text).otherwise(whole)
