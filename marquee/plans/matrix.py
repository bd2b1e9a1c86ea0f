"""The model matrix: typed columns of titles from several sources, and what is known by a day.

Columns are registered with their kind. Numbers stay as they are, logged signals become
ln(1 + x) unless never observed, categories become codes, label sets become 0/1 columns over a
vocabulary that is fitted once, stored and applied again at scoring. Day signals come as arrays in
the title's own row, one for each form, and become one column for each form and day; a model that
knows the first n days reads the columns up to day n. So the wide rows are a projection: nothing
long is built, shuffled or written for them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.constants import RARE_LABEL_SHARE
from marquee.functions.metrics import log1p_unless_never
from marquee.operators.pivots import common_labels, label_codes
from marquee.plans.features import KEY, FeatureChoice

NUMBER, LOGGED, CATEGORY, LABELS = "number", "logged", "category", "labels"
#: Which side of the launch a column is known on.
BEFORE, AFTER, ALWAYS = "before", "after", "always"
UNSEEN = -1


@dataclass(frozen=True)
class Field:
    """A column of the title table. ``share`` and ``drop`` concern label sets: the least share of
    titles that a label must be on, and labels that are never columns."""

    name: str
    kind: str = NUMBER
    known: str = ALWAYS
    prefix: str = ""
    share: float = RARE_LABEL_SHARE
    drop: tuple[str, ...] = ()


@dataclass(frozen=True)
class Registry:
    """The columns of a matrix. ``signals``: metrics of the days since launch; ``ahead``: signals
    by days before launch, of which a model reads the newest day that it knows, its first name
    being the one that predictions must not fall along."""

    fields: tuple[Field, ...]
    signals: tuple[str, ...] = ()
    last_day: int = 27
    ahead: tuple[str, ...] = ()
    first_day: int = -27
    log_ratio: bool = True

    def of_kind(self, *kinds: str) -> list[Field]:
        return [f for f in self.fields if f.kind in kinds]


def ahead_column(signal: str, days: int) -> str:
    return f"before{days:03d}_{signal}"


@dataclass(frozen=True)
class Vocabulary:
    """The labels that are columns, in slot order. Bounded: each is on a stated share of titles."""

    prefix: str
    labels: tuple[str, ...]

    @classmethod
    def fit(
        cls, rows: DataFrame, tokens: Column, prefix: str, share: float = RARE_LABEL_SHARE, drop: Sequence[str] = ()
    ) -> Vocabulary:
        """Labels on at least ``share`` of the rows, in order."""
        found = common_labels(rows, tokens, share, drop).select("token").collect()
        return cls(prefix, tuple(sorted(r.token for r in found)))

    @property
    def columns(self) -> list[str]:
        return [self.prefix + v.replace(" ", "_").replace(".", "_") for v in self.labels]

    def flags(self, tokens: Column) -> list[Column]:
        """One 0/1 column for each label. Labels that were not seen in fitting have none; a null
        set has no label."""
        has = lambda v: F.coalesce(F.array_contains(tokens, v).cast("int"), F.lit(0))
        return [has(v).alias(c) for v, c in zip(self.labels, self.columns, strict=True)]

    def flag_list(self, tokens: Column) -> Column:
        """``flags`` as one array, whose code does not grow with the vocabulary. The places of a
        title's own labels are looked up once (a list of one binds them for the inner lambda)."""
        listed = F.array(*map(F.lit, self.labels)) if self.labels else F.array().cast("array<string>")
        slots = F.array(*map(F.lit, range(len(self.labels)))) if self.labels else F.array().cast("array<int>")
        places = F.transform(F.coalesce(tokens, F.array()), lambda v: F.coalesce(F.array_position(listed, v), F.lit(0)).cast("int") - 1)
        return F.get(F.transform(F.array(places), lambda own: F.transform(slots, lambda i: F.array_contains(own, i).cast("int"))), 0)

    def slots(self, tokens: Column) -> Column:
        """The slots of the labels a title has, ascending: the sparse form of ``flags``."""
        listed = F.array(*map(F.lit, self.labels)) if self.labels else F.array().cast("array<string>")
        numbered = F.transform(listed, lambda v, i: F.when(F.array_contains(tokens, v), i))
        return F.filter(numbered, lambda i: i.isNotNull())

    def unseen(self, tokens: Column) -> Column:
        """How many labels of a title are no column."""
        listed = F.array(*map(F.lit, self.labels)) if self.labels else F.array().cast("array<string>")
        return F.coalesce(F.size(F.array_except(tokens, listed)), F.lit(0))


@dataclass(frozen=True)
class Matrix:
    """What was fitted: the registry, vocabularies by field, and codes by category."""

    registry: Registry
    vocabularies: dict[str, Vocabulary] = field(default_factory=dict)
    codes: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @classmethod
    def fit(cls, titles: DataFrame, registry: Registry) -> Matrix:
        """Vocabularies and codes of all titles. Label sets are arrays, categories few."""
        vocabularies = {
            f.name: Vocabulary.fit(titles, F.col(f.name), f.prefix, f.share, f.drop) for f in registry.of_kind(LABELS)
        }
        codes = {}
        for f in registry.of_kind(CATEGORY):
            rows = label_codes(titles.withColumn(f.name, F.col(f.name).cast("string")), f.name).orderBy("code").collect()
            codes[f.name] = tuple(r[f.name] for r in rows)
        return cls(registry, vocabularies, codes)

    def table(self, spark: SparkSession) -> DataFrame:
        """The fitted parts as rows: field, slot, value. ``of_table`` restores them."""
        rows = [(name, i, v) for name, values in self.codes.items() for i, v in enumerate(values)]
        rows += [(name, i, v) for name, v_ in self.vocabularies.items() for i, v in enumerate(v_.labels)]
        return spark.createDataFrame(rows, "field string, slot int, value string")

    @classmethod
    def of_table(cls, table: DataFrame, registry: Registry) -> Matrix:
        held: dict[str, list[str]] = {f.name: [] for f in registry.of_kind(LABELS, CATEGORY)}
        for r in sorted(table.collect(), key=lambda r: (r.field, r.slot)):
            held[r.field].append(r.value)
        vocabularies = {f.name: Vocabulary(f.prefix, tuple(held[f.name])) for f in registry.of_kind(LABELS)}
        return cls(registry, vocabularies, {f.name: tuple(held[f.name]) for f in registry.of_kind(CATEGORY)})

    def title_columns(self, titles: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """One row for each title with the columns of all fields, and those to ``keep``; no shuffle."""
        flags = {f"_flags_{f.name}": self.vocabularies[f.name].flag_list(F.col(f.name)) for f in self.registry.of_kind(LABELS)}
        out: list[Column] = [F.col(KEY)]
        for f in self.registry.fields:
            value = F.col(f.name)
            if f.kind == LABELS:
                listed = F.col(f"_flags_{f.name}")
                out += [F.get(listed, i).alias(c) for i, c in enumerate(self.vocabularies[f.name].columns)]
            elif f.kind == CATEGORY:
                listed = F.array(*map(F.lit, self.codes[f.name])) if self.codes[f.name] else F.array().cast("array<string>")
                place = F.array_position(listed, value.cast("string")).cast("int") - 1
                out.append(F.coalesce(F.when(place >= 0, place), F.lit(UNSEEN)).alias(f.name))
            elif f.kind == LOGGED:
                out.append(log1p_unless_never(value.cast("double")).alias(f.name))
            else:
                out.append(value.cast("double").alias(f.name))
        return titles.withColumns(flags).select(*out, *keep)

    def wide(
        self,
        titles: DataFrame,
        signals: Mapping[str, str] | None = None,
        ahead: Mapping[str, str] | None = None,
        keep: Sequence[str] = (),
    ) -> DataFrame:
        """One row for each title: field columns, a column for each form and day of the signals,
        one for each day before launch of the signals ahead, and the columns to ``keep``.

        ``signals``: by form (``log_<signal>``, ``log_ratio_<signal>``, or the signal itself where
        it is logged already) the array column of its values on days 1, 2, ... ``ahead``: by signal
        the array column of its values 0, 1, ... days before launch. Arrays may be null or short:
        those values are null. No shuffle.
        """
        days: list[tuple[str, str, int]] = []
        if signals is not None and self.registry.signals:
            spans = self._spans(self.registry.last_day, whole=True)
            days += [(f"day{d:03d}_{m}", signals[m], d - 1) for m, low, high in spans for d in range(low, high + 1)]
        if ahead is not None:
            before = range(0, 1 - self.registry.first_day)
            days += [(ahead_column(s, d), ahead[s], d) for s in self.registry.ahead for d in before]
        arrays = sorted({a for _, a, _ in days} - set(keep))
        rows = self.title_columns(titles, [*keep, *arrays])
        fields = [c for c in rows.columns if c not in {*arrays, *keep}]
        return rows.select(*fields, *(F.get(a, F.lit(i)).alias(c) for c, a, i in days), *keep)

    def _spans(self, last_day: int, whole: bool = False) -> list[tuple[str, int, int]]:
        choice = FeatureChoice(last_day, log_ratio=self.registry.log_ratio, cumulative_cost=not whole)
        return choice.spans(self.registry.signals)

    def columns(self, known_day: int) -> list[str]:
        """The columns that a model may read when it knows the days up to ``known_day``: before
        day 1 the signals ahead of launch of that day, from day 1 on the day signals."""
        side = BEFORE if known_day < 1 else AFTER
        out = []
        for f in self.registry.fields:
            if f.known in (ALWAYS, side):
                out += self.vocabularies[f.name].columns if f.kind == LABELS else [f.name]
        if known_day < 1:
            return out + [ahead_column(s, -known_day) for s in self.registry.ahead]
        return out + [f"day{d:03d}_{m}" for m, low, high in self._spans(known_day) for d in range(low, high + 1)]

    def rising(self, known_day: int) -> list[str]:
        """Columns along which a model of the days before launch never falls."""
        return [ahead_column(s, -known_day) for s in self.registry.ahead[:1]] if known_day < 1 else []


def missing_flags(rows: DataFrame, columns: Sequence[str], sentinel: float = -1.0) -> tuple[DataFrame, list[str]]:
    """For learners that take no missing values: the sentinel in their place, and a 0/1 column
    that keeps the fact. Returns the rows and all columns, flags behind."""
    flags = {f"{c}__missing": F.col(c).isNull().cast("int") for c in columns}
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(sentinel)) for c in columns}
    return rows.withColumns(flags).withColumns(filled), [*columns, *flags]


def vectors(wide: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    """One vector of the columns and of their missing flags, sparse where that is shorter."""
    rows, every = missing_flags(wide, columns)
    return VectorAssembler(inputCols=every, outputCol=out).transform(rows)
