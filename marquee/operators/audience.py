"""How many users had at least one period inside each of many windows.

Joining windows with periods multiplies users by launches. The count splits into
three parts that need no such join, because the islands of a user are disjoint:

    islands that start by the window end
  - islands that end before the window start
  - gaps between islands of one user that lie inside the window

The first two are running counts over time, read at the window edges. So is the
third, once gaps are counted by the calendar day, hour or minute they start in: a
window holds whole days, before them whole hours of its first day, before those
whole minutes of its first hour, and the gaps that start in its first minute.

Where the windows have few different edges, as launches on a calendar do, all three come
from one pass: each moment is placed among the edges, and counts by a gap's place among the
openings and among the closes are summed up over both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.dates import add_days

HOUR_US = 3_600_000_000
MINUTE_US = 60_000_000
DAY_US = 24 * HOUR_US


def _unit(moment: Column, micros: int) -> Column:
    return F.floor(F.unix_micros(moment) / F.lit(micros)).cast("long")


def events_up_to(
    events: DataFrame,
    event: str,
    points: DataFrame,
    point: str,
    inclusive: bool = True,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Number of events at or before (or strictly before) each distinct point, per key.

    Events are combined before the shuffle: by the hour, and in hours that hold a
    point by the moment. Windows then run over the moments and points of one hour,
    the hours of one day, and the days. Only the last knows no smaller part, and the
    calendar bounds it. Result: ``keys``, ``point``, ``n_events``.
    """
    keys = list(keys)
    points = points.select(*keys, F.col(point).alias("_at")).distinct()
    points = points.withColumn("_hour", _unit(F.col("_at"), HOUR_US))
    fine = points.select(*keys, "_hour").distinct().withColumn("_fine", F.lit(True))
    counts = (
        events.where(F.col(event).isNotNull())
        .select(*keys, F.col(event).alias("_at"), _unit(F.col(event), HOUR_US).alias("_hour"))
        .join(fine, [*keys, "_hour"], "left")
        .groupBy(*keys, "_hour", F.when(F.col("_fine"), F.col("_at")).alias("_at"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    marks = counts.withColumn("_point", F.lit(False)).unionByName(
        points.select(*keys, "_hour", "_at", F.lit(0).cast("long").alias("_n"), F.lit(True).alias("_point"))
    )
    first = F.col("_point").asc() if inclusive else F.col("_point").desc()
    in_hour = (
        Window.partitionBy(*keys, "_hour").orderBy("_at", first).rowsBetween(Window.unboundedPreceding, 0)
    )
    read = marks.withColumn("_local", F.sum("_n").over(in_hour)).where("_point")
    day = F.floor(F.col("_hour") / 24).alias("_day")
    hours = marks.groupBy(*keys, "_hour").agg(F.sum("_n").alias("_n")).withColumn("_day", day)
    earlier = Window.partitionBy(*keys, "_day").orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = hours.withColumn("_in_day", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    # one row per day: the calendar bounds this window
    before = Window.partitionBy(*keys).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = hours.groupBy(*keys, "_day").agg(F.sum("_n").alias("_n"))
    days = days.select(*keys, "_day", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_carry"))
    carried = hours.join(days, [*keys, "_day"]).select(
        *keys, "_hour", (F.col("_in_day") + F.col("_carry")).alias("_carry")
    )
    return read.join(carried, [*keys, "_hour"]).select(
        *keys, F.col("_at").alias(point), (F.col("_local") + F.col("_carry")).alias("n_events")
    )


def gaps_inside(gaps: DataFrame, grid: DataFrame, start: str, end: str) -> DataFrame:
    """Gaps that lie inside each window of ``grid`` (``opens``, ``closes``).

    A window asks for one count per day, hour and minute that it is made of, each of the
    gaps that start there and end by its close. Work grows with gaps plus windows; only
    moments within the same minute ever meet. Result: ``opens``, ``closes``, ``n_gaps``.
    """
    windows = grid.select("opens", "closes").distinct()
    sizes = (DAY_US, HOUR_US, MINUTE_US)

    def parts(i: int) -> Column:
        """Units of size i after the one that holds the start, within the next larger unit."""
        first = _unit(F.col("opens"), sizes[i]) + 1
        last = _unit(F.col("closes"), sizes[i])
        if i:
            each = sizes[i - 1] // sizes[i]
            last = F.least(last, (_unit(F.col("opens"), sizes[i - 1]) + 1) * each - 1)
        return F.when(first <= last, F.sequence(first, last))

    asked = None
    for i in range(len(sizes)):
        rows = windows.select("opens", "closes", F.lit(i).alias("_size"), F.explode(parts(i)).alias("_part"))
        asked = rows if asked is None else asked.unionByName(rows)
    moment = F.unix_micros("opens")
    asked = asked.unionByName(
        windows.select("opens", "closes", F.lit(len(sizes)).alias("_size"), moment.alias("_part"))
    )
    needed = asked.select("_size", "_part").distinct()
    starts = [F.struct(F.lit(i).alias("_size"), _unit(F.col(start), m).alias("_part")) for i, m in enumerate(sizes)]
    whole = gaps.select(F.col(end).alias("_ends"), F.inline(F.array(*starts))).join(
        needed.where(F.col("_size") < len(sizes)), ["_size", "_part"], "left_semi"
    )
    opened = windows.select("opens", _unit(F.col("opens"), MINUTE_US).alias("_minute")).distinct()
    same_minute = (
        gaps.select(F.col(start).alias("_from"), F.col(end).alias("_ends"))
        .withColumn("_minute", _unit(F.col("_from"), MINUTE_US))
        .join(opened, "_minute")
        .where(F.col("_from") >= F.col("opens"))
        .select("_ends", F.lit(len(sizes)).alias("_size"), moment.alias("_part"))
    )
    counts = events_up_to(
        whole.unionByName(same_minute), "_ends", asked, "closes", keys=["_size", "_part"]
    )
    return (
        asked.join(counts, ["_size", "_part", "closes"])
        .groupBy("opens", "closes")
        .agg(F.sum("n_events").alias("n_gaps"))
    )


EDGES = 10_000
CELLS = 2_000_000


def _place(edges: str, moment: Column, strict: bool) -> Column:
    """How many edges are before the moment, or at it too unless ``strict``. The edges are a sorted
    array of rows of about the square root of their number, so two short looks find the place."""
    at = F.unix_micros(moment)
    below = (lambda e: e < at) if strict else (lambda e: e <= at)
    row = F.size(F.filter(edges, lambda r: below(r[0]))) - 1
    width = F.size(F.get(edges, F.lit(0)))
    return F.when(row < 0, 0).otherwise(row * width + F.size(F.filter(F.get(edges, row), below)))


def _direct_counts(
    islands: DataFrame, grid: DataFrame, opens: list[int], closes: list[int], user_start: str, user_end: str
) -> DataFrame:
    """``audience_counts`` for windows of few different edges (sorted microseconds).

    A moment is by the close number c where c is at least the number of closes before it, and
    at or after the opening number o where o is below the number of openings up to it.
    """
    spark = islands.sparkSession

    def rows_of(edges: list[int]) -> list[list[int]]:
        width = max(1, int(len(edges) ** 0.5))
        return [edges[i : i + width] for i in range(0, len(edges), width)]

    schema = "_opens array<array<bigint>>, _closes array<array<bigint>>"
    edges = spark.createDataFrame([(rows_of(opens), rows_of(closes))], schema)  # one row
    by_close = _place("_closes", F.col(user_start), strict=True)
    counted = [
        F.struct(F.lit(0).alias("kind"), F.lit(0).alias("o"), by_close.alias("c")),
        F.struct(F.lit(1).alias("kind"), _place("_opens", F.col(user_end), strict=False).alias("o"), F.lit(0).alias("c")),
        F.struct(F.lit(2).alias("kind"), _place("_opens", F.col("previous_end"), strict=False).alias("o"), by_close.alias("c")),
    ]
    cells = (
        islands.select(user_start, user_end, "previous_end")
        .crossJoin(F.broadcast(edges))
        .select("previous_end", F.inline(F.array(*counted)))
        .where((F.col("kind") < 2) | F.col("previous_end").isNotNull())
        .groupBy("kind", "o", "c")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    # At most CELLS rows from here on. Ends before opening o: all that are not at or after it.
    every_o = spark.range(len(opens)).select(F.col("id").cast("int").alias("o"))
    every_c = spark.range(len(closes)).select(F.col("id").cast("int").alias("c"))
    started = every_c.join(cells.where("kind = 0").select("c", "_n"), "c", "left")
    started = started.select("c", F.coalesce(F.sum("_n").over(Window.orderBy("c")), F.lit(0)).alias("_started"))
    ended = every_o.join(cells.where("kind = 1").select("o", "_n"), "o", "left")
    ended = ended.select("o", F.coalesce(F.sum("_n").over(Window.orderBy("o")), F.lit(0)).alias("_ended"))
    # A gap of place o is inside the windows of all openings below o, so it counts at o - 1 down.
    inner = cells.where("kind = 2 and o > 0").select((F.col("o") - 1).alias("o"), "c", "_n")
    dense = every_o.crossJoin(F.broadcast(every_c)).join(inner, ["o", "c"], "left")
    up, down = Window.partitionBy("o").orderBy("c"), Window.partitionBy("c").orderBy(F.desc("o"))
    dense = dense.withColumn("_n", F.coalesce(F.sum("_n").over(up), F.lit(0)))
    dense = dense.select("o", "c", F.sum("_n").over(down).alias("_gaps"))
    numbered = lambda name, edges: spark.createDataFrame(
        list(zip(range(len(edges)), edges, strict=True)), f"{name} int, _{name} bigint"
    )
    windows = grid.join(F.broadcast(numbered("o", opens)), F.unix_micros("opens") == F.col("_o"))
    windows = windows.join(F.broadcast(numbered("c", closes)), F.unix_micros("closes") == F.col("_c"))
    users = F.col("_started") - F.col("_ended") - F.col("_gaps")
    found = windows.join(started, "c").join(ended, "o").join(dense, ["o", "c"])
    return found.select("opens", "launch", "n", users.alias("users"))


def _edges(anchors: DataFrame, days: Sequence[int]) -> tuple[list[int], list[int]] | None:
    """The sorted microseconds at which windows open and close, if they are few."""
    found = anchors.select(*(F.unix_micros(c) for c in ("opens", "launch"))).distinct().limit(EDGES + 1).collect()
    if not 0 < len(found) <= EDGES:
        return None
    windows = [(opens, launch + n * DAY_US) for opens, launch in found for n in days]
    opens, closes = (sorted({w[i] for w in windows if w[0] <= w[1]}) for i in (0, 1))
    few = 0 < len(closes) <= EDGES and len(opens) * len(closes) <= CELLS
    return (opens, closes) if few else None


def audience_counts(
    islands: DataFrame, anchors: DataFrame, days: Sequence[int], user_start: str, user_end: str
) -> DataFrame:
    """Distinct users with a period reaching into ``[opens, launch + n days]``.

    ``islands`` come from ``merge_intervals`` keyed by user. ``anchors`` has the
    columns ``opens`` and ``launch``; the window of day n runs from ``opens`` to
    ``launch + n days`` and counts only where it is not empty.
    Result: ``opens``, ``launch``, ``n``, ``users``.
    """
    anchors = anchors.select("opens", "launch").distinct()
    grid = (
        anchors.withColumn("n", F.explode(F.array(*[F.lit(d) for d in days])))
        .withColumn("closes", add_days(F.col("launch"), F.col("n")))
        .where(F.col("closes") >= F.col("opens"))
    )
    edges = _edges(anchors, days)
    if edges is not None:
        return _direct_counts(islands, grid, *edges, user_start, user_end)
    started = events_up_to(islands, user_start, grid, "closes").withColumnRenamed("n_events", "_started")
    ended = events_up_to(islands, user_end, anchors, "opens", inclusive=False).withColumnRenamed(
        "n_events", "_ended"
    )
    inner = gaps_inside(islands.where(F.col("previous_end").isNotNull()), grid, "previous_end", user_start)
    return (
        grid.join(started, "closes", "left")
        .join(ended, "opens", "left")
        .join(inner, ["opens", "closes"], "left")
        .select(
            "opens",
            "launch",
            "n",
            (
                F.coalesce("_started", F.lit(0)) - F.coalesce("_ended", F.lit(0)) - F.coalesce("n_gaps", F.lit(0))
            ).alias("users"),
        )
    )
