"""Growth-trend neighbours: what became of titles that started the same way."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.constants import EMBARGO_DAYS, NO_NEIGHBOUR

BLOCK_ROWS = 2048
TILE = 1 << 20  # distances that a task holds at a time
_CANDIDATE = "id string, neighbour string, distance double, neighbour_target double"


def _edges(df: DataFrame, block_rows: int) -> list[int]:
    """Launch times that cut the rows into blocks of about ``block_rows``: one number a block."""
    count = -(-df.count() // block_rows)
    shares = [i / count for i in range(1, count)]
    return sorted({int(e) for e in df.approxQuantile("at_us", shares, 0.1 / count)}) if shares else []


def _block(edges: list[int]) -> Column:
    if not edges:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e <= F.col("at_us")))


def _closest(left: np.ndarray, right: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row of ``left`` its k nearest allowed rows of ``right``: row, place and distance,
    nearest first, equal distances by place.

    One matrix product gives all squared distances up to rounding; those that may be among the
    first k within its error are taken again exactly.
    """
    size = (left**2).sum(1)[:, None] + (right**2).sum(1)[None, :]
    rough = np.where(allowed, size - 2 * left @ right.T, np.inf)
    n = min(k, rough.shape[1])
    limit = np.partition(rough, n - 1, axis=1)[:, n - 1 : n]
    error = 1e-12 * left.shape[1] * size.max(initial=0.0, where=np.isfinite(size))
    row, place = np.nonzero(allowed & (rough <= limit + 2 * error))
    exact = np.sqrt(((right[place] - left[row]) ** 2).sum(axis=1))
    order = np.lexsort((place, exact, row))
    row, place, exact = row[order], place[order], exact[order]
    first = np.searchsorted(row, row)
    keep = np.arange(len(row)) - first < k
    return row[keep], place[keep], exact[keep]


def _nearest(k: int, embargo_us: int):
    def search(key, query: pd.DataFrame, base: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(query) and len(base):
            base = base.sort_values("id", kind="stable")  # equal distances keep the order of ids
            left = np.stack(query["curve"].to_numpy()).astype(float)
            right = np.stack(base["curve"].to_numpy()).astype(float)
            base_at, query_at = base["at_us"].to_numpy(), query["at_us"].to_numpy()
            names, targets, own = base["id"].to_numpy(), base["target"].to_numpy(), query["id"].to_numpy()
            step = max(1, TILE // len(base))
            for at in range(0, len(query), step):
                some = slice(at, at + step)
                allowed = base_at[None, :] + embargo_us < query_at[some, None]
                row, place, distance = _closest(left[some], right, allowed, k)
                parts.append((own[some][row], names[place], distance, targets[place]))
        columns = [np.concatenate([p[i] for p in parts]) if parts else [] for i in range(4)]
        kinds = {"id": str, "neighbour": str, "distance": float, "neighbour_target": float}
        return pd.DataFrame(dict(zip(kinds, columns, strict=True))).astype(kinds)

    return search


def trend_neighbours(
    titles: DataFrame,
    k: int,
    embargo_days: int = EMBARGO_DAYS,
    block_rows: int = BLOCK_ROWS,
    after: str | None = None,
) -> DataFrame:
    """The k nearest observed titles launched more than ``embargo_days`` earlier.

    ``titles`` has id (string), launched_at, curve (array) and target, null where
    not observed yet. Only titles launched after ``after`` look for neighbours. Both
    sides are cut by launch time into blocks of about ``block_rows`` rows, and pairs of
    blocks that the embargo rules out are never formed. One task compares one pair and
    returns k rows per title, so neither side has to fit in a task.
    Result: ``id``, ``rank`` (1 = nearest), ``neighbour``, ``neighbour_target``.
    """
    rows = titles.select(
        "id", F.unix_micros("launched_at").alias("at_us"), "curve", F.col("target").cast("double").alias("target")
    )
    query, base = rows.drop("target"), rows.where(F.col("target").isNotNull())
    if after is not None:
        query = query.where(F.col("at_us") > F.unix_micros(F.lit(after).cast("timestamp")))
    embargo = embargo_days * 86_400_000_000
    q_edges, b_edges = _edges(query, block_rows), _edges(base, block_rows)
    # the last block of the base that begins early enough for each block of the queries
    last = [sum(b <= top - embargo for b in b_edges) for top in q_edges] + [len(b_edges)]
    first = [next(q for q, b in enumerate(last) if b >= i) for i in range(len(b_edges) + 1)]
    of = lambda values, block: F.get(F.array(*map(F.lit, values)), F.col(block))
    query = query.withColumn("q_block", _block(q_edges)).withColumn(
        "b_block", F.explode(F.sequence(F.lit(0), of(last, "q_block")))
    )
    base = base.withColumn("b_block", _block(b_edges)).withColumn(
        "q_block", F.explode(F.sequence(of(first, "b_block"), F.lit(len(q_edges))))
    )
    pair = ["q_block", "b_block"]
    found = (
        query.groupBy(*pair)
        .cogroup(base.groupBy(*pair))
        .applyInPandas(_nearest(k, embargo), _CANDIDATE)
    )
    ranked = F.slice(
        F.array_sort(F.collect_list(F.struct("distance", "neighbour", "neighbour_target"))), 1, k
    )
    # k candidates per block of the base: small per title
    return (
        found.groupBy("id")
        .agg(ranked.alias("_found"))
        .select("id", F.posexplode("_found").alias("_pos", "_n"))
        .select(
            "id",
            (F.col("_pos") + 1).alias("rank"),
            F.col("_n.neighbour").alias("neighbour"),
            F.col("_n.neighbour_target").alias("neighbour_target"),
        )
    )


def trend_features(titles: DataFrame, neighbours: DataFrame, k: int) -> DataFrame:
    """``growth_trend_<i>_order`` columns, -2 where a title has no such neighbour."""
    wide = neighbours.groupBy("id").pivot("rank", list(range(1, k + 1))).agg(
        F.max("neighbour_target")
    )
    names = {str(i): f"growth_trend_{i}_order" for i in range(1, k + 1)}
    return (
        titles.select("id")
        .join(wide, "id", "left")
        .select(
            "id",
            *[F.coalesce(F.col(c), F.lit(NO_NEIGHBOUR)).alias(n) for c, n in names.items()],
        )
    )
