"""The learner of ``trees.py`` over labelled rows of any number, which stay on the executors.

Rows are held in blocks of some thousands: as numbers of the ranges between all cuts that some
model makes, with the predictions so far. Models grow side by side, level by level: a Spark job
brings the rows and slopes in the slots of all nodes of a level to the driver, which chooses the
splits as for a table in one task. Cuts, medians and counts are exact and over all rows of a model.
A task holds one block and the sums of the models that grow together, whatever the number of rows.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession

from marquee.plans.trees import Boosting, Layout, Tree, Trees
from marquee.session import ensure_checkpoint_dir

#: Models that grow together, numbers that tasks may send to the driver in one job, rounds until
#: the predictions so far are written to the checkpoint folder.
TOGETHER = 16
NUMBERS = 2**23
ROUNDS = 24
#: Values that are brought together to find ranks among them.
FEW = 2**16
#: One row in a sum of rows and signs.
ONE = 2.0**27


@dataclass
class Block:
    """Some labelled rows: columns by rows, either values or, once there are cuts, their codes."""

    whole: np.ndarray  # columns that hold small whole numbers only
    small: np.ndarray
    large: np.ndarray
    codes: np.ndarray | None
    y: np.ndarray
    launch: np.ndarray
    original: np.ndarray
    order: np.ndarray
    now: np.ndarray  # predictions so far, models by rows

    def __len__(self) -> int:
        return len(self.y)

    def value(self, column: int) -> np.ndarray:
        own = self.whole if self.whole[column] else ~self.whole
        place = int(own[:column].sum())
        return (self.small if self.whole[column] else self.large)[place]


def block_of(x: np.ndarray, y: np.ndarray, launch: np.ndarray, original: np.ndarray, order: np.ndarray) -> Block:
    """``x``: columns by rows."""
    with np.errstate(invalid="ignore"):
        whole = ((x == np.floor(x)) & (x >= 0) & (x < 256)).all(1) if x.size else np.zeros(len(x), bool)
    return Block(whole, x[whole].astype(np.uint8), x[~whole], None, y, launch, original, order, np.zeros((0, len(y))))


@dataclass
class Spread:
    """Labelled rows on the executors. ``order`` is their place in the order of the keys' hashes,
    where it was asked for."""

    columns: tuple[str, ...]
    blocks: RDD
    n: int
    held: tuple[RDD, ...]

    def __len__(self) -> int:
        return self.n

    def release(self) -> None:
        """Removes the blocks from the executors' disks; they are made again if they are read."""
        for one in self.held:
            one.unpersist()

    def places(self, names: Sequence[str]) -> np.ndarray:
        at = {c: i for i, c in enumerate(self.columns)}
        return np.array([at[c] for c in names], np.int64)


def spread_of(rows: DataFrame, columns: Sequence[str], ordered: Sequence[str] = ()) -> Spread:
    """``rows``: x0, x1, ..., y, launch (microseconds), original, and the columns to order by."""
    spark = rows.sparkSession
    n = len(columns)
    if ordered:
        rows = rows.orderBy(*ordered)
    rows = rows.select(*(f"x{i}" for i in range(n)), "y", "launch", "original")

    def packed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first = TaskContext.get().partitionId(), 0
        for batch in batches:
            if batch.num_rows:
                values = [batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(n)]
                x = np.stack(values) if n else np.zeros((0, batch.num_rows))
                y, launch, original = (batch.column(n + i).to_numpy(zero_copy_only=False) for i in range(3))
                order = np.arange(first, first + batch.num_rows)
                first += batch.num_rows
                block = block_of(x, y.astype(float), launch, original.astype(bool), order)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part]), pa.array([pickle.dumps(block, 5)], pa.binary())], names=["part", "block"]
                )

    made = rows.mapInArrow(packed, "part long, block binary").rdd.map(lambda r: (r["part"], pickle.loads(r["block"])))
    made = made.persist(StorageLevel.DISK_ONLY)
    sizes: dict[int, int] = {}
    for part, size in made.map(lambda b: (b[0], len(b[1]))).collect():
        sizes[part] = sizes.get(part, 0) + size
    before = dict(zip(sorted(sizes), np.cumsum([0, *(sizes[p] for p in sorted(sizes))]).tolist(), strict=False))

    def numbered(item: tuple[int, Block]) -> Block:
        item[1].order = item[1].order + before[item[0]]
        return item[1]

    cores = spark.sparkContext.defaultParallelism
    blocks, held = made.map(numbered), (made,)
    if made.getNumPartitions() > cores:
        blocks = blocks.coalesce(cores)
    elif made.getNumPartitions() < cores:
        blocks = blocks.repartition(cores).persist(StorageLevel.DISK_ONLY)
        held = (made, blocks)
    return Spread(tuple(columns), blocks, sum(sizes.values()), held)


def over(blocks: RDD, work: Callable[[Iterable[Block]], object]) -> list:
    """What ``work`` gives for the blocks of each task."""
    return blocks.mapPartitions(lambda some: [work(some)]).collect()


# --- exact ranks ----------------------------------------------------------------------------

Cells = Callable[[Block], Iterable[tuple[int, np.ndarray, np.ndarray]]]


def _keys(values: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the values."""
    bits = (values + 0.0).view(np.uint64)  # one zero
    return np.where(bits >> np.uint64(63) == 1, ~bits, bits | np.uint64(1 << 63))


def _value(keys: np.ndarray) -> np.ndarray:
    return np.where(keys >> np.uint64(63) == 1, keys & np.uint64((1 << 63) - 1), ~keys).view(np.float64)


def ranked(blocks: RDD, cells: Cells, wanted: dict[int, dict[int, np.ndarray]], bits: int = 11) -> dict[int, dict[int, np.ndarray]]:
    """The values at the wanted ranks (from 0) of each cell and subcell. ``cells`` gives a block's
    values: cell, subcell of each value (below 512), value. Each pass counts the values in the
    ranges that hold a wanted rank by their next ``bits`` bits, until few values are left in them,
    which are brought together."""
    done = 0
    # by cell: subcell, rank inside its range and range of each wanted rank
    subs = {c: np.concatenate([np.full(len(r), s, np.uint64) for s, r in w.items()]) for c, w in wanted.items()}
    ranks = {c: np.concatenate(list(w.values())).astype(np.int64) for c, w in wanted.items()}
    starts = {c: np.zeros(len(r), np.uint64) for c, r in ranks.items()}
    found = {c: np.zeros(len(r)) for c, r in ranks.items()}
    while ranks and done < 64:
        size = min(bits, 64 - done)
        ranges = {c: np.unique((subs[c] << np.uint64(done)) | starts[c]) for c in ranks}
        shift = np.uint64(64 - done - size)

        def placed(c, sub, values, ranges=ranges, done=done):
            keys = _keys(values)
            top = (sub.astype(np.uint64) << np.uint64(done)) | (keys >> np.uint64(64 - done) if done else np.uint64(0))
            at = np.minimum(np.searchsorted(ranges[c], top), len(ranges[c]) - 1)
            inside = ranges[c][at] == top
            return at[inside], keys[inside]

        def counted(some, ranges=ranges, size=size, shift=shift, placed=placed):
            held = {c: np.zeros(len(r) << size, np.int64) for c, r in ranges.items()}
            for block in some:
                for c, sub, values in cells(block):
                    if c in held and len(values):
                        at, keys = placed(c, sub, values)
                        digit = ((keys >> shift) & np.uint64((1 << size) - 1)).astype(np.int64)
                        held[c] += np.bincount((at << size) + digit, minlength=len(held[c]))
            return {c: (np.flatnonzero(h), h[h > 0]) for c, h in held.items()}

        total = {c: np.zeros(len(r) << size, np.int64) for c, r in ranges.items()}
        for part in over(blocks, counted):
            for c, (place, number) in part.items():
                total[c][place] += number
        left = 0
        for c in ranks:
            sums = np.cumsum(total[c].reshape(-1, 1 << size), 1)
            line = np.searchsorted(ranges[c], (subs[c] << np.uint64(done)) | starts[c])
            digit = (sums[line] <= ranks[c][:, None]).sum(1)
            here = np.take_along_axis(sums[line], digit[:, None], 1)[:, 0]
            own = total[c].reshape(-1, 1 << size)[line, digit]
            ranks[c] = ranks[c] - (here - own)
            starts[c] = (starts[c] << np.uint64(size)) | digit.astype(np.uint64)
            one = np.unique(np.stack([subs[c].astype(np.int64), line, digit]), axis=1, return_index=True)[1]
            left += int(own[one].sum())
        done += size
        if done < 64 and left <= FEW:
            ranges = {c: np.unique((subs[c] << np.uint64(done)) | starts[c]) for c in ranks}

            def gathered(some, ranges=ranges, done=done, placed=placed):
                held = [
                    (c, *placed(c, sub, values, ranges, done)) for block in some for c, sub, values in cells(block) if c in ranges and len(values)
                ]
                return [h for h in held if len(h[1])]

            parts = [p for part in over(blocks, gathered) for p in part]
            for c in ranks:
                at = np.concatenate([p[1] for p in parts if p[0] == c])
                keys = np.concatenate([p[2] for p in parts if p[0] == c])
                order = np.lexsort((keys, at))
                first = np.searchsorted(at[order], np.searchsorted(ranges[c], (subs[c] << np.uint64(done)) | starts[c]))
                found[c] = _value(keys[order][first + ranks[c]])
            break
    else:
        found = {c: _value(s) for c, s in starts.items()}
    out: dict[int, dict[int, np.ndarray]] = {}
    for c in ranks:
        out[c] = {int(s): found[c][subs[c] == np.uint64(s)] for s in wanted[c]}
    return out


def middle(n: int) -> np.ndarray:
    return np.array([(n - 1) // 2, n // 2])


# --- cuts -------------------------------------------------------------------------------------

Chosen = Callable[[object], np.ndarray]


def cuts_of(spread: Spread, groups: Sequence[Chosen], most: int) -> tuple[list[list[np.ndarray]], np.ndarray, np.ndarray]:
    """For each group of rows the cuts of every column, as ``Grower`` has them for a table in one
    task, whether the column has missing values there, and the number of rows."""
    columns = len(spread.columns)

    def seen(some: Iterable[Block]):
        values = [[np.zeros(0) for _ in range(columns)] for _ in groups]
        present = np.zeros((len(groups), columns), np.int64)
        sizes = np.zeros(len(groups), np.int64)
        for block in some:
            for g, group in enumerate(groups):
                mine = group(block)
                sizes[g] += mine.sum()
                for c in range(columns):
                    v = block.value(c)[mine]
                    if block.whole[c]:
                        present[g, c] += len(v)
                        own = np.flatnonzero(np.bincount(v, minlength=256)).astype(float)
                    else:
                        v = v[~np.isnan(v)]
                        present[g, c] += len(v)
                        own = v
                    if values[g][c] is not None:
                        own = np.unique(np.concatenate([values[g][c], own]))
                        values[g][c] = own if len(own) <= most + 1 else None
        return values, present, sizes

    parts = over(spread.blocks, seen)
    present, sizes = sum(p[1] for p in parts), sum(p[2] for p in parts)
    distinct: list[list] = [[None] * columns for _ in groups]
    wanted = {}
    for g in range(len(groups)):
        for c in range(columns):
            held = [p[0][g][c] for p in parts]
            own = None if any(h is None for h in held) else np.unique(np.concatenate(held))
            if own is not None and len(own) <= most + 1:
                distinct[g][c] = own
            else:
                shares = np.linspace(0, 1, most + 2)[1:-1]
                last = int(present[g, c]) - 1
                wanted[g * columns + c] = {0: np.unique(np.concatenate([[0], np.floor(last * shares), [last]])).astype(np.int64)}
    due = sorted({c % columns for c in wanted})

    def cells(block: Block):
        for g, group in enumerate(groups):
            mine = group(block)
            for c in due:
                if g * columns + c in wanted:
                    v = block.value(c)[mine].astype(float)
                    v = v[~np.isnan(v)]
                    yield g * columns + c, np.zeros(len(v), np.uint64), v

    if wanted:
        for cell, own in ranked(spread.blocks, cells, wanted, bits=8).items():
            distinct[cell // columns][cell % columns] = np.unique(own[0])
    return [[(d[:-1] + d[1:]) / 2 for d in own] for own in distinct], present < sizes[:, None], sizes


# --- models -----------------------------------------------------------------------------------


@dataclass
class Model:
    """One model that grows: its group of rows, its columns and layout, and its trees so far."""

    settings: Boosting
    group: int
    places: np.ndarray
    layout: Layout
    trees: Trees
    draw: np.random.Generator
    ended: bool = False


@dataclass
class Grown:
    """A tree as it grows: nodes with the column split on and the last of its bins that goes left."""

    column: np.ndarray
    at: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray

    def leaf(self, bins: np.ndarray) -> np.ndarray:
        """``bins``: columns by rows."""
        n = bins.shape[1]
        at, rows = np.zeros(n, np.int32), np.arange(n)
        while True:
            column = self.column[at]
            if not (column >= 0).any():
                return at
            v = bins[np.maximum(column, 0), rows]
            goes_left = np.where(v == 0, self.missing_left[at], v <= self.at[at])
            at = np.where(column >= 0, np.where(goes_left, self.left[at], self.right[at]), at)


def growing(layout: Layout, usable: np.ndarray):
    """Grows a tree as ``Grower.tree`` does. Yields ("level", nodes, tree) and takes the rows and
    slopes of these nodes in each slot; then yields ("values", None, tree) and takes the value of
    each node; at last yields ("done", tree, grown)."""
    s = layout.settings
    column, cut, at, missing, left, right = [-1], [0.0], [0], [False], [0], [0]
    low, high = [-np.inf], [np.inf]
    grown = lambda: Grown(np.array(column, np.int32), np.array(at), np.array(missing), np.array(left, np.int32), np.array(right, np.int32))
    node = np.zeros(1, np.int64)
    of_first = slice(0, int(np.searchsorted(layout.of_slot, 1)))
    for _ in range(s.depth if layout.columns else 0):
        count, total = yield "level", node, grown()
        rows, sums = count[:, of_first].sum(1)[:, None], total[:, of_first].sum(1)[:, None]
        chosen = layout.choose(count, total, rows, sums, usable)
        if chosen is None:
            break
        splits, slot, side, means, gain, lefts = chosen
        room = s.leaves - len(column) // 2 - 1
        if s.leaves and splits.sum() > room:
            splits = np.isin(np.arange(len(node)), np.argsort(np.where(splits, -gain, np.inf), kind="stable")[:room])
        if not splits.any():
            break
        following = []
        for i in np.flatnonzero(splits):
            n, c = node[i], int(layout.of_slot[slot[i]])
            bounds = [(low[n], high[n])] * 2
            if layout.rising[slot[i]]:
                middle_ = min(max((means[i][0] + means[i][1]) / 2, low[n]), high[n])
                bounds = [(low[n], middle_), (middle_, high[n])]
            column[n], cut[n], missing[n] = c, layout.cut[slot[i]], bool(side[i])
            at[n] = int(slot[i] - layout.first[slot[i]])
            left[n], right[n] = len(column), len(column) + 1
            for (a, b), size in zip(bounds, (lefts[i], rows[i, 0] - lefts[i]), strict=True):
                if size >= 2 * s.min_leaf:
                    following.append(len(column))
                for held, value in ((column, -1), (cut, 0.0), (at, 0), (missing, False), (left, 0), (right, 0), (low, a), (high, b)):
                    held.append(value)
        node = np.array(following, np.int64)
        if not len(node):
            break
    values = yield "values", None, grown()
    parts = (np.array(column, np.int32), np.array(cut), np.array(missing), np.array(left, np.int32), np.array(right, np.int32))
    yield "done", Tree(*parts, np.clip(values, low, high) * s.rate), grown()


def _coded(spread: Spread, cuts: list[list[np.ndarray]]) -> tuple[RDD, list[list[np.ndarray]]]:
    """Blocks with codes for the ranges between the cuts of all groups, and for each group the
    bin of each code of a column."""
    edges = [np.unique(np.concatenate([own[c] for own in cuts])) for c in range(len(spread.columns))]
    kind = np.uint8 if max((len(e) for e in edges), default=0) < 255 else np.uint16
    bins = [
        [np.concatenate([[0, 1], np.searchsorted(own[c], edges[c], "right") + 1]).astype(kind) for c in range(len(edges))] for own in cuts
    ]

    def coded(block: Block) -> Block:
        codes = np.zeros((len(edges), len(block)), kind)
        for c, e in enumerate(edges):
            v = block.value(c)
            codes[c] = np.searchsorted(e, v) + 1
            if not block.whole[c]:
                codes[c][np.isnan(v)] = 0
        none = np.zeros((0, len(block)))
        return Block(block.whole, none, none, codes, block.y, block.launch, block.original, block.order, none)

    return spread.blocks.map(coded).persist(StorageLevel.DISK_ONLY), bins


def boosted(
    spark: SparkSession,
    spread: Spread,
    models: Sequence[tuple[Sequence[str], Boosting, Chosen]],
    rated: Callable[[Block, int, np.ndarray], Sequence[float]] | None = None,
    each: Callable[[list[tuple[int, int, Trees | None, np.ndarray]]], None] = lambda found: None,
) -> None:
    """Fits models (columns, settings, the rows to learn from), ``TOGETHER`` at a time, and hands
    them to ``each``: number, rows learned from, trees (None without rows) and the sums over all
    rows of what ``rated`` gives for a block, the model's number and its predictions."""
    models = list(models)
    groups: list[Chosen] = []
    of = []
    for _, _, chosen in models:
        if chosen not in groups:
            groups.append(chosen)
        of.append(groups.index(chosen))
    by_cuts = sorted({s.cuts for _, s, _ in models})
    for most in by_cuts:
        cuts, missing, sizes = cuts_of(spread, groups, most)
        blocks, bins = _coded(spread, cuts)
        numbers = [i for i, m in enumerate(models) if m[1].cuts == most]
        for first in range(0, len(numbers), TOGETHER):
            some = numbers[first : first + TOGETHER]
            made = []
            for i in some:
                names, settings, _ = models[i]
                if settings.rising and settings.absolute_loss:
                    raise ValueError("rising columns need squared loss")
                places = spread.places(names)
                layout = Layout(settings, [cuts[of[i]][c] for c in places], bool(missing[of[i]][places].any()))
                made.append(Model(settings, of[i], places, layout, Trees(0.0, [], len(places)), np.random.default_rng(settings.seed)))
                made[-1].ended = not sizes[of[i]]
            sums = _grow(spark, blocks, bins, groups, made, sizes, rated, some)
            each([(i, int(sizes[m.group]), m.trees if sizes[m.group] else None, sums[k]) for k, (i, m) in enumerate(zip(some, made, strict=True))])
        blocks.unpersist()


def _grow(spark, blocks, bins, groups, models, sizes, rated, numbers) -> np.ndarray:
    """All trees of some models; also the sums of ``rated``."""
    context = spark.sparkContext
    ensure_checkpoint_dir(spark)
    held = context.broadcast((bins, groups, models))

    def binned(block: Block, kept: dict, m: int) -> np.ndarray:
        """The bins of a model's columns, computed once for the models that share them."""
        all_bins, _, made = held.value
        key = (made[m].group, made[m].places.tobytes())
        if key not in kept:
            kept.clear()  # models that share columns follow each other
            own = all_bins[made[m].group]
            kept[key] = np.stack([own[c][block.codes[c]] for c in made[m].places]) if len(made[m].places) else block.codes[:0]
        return kept[key]

    def slopes(block: Block, m: int) -> np.ndarray:
        rest = block.y - block.now[m]
        return np.sign(rest) if held.value[2][m].settings.absolute_loss else rest

    def levels(asked: dict):
        def work(some: Iterable[Block]) -> dict:
            made = held.value[2]
            count = {m: np.zeros((len(node), made[m].layout.slots), np.int64) for m, (node, _, _) in asked.items()}
            total = {m: np.zeros(c.shape) for m, c in count.items()}
            for block in some:
                kept: dict = {}
                for m, (node, tree, wanted) in asked.items():
                    layout, own = made[m].layout, binned(block, kept, m)
                    place = np.full(len(tree.column), -1)
                    place[node] = np.arange(len(node))
                    spot = place[tree.leaf(own)]
                    mine = np.flatnonzero((spot >= 0) & held.value[1][made[m].group](block))
                    spot, slope, n = spot[mine], slopes(block, m)[mine], len(node)
                    sign = made[m].settings.absolute_loss
                    # rows and signs in one sum, which is exact: a block is far smaller than ONE
                    weight = slope + ONE if sign else slope
                    lines: dict[int, np.ndarray] = {}  # by the slots of a column
                    for c in wanted:
                        low = layout.start[c]
                        high = layout.start[c + 1] if c + 1 < layout.columns else layout.slots
                        size = int(high - low)
                        if size not in lines:
                            lines[size] = spot * size
                        key = lines[size] + own[c][mine]
                        sums = np.bincount(key, weight, n * size).reshape(n, size)
                        if sign:
                            rows = np.rint(sums / ONE)
                            sums -= rows * ONE
                        else:
                            rows = np.bincount(key, minlength=n * size).reshape(n, size)
                        count[m][:, low:high] += rows.astype(np.int64)
                        total[m][:, low:high] += sums
            return {m: (count[m], total[m]) for m in asked}

        return work

    def leaf_sums(asked: dict):
        def work(some: Iterable[Block]) -> dict:
            out = {m: [np.zeros(len(t.column)), np.zeros(len(t.column))] for m, t in asked.items()}
            for block in some:
                kept: dict = {}
                for m, tree in asked.items():
                    mine = held.value[1][held.value[2][m].group](block)
                    leaf = tree.leaf(binned(block, kept, m))[mine]
                    out[m][0] += np.bincount(leaf, minlength=len(tree.column))
                    out[m][1] += np.bincount(leaf, (block.y - block.now[m])[mine], len(tree.column))
            return out

        return work

    def values_of(state: RDD, asked: dict) -> dict:
        """The mean or, under absolute loss, median of what is left in each leaf."""
        parts = over(state, leaf_sums(asked))
        counts = {m: sum(p[m][0] for p in parts) for m in asked}
        out = {m: sum(p[m][1] for p in parts) / np.maximum(counts[m], 1) for m in asked}
        median = {m: t for m, t in asked.items() if models[m].settings.absolute_loss}
        numbered, wanted = {}, {}
        for m in median:
            own = np.flatnonzero(counts[m])
            if len(own) > 512:
                raise ValueError("medians need trees of at most 512 leaves")
            numbered[m] = np.zeros(len(counts[m]), np.uint64)
            numbered[m][own] = np.arange(len(own))
            wanted[m] = {i: middle(int(counts[m][n])) for i, n in enumerate(own)}

        def cells(block: Block):
            kept: dict = {}
            for m, tree in median.items():
                mine = held.value[1][held.value[2][m].group](block)
                yield m, numbered[m][tree.leaf(binned(block, kept, m))[mine]], (block.y - block.now[m])[mine]

        for m, found in (ranked(state, cells, wanted) if wanted else {}).items():
            out[m] = np.zeros(len(counts[m]))
            for i, n in enumerate(np.flatnonzero(counts[m])):
                out[m][n] = found[i].mean()
        return out

    def moved(state: RDD, steps: dict) -> RDD:
        """Predictions after another tree of each model."""

        def work(block: Block) -> Block:
            kept: dict = {}
            now = block.now.copy()
            for m, (tree, value) in steps.items():
                now[m] += value[tree.leaf(binned(block, kept, m))]
            block.now = now
            return block

        return state.map(work).persist(StorageLevel.DISK_ONLY)

    due = [m for m, model in enumerate(models) if not model.ended]
    root = Grown(np.array([-1], np.int32), np.zeros(1, int), np.zeros(1, bool), np.zeros(1, np.int32), np.zeros(1, np.int32))

    def started(block: Block) -> Block:
        block.now = np.zeros((len(numbers), len(block)))
        return block

    state = blocks.map(started)
    base = values_of(state, {m: root for m in due}) if due else {}
    for m in due:
        models[m].trees.base = float(base[m][0])
    state, last = moved(state, {m: (root, base[m]) for m in due}), None
    written = None

    def read(work: Callable[[Iterable[Block]], object]) -> list:
        """Once the predictions were read they are stored; those before them can go."""
        nonlocal last, written
        parts = over(state, work)
        if last is not None:
            last.unpersist()
            last = None
            if state.isCheckpointed():
                _removed(context, written)
                written = state.getCheckpointFile()
        return parts

    for number in range(max((models[m].settings.rounds for m in due), default=0)):
        due = [m for m in due if number < models[m].settings.rounds and not models[m].ended]
        if not due:
            break
        usable = {m: models[m].layout.usable(models[m].draw) for m in due}
        trees = {m: growing(models[m].layout, usable[m]) for m in due}
        step = {m: next(t) for m, t in trees.items()}
        while any(s[0] == "level" for s in step.values()):
            asked, room = {}, NUMBERS
            for m in due:
                if step[m][0] != "level":
                    continue
                columns = np.unique(np.concatenate([models[m].layout.of_slot[usable[m]], [0]]))
                size = 2 * len(step[m][1]) * models[m].layout.slots
                if asked and size > room:
                    break  # the others come in a job of their own
                asked[m], room = (step[m][1], step[m][2], columns), room - size
            parts = read(levels(asked))
            for m in asked:
                count = sum(p[m][0] for p in parts).astype(float)
                step[m] = trees[m].send((count, sum(p[m][1] for p in parts)))
        values = values_of(state, {m: step[m][2] for m in due})
        steps = {}
        for m in due:
            _, tree, grown = trees[m].send(values[m])
            models[m].trees.trees.append(tree)
            models[m].ended = len(tree.column) == 1
            steps[m] = (grown, tree.value)
        last, state = state, moved(state, steps)
        if number % ROUNDS == ROUNDS - 1:
            state.checkpoint()

    def rates(some: Iterable[Block]) -> list:
        out = [0.0] * len(numbers)
        for block in some:
            for k, number in enumerate(numbers):
                out[k] = out[k] + np.array(rated(block, number, block.now[k]), float)
        return out

    sums = [np.zeros(0)] * len(numbers)
    if rated is not None:
        parts = read(rates)
        sums = [sum(p[k] for p in parts) for k in range(len(numbers))]
    for one in (state, last):
        if one is not None:
            one.unpersist()
    _removed(context, written)
    held.unpersist()
    return sums


def _removed(context, path: str | None) -> None:
    """A checkpoint that nothing reads any more."""
    if path:
        own = context._jvm.org.apache.hadoop.fs.Path(path)
        own.getFileSystem(context._jsc.hadoopConfiguration()).delete(own, True)
