"""Boosted regression trees for labelled titles, fitted inside one task.

Tuning and daily scoring need hundreds of models. So models are fitted side by side, one in each
task, as long as the rows they learn from fit there; ``spread.py`` grows the same trees over more. What Spark's own learner
lacks is here: splits that send missing values to the better side, and columns along which
predictions never fall.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np

from marquee.constants import BOOST_DEFAULT_DEPTH, BOOST_LEAVES, BOOST_MIN_LEAF, BOOST_ROUNDS

#: Rows that are predicted at once, and leaves of a tree that fit a mask.
CHUNK = 4096
MASK_LEAVES = 32
#: The place of a mask's only bit by the top five bits of its product with a de Bruijn number.
_BIT = np.zeros(32, np.int64)
_BIT[[(0x077CB531 << i & 0xFFFFFFFF) >> 27 for i in range(32)]] = range(32)


@dataclass(frozen=True)
class Boosting:
    """Settings. ``rising``: columns along which predictions never fall; they need squared loss.
    ``leaves``: most leaves of a tree, given to the best splits of a level; 0 for no limit."""

    rounds: int = BOOST_ROUNDS[0]
    depth: int = BOOST_DEFAULT_DEPTH
    rate: float = 0.05
    feature_fraction: float = 1.0
    min_leaf: int = BOOST_MIN_LEAF
    min_gain: float = 0.0
    absolute_loss: bool = True
    leaves: int = BOOST_LEAVES
    rising: tuple[int, ...] = ()
    cuts: int = 31  # per column
    seed: int = 7

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        """``x``: rows by columns, missing values as NaN."""
        if self.rising and self.absolute_loss:
            raise ValueError("rising columns need squared loss")
        return Grower(self, x).boosted(y)


@dataclass
class Tree:
    """Nodes: the column split on (-1 for a leaf), values up to ``cut`` go left."""

    column: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def leaves(self) -> tuple[list[int], dict[int, range]]:
        """The leaves from left to right, and for each split the places of those on its left."""
        order: list[int] = []
        left_of: dict[int, range] = {}
        due = [(0, None)]
        while due:
            n, first = due.pop()
            if first is not None:  # back from the left side
                left_of[n] = range(first, len(order))
            elif self.column[n] < 0:
                order.append(n)
            else:
                due += [(int(self.right[n]), None), (n, len(order)), (int(self.left[n]), None)]
        return order, left_of


@dataclass
class Trees:
    base: float
    trees: list[Tree]
    n_columns: int

    def predict(self, x: np.ndarray) -> np.ndarray:
        tests = self._tests
        if tests is None:
            return self._walked(x)
        out = np.full(len(x), self.base)
        for first in range(0, len(x), CHUNK):
            out[first : first + CHUNK] = self._masked(np.ascontiguousarray(x[first : first + CHUNK].T), tests)
        return out

    @cached_property
    def _tests(self) -> list | None:
        """Each different test (column, cut, side of missing values) with the trees that ask it and
        the leaves that are out where it fails; None if a tree has too many leaves for a mask."""
        tests: dict[tuple, list] = {}
        for number, t in enumerate(self.trees):
            if (t.column < 0).sum() > MASK_LEAVES:
                return None
            order = t.leaves()
            for n in np.flatnonzero(t.column >= 0):
                out = sum(1 << i for i in order[1][n])
                key = (int(t.column[n]), float(t.cut[n]), bool(t.missing_left[n]))
                tests.setdefault(key, []).append((number, np.uint32(~out & 0xFFFFFFFF)))
        values = [t.value[t.leaves()[0]] for t in self.trees]
        return [sorted(tests.items()), values]

    def _masked(self, columns: np.ndarray, tests: list) -> np.ndarray:
        """Every tree starts with all its leaves and loses those left of each failed test; the
        first one that stays is the row's."""
        n = columns.shape[1]
        mask = np.full((len(self.trees), n), 0xFFFFFFFF, np.uint32)
        held = np.empty(n, np.uint32)
        for (column, cut, missing_left), asked in tests[0]:
            v = columns[column]
            passed = v <= cut
            if missing_left:
                passed |= np.isnan(v)
            passed = np.where(passed, np.uint32(0xFFFFFFFF), np.uint32(0))
            for number, stays in asked:
                np.bitwise_or(passed, stays, out=held)
                np.bitwise_and(mask[number], held, out=mask[number])
        out = np.full(n, self.base)
        for number, value in enumerate(tests[1]):
            m = mask[number]
            first = m & (~m + np.uint32(1))
            out += value[_BIT[(first * np.uint32(0x077CB531)) >> np.uint32(27)]]
        return out

    def _walked(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for t in self.trees:
            at = np.zeros(len(x), np.int32)
            while True:
                column = t.column[at]
                if not (column >= 0).any():
                    break
                v = x[rows, np.maximum(column, 0)]
                left = np.where(np.isnan(v), t.missing_left[at], v <= t.cut[at])
                at = np.where(column >= 0, np.where(left, t.left[at], t.right[at]), at)
            out += t.value[at]
        return out

    def splits(self) -> np.ndarray:
        """How many splits each column has."""
        used = [t.column[t.column >= 0] for t in self.trees]
        return np.bincount(np.concatenate([*used, np.zeros(0, np.int32)]).astype(int), minlength=self.n_columns)


class Layout:
    """Slots of a model's columns. Each column has a slot for missing values, then one for the
    values up to each cut, then one for the rest. ``missing``: whether some value is missing."""

    def __init__(self, settings: Boosting, cuts: list[np.ndarray], missing: bool):
        self.settings, self.columns, self.missing = settings, len(cuts), missing
        sizes = np.array([len(c) + 2 for c in cuts], np.int64)
        self.start = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        self.slots = int(sizes.sum())
        self.of_slot = np.repeat(np.arange(self.columns), sizes)
        self.first = np.repeat(self.start, sizes)
        self.cut = np.concatenate([np.zeros(0), *(np.concatenate([[-np.inf], c, [np.nan]]) for c in cuts)])
        self.can_split = ~np.isnan(self.cut)
        self.rising = np.isin(self.of_slot, settings.rising)

    def usable(self, draw: np.random.Generator) -> np.ndarray:
        """The slots that a tree may split at: those of the columns drawn for it."""
        s = self.settings
        if s.feature_fraction >= 1:
            return self.can_split
        kept = draw.permutation(self.columns)[: max(1, round(s.feature_fraction * self.columns))]
        return self.can_split & np.isin(self.of_slot, kept)

    def choose(self, count: np.ndarray, total: np.ndarray, rows: np.ndarray, sums: np.ndarray, usable: np.ndarray):
        """For each node whether it splits, the slot, whether missing values go left, the mean
        slopes of both sides, the gain and the rows that go left; from the rows and slopes in each
        slot (nodes by slots) and in each node (one column)."""
        s, n = self.settings, len(count)
        none, none_sum = count[:, self.first], total[:, self.first]
        held, held_sum = np.cumsum(count, 1), np.cumsum(total, 1)
        held, held_sum = held - held[:, self.first], held_sum - held_sum[:, self.first]  # without missing ones
        best_gain = np.full(n, -np.inf)
        slot, side, means, lefts = np.zeros(n, np.int64), np.zeros(n, bool), np.zeros((n, 2)), np.zeros(n)
        lines = np.arange(n)
        for with_missing in (True, False) if self.missing else (False,):
            a, a_sum = (held + none, held_sum + none_sum) if with_missing else (held, held_sum)
            b, b_sum = rows - a, sums - a_sum
            good = usable & (a >= s.min_leaf) & (b >= s.min_leaf)
            with np.errstate(divide="ignore", invalid="ignore"):
                a_mean, b_mean = a_sum / a, b_sum / b
                if s.rising:
                    good &= ~self.rising | (b_mean >= a_mean)
                gain = np.where(good, a_sum * a_mean + b_sum * b_mean, -np.inf)
            at = gain.argmax(1)
            better = gain[lines, at] > best_gain
            best_gain = np.where(better, gain[lines, at], best_gain)
            slot, side = np.where(better, at, slot), np.where(better, with_missing, side)
            lefts = np.where(better, a[lines, at], lefts)
            pair = np.stack([a_mean[lines, at], b_mean[lines, at]], 1)
            means = np.where(better[:, None], pair, means)
        gain = best_gain - (sums**2 / rows)[:, 0]
        splits = gain > max(s.min_gain, 1e-9)
        return (splits, slot, side, means, gain, lefts) if splits.any() else None


class Grower(Layout):
    """Binned columns of one table."""

    def __init__(self, settings: Boosting, x: np.ndarray):
        cuts = [self._cuts(settings, x[:, c]) for c in range(x.shape[1])]
        super().__init__(settings, cuts, bool(np.isnan(x).any()))
        self.rows = len(x)
        self.bins = np.empty((self.rows, self.columns), np.int64)
        for c in range(self.columns):
            at = np.searchsorted(cuts[c], x[:, c]) + 1
            self.bins[:, c] = np.where(np.isnan(x[:, c]), 0, at)
        self.place = self.bins + self.start

    @staticmethod
    def _cuts(settings: Boosting, values: np.ndarray) -> np.ndarray:
        values = values[~np.isnan(values)]
        distinct = np.unique(values)
        if len(distinct) > settings.cuts + 1:
            shares = np.linspace(0, 1, settings.cuts + 2)[1:-1]
            distinct = np.unique(np.concatenate([np.quantile(values, shares, method="lower"), distinct[:1], distinct[-1:]]))
        return (distinct[:-1] + distinct[1:]) / 2

    def boosted(self, y: np.ndarray) -> Trees:
        s = self.settings
        draw = np.random.default_rng(s.seed)
        base = float(np.median(y) if s.absolute_loss else y.mean())
        now, trees = np.full(self.rows, base), []
        for _ in range(s.rounds):
            tree, leaf = self.tree(y - now, self.usable(draw))
            now += tree.value[leaf]
            trees.append(tree)
            if len(tree.column) == 1:
                break  # no split is left, nor will there be one
        return Trees(base, trees, self.columns)

    def tree(self, residual: np.ndarray, usable: np.ndarray) -> tuple[Tree, np.ndarray]:
        """Grown level by level; also the leaf of each row."""
        s = self.settings
        slope = np.sign(residual) if s.absolute_loss else residual
        column, cut, missing, left, right = [-1], [0.0], [False], [0], [0]
        low, high = [-np.inf], [np.inf]
        leaf = np.zeros(self.rows, np.int64)
        active, node = np.arange(self.rows), np.zeros(1, np.int64)  # rows in nodes that may split
        spot = np.zeros(self.rows, np.int64)
        for _ in range(s.depth):
            chosen = self._splits(active, spot, len(node), slope, usable)
            if chosen is None:
                break
            splits, slot, side, means, gain, _ = chosen
            room = s.leaves - len(column) // 2 - 1  # a tree of n nodes has (n + 1) / 2 leaves
            if s.leaves and splits.sum() > room:
                splits = np.isin(np.arange(len(node)), np.argsort(np.where(splits, -gain, np.inf), kind="stable")[:room])
            if not splits.any():
                break
            children = np.full((len(node), 2), -1)
            for i in np.flatnonzero(splits):
                n, c = node[i], int(self.of_slot[slot[i]])
                bounds = [(low[n], high[n])] * 2
                if self.rising[slot[i]]:
                    middle = min(max((means[i][0] + means[i][1]) / 2, low[n]), high[n])
                    bounds = [(low[n], middle), (middle, high[n])]
                column[n], cut[n], missing[n] = c, self.cut[slot[i]], bool(side[i])
                left[n], right[n] = children[i] = len(column), len(column) + 1
                for a, b in bounds:
                    column.append(-1)
                    cut.append(0.0)
                    missing.append(False)
                    left.append(0)
                    right.append(0)
                    low.append(a)
                    high.append(b)
            moving = splits[spot]
            active, spot = active[moving], spot[moving]
            at = slot[spot]
            bins = self.bins[active, self.of_slot[at]]
            goes_left = np.where(bins == 0, side[spot], bins <= at - self.first[at])
            leaf[active] = np.where(goes_left, children[spot, 0], children[spot, 1])
            count = np.bincount(leaf[active], minlength=len(column))
            node = np.flatnonzero((count >= 2 * s.min_leaf) & (np.arange(len(column)) >= children[splits].min()))
            place = np.full(len(column), -1)
            place[node] = np.arange(len(node))
            inside = place[leaf[active]] >= 0
            active = active[inside]
            spot = place[leaf[active]]
            if not len(node):
                break
        value = np.clip(self._values(residual, leaf, len(column)), low, high) * s.rate
        parts = (np.array(column, np.int32), np.array(cut), np.array(missing), np.array(left, np.int32), np.array(right, np.int32))
        return Tree(*parts, value), leaf

    def _splits(self, active: np.ndarray, spot: np.ndarray, n: int, slope: np.ndarray, usable: np.ndarray):
        key = (spot[:, None] * self.slots + self.place[active]).ravel()
        shape = (n, self.slots)
        count = np.bincount(key, minlength=n * self.slots).reshape(shape).astype(float)
        total = np.bincount(key, np.repeat(slope[active], self.columns), n * self.slots).reshape(shape)
        rows, sums = np.bincount(spot, minlength=n)[:, None], np.bincount(spot, slope[active], n)[:, None]
        return self.choose(count, total, rows, sums, usable)

    def _values(self, residual: np.ndarray, leaf: np.ndarray, n: int) -> np.ndarray:
        if not self.settings.absolute_loss:
            count = np.bincount(leaf, minlength=n)
            return np.bincount(leaf, residual, n) / np.maximum(count, 1)
        order = np.lexsort((residual, leaf))
        held = np.bincount(leaf, minlength=n)
        first = np.concatenate([[0], np.cumsum(held)[:-1]])
        ordered = residual[order]
        pick = lambda i: ordered[np.minimum(first + i, len(ordered) - 1)]
        return np.where(held > 0, (pick((held - 1) // 2) + pick(held // 2)) / 2, 0.0)


@dataclass
class Line:
    """Least squares on scaled columns; a missing value is its column's mean and a flag."""

    weights: np.ndarray
    means: np.ndarray
    scales: np.ndarray
    flagged: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 1e-6) -> Line:
        gone = np.isnan(x)
        held = np.maximum((~gone).sum(0), 1)
        means = np.where(gone, 0, x).sum(0) / held
        spread = np.sqrt((np.where(gone, 0, x - means) ** 2).sum(0) / held)
        line = cls(np.zeros(0), means, np.where(spread > 0, spread, 1), np.flatnonzero(gone.any(0)))
        a = line._inputs(x)
        penalty = ridge * len(y) * np.eye(a.shape[1])
        penalty[0, 0] = 0
        line.weights = np.linalg.solve(a.T @ a + penalty + 1e-12 * np.eye(a.shape[1]), a.T @ y)
        return line

    def _inputs(self, x: np.ndarray) -> np.ndarray:
        scaled = np.where(np.isnan(x), 0, (x - self.means) / self.scales)
        return np.hstack([np.ones((len(x), 1)), scaled, np.isnan(x[:, self.flagged]).astype(float)])

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self._inputs(x) @ self.weights
