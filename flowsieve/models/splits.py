"""The best of all boundaries, found exactly from bounded histograms.

A node's rows are first counted in up to 256 cells of every feature, with the smallest and largest value seen in each cell.
All boundaries between cells are judged exactly. Within a cell, the statistics left of any boundary lie between those at
its ends, which bounds what a boundary inside can reach; only cells whose bound is not below the best boundary so far are
cut into finer cells in a next pass, until none is left. So every boundary between two different values takes part, but a
pass moves cells, never the sorted values. A cut lies half way between the two values next to it; missing values are
larger than all others. Boundaries of equal score: the first feature, then the smallest cut.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

from .passes import Block, Job, LocalPasses, SparkPasses, Tree, all_cuts

BINS = 256            # cells of a node's feature in the first pass
ZOOM = 64             # cells of a cell that is looked into
OPEN = 256            # nodes whose cells one pass counts
CELLS = BINS + 1      # the last cell is for missing values
TIE = 1e-12


# ---------------------------------------------------------------- what is counted, and what a boundary is worth

class Gini:
    """Rows and the weights of both classes. Worth: the negative weighted impurity, up to a constant of the node."""

    @staticmethod
    def spread(stats: np.ndarray) -> np.ndarray:
        """What `bound` has to know of single rows: nothing here."""
        return np.zeros(len(stats))

    @staticmethod
    def stats(y: np.ndarray, w: np.ndarray) -> np.ndarray:
        return np.stack([np.ones(len(y)), w * (y == 0), w * (y == 1)], axis=1)

    @staticmethod
    def score(left: np.ndarray, total: np.ndarray) -> np.ndarray:
        a, b = left[..., 1], left[..., 2]
        c, d = np.maximum(total[..., 1] - a, 0.0), np.maximum(total[..., 2] - b, 0.0)
        l, r = a + b, c + d
        return (np.divide(a * a + b * b, l, out=np.zeros_like(l), where=l > 0) + np.divide(c * c + d * d, r, out=np.zeros_like(r), where=r > 0))

    @classmethod
    def bound(cls, before: np.ndarray, cell: np.ndarray, total: np.ndarray, spread: np.ndarray) -> np.ndarray:
        """The worth is convex in the two weights, so it is largest at a corner of what the cell spans."""
        corners = [np.array([0.0, a, b]) for a in (0.0, 1.0) for b in (0.0, 1.0)]
        return np.max([cls.score(before + cell * c, total) for c in corners], axis=0)

    @staticmethod
    def splittable(total: np.ndarray) -> bool:
        return total[0] >= 2 and total[1] > 0 and total[2] > 0

    @staticmethod
    def mixed(cell: np.ndarray) -> np.ndarray:
        """Cells of one class: the worth inside is below that of their ends."""
        return (cell[..., 1] > 0) & (cell[..., 2] > 0)

    @staticmethod
    def value(total: np.ndarray) -> float:
        """Share of class 1."""
        return float(total[2] / (total[1] + total[2])) if total[1] + total[2] > 0 else 0.0


class Residual:
    """Rows, positive and negative residuals (none beyond 1), curvature and squares. Worth: the variance a boundary takes away."""

    @staticmethod
    def spread(stats: np.ndarray) -> np.ndarray:
        """Each row's residual; its extremes within a node tighten the bound."""
        return stats[:, 1] + stats[:, 2]

    @staticmethod
    def stats(r: np.ndarray, h: np.ndarray) -> np.ndarray:
        return np.stack([np.ones(len(r)), np.maximum(r, 0), np.minimum(r, 0), h, r * r], axis=1)

    @staticmethod
    def score(left: np.ndarray, total: np.ndarray) -> np.ndarray:
        out = 0.0
        for part in (left, total - left):
            n = part[..., 0]
            out = out + np.divide((part[..., 1] + part[..., 2]) ** 2, n, out=np.zeros_like(n), where=n > 0)
        return out

    @classmethod
    def bound(cls, before: np.ndarray, cell: np.ndarray, total: np.ndarray, spread: np.ndarray) -> np.ndarray:
        """The worth is convex in rows and sum, so it is largest at a corner of a polygon around all that part of a cell can have.

        Of n rows with positive residuals adding up to P and negative ones to -N, m rows sum to P at most, to m times the largest
        residual, and to the whole sum less what the others hold at least; likewise downwards.
        """
        n, up, down = cell[..., 0], cell[..., 1], cell[..., 2]
        tall = np.divide(up, spread[1], out=np.zeros_like(up), where=up > 0)            # fewest rows that sum to P
        deep = np.divide(down, spread[0], out=np.zeros_like(down), where=down < 0)
        none = np.zeros_like(n)
        corners = ((none, none), (tall, up), (n - deep, up), (n, up + down), (deep, down), (n - tall, down))
        out = np.full(n.shape, -np.inf)
        for rows, s in corners:
            a, sa = before[..., 0] + rows, before[..., 1] + before[..., 2] + s
            b, sb = total[..., 0] - a, total[..., 1] + total[..., 2] - sa
            # no residual is beyond the spread, so a side has at least as many rows as its sum needs
            a, b = np.maximum(a, np.abs(sa)), np.maximum(b, np.abs(sb))
            worth = np.divide(sa * sa, a, out=np.zeros_like(a), where=a > 0) + np.divide(sb * sb, b, out=np.zeros_like(b), where=b > 0)
            out = np.maximum(out, worth)
        return out

    @staticmethod
    def splittable(total: np.ndarray) -> bool:
        n, s = total[0], total[1] + total[2]
        return n >= 2 and total[4] / n - (s / n) ** 2 > np.finfo(np.float64).eps

    @staticmethod
    def mixed(cell: np.ndarray) -> np.ndarray:
        return cell[..., 0] > 1

    @staticmethod
    def value(total: np.ndarray) -> float:
        """Newton step: residuals over curvature."""
        return float((total[1] + total[2]) / total[3]) if abs(total[3]) > 1e-150 else 0.0


# ---------------------------------------------------------------- candidates

@dataclass
class Best:
    """A boundary: its worth, feature, cut and the statistics left of it."""

    score: float
    feature: int
    cut: float
    left: np.ndarray

    def beats(self, other: Best | None) -> bool:
        if other is None:
            return True
        slack = TIE * max(abs(self.score), abs(other.score))
        if abs(self.score - other.score) > slack:
            return self.score > other.score
        return (self.feature, self.cut) < (other.feature, other.cut)


@dataclass
class Look:
    """A cell to look into: its node and feature, the values it spans, the statistics before it and what it may reach."""

    node: int
    feature: int
    low: float
    high: float
    before: np.ndarray
    bound: float

    def cuts(self) -> np.ndarray:
        steps = self.low + (self.high - self.low) * (np.arange(ZOOM) / ZOOM) if np.isfinite(self.high) else np.array([self.low])
        if not np.isfinite(steps).all():             # the span itself overflows
            steps = self.low * (1 - np.arange(ZOOM) / ZOOM) + self.high * (np.arange(ZOOM) / ZOOM)
        return np.unique(steps)


def middle(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    half = a / 2 + b / 2
    return np.where((half >= b) | ~np.isfinite(half) | (half < a), a, half)


def judge(kind, stats: np.ndarray, low: np.ndarray, high: np.ndarray, before: np.ndarray, total: np.ndarray, spread: np.ndarray, node: int, features: np.ndarray) -> tuple[Best | None, list[Look]]:
    """The best boundary between the cells of one node ([feature, cell] arrays), and the cells worth looking into."""
    left = before[:, None, :] + np.cumsum(stats, axis=1)
    following = np.minimum.accumulate(low[:, ::-1], axis=1)[:, ::-1]
    following = np.concatenate([following[:, 1:], np.full((len(low), 1), np.inf)], axis=1)
    some = stats[..., 0] > 0
    more = np.cumsum(some[:, ::-1], axis=1)[:, ::-1] - some          # filled cells after this one
    ends = some & (more > 0)
    scores = np.where(ends, kind.score(left, total), -np.inf)
    best = None
    top = scores.max()
    if np.isfinite(top):
        near = np.argwhere(scores >= top - TIE * abs(top))           # ordered by feature, then cell
        f, c = near[0]
        best = Best(float(scores[f, c]), int(features[f]), float(middle(high[f, c], following[f, c])), left[f, c].copy())
    open_ = some & (low < high) & kind.mixed(stats)
    looks = []
    places = np.argwhere(open_)
    if len(places):
        cell = stats[open_]
        start = left[open_] - cell
        bounds = kind.bound(start, cell, total, spread)
        for i in np.flatnonzero(bounds >= (top - TIE * abs(top) if np.isfinite(top) else -np.inf)):
            f, c = places[i]
            looks.append(Look(node, int(features[f]), float(low[f, c]), float(high[f, c]), start[i], float(bounds[i])))
    return best, looks


# ---------------------------------------------------------------- the two kinds of passes

class Learner:
    """What a block's rows count for now: the node of the growing tree each is in (others are ignored) and their statistics."""

    kind: type

    def __init__(self) -> None:
        self.tree = Tree()

    def stats(self, block: Block) -> np.ndarray:
        raise NotImplementedError


def add_cells(place: np.ndarray, stats: np.ndarray, cells: int) -> np.ndarray:
    return np.stack([np.bincount(place, stats[:, k], cells) for k in range(stats.shape[1])], axis=1)


class CellJob(Job):
    """Statistics of open nodes by feature and cell, with the values seen there."""

    def __init__(self, learner: Learner, nodes: list[int], cuts: list[np.ndarray]) -> None:
        self.learner, self.nodes, self.cuts = learner, nodes, cuts

    def map(self, block: Block) -> dict[int, tuple]:
        at = self.learner.tree.descend(block.x)
        where = np.full(len(self.learner.tree.feature), -1)
        where[self.nodes] = np.arange(len(self.nodes))
        slot = where[at]
        rows = np.flatnonzero(slot >= 0)
        if not len(rows):
            return {}
        stats, codes, x = self.learner.stats(block)[rows], block.codes(self.cuts, BINS)[rows], block.x[rows]
        x = np.where(np.isnan(x), np.inf, x)
        n_features = x.shape[1]
        place = ((slot[rows, None] * n_features + np.arange(n_features)) * CELLS + codes).reshape(-1)
        shape = (len(self.nodes), n_features, CELLS)
        size = int(np.prod(shape))
        grid = add_cells(place, np.repeat(stats, n_features, axis=0), size).reshape(*shape, -1)
        low, high = np.full(size, np.inf), np.full(size, -np.inf)
        np.minimum.at(low, place, x.reshape(-1))
        np.maximum.at(high, place, x.reshape(-1))
        low, high = low.reshape(shape), high.reshape(shape)
        each = self.learner.kind.spread(stats)
        least, most = np.full(len(self.nodes), np.inf), np.full(len(self.nodes), -np.inf)
        np.minimum.at(least, slot[rows], each)
        np.maximum.at(most, slot[rows], each)
        return {self.nodes[i]: (grid[i], low[i], high[i], least[i], most[i]) for i in np.unique(slot[rows])}

    def merge(self, left: tuple, right: tuple) -> tuple:
        return left[0] + right[0], np.minimum(left[1], right[1]), np.maximum(left[2], right[2]), min(left[3], right[3]), max(left[4], right[4])

    def finish(self, key: int, total: tuple) -> tuple:
        stats, low, high, least, most = total
        whole, spread = stats[0].sum(0), np.array([least, most])
        if not self.learner.kind.splittable(whole):
            return whole, spread, None, []
        best, looks = judge(self.learner.kind, stats, low, high, np.zeros((len(stats), stats.shape[2])), whole, spread, key, np.arange(len(stats)))
        return whole, spread, best, looks


class LookJob(Job):
    """The same for cells that are looked into, each with cuts of its own."""

    def __init__(self, learner: Learner, looks: list[Look], totals: dict[int, tuple]) -> None:
        self.learner, self.looks, self.totals = learner, looks, totals

    def map(self, block: Block) -> dict[int, tuple]:
        at = self.learner.tree.descend(block.x)
        order = np.argsort(at, kind="stable")
        bounds = np.searchsorted(at[order], np.arange(len(self.learner.tree.feature) + 1))
        stats = self.learner.stats(block)
        out = {}
        for i, look in enumerate(self.looks):
            rows = order[bounds[look.node]:bounds[look.node + 1]]
            x = block.x[rows, look.feature]
            inside = (x >= look.low) & (x <= look.high)
            if inside.any():
                rows, x = rows[inside], x[inside]
                place = np.searchsorted(look.cuts(), x, side="left")
                low, high = np.full(ZOOM + 1, np.inf), np.full(ZOOM + 1, -np.inf)
                np.minimum.at(low, place, x)
                np.maximum.at(high, place, x)
                out[i] = (add_cells(place, stats[rows], ZOOM + 1), low, high)
        return out

    def merge(self, left: tuple, right: tuple) -> tuple:
        return left[0] + right[0], np.minimum(left[1], right[1]), np.maximum(left[2], right[2])

    def finish(self, key: int, total: tuple) -> tuple:
        look = self.looks[key]
        stats, low, high = (a[None] for a in total)
        return judge(self.learner.kind, stats, low, high, look.before[None], *self.totals[look.node], look.node, np.array([look.feature]))


def best_splits(passes: LocalPasses | SparkPasses, learner: Learner, nodes: list[int], cuts: list[np.ndarray]) -> dict[int, tuple[np.ndarray, Best | None]]:
    """For every node its statistics and its best boundary (None: it cannot be split)."""
    totals: dict[int, tuple] = {}
    best: dict[int, Best | None] = {}
    looks: list[Look] = []
    for start in range(0, len(nodes), OPEN):
        for node, (whole, spread, found, more) in passes.run(CellJob(learner, nodes[start:start + OPEN], cuts)).items():
            totals[node], best[node] = (whole, spread), found
            looks += more
    while looks := sorted((k for k in looks if best[k.node] is None or k.bound >= best[k.node].score - TIE * abs(best[k.node].score)), key=lambda k: -k.bound):
        some, looks = looks[:4 * OPEN], looks[4 * OPEN:]          # the most promising ones first, they may settle the others
        for i, (found, more) in passes.run(LookJob(learner, some, totals)).items():
            if found is not None and found.beats(best[some[i].node]):
                best[some[i].node] = found
            looks += more
    return {node: (totals[node][0], best[node]) for node in totals}


def grow(passes: LocalPasses | SparkPasses, learner: Learner, cuts: list[np.ndarray], depth: int | None, leaf: Callable[[np.ndarray], float]) -> Tree:
    """Grow ``learner.tree`` level by level; ``leaf`` turns a node's statistics into its value, inner nodes have one, too."""
    tree = learner.tree
    open_ = [0]
    while open_ and (depth is None or tree.depth[open_[0]] < depth):
        following = []
        for node, (total, best) in sorted(best_splits(passes, learner, open_, cuts).items()):
            if node == 0:
                tree.value[0] = leaf(total)
            if best is None:
                continue
            right = total - best.left
            at = tree.split(node, best.feature, best.cut, False, (leaf(best.left), leaf(right)))
            following += [child for child, stats in ((at, best.left), (at + 1, right)) if learner.kind.splittable(stats)]
        open_ = following
    return tree


def exact_cuts(passes: LocalPasses | SparkPasses) -> list[np.ndarray]:
    return all_cuts(passes, BINS)
