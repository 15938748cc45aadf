"""Where rows leave many trees, found by bit masks.

The top of a tree, as many nodes as give 64 exits, is looked up at once. Its exits, which are leaves or nodes below which the tree goes
on, are numbered from left to right. A node that sends a row to the right rules out the exits on its left, and the row takes the first one that is not ruled out.
Which nodes of all trees send a row to the right depends, per feature, only on how many cuts lie below the row's value, so a
row costs one table line per feature for all trees together. Deeper trees are walked on from there, node by node.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np

MOST = 64           # exits that one mask holds
STRIP = 512         # rows whose masks are held at a time
ALL = (1 << 64) - 1


class Exits:
    """Trees as parallel arrays over all nodes: ``feature`` is -1 at a leaf, ``x <= cut`` goes ``left``, others to the node after it.

    Missing values go left where ``missing_left`` says so, everywhere when it is not given.
    """

    def __init__(self, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, roots: np.ndarray, missing_left: np.ndarray | None = None) -> None:
        self.feature, self.cut, self.left, self.roots, self.missing_left = feature, cut, left, roots, missing_left
        self.nodes = np.zeros((len(roots), MOST), np.int64)
        marks: dict[int, list[tuple]] = {}
        for tree, root in enumerate(roots):
            for at, mask in self._top(tree, int(root)):
                stays = missing_left is None or bool(missing_left[at])
                marks.setdefault(int(feature[at]), []).append((float(cut[at]), tree, mask, stays))
        self.tables = [(f, *self._table(found, len(roots))) for f, found in sorted(marks.items())]

    def _top(self, tree: int, root: int) -> Iterator[tuple[int, int]]:
        """Inner nodes of the tree's top with the exits that are left when a row goes to the right; fills in the exits."""
        opened, waiting = set(), deque([root])
        while waiting and len(opened) < MOST - 1:                       # level by level, so a tree of few exits is looked up deeper down
            at = waiting.popleft()
            if self.feature[at] >= 0:
                opened.add(at)
                waiting += (int(self.left[at]), int(self.left[at]) + 1)
        order, n = [(root, False)], 0
        first: dict[int, int] = {}
        while order:
            at, seen = order.pop()
            if seen:                                                    # all exits on the left of this node are numbered now
                yield at, ALL ^ (((1 << n) - 1) ^ ((1 << first[at]) - 1))
            elif at in opened:
                first[at], go = n, int(self.left[at])
                order += [(go + 1, False), (at, True), (go, False)]
            else:
                self.nodes[tree, n] = at
                n += 1

    @staticmethod
    def _table(found: list[tuple], trees: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct cuts of a feature, and per number of cuts below a value the exits left in each tree; the last line is for missing values."""
        cuts = np.unique([cut for cut, *_ in found])
        table = np.full((len(cuts) + 2, trees), ALL, np.uint64)
        for place, (_, tree, mask, stays) in zip(np.searchsorted(cuts, [cut for cut, *_ in found]), found, strict=True):
            table[place + 1, tree] &= np.uint64(mask)
            if not stays:
                table[-1, tree] &= np.uint64(mask)
        np.bitwise_and.accumulate(table[:-1], axis=0, out=table[:-1])
        return cuts, table

    def _leaves(self, x: np.ndarray) -> np.ndarray:
        """[row, tree] node each row ends in."""
        alive = np.full((len(x), len(self.roots)), ALL, np.uint64)
        for f, cuts, table in self.tables:
            v = x[:, f]
            at = np.searchsorted(cuts, v, side="left")
            at[np.isnan(v)] = len(cuts) + 1
            alive &= table[at]
        lowest = (alive & (~alive + np.uint64(1))).astype(np.float64)                      # a power of two, so its exponent is the place
        place = (lowest.view(np.int64) >> 52) - 1023
        ends = self.nodes.reshape(-1)[place + np.arange(len(self.roots)) * MOST].reshape(-1)
        moving = np.flatnonzero(self.feature[ends] >= 0)
        while len(moving):
            here = ends[moving]
            v = x[moving // len(self.roots), self.feature[here]]
            right = v > self.cut[here]
            if self.missing_left is not None:
                right |= np.isnan(v) & ~self.missing_left[here]
            ends[moving] = here = self.left[here] + right
            moving = moving[self.feature[here] >= 0]
        return ends.reshape(len(x), -1)

    def total(self, x: np.ndarray, value: np.ndarray, start: float = 0.0) -> np.ndarray:
        """``start`` and the values of the nodes each row ends in, added tree by tree."""
        out = np.empty(len(x))
        parts = np.empty((STRIP, len(self.roots) + 1))
        parts[:, 0] = start
        for at in range(0, len(x), STRIP):
            rows = x[at:at + STRIP]
            some = parts[:len(rows)]
            some[:, 1:] = value[self._leaves(rows)]
            out[at:at + STRIP] = np.cumsum(some, axis=1)[:, -1]         # one after the other, as a loop over the trees adds them
        return out
