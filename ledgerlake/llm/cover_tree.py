"""Simplified cover trees over integer points, a forest at a time.

A node holds the points of one run of the forest's order, a centre among
them and their largest distance from it. A node that is not a leaf takes the
largest power of two below that distance: its first child keeps the centre,
further children have the first point that no child covers as centre, and a
child holds what lies within the power from its centre and in no earlier
child. So children cover their points and are further apart than the power.
Nodes of up to LEAF points, or whose points are all equal, are leaves.

``assign`` finds each point's nearest entry of its tree's codebook. For a
node with centre c and radius r, an entry further from c than the nearest
one by more than 2 r is nearest to none of its points; when one entry is
left, the whole subtree goes to it, its sums read from cumulative sums. Only
the other nodes are opened, and points of leaves compared exactly. The distances that rule entries
out are rounded outwards, the comparisons that decide are of integers.
"""

from __future__ import annotations

import numpy as np

LEAF = 8
#: points compared at once
STEP = 8192
SLACK = 1e-9


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("...i,...i->...", d, d)


def spread(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """low[0] .. high[0] - 1, low[1] .. high[1] - 1, and so on."""
    n = high - low
    return np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class Forest:
    """Trees over ``points`` (trees, n, dims). After ``build``: points in the
    forest's order (trees * n, dims), ``rows``: the row in its tree of each,
    and one entry per node of ``centre``, ``low``, ``high``, ``radius``,
    ``child_low`` and ``child_high``; the first ``trees`` nodes are the roots."""

    def __init__(self, trees: int, points, rows, centre, low, high, radius, child_low, child_high):
        self.trees, self.points, self.rows, self.centre = trees, points, rows, centre
        self.low, self.high, self.radius, self.child_low, self.child_high = low, high, radius, child_low, child_high

    @classmethod
    def build(cls, points: np.ndarray) -> "Forest":
        trees, n, dims = points.shape
        flat = points.reshape(-1, dims).astype(np.int64)
        order = np.arange(trees * n)
        low = np.arange(trees) * n
        centre = low.copy()
        high = low + n
        levels = []
        made = 0
        while len(low):
            # all nodes of this level: the distances of their points from their centres
            members = spread(low, high)
            node = np.repeat(np.arange(len(low)), high - low)
            square = _squared(flat[order[members]], flat[centre[node]])
            starts = np.cumsum(high - low) - (high - low)
            radius = np.sqrt(np.maximum.reduceat(square, starts).astype(float))
            open_ = (high - low > LEAF) & (radius > 0)
            children = np.zeros(len(low), np.int64)
            next_low = next_high = next_centre = np.empty(0, np.int64)
            if open_.any():
                power = np.exp2(np.ceil(np.log2(np.maximum(radius, 1.0))) - 1)
                limit = np.square(power)
                here = open_[node]
                at, own = members[here], node[here]
                child = np.empty(len(at), np.int64)  # the child of each point, counted within its node
                left = np.arange(len(at))
                now, turn = centre.copy(), 0
                centres = []
                while len(left):
                    if turn:
                        first = np.flatnonzero(np.diff(own[left], prepend=-1))
                        now[own[left[first]]] = order[at[left[first]]]
                        parents = own[left[first]]
                    else:
                        parents = np.flatnonzero(open_)
                    centres.append((parents, now[parents].copy()))
                    children[parents] += 1
                    o = own[left]
                    inside = _squared(flat[order[at[left]]], flat[now[o]]) <= limit[o]
                    child[left[inside]] = turn
                    left = left[~inside]
                    turn += 1
                key = own * turn + child
                by = np.argsort(key, kind="stable")
                order[at] = order[at[by]]
                begin = np.flatnonzero(np.diff(key[by], prepend=-1))
                next_low = at[begin]
                next_high = next_low + np.diff(np.append(begin, len(by)))
                parents = np.concatenate([p for p, _ in centres])
                turns = np.repeat(np.arange(turn), [len(p) for p, _ in centres])
                next_centre = np.concatenate([c for _, c in centres])[np.argsort(parents * turn + turns, kind="stable")]
            made += len(low)
            child_high = made + np.cumsum(children)
            levels.append((flat[centre], low, high, radius, child_high - children, child_high))
            low, high, centre = next_low, next_high, next_centre
        columns = [np.concatenate(c) for c in zip(*levels)]
        return cls(trees, flat[order], order % n, *columns)

    def assign(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The nearest of ``entries`` (trees, k, dims) for each point, the
        lower number of equals; the number of points of each entry and their sums."""
        trees, k, dims = entries.shape
        per_tree = len(self.points) // trees
        entries = entries.astype(np.int64)
        code = np.empty(len(self.points), np.int64)
        number, sums = np.zeros(trees * k, np.int64), np.zeros((trees * k, dims), np.int64)
        total = np.concatenate([np.zeros((1, dims), np.int64), np.cumsum(self.points, axis=0, dtype=np.int64)])
        far = np.iinfo(np.int64).max
        front = np.arange(trees)
        may = np.ones((trees, k), bool)
        while len(front):
            low, high, radius = self.low[front], self.high[front], self.radius[front]
            tree = low // per_tree
            square = np.where(may, _squared(self.centre[front][:, None].astype(np.int64), entries[tree]), far)
            best = np.argmin(square, axis=1)
            away = np.sqrt(square.astype(float))
            nearest = away[np.arange(len(front)), best]
            may &= away * (1 - SLACK) <= ((nearest + 2 * radius) * (1 + SLACK))[:, None]
            whole = (may.sum(axis=1) == 1) | (radius == 0)
            key = tree[whole] * k + best[whole]
            code[spread(low[whole], high[whole])] = np.repeat(best[whole], (high - low)[whole])
            np.add.at(number, key, (high - low)[whole])
            np.add.at(sums, key, total[high[whole]] - total[low[whole]])
            leaf = ~whole & (self.child_low[front] == self.child_high[front])
            if leaf.any():
                at = spread(low[leaf], high[leaf])
                size = (high - low)[leaf]
                own, allowed = np.repeat(tree[leaf], size), np.repeat(may[leaf], size, axis=0)
                for s in range(0, len(at), STEP):
                    here, mine = at[s:s + STEP], own[s:s + STEP]
                    points = self.points[here].astype(np.int64)
                    exact = np.where(allowed[s:s + STEP], _squared(points[:, None], entries[mine]), far)
                    code[here] = found = np.argmin(exact, axis=1)
                    np.add.at(number, mine * k + found, 1)
                    np.add.at(sums, mine * k + found, points)
            more = ~whole & ~leaf
            children = (self.child_high - self.child_low)[front[more]]
            may = np.repeat(may[more], children, axis=0)
            front = spread(self.child_low[front[more]], self.child_high[front[more]])
        return code, number.reshape(trees, k), sums.reshape(trees, k, dims)
