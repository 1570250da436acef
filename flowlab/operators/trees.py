"""Ensembles of regression trees as flat arrays, evaluated over whole batches of rows."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

CELLS = 1 << 18  # rows x trees looked at together


@dataclass
class Tree:
    """Nodes in arrays. An inner node's children are `child` (rows whose feature is at most
    the threshold) and `child` + 1; a leaf is its own child. `leaf` numbers the leaves in
    depth-first order, -1 for inner nodes."""

    feature: np.ndarray
    threshold: np.ndarray
    child: np.ndarray
    value: np.ndarray
    leaf: np.ndarray
    gain: np.ndarray  # of each split

    @property
    def inner(self) -> np.ndarray:
        return self.child != np.arange(len(self.child))


_SPLIT = re.compile(r"If \(feature (\d+) <= (\S+)\)")
_LEAF = re.compile(r"Predict: (\S+)")


def parse_tree(text: str, columns: Sequence[int] | None = None) -> Tree:
    """A fitted regression tree from its printed form; `columns` are the features it saw."""
    feature, threshold, child, value, leaf = [0], [np.inf], [0], [0.0], [-1]
    open_nodes, leaves = [0], 0
    for line in text.split("\n"):
        if split := _SPLIT.search(line):
            at, first = open_nodes.pop(), len(child)
            column = int(split[1])
            feature[at] = column if columns is None else columns[column]
            threshold[at], child[at] = float(split[2]), first
            for i in (0, 1):
                feature.append(0)
                threshold.append(np.inf)
                child.append(first + i)
                value.append(0.0)
                leaf.append(-1)
            open_nodes += [first + 1, first]
        elif found := _LEAF.search(line):
            at = open_nodes.pop()
            value[at], leaf[at] = float(found[1]), leaves
            leaves += 1
    return Tree(np.array(feature, np.int32), np.array(threshold), np.array(child, np.int32),
                np.array(value), np.array(leaf, np.int32), np.zeros(len(child)))


def soft(total: np.ndarray | float, l1: float) -> np.ndarray | float:
    """`total` drawn towards zero by `l1`."""
    return np.sign(total) * np.maximum(np.abs(total) - l1, 0.0)


def regularised(tree: Tree, gradient: np.ndarray, hessian: np.ndarray, rate: float,
                l1: float, l2: float, gamma: float) -> Tree:
    """The tree with leaf values -soft(G, l1) / (H + l2) times the rate, from the sums of each
    leaf. A split of two leaves that gains less than `gamma` becomes a leaf, from below."""
    inner = tree.inner
    nodes = len(tree.child)
    g, h = np.zeros(nodes), np.zeros(nodes)
    ends = tree.leaf >= 0
    g[ends], h[ends] = gradient[tree.leaf[ends]], hessian[tree.leaf[ends]]

    def score(i: int) -> float:
        return float(soft(g[i], l1) ** 2 / (h[i] + l2)) if h[i] + l2 > 0 else 0.0

    child, gain = tree.child.copy(), np.zeros(nodes)
    for i in range(nodes - 1, -1, -1):  # children come after their parents
        if inner[i]:
            a = child[i]
            g[i], h[i] = g[a] + g[a + 1], h[a] + h[a + 1]
            gain[i] = score(a) + score(a + 1) - score(i)
            if child[a] == a and child[a + 1] == a + 1 and gain[i] < gamma:
                child[i] = i
    value = np.where(h + l2 > 0, -rate * soft(g, l1) / np.where(h + l2 > 0, h + l2, 1.0), 0.0)
    ends = child == np.arange(nodes)
    return Tree(tree.feature, np.where(ends, np.inf, tree.threshold), child, np.where(ends, value, 0.0),
                tree.leaf, np.where(ends, 0.0, gain))


@dataclass
class Walk:
    """A tree over codes of the features: a row goes left if its code of a node's feature is at most
    the node's cut."""

    feature: list[int]
    cut: list[int]
    child: list[int]
    levels: int = 0  # of splits
    value: np.ndarray | None = None

    def ends(self, codes: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """The node where each of the rows ends; `codes` is (features, rows)."""
        n = codes.shape[1]
        rows = np.arange(n) if rows is None else rows
        at = np.zeros(len(rows), np.int64)
        feature, cut, child = (np.array(a, np.int64) for a in (self.feature, self.cut, self.child))
        flat, start = codes.reshape(-1), feature * n
        for _ in range(self.levels):
            place = start.take(at)
            place += rows
            right = flat.take(place) > cut.take(at)
            at = child.take(at)
            at += right
        return at

    def added(self, margins: np.ndarray, codes: np.ndarray) -> None:
        """Adds each row's leaf value to its margin."""
        margins += self.value.take(self.ends(codes))


class Growth(Walk):
    """A tree while it grows. `g` and `h` are the sums of each node's rows."""

    def __init__(self):
        super().__init__([0], [_NEVER], [0])
        self.threshold = [np.inf]
        self.g, self.h, self.depth = [0.0], [0.0], [0]
        self.final: Tree | None = None

    @property
    def size(self) -> int:
        return len(self.child)

    def total(self, g: float, h: float) -> None:
        self.g[0], self.h[0] = g, h

    def split(self, node: int, feature: int, threshold: float, cut: int,
              g: tuple[float, float], h: tuple[float, float]) -> list[int]:
        """Gives a leaf two children, and returns these."""
        first = self.size
        self.feature[node], self.threshold[node], self.cut[node], self.child[node] = feature, threshold, int(cut), first
        for i in (0, 1):
            self.feature.append(0)
            self.threshold.append(np.inf)
            self.cut.append(_NEVER)
            self.child.append(first + i)
            self.g.append(g[i])
            self.h.append(h[i])
            self.depth.append(self.depth[node] + 1)
        self.levels = max(self.levels, self.depth[first])
        return [first, first + 1]

    def walk(self) -> Walk:
        """What the rows need of it."""
        return Walk(self.feature, self.cut, self.child, self.levels, self.value)

    def tree(self) -> tuple[Tree, np.ndarray, np.ndarray]:
        """The tree before its leaf values, with the sums of its leaves, numbered in depth-first order."""
        leaf, found, open_nodes = np.full(self.size, -1, np.int32), [], [0]
        while open_nodes:
            at = open_nodes.pop()
            if self.child[at] == at:
                leaf[at] = len(found)
                found.append(at)
            else:
                open_nodes += [self.child[at] + 1, self.child[at]]
        tree = Tree(np.array(self.feature, np.int32), np.array(self.threshold), np.array(self.child, np.int32),
                    np.zeros(self.size), leaf, np.zeros(self.size))
        return tree, np.array(self.g)[found], np.array(self.h)[found]

    def value_by(self, tree: Tree) -> None:
        """Takes the leaf values, and the splits taken back, of the finished tree."""
        self.final, self.value = tree, tree.value
        self.child = tree.child.tolist()
        self.cut = [c if inner else _NEVER for c, inner in zip(self.cut, tree.inner)]


_NEVER = np.iinfo(np.int64).max  # the cut of a leaf, whose rows stay


def reachable(tree: Tree) -> np.ndarray:
    """Whether a row can come to each node: those below a split taken back can't be met."""
    met = np.zeros(len(tree.child), bool)
    met[0] = True
    for i in np.flatnonzero(tree.inner):
        if met[i]:
            met[[tree.child[i], tree.child[i] + 1]] = True
    return met


class Forest:
    """Trees with a class each, their nodes in shared arrays."""

    def __init__(self, trees: Sequence[Tree], classes: Sequence[int], k: int):
        sizes = [len(t.child) for t in trees]
        starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        self.k = k
        # Trees of a class side by side, so that each class sums one range.
        self.order = np.argsort(np.array(classes, np.int64), kind="stable")
        self.roots = starts[:-1][self.order]
        self.bounds = np.searchsorted(np.array(classes, np.int64)[self.order], np.arange(k + 1))

        def joined(parts: list, kind) -> np.ndarray:
            return np.concatenate([np.empty(0, kind), *parts]).astype(kind)

        inner = joined([t.inner for t in trees], bool)
        self.feature = joined([t.feature for t in trees], np.int32)
        self.threshold = joined([t.threshold for t in trees], np.float64)
        self.child = joined([t.child + s for t, s in zip(trees, starts)], np.int32)
        self.value = joined([t.value for t in trees], np.float64)
        self.leaf = joined([t.leaf for t in trees], np.int32)
        self.feature[~inner] = -1  # a column of zeros that follows the features
        self.depth = max((_depth(t) for t in trees), default=0)

    def nodes(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees in class order): where each row ends. `x` has a last column of zeros."""
        at = np.repeat(self.roots[None, :], len(x), axis=0)
        width = x.shape[1]
        flat, base = np.ascontiguousarray(x).reshape(-1), (np.arange(len(x)) * width + width)[:, None]
        for _ in range(self.depth):
            feature = self.feature[at]
            seen = flat[np.where(feature < 0, base - 1, base - width + feature)]
            # What is not at most the threshold, missing values included, goes on.
            at = self.child[at] + ~(seen <= self.threshold[at])
        return at

    def margins(self, x: np.ndarray) -> np.ndarray:
        """(rows, k): the sums of the leaf values of each class's trees."""
        out = np.zeros((len(x), self.k))
        if not len(self.roots):
            return out
        wide = np.concatenate([x, np.zeros((len(x), 1))], axis=1)
        step = max(1, CELLS // len(self.roots))
        for start in range(0, len(x), step):
            values = self.value[self.nodes(wide[start:start + step])]
            for c in range(self.k):
                out[start:start + step, c] = values[:, self.bounds[c]:self.bounds[c + 1]].sum(axis=1)
        return out

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """(rows, trees in class order): the number of the leaf where each row ends."""
        return self.leaf[self.nodes(np.concatenate([x, np.zeros((len(x), 1))], axis=1))]


def _depth(tree: Tree) -> int:
    depth = np.zeros(len(tree.child), np.int64)
    for i in np.flatnonzero(tree.inner):
        depth[[tree.child[i], tree.child[i] + 1]] = depth[i] + 1
    return int(depth.max())


def softmax(margins: np.ndarray, axis: int = 1) -> np.ndarray:
    """Shares of the classes, which lie along `axis`."""
    share = margins - margins.max(axis=axis, keepdims=True)
    np.exp(share, out=share)
    share /= share.sum(axis=axis, keepdims=True)
    return share
