"""Ensembles of binary trees as flat arrays: training bins, walking and bit-vector scoring.

Nodes are numbered as in a heap: the children of node i are 2i + 1 (``x <= threshold``) and
2i + 2. An array of n trees of depth d holds ``2**(d + 1) - 1`` nodes a tree.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Trees whose bit vectors are held together while rows are scored, and rows of a block.
TREE_BLOCK, ROW_BLOCK = 8, 8192
LEAF = -1


@dataclass
class Trees:
    """``feature`` (-1 for a leaf), ``threshold``, ``value`` and ``cover`` of every node, by tree;
    ``target`` tells the class index a tree adds to."""

    target: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    cover: np.ndarray
    _scorer: list = field(default_factory=list, repr=False, compare=False)

    @property
    def depth(self) -> int:
        return int(np.log2(self.feature.shape[1] + 1)) - 1

    def __len__(self) -> int:
        return len(self.target)

    def nbytes(self) -> int:
        return sum(a.nbytes for a in (self.target, self.feature, self.threshold, self.value,
                                      self.cover))

    def __getstate__(self):
        return {**self.__dict__, "_scorer": []}

    def walk(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row in every tree, node by node."""
        at = np.zeros((len(x), len(self)), np.int64)
        trees, rows = np.arange(len(self))[None, :], np.arange(len(x))[:, None]
        for _ in range(self.depth):
            f = self.feature[trees, at]
            right = x[rows, f] > self.threshold[trees, at]
            at = np.where(f == LEAF, at, 2 * at + 1 + right)
        return at

    def margins(self, x: np.ndarray, n_targets: int) -> np.ndarray:
        """Sums of leaf values by target, through bit vectors."""
        if not self._scorer:
            self._scorer.append(_Scorer(self))
        out = np.zeros((len(x), n_targets))
        for at in range(0, len(x), ROW_BLOCK):
            self._scorer[0].add(x[at:at + ROW_BLOCK], out[at:at + ROW_BLOCK])
        return out


class _Scorer:
    """All trees by test instead of by node.

    Each distinct test (feature, threshold) is made once for a block of rows, as a vector of one
    bit a row. A tree then asks of every row which way it goes at each level: among the tests of
    the level's nodes, paired up from the right, the row's earlier turns pick its own. All of this
    is done on whole words of 64 rows; the turns of a row, unpacked, are the number of its leaf.
    """

    def __init__(self, trees: Trees):
        self.depth, self.target = trees.depth, trees.target
        n, width, n_leaves = *trees.feature.shape, 1 << trees.depth
        # A leaf above the last level stands at the first of the places below it, and is written
        # after the unused nodes there.
        self.values = np.zeros((n, n_leaves))
        for node in reversed(range(width)):
            level = int(np.log2(node + 1))
            first = (node + 1 - (1 << level)) << (self.depth - level)
            ends = trees.feature[:, node] == LEAF
            self.values[ends, first] = trees.value[ends, node]
        inner, threshold = trees.feature[:, :n_leaves - 1], trees.threshold[:, :n_leaves - 1]
        tree, node = np.nonzero(inner != LEAF)
        used, place = np.unique(np.stack([inner[tree, node].astype(float), threshold[tree, node]]),
                                axis=1, return_inverse=True)
        # test 0 is never passed, so rows of a leaf above the last level keep left
        self.tests = np.zeros(inner.shape, np.intp)
        self.tests[tree, node] = place.ravel() + 1
        feature = used[0].astype(int)
        self.features = [(int(f), own[0] + 1, used[1][own]) for f in np.unique(feature)
                         for own in [np.flatnonzero(feature == f)]]
        self.n_tests = used.shape[1] + 1

    def add(self, x: np.ndarray, out: np.ndarray) -> None:
        """Add the leaf values of the rows of ``x`` to ``out``."""
        n = len(x)
        words = -(-n // 64)
        passed = np.zeros((self.n_tests, words), np.uint64)
        as_bytes = passed.view(np.uint8)
        for f, first, limits in self.features:
            bits = np.packbits(x[:, f][None, :] > limits[:, None], axis=1, bitorder="little")
            as_bytes[first:first + len(limits), :bits.shape[1]] = bits
        kind = np.min_scalar_type((1 << self.depth) - 1)
        for at in range(0, len(self.target), TREE_BLOCK):
            tests, target = self.tests[at:at + TREE_BLOCK], self.target[at:at + TREE_BLOCK]
            turns: list[np.ndarray] = []
            leaf = np.zeros((len(tests), n), kind)
            for level in range(self.depth):
                turn = passed[tests[:, (1 << level) - 1:(2 << level) - 1]]
                for earlier in reversed(turns):
                    left, turn = turn[:, 0::2], turn[:, 1::2]
                    turn ^= left
                    turn &= earlier[:, None, :]
                    turn ^= left
                turns.append(turn[:, 0])
                leaf <<= 1
                leaf |= np.unpackbits(np.ascontiguousarray(turns[-1]).view(np.uint8), axis=1,
                                      count=n, bitorder="little")
            values = self.values[at:at + TREE_BLOCK]
            for t in np.unique(target):
                total = np.zeros(n)
                for own in np.flatnonzero(target == t):
                    total += values[own].take(leaf[own])
                out[:, t] += total


def stacked(parts: list[Trees]) -> Trees:
    return Trees(*(np.concatenate([getattr(p, name) for p in parts]) for name in (
        "target", "feature", "threshold", "value", "cover")))
