"""Links between sets of tokens inside one task, by signature trees.

A set's signature is a bitmap of its tokens. A set of n tokens with s bits set
has n - s tokens that share a bit with another of its own (its excess). For two
sets the overlap is at most popcount(A & B) + min(excess A, excess B). A node
of the tree holds the OR of the bitmaps below it, the range of their sizes and
the largest excess, so the same bound holds for any pair below two nodes. A
dual traversal drops node pairs that cannot hold a link by bound or by sizes;
pairs of sets that are left are compared exactly.

What is wanted are groups, so pairs already known to be connected need no
comparison: nodes whose sets are all in one group are dropped together. Sets
that are nearly alike are linked to their neighbours in an order by smallest
tokens first, which leaves one group of them, however many they are.
"""

from __future__ import annotations

import numpy as np

FAN = 8
CHUNK = 8192
MIN_BITS, MAX_BITS = 256, 8192
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Groups:
    """Union-find over 0 .. n - 1."""

    def __init__(self, start: np.ndarray) -> None:
        first: dict[int, int] = {}
        self.parent = [first.setdefault(int(x), i) for i, x in enumerate(start)]
        self.merges = 0

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def union(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.parent[max(i, j)] = min(i, j)
        self.merges += 1
        return True

    def labels(self) -> np.ndarray:
        return np.array([self.find(i) for i in range(len(self.parent))], np.int64)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Common values of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


class Linker:
    """Sets with at least one token; a link needs D * |A & B| >= N * |A | B|."""

    def __init__(self, sets: list[np.ndarray], groups: np.ndarray | None = None, share: tuple[int, int] = (75, 100)) -> None:
        self.sets = sets
        self.n = np.array([len(s) for s in sets], np.int64)
        self.groups = Groups(np.arange(len(sets)) if groups is None else groups)
        self.part, self.whole = share
        self.links: list[tuple[int, int]] = []
        self.compared = 0
        self._sign()

    def _sign(self) -> None:
        bits = MIN_BITS
        while bits < MAX_BITS and bits < 2 * self.n.max(initial=0):
            bits *= 2
        shift = np.uint64(64 - bits.bit_length() + 1)
        at = (np.concatenate(self.sets) * _SPREAD >> shift).astype(np.int64)
        owner = np.repeat(np.arange(len(self.sets)), self.n)
        flat = np.zeros(len(self.sets) * bits, bool)
        flat[owner * bits + at] = True
        self.maps = np.packbits(flat.reshape(len(self.sets), bits), axis=1).view(np.uint64)
        self.excess = self.n - np.bitwise_count(self.maps).sum(axis=1).astype(np.int64)

    def enough(self, common, a, b):
        """Whether so many common tokens can link sets of these sizes."""
        return common * (self.part + self.whole) >= self.part * (a + b)

    def compare(self, i: int, j: int) -> bool:
        self.compared += 1
        if self.enough(overlap(self.sets[i], self.sets[j]), self.n[i], self.n[j]):
            self.links.append((i, j))
            self.groups.union(i, j)
            return True
        return False

    def run(self) -> list[tuple[int, int]]:
        """Links that connect exactly what all links connect."""
        if len(self.sets) > 1:
            self._neighbours()
            labels = self.groups.labels()
            heads = np.unique(labels, return_index=True)[1]
            if 1 < len(heads) < len(labels):
                self._traverse(heads)
                labels = self.groups.labels()
            if len(np.unique(labels)) > 1:
                self._traverse(np.lexsort((self.n, labels)))
        return self.links

    def _neighbours(self) -> None:
        """Compares each set with the next ones in an order by smallest tokens."""
        lows = np.array([[s[0], s[min(1, len(s) - 1)]] for s in self.sets])
        order = np.lexsort((self.n, lows[:, 1], lows[:, 0]))
        for step in (1, 2):
            for i, j in zip(order[:-step].tolist(), order[step:].tolist(), strict=True):
                if self.groups.find(i) != self.groups.find(j) and self._possible(np.array([i]), np.array([j]))[0]:
                    self.compare(i, j)

    def _possible(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        common = np.bitwise_count(self.maps[i] & self.maps[j]).sum(axis=1).astype(np.int64)
        return self.enough(common + np.minimum(self.excess[i], self.excess[j]), self.n[i], self.n[j])

    def _traverse(self, order: np.ndarray) -> None:
        levels = [(self.maps[order], self.n[order], self.n[order], self.excess[order])]
        while len(levels[-1][0]) > 1:
            maps, low, high, excess = levels[-1]
            at = np.arange(0, len(maps), FAN)
            levels.append(
                (np.bitwise_or.reduceat(maps, at, axis=0), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(excess, at))
            )
        seen, uniform = -1, []
        top = len(levels) - 1
        stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while stack:
            level, i, j = stack.pop()
            if seen != self.groups.merges:
                seen, uniform = self.groups.merges, self._uniform(order, top)
            u = uniform[level]
            keep = (u[i] != u[j]) | (u[i] < 0)
            i, j = i[keep], j[keep]
            maps, low, high, excess = levels[level]
            keep = (self.whole * high[i] >= self.part * low[j]) & (self.whole * high[j] >= self.part * low[i])
            i, j = i[keep], j[keep]
            common = np.bitwise_count(maps[i] & maps[j]).sum(axis=1).astype(np.int64)
            bound = np.minimum(common + np.minimum(excess[i], excess[j]), np.minimum(high[i], high[j]))
            keep = (i == j) | self.enough(bound, low[i], low[j])
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            if level == 0:
                for a, b in zip(order[i].tolist(), order[j].tolist(), strict=True):
                    if a != b and self.groups.find(a) != self.groups.find(b):
                        self.compare(a, b)
                continue
            below = len(levels[level - 1][0])
            a = (i[:, None] * FAN + np.arange(FAN))[:, :, None] + np.zeros(FAN, np.int64)
            b = (j[:, None] * FAN + np.arange(FAN))[:, None, :] + np.zeros((FAN, 1), np.int64)
            good = (a < below) & (b < below) & (a <= b)
            a, b = a[good], b[good]
            for first in range(0, len(a), CHUNK):
                stack.append((level - 1, a[first : first + CHUNK], b[first : first + CHUNK]))

    def _uniform(self, order: np.ndarray, top: int) -> list[np.ndarray]:
        """The group of each node's sets by level, -1 where there are several."""
        made = [self.groups.labels()[order]]
        for _ in range(top):
            at = np.arange(0, len(made[-1]), FAN)
            low, high = np.minimum.reduceat(made[-1], at), np.maximum.reduceat(made[-1], at)
            made.append(np.where(low == high, low, -1))
        return made
