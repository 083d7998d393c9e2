"""Double-array tries over word labels, built and walked by numpy inside tasks and on the driver."""

from __future__ import annotations

import numpy as np


class Trie:
    """Paths of 64-bit labels as a double array: a slot of ``base + label`` is the child if ``check`` agrees.

    A state is a slot. As labels have 64 bits and some states many children, a state owns
    several cells of ``base``, about one for two children; a label chooses its cell by remainder,
    and ``check`` holds the cell. The label itself is compared too, so no path is taken by chance.
    Slots are at least twice the states, so memory is at most about 130 bytes a state.
    """

    def __init__(self, paths: list[np.ndarray], seed: int = 7):
        """``paths[n]`` has a row of ``n + 1`` labels for each path of that length; prefixes are added."""
        levels = _levels(paths)
        n = sum(len(labels) for labels, _ in levels)
        size = 1 << int(np.ceil(np.log2(max(4, 2 * n))))
        self.mask = np.uint64(size - 1)
        label = np.concatenate([np.zeros(1, np.uint64), *[labels for labels, _ in levels]])
        parent = np.concatenate([np.zeros(1, np.int64), *[up for _, up in levels]])
        cell, first, width = _cells(label, parent, self.mask)
        slot = _placed(cell, label, self.mask, np.random.default_rng(seed))
        # by slot; the root stands outside the array
        at = slot[1:]
        self.check = np.full(size, -1, np.int32)
        self.label = np.zeros(size, np.uint64)
        self.parent = np.full(size, -1, np.int32)
        self.first = np.zeros(size, np.int32)
        self.width = np.zeros(size, np.int32)
        self.check[at], self.label[at] = cell[1:], label[1:]
        self.parent[at] = slot[parent[1:]]
        self.first[at], self.width[at] = first[1:], width[1:]
        self.root = int(first[0]), int(width[0])
        self.base = np.zeros(int(cell.max(initial=0)) + 1, np.uint64)
        self.base[cell[1:]] = (at.astype(np.uint64) - _offset(label[1:])) & self.mask

    @classmethod
    def of(cls, arrays: dict) -> Trie:
        """The trie whose ``vars`` these are."""
        trie = cls.__new__(cls)
        trie.__dict__.update(arrays)
        return trie

    @property
    def size(self) -> int:
        return len(self.check)

    def step(self, states: np.ndarray | None, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places among the given that have a child by their label, and the children. ``None``: from the root."""
        if states is None:
            first, width = np.int64(self.root[0]), np.int64(self.root[1])
            alive = np.arange(len(labels) if self.root[1] else 0)
            labels = labels[alive]
        else:
            width = self.width[states]
            alive = np.flatnonzero(width)
            first, width, labels = self.first[states[alive]].astype(np.int64), width[alive], labels[alive]
        cell = first + (labels % np.asarray(width, np.uint64)).astype(np.int64)
        slot = ((self.base[cell] + _offset(labels)) & self.mask).astype(np.int64)
        found = (self.check[slot] == cell) & (self.label[slot] == labels)
        return alive[found], slot[found]

    def count(self, labels: np.ndarray, depth: int) -> np.ndarray:
        """How often each slot is reached from all positions of a text, as a label's path of 2 to ``depth`` steps."""
        reached = []
        places, states = self.step(None, labels)
        for level in range(2, depth + 1):
            inside = places + level <= len(labels)
            places, states = places[inside], states[inside]
            kept, states = self.step(states, labels[places + level - 1])
            places = places[kept]
            reached.append(states)
        return np.bincount(np.concatenate(reached), minlength=self.size)

    def paths(self, slots: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The labels that lead to each slot, a row each, filled up with zeros, and their number."""
        out = np.zeros((len(slots), depth), np.uint64)
        steps = np.zeros(len(slots), np.int64)
        up = slots.copy()
        while (going := up >= 0).any():
            steps += going
            up = np.where(going, self.parent[np.maximum(up, 0)], -1)
        up, left = slots.copy(), steps.copy()
        for _ in range(depth):
            going = np.flatnonzero(left > 0)
            out[going, left[going] - 1] = self.label[up[going]]
            up[going] = self.parent[up[going]]
            left[going] -= 1
        return out, steps


def _offset(labels: np.ndarray) -> np.ndarray:
    return labels >> np.uint64(32)


def _levels(paths: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each depth the labels of its states and the numbers of their parents; the root is state 0."""
    out, before, first = [], [np.zeros(len(p), np.int64) for p in paths], 1
    for depth in range(len(paths)):
        ups = np.concatenate(before[depth:])
        labels = np.concatenate([p[:, depth] for p in paths[depth:]])
        order = np.lexsort([labels, ups])
        ups, labels = ups[order], labels[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (ups[1:] != ups[:-1]) | (labels[1:] != labels[:-1])
        number = np.empty(len(order), np.int64)
        number[order] = first + np.cumsum(fresh) - 1
        out.append((labels[fresh], ups[fresh]))
        first += int(fresh.sum())
        at = 0
        for i in range(depth, len(paths)):
            before[i] = number[at : at + len(paths[i])]
            at += len(paths[i])
    return out


def _cells(label: np.ndarray, parent: np.ndarray, mask: np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cell of each state, and of each parent its first cell and how many it has.

    A cell can't be placed if two labels of it have the same offset; such a parent takes more cells.
    """
    children = np.bincount(parent[1:], minlength=len(label))
    width = (children + 1) // 2
    while True:
        first = np.cumsum(width) - width
        up = parent[1:]
        cell = first[up] + (label[1:] % np.maximum(width[up], 1).astype(np.uint64)).astype(np.int64)
        key = _offset(label[1:]) & mask
        order = np.lexsort([key, cell])
        same = (cell[order][1:] == cell[order][:-1]) & (key[order][1:] == key[order][:-1])
        clashing = np.unique(up[order][1:][same])
        if not len(clashing):
            return np.concatenate([[-1], cell]), first, width
        width[clashing] = 2 * width[clashing] + 1


def _placed(cell: np.ndarray, label: np.ndarray, mask: np.uint64, random: np.random.Generator) -> np.ndarray:
    """A slot for each state, those of a cell at one base; cells with many children choose first."""
    slot = np.full(len(cell), -1, np.int64)
    taken = np.zeros(int(mask) + 1, bool)
    order = 1 + np.argsort(cell[1:], kind="stable")
    key = _offset(label[order])
    starts = np.flatnonzero(np.append(True, np.diff(cell[order]) != 0)) if len(order) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(order)))
    for size in sorted(set(sizes.tolist()), reverse=True):
        todo = starts[sizes == size]
        while len(todo):
            inside = todo[:, None] + np.arange(size)
            base = random.integers(0, int(mask) + 1, len(todo), dtype=np.uint64)
            wanted = ((base[:, None] + key[inside]) & mask).astype(np.int64)
            # of cells that want one slot the first has it
            _, earliest = np.unique(wanted, return_index=True)
            first = np.zeros(wanted.size, bool)
            first[earliest] = True
            good = (first.reshape(wanted.shape) & ~taken[wanted]).all(axis=1)
            slot[order[inside[good]]] = wanted[good]
            taken[wanted[good]] = True
            todo = todo[~good]
    return slot
