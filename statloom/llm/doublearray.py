"""A trie of word sequences as a double array, stepped for many states at once.

A state ``s`` goes on with symbol ``c`` to ``base[s] + c`` if ``check`` there names ``s`` as its parent.
Symbols are below ``SYMBOLS``; larger numbers are written as several of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SYMBOLS = 1 << 8
_TRIED = 1 << 10  # places tested at once for a node's children
_ROUNDS = 64  # of them, before its children go behind all others


@dataclass
class DoubleArray:
    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray  # the sequence that ends in a state, or -1

    def step(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """The states behind ``states``; -1 where the trie has none. Symbols below 0 lead nowhere."""
        place = self.base[states] + symbols
        inside = (symbols >= 0) & (place >= 0) & (place < len(self.check))
        return np.where(inside & (self.check[np.where(inside, place, 0)] == states), place, -1)


def _places(symbols: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, int]:
    """A base per node, so that all children of all nodes have slots of their own; slot 0 is the root's."""
    bases = np.zeros(len(begins), dtype=np.int64)
    free = np.ones(1 << 16, dtype=bool)
    free[0] = False
    top = 1  # slots from here on are all free

    def grown(size: int) -> None:
        nonlocal free
        if size > len(free):
            free = np.concatenate([free, np.ones(max(size - len(free), len(free)), dtype=bool)])

    last: dict[int, int] = {}  # where the last node with so many children went
    for node in np.argsort(-sizes, kind="stable")[: int((sizes > 1).sum())].tolist():
        own = symbols[begins[node] : begins[node] + sizes[node]]
        grown(top + 2 * SYMBOLS + _TRIED)
        base, at = top - int(own[0]), last.get(len(own), 1)
        offsets = own - own[0]
        for _ in range(_ROUNDS):
            if at >= top:
                break
            fits = free[at : at + _TRIED].copy()
            for shift in offsets[1:].tolist():
                fits &= free[at + shift : at + shift + _TRIED]
                if not fits.any():
                    break
            first = int(fits.argmax())
            if fits[first]:
                base = at + first - int(own[0])
                break
            at += _TRIED
        last[len(own)] = base + int(own[0])
        free[base + own] = False
        top = max(top, base + int(own[-1]) + 1)
        bases[node] = base
    single = np.flatnonzero(sizes == 1)
    grown(top + len(single))
    slots = np.flatnonzero(free[:top])[: len(single)]
    slots = np.concatenate([slots, np.arange(top, top + len(single) - len(slots))])
    bases[single] = slots - symbols[begins[single]]
    return bases, max(top, int(slots[-1]) + 1 if len(slots) else 1)


def build(paths: np.ndarray) -> DoubleArray:
    """From rows of symbols, padded behind with -1; row ``i`` is accepted as ``i``. Rows are distinct."""
    order = np.lexsort(paths.T[::-1])
    rows = paths[order]
    parents, symbols, accepted = [], [], []  # of all nodes but the root, level by level
    above = np.zeros(len(rows), dtype=np.int64)  # every row's node on the level before
    count = 1
    accept_root = np.flatnonzero(paths[:, 0] < 0) if len(paths) else []
    for level in range(paths.shape[1] if len(paths) else 0):
        here = rows[:, level] >= 0
        if not here.any():
            break
        held = np.flatnonzero(here)
        fresh = np.ones(len(held), dtype=bool)
        fresh[1:] = (above[held][1:] != above[held][:-1]) | (rows[held, level][1:] != rows[held, level][:-1])
        node = count + np.cumsum(fresh) - 1
        parents.append(above[held][fresh])
        symbols.append(rows[held, level][fresh])
        last = held if level + 1 == paths.shape[1] else held[rows[held, level + 1] < 0]
        accepted.append(np.stack([node[np.searchsorted(held, last)], order[last]]))
        above[held] = node
        count += int(fresh.sum())
    parent = np.concatenate([*parents, np.empty(0, dtype=np.int64)]).astype(np.int64)
    symbol = np.concatenate([*symbols, np.empty(0, dtype=np.int64)]).astype(np.int64)
    begins = np.searchsorted(parent, np.arange(count))  # nodes are numbered so that parents ascend
    sizes = np.searchsorted(parent, np.arange(count), side="right") - begins
    bases, size = _places(symbol, begins, sizes)
    state = np.zeros(count, dtype=np.int64)
    state[1:] = bases[parent] + symbol
    made = DoubleArray(np.zeros(size, dtype=np.int32), np.full(size, -1, dtype=np.int32), np.full(size, -1, dtype=np.int32))
    made.base[state] = bases
    made.check[state[1:]] = state[parent]
    for node, row in (x.tolist() for x in accepted):
        made.accept[state[node]] = row
    made.accept[0] = accept_root[0] if len(accept_root) else -1
    return made
