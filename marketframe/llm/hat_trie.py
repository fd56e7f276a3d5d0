"""Counting of integer sequences in a HAT-trie: hash containers under a shallow trie, spilled as sorted runs.

A sequence is a row of unsigned 64-bit numbers.  A trie node branches on the numbers of one place, by
ranges; behind a range stands a container, which holds rows by their hash, each once with its
count, or another node.  A container that grows too large bursts: it is halved by ranges while it holds
several numbers at its place, and becomes a node for the next place when it holds one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

from marketframe.llm.textscan import mixed

Rows = tuple[list[np.ndarray], np.ndarray]                  # the places' numbers, and the counts
Combine = Callable[[np.ndarray, np.ndarray], np.ndarray]    # counts, and where each row's begin: one count a row


def grouped(places: list[np.ndarray], counts: np.ndarray, combine: Combine = np.add.reduceat) -> Rows:
    """Each row once, with the sum of its counts (or what ``combine`` makes of them), in the order of the rows' hashes."""
    if not len(counts):
        return places, counts
    h = places[0]
    for p in places[1:]:
        h = mixed(h * np.uint64(31) + p)
    order = np.argsort(h, kind="stable")
    h, places = h[order], [p[order] for p in places]
    new = np.concatenate([[True], h[1:] != h[:-1]])
    differs = np.zeros(len(h) - 1, bool)
    for p in places:
        differs |= p[1:] != p[:-1]
    if (differs & ~new[1:]).any():                          # two rows of one hash: order by the rows themselves
        again = np.lexsort(places[::-1])
        order, places = order[again], [p[again] for p in places]
        new = np.concatenate([[True], np.any([p[1:] != p[:-1] for p in places], axis=0)])
    first = np.flatnonzero(new)
    return [p[first] for p in places], combine(counts[order], first)


def _joined(parts: list[Rows]) -> Rows:
    return [np.concatenate(p) for p in zip(*[places for places, _ in parts])], np.concatenate([n for _, n in parts])


class Container:
    """Rows by their hash, and rows added since they were last grouped."""

    def __init__(self, combine: Combine, rows: Rows | None = None):
        self.combine, self.parts = combine, [rows] if rows else []
        self.settled = self.rows = len(rows[1]) if rows else 0

    def add(self, places: list[np.ndarray], counts: np.ndarray) -> None:
        self.parts.append((places, counts))
        self.rows += len(counts)

    def settle(self) -> None:
        if len(self.parts) > 1:
            self.parts = [grouped(*_joined(self.parts), self.combine)]
        self.settled = self.rows = len(self.parts[0][1]) if self.parts else 0

    def containers(self) -> Iterator["Container"]:
        yield self


class Node:
    """Branches on the numbers at ``place``: child i has those from ``bounds[i]`` up to the next bound."""

    def __init__(self, place: int, child: Container):
        self.place, self.bounds, self.children = place, np.zeros(1, np.uint64), [child]

    @property
    def rows(self) -> int:
        return sum(c.rows for c in self.children)

    def containers(self) -> Iterator[Container]:
        for c in self.children:
            yield from c.containers()


class HatTrie:
    """Counts rows of ``places`` numbers.  At most about ``budget`` rows are held (and those just added);
    a container bursts beyond ``burst`` rows.  Counts of one row are summed, or put together by ``combine``."""

    def __init__(self, places: int, budget: int = 1 << 20, burst: int = 1 << 15, combine: Combine = np.add.reduceat):
        self.places, self.budget, self.burst, self.combine = places, budget, burst, combine
        self.root = Node(0, Container(combine))
        self.rows = 0

    def add(self, places: list[np.ndarray], counts: np.ndarray) -> Iterator[Rows]:
        """Count rows; sorted runs of the largest subtrees if there are too many rows now."""
        places, counts = grouped(places, counts, self.combine)
        if len(counts):
            self._add(self.root, places, counts)
        if self.rows > self.budget:
            for c in self.root.containers():
                self._settle(c)
            yield from self.spill(self.budget // 2)

    def spill(self, keep: int = 0) -> Iterator[Rows]:
        """Empty the largest subtrees of the root until at most ``keep`` rows are left, each as one sorted run."""
        for i in sorted(range(len(self.root.children)), key=lambda i: -self.root.children[i].rows):
            if self.rows <= keep:
                return
            held = [c for c in self.root.children[i].containers() if c.rows]
            self.root.children[i], before = Container(self.combine), sum(c.rows for c in held)
            self.rows -= before
            if held:
                for c in held:
                    c.settle()
                places, counts = _joined([c.parts[0] for c in held])
                order = np.lexsort(places[::-1])
                yield [p[order] for p in places], counts[order]

    def _settle(self, container: Container) -> None:
        self.rows -= container.rows
        container.settle()
        self.rows += container.rows

    def _add(self, node: Node, places: list[np.ndarray], counts: np.ndarray) -> None:
        if len(node.children) == 1:
            dealt = [(node.children[0], places, counts)]
        else:
            child = np.searchsorted(node.bounds, places[node.place], side="right") - 1
            order = np.argsort(child, kind="stable")
            cut = np.flatnonzero(np.diff(child[order])) + 1
            dealt = [(node.children[child[o[0]]], [p[o] for p in places], counts[o]) for o in np.split(order, cut)]
        for part, p, n in dealt:
            if isinstance(part, Node):
                self._add(part, p, n)
                continue
            part.add(p, n)
            self.rows += len(n)
            if part.rows - part.settled > max(part.settled, 1 << 12, self.burst // 4):
                self._settle(part)
                if part.rows > self.burst:
                    self._burst(node, part)

    def _burst(self, node: Node, container: Container) -> None:
        (places, counts), i = container.parts[0], next(i for i, c in enumerate(node.children) if c is container)
        numbers = places[node.place]
        low = numbers.min()
        if low == numbers.max():
            if node.place + 1 < self.places:
                node.children[i] = deeper = Node(node.place + 1, container)
                self._burst(deeper, container)
            return
        half = np.sort(numbers)[len(numbers) // 2]
        if half == low:
            half = numbers[numbers > low].min()
        left = numbers < half
        halves = [Container(self.combine, ([p[at] for p in places], counts[at])) for at in (left, ~left)]
        node.children[i: i + 1] = halves
        node.bounds = np.insert(node.bounds, i + 1, half)
        for part in halves:
            if part.rows > self.burst:
                self._burst(node, part)
