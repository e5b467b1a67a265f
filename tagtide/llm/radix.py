"""Adaptive radix trees over sequences of fixed-width turn ids."""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Bytes of a turn id, which is two big-endian words.
WIDTH = 16
NOWHERE = 2**62


class Sorted:
    """Up to 4, then up to 16 children beside their sorted bytes."""

    def __init__(self) -> None:
        self.room, self.bytes, self.kids = 4, bytearray(), []

    def get(self, byte: int) -> Node | None:
        at = self.bytes.find(byte)
        return self.kids[at] if at >= 0 else None

    def put(self, byte: int, kid: Node) -> Sorted | Indexed:
        if len(self.kids) == self.room:
            if self.room == 16:
                return Indexed(self).put(byte, kid)
            self.room = 16
        at = bisect(self.bytes, byte)
        self.bytes.insert(at, byte)
        self.kids.insert(at, kid)
        return self


class Indexed:
    """Up to 48 children, found by an index of 256 bytes."""

    def __init__(self, small: Sorted) -> None:
        self.place, self.kids = bytearray(256), []
        for byte, kid in zip(small.bytes, small.kids, strict=True):
            self.put(byte, kid)

    def get(self, byte: int) -> Node | None:
        at = self.place[byte]
        return self.kids[at - 1] if at else None

    def put(self, byte: int, kid: Node) -> Indexed | Full:
        if len(self.kids) == 48:
            return Full(self).put(byte, kid)
        self.kids.append(kid)
        self.place[byte] = len(self.kids)
        return self


class Full:
    """A slot for every byte."""

    def __init__(self, indexed: Indexed) -> None:
        self.slots = [indexed.get(byte) for byte in range(256)]

    @property
    def kids(self) -> list[Node]:
        return [kid for kid in self.slots if kid is not None]

    def get(self, byte: int) -> Node | None:
        return self.slots[byte]

    def put(self, byte: int, kid: Node) -> Full:
        self.slots[byte] = kid
        return self


@dataclass(slots=True)
class Row:
    """A sequence of turns and what its conversations add up to."""

    key: bytes
    words: np.ndarray
    n: int
    least: int
    #: First turn that one of its conversations owns, from 1, and NOWHERE if none does.
    owns: int
    #: What turns behind this sequence save, and leaves there.
    rest: int
    leaves: int


class Node:
    """A compressed path below a parent's byte; ``end`` counts all bytes up to its end."""

    __slots__ = ("path", "end", "sample", "rows", "kids")

    def __init__(self, path: bytes, end: int, sample: Row | None) -> None:
        self.path, self.end, self.sample = path, end, sample
        self.rows: list[Row] = []
        self.kids: Sorted | Indexed | Full = Sorted()

    def split(self, at: int) -> None:
        """Cut the path, so that another key can leave it at ``at``."""
        below = Node(self.path[at + 1 :], self.end, self.sample)
        below.rows, below.kids = self.rows, self.kids
        self.end -= len(self.path) - at
        self.rows, self.kids = [], Sorted().put(self.path[at], below)
        self.path = self.path[:at]


def _shared(path: bytes, key: bytes, start: int) -> int:
    """Bytes of ``path`` that ``key`` has from ``start`` on."""
    other = key[start : start + len(path)]
    if path == other:
        return len(path)
    most = min(len(path), len(other))
    apart = int.from_bytes(path[:most]) ^ int.from_bytes(other[:most])
    return most - (apart.bit_length() + 7) // 8


class Tree:
    """Rows that start at one node (two words) at depth ``base``."""

    def __init__(self, start: tuple[int, int], base: int) -> None:
        self.start, self.base = np.array(start, dtype=np.int64), base
        self.root, self.bytes = Node(b"", 0, None), 0

    def insert(self, row: Row) -> None:
        node, at, key = self.root, 0, row.key
        self.bytes += len(key)
        self.root.sample = self.root.sample or row
        while True:
            shared = _shared(node.path, key, at)
            if shared < len(node.path):
                node.split(shared)
            at += shared
            if at == len(key):
                node.rows.append(row)
                return
            kid = node.kids.get(key[at])
            if kid is None:
                leaf = Node(key[at + 1 :], len(key), row)
                leaf.rows.append(row)
                node.kids = node.kids.put(key[at], leaf)
                return
            node, at = kid, at + 1

    def fold(self) -> Iterator[list[np.ndarray]]:
        """Columns of the nodes at whole turns, for one compressed path after another.

        Ids and parents' ids (two words each), depth, words of the last turn, n, least,
        saved and leaves, where each sums up the rows below. Inner bytes of an id give no
        node; the root gives one at depth 0 only.
        """
        order, stack = [], [(self.root, -1)]
        while stack:
            node, above = stack.pop()
            order.append((node, above))
            stack += [(kid, len(order) - 1) for kid in node.kids.kids]
        sums: list[list[int]] = [[0, NOWHERE, NOWHERE, 0, 0] for _ in order]
        for place in range(len(order) - 1, -1, -1):
            node, above = order[place]
            total = sums[place]
            for row in node.rows:
                _add(total, [row.n, row.least, row.owns, row.rest, row.leaves])
            n, least, owns, saved, leaves = total
            first = (order[above][0].end if above >= 0 else 0) // WIDTH + 1
            last = node.end // WIDTH
            if last >= first:
                yield self._path(node.sample, first, last, total)
            if above >= 0:
                _add(sums[above], total)
            elif self.base == 0:
                nothing = np.zeros(1, dtype=np.int64)
                yield [nothing] * 6 + [np.array([x], dtype=np.int64) for x in (n, least, saved, leaves)]

    def _path(self, sample: Row, first: int, last: int, total: list[int]) -> list[np.ndarray]:
        """The nodes from depth ``first`` to ``last``; ``total`` then holds what the first one saves."""
        n, least, owns, saved, leaves = total
        turns = np.frombuffer(sample.key, dtype=">i8", count=2 * last).reshape(-1, 2).astype(np.int64)
        ids = np.bitwise_xor.accumulate(np.vstack([self.start, turns]), axis=0)
        depths = np.arange(first, last + 1)
        words = sample.words[first - 1 : last].astype(np.int64)
        each = words * (n - (depths >= owns))
        below = saved + each[::-1].cumsum()[::-1]
        total[3] = int(below[0])
        size = len(depths)
        here, parents = ids[first : last + 1], ids[first - 1 : last]
        return [
            here[:, 0],
            here[:, 1],
            parents[:, 0],
            parents[:, 1],
            self.base + depths,
            words,
            np.full(size, n),
            np.full(size, least),
            below,
            np.full(size, leaves),
        ]


def _add(total: list[int], more: list[int]) -> None:
    total[0] += more[0]
    total[1] = min(total[1], more[1])
    total[2] = min(total[2], more[2])
    total[3] += more[3]
    total[4] += more[4]
