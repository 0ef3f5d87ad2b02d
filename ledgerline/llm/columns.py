"""Column-wise construction of a collection's Burrows-Wheeler transform and common prefixes.

All strings are laid out against one origin.  Going from the last column to the first, every
round puts one symbol before the current suffix of each string: a stable sort by that symbol
turns the order of the old suffixes into that of the new ones, and the common prefix of two
neighbours is one longer than the shortest among the old neighbours between them, or nothing if
their symbols differ.  The columns come from one sequential file, the transform (the symbols in
suffix order) and the common prefixes go to two others; a round holds one number a string, so
memory does not depend on string length.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

BLOCK = 4096


class Collection:
    """Strings with start columns.  ``cap``: common prefixes are counted up to this length."""

    def __init__(self, strings: list[bytes], starts: np.ndarray, width: int, cap: int):
        self.m, self.width, self.cap = len(strings), width, cap
        self.low = starts.astype(np.int32)
        self.high = self.low + np.fromiter(map(len, strings), np.int32, self.m)
        self.files = [tempfile.TemporaryFile() for _ in range(3)]
        columns = self.files[0]
        for i in range(0, self.m, BLOCK):  # 0 stands for no symbol
            part = strings[i:i + BLOCK]
            table = np.zeros((len(part), width), "<u2")
            for row, s, at in zip(table, part, self.low[i:i + BLOCK]):
                row[at:at + len(s)] = np.frombuffer(s, np.uint8)
                row[at:at + len(s)] += 1
            for c, column in enumerate(np.ascontiguousarray(table.T)):
                columns.seek(2 * (c * self.m + i))
                columns.write(column.tobytes())

    def column(self, c: int) -> np.ndarray:
        self.files[0].seek(2 * c * self.m)
        return np.frombuffer(self.files[0].read(2 * self.m), "<u2")

    def rounds(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(column, strings in suffix order, common prefix with the one before) from the last
        column to the first; only strings that have the column take part."""
        order = np.empty(0, np.int32)
        prefix = np.empty(0, np.uint16)
        by_end = np.argsort(-self.high, kind="stable").astype(np.int32)
        ends, at = self.high[by_end], 0
        for c in range(self.width - 1, -1, -1):
            till = at + np.searchsorted(-ends[at:], -(c + 1), "right")
            if till > at:  # strings that end here come in as empty suffixes, before all others
                order = np.concatenate([by_end[at:till], order])
                prefix = np.concatenate([np.zeros(till - at, np.uint16), prefix])
                at = till
            if not len(order):
                continue
            symbols = self.column(c)[order]
            there = np.flatnonzero(symbols)
            new = there[np.argsort(symbols[there], kind="stable")]
            s = symbols[new]
            grown = np.zeros(len(new), np.uint16)
            same = np.flatnonzero(s[1:] == s[:-1]) + 1
            if len(same):
                least = range_minima(prefix, new[same - 1] + 1, new[same])
                grown[same] = np.minimum(least + 1, self.cap)
            order, prefix = order[new], grown
            self.files[1].write(s.tobytes())
            self.files[2].write(prefix.tobytes())
            yield c, order, prefix

    def close(self) -> None:
        for f in self.files:
            f.close()


def range_minima(x: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """min(x[first..last]) of every range, by minima over powers of two."""
    length = last - first + 1
    level = np.frexp(length)[1] - 1
    out = np.empty(len(first), x.dtype)
    table = x
    for k in range(int(level.max()) + 1):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[:-half], table[half:])
        at = np.flatnonzero(level == k)
        if len(at):
            out[at] = np.minimum(table[first[at]], table[last[at] - (1 << k) + 1])
    return out


def repeated_starts(strings: list[bytes], starts: np.ndarray, weights: np.ndarray, width: int,
                    length: int) -> np.ndarray:
    """Boolean (string, column) table: the ``length`` bytes from that column occur at the same
    column of another string, or the string itself stands for several."""
    found = np.zeros((len(strings), width - length + 1), bool)
    work = Collection(strings, starts, width, length)
    try:
        for c, order, prefix in work.rounds():
            if c > width - length:
                continue
            near = prefix >= length
            hit = near.copy()
            hit[:-1] |= near[1:]
            found[order[hit], c] = True
    finally:
        work.close()
    column = np.arange(found.shape[1])
    own = (column >= work.low[:, None]) & (column + length <= work.high[:, None])
    return found | (own & (weights > 1)[:, None])
