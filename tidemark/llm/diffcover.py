"""Blockwise suffix sorting with a difference cover, for finding repeated strings of a fixed length.

Sample positions are those whose residue is in a difference cover: for any two positions there is a
shift below the period that takes both to samples. The samples are ranked once, by doubling. All
other suffixes are then sorted a block (a range of first bytes) at a time: by their first bytes up
to the period, and long ties by the ranks of the samples that a common shift reaches. So memory is
bounded by the text, its samples and one block, however long the repeats are.
"""

from __future__ import annotations

import numpy as np

# A perfect difference set of eight residues.
PERIOD = 57
COVER = (0, 1, 3, 13, 32, 36, 43, 52)
#: Suffixes sorted at a time; a block grows beyond it only for suffixes that share eight bytes.
BLOCK = 1 << 17

_IN = np.full(PERIOD, -1)
_IN[list(COVER)] = range(len(COVER))
_SHIFT = np.array([[next(d for d in range(PERIOD) if _IN[(i + d) % PERIOD] >= 0 and _IN[(j + d) % PERIOD] >= 0) for j in range(PERIOD)] for i in range(PERIOD)])


def _strings(text: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """The n bytes from each position, as values that sort like them."""
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, n)[at]).view(f"S{n}").reshape(-1)


def _words(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(text, 8)[at]).view(">u8").reshape(-1).astype(np.uint64)


class Sample:
    """Ranks of the sample suffixes to depths of PERIOD x 1, 2, 4, 8 bytes."""

    def __init__(self, text: np.ndarray):
        self.text = np.concatenate((text, np.zeros(10 * PERIOD, np.uint8)))
        rows = (len(self.text) - PERIOD) // PERIOD
        at = (np.arange(rows)[:, None] * PERIOD + np.array(COVER)).reshape(-1)
        rank = np.unique(_strings(self.text, at, PERIOD), return_inverse=True)[1].astype(np.int64)
        self.ranks = [rank]
        for k in range(3):
            ahead = np.minimum(np.arange(len(at)) + (len(COVER) << k), len(at) - 1)
            rank = np.unique(rank * (len(at) + 1) + rank[ahead], return_inverse=True)[1].astype(np.int64)
            self.ranks.append(rank)

    def place(self, at: np.ndarray) -> np.ndarray:
        return at // PERIOD * len(COVER) + _IN[at % PERIOD]

    def _shifts(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return _SHIFT[a % PERIOD, b % PERIOD]

    def settle(self, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of suffixes within groups (consecutive, equal in their first PERIOD bytes): three-way quicksort of all groups at once."""
        order = np.arange(len(at))
        active = np.flatnonzero(np.bincount(group)[group] > 1)
        label = group.astype(np.int64)
        while len(active):
            lab = label[active]
            start = np.flatnonzero(np.diff(lab, prepend=-1))
            size = np.diff(np.append(start, len(lab)))
            pivot = np.repeat(at[order[active[start + size // 2]]], size)
            mine = at[order[active]]
            d = self._shifts(mine, pivot)
            a, b = self.ranks[3][self.place(mine + d)], self.ranks[3][self.place(pivot + d)]
            side = np.sign(a - b) + 1
            key = np.repeat(np.arange(len(start)), size) * 3 + side
            by = np.argsort(key, kind="stable")
            order[active] = order[active[by]]
            key = key[by]
            many = np.bincount(key, minlength=3 * len(start))[key] > 1
            go = many & (key % 3 != 1)
            label[active] = key
            active = active[go]
        return order

    def common(self, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
        """Whether suffixes that agree in their first PERIOD bytes agree in their first ``length`` (below 8 x PERIOD)."""
        d = self._shifts(a, b)
        x, y, left, same = a + d, b + d, length - d, np.ones(len(a), bool)
        for k in (2, 1, 0):
            step = PERIOD << k
            jump = np.flatnonzero(same & (left >= step))
            same[jump] = self.ranks[k][self.place(x[jump])] == self.ranks[k][self.place(y[jump])]
            x[jump] += step
            y[jump] += step
            left[jump] -= step
        for o in range(0, PERIOD, 8):
            go = np.flatnonzero(same & (left > o))
            drop = (8 * np.maximum(0, 8 - (left[go] - o))).astype(np.uint64)
            same[go] = (_words(self.text, x[go] + o) ^ _words(self.text, y[go] + o)) >> drop == 0
        return same


def repeated(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For each start (ascending), whether the ``length`` bytes there also stand at another of the starts."""
    if PERIOD >= length or length >= 8 * PERIOD:
        raise ValueError(f"length must be between {PERIOD} and {8 * PERIOD}")
    out = np.zeros(len(starts), bool)
    if len(starts) < 2:
        return out
    sample = Sample(text)
    head = _words(sample.text, starts)
    by_head = np.argsort(head, kind="stable")
    sorted_head = head[by_head]
    edges = np.flatnonzero(np.diff(sorted_head) != 0) + 1
    at = 0
    while at < len(starts):
        end = len(starts)
        if at + BLOCK < end:
            k = int(np.searchsorted(edges, at + BLOCK, "right"))
            end = int(edges[k - 1]) if k and edges[k - 1] > at else (int(edges[k]) if k < len(edges) else end)
        mine = by_head[at:end]
        at = end
        first = _strings(sample.text, starts[mine], PERIOD)
        order = np.argsort(first, kind="stable")
        group = np.cumsum(np.concatenate(([0], first[order][1:] != first[order][:-1])))
        mine = mine[order]
        mine = mine[sample.settle(starts[mine], group)]
        tie = np.flatnonzero(group[1:] == group[:-1])
        if len(tie):
            same = tie[sample.common(starts[mine[tie]], starts[mine[tie + 1]], length)]
            out[mine[same]] = True
            out[mine[same + 1]] = True
    return out
