"""Signature trees over token sets, and their join by Jaccard similarity.

A leaf holds a few sets that share many tokens; a node above holds its children. Every node keeps
the OR of its sets' token bitmaps and the range of their sizes. Two nodes are visited together only
if some pair of their sets could still overlap enough; the bound is the number of common bits plus
the tokens that share a bit with another of their own set.
"""

from __future__ import annotations

import numpy as np

from .components import UnionFind

BITS = 4096
FANOUT = 8
LEAF = 24


def needed(n1, n2, num: int, den: int):
    """Least overlap of sets of n1 and n2 tokens for overlap / union >= num / den."""
    return -(-num * (n1 + n2) // (num + den))


def bitmaps(sets: list[np.ndarray], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Bitmap of each set, and how many of its tokens fall on a bit that another of its tokens has."""
    out = np.zeros((len(sets), bits // 64), np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    bit = (flat >> np.uint64(20)) % np.uint64(bits)
    np.bitwise_or.at(out, (owner, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
    return out, np.array([len(s) for s in sets], np.int64) - np.bitwise_count(out).sum(1).astype(np.int64)


class SignatureTree:
    """Bulk-loaded over sets of sorted distinct 64-bit tokens."""

    def __init__(self, sets: list[np.ndarray], *, leaf: int = LEAF, fanout: int = FANOUT):
        size = np.array([len(s) for s in sets], np.int64)
        low = np.array([s[0] if len(s) else 0 for s in sets], np.uint64)
        self.order = np.lexsort((size, low))  # equal least tokens: likely alike
        self.sets = [sets[i] for i in self.order]
        self.size = size[self.order]
        self.bits, self.clash = bitmaps(self.sets)
        #: Levels from the leaves up; each has bitmaps, least and most size, most clashes, and where its children start.
        self.levels = []
        starts = np.arange(0, len(sets), leaf)
        bits, lo, hi, clash = self.bits, self.size, self.size, self.clash
        while True:
            bits, lo, hi, clash = np.bitwise_or.reduceat(bits, starts), np.minimum.reduceat(lo, starts), np.maximum.reduceat(hi, starts), np.maximum.reduceat(clash, starts)
            self.levels.append((bits, lo, hi, clash, starts))
            if len(starts) == 1:
                break
            starts = np.arange(0, len(starts), fanout)

    def children(self, level: int, node: int) -> range:
        starts = self.levels[level][4]
        below = len(self.levels[level - 1][4]) if level else len(self.sets)
        return range(int(starts[node]), int(starts[node + 1]) if node + 1 < len(starts) else below)


def _possible(a: tuple, b: tuple, num: int, den: int) -> np.ndarray:
    """Which pairs of (bitmaps, least size, most size, clashes) rows could hold a link; a's rows against b's."""
    common = np.bitwise_count(a[0][:, None, :] & b[0][None, :, :]).sum(2, dtype=np.int64)
    most = np.minimum(np.minimum(a[2][:, None], b[2][None, :]), common + np.minimum(a[3][:, None], b[3][None, :]))
    return (most >= needed(a[1][:, None], b[1][None, :], num, den)) & (den * a[2][:, None] >= num * b[1][None, :]) & (den * b[2][None, :] >= num * a[1][:, None])


def linked(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """The exact test of two sets of sorted distinct tokens."""
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum()) >= needed(len(a), len(b), num, den)


def join(left: SignatureTree, right: SignatureTree | None, num: int, den: int, groups: UnionFind, ids: tuple[np.ndarray, np.ndarray | None]) -> None:
    """Unite in ``groups`` all linked sets of two trees, or of one with itself (right is None).

    ``ids`` gives the place in ``groups`` of each tree's sets, in the tree's order. Pairs that
    earlier links already connect are not compared: their answer could change no component.
    """
    other = right or left
    li, ri = ids[0], ids[1] if right else ids[0]
    top_l, top_r = len(left.levels) - 1, len(other.levels) - 1
    todo = [(top_l, 0, top_r, 0)]
    while todo:
        lv, a, rv, b = todo.pop()
        if lv == 0 and rv == 0:
            _leaves(left, a, other, b, right is None and a == b, num, den, groups, li, ri)
            continue
        if lv >= rv and rv < lv or rv == 0:
            kids, fixed = left.children(lv, a), [b]
            pairs = [(lv - 1, rv)]
        elif rv > lv:
            kids, fixed = [a], other.children(rv, b)
            pairs = [(lv, rv - 1)]
        else:
            kids, fixed = left.children(lv, a), other.children(rv, b)
            pairs = [(lv - 1, rv - 1)]
        nl, nr = pairs[0]
        x, y = np.asarray(kids), np.asarray(fixed)
        ok = _possible(tuple(v[x] for v in left.levels[nl][:4]), tuple(v[y] for v in other.levels[nr][:4]), num, den)
        found = [(nl, int(x[i]), nr, int(y[j])) for i, j in np.argwhere(ok)]
        if right is None and lv == rv and a == b:
            found = [f for f in found if f[1] <= f[3]]
        # A node with itself comes first: its links spare later comparisons.
        todo += sorted(found, key=lambda f: f[1] == f[3]) if right is None else found


def _leaves(left, a, other, b, same, num, den, groups, li, ri) -> None:
    x, y = np.asarray(left.children(0, a)), np.asarray(other.children(0, b))
    gx, gy = [groups.find(int(i)) for i in li[x]], [groups.find(int(j)) for j in ri[y]]
    if len({*gx, *gy}) == 1:
        return
    ok = _possible((left.bits[x], left.size[x], left.size[x], left.clash[x]), (other.bits[y], other.size[y], other.size[y], other.clash[y]), num, den)
    ok &= np.array(gx)[:, None] != np.array(gy)[None, :]
    for i, j in np.argwhere(ok):
        if same and i >= j:
            continue
        p, q = int(li[x[i]]), int(ri[y[j]])
        if groups.find(p) != groups.find(q) and linked(left.sets[x[i]], other.sets[y[j]], num, den):
            groups.union(p, q)
