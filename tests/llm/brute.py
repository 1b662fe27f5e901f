"""Plain-Python versions of the operators, for small fixtures."""

from __future__ import annotations

import hashlib
import re

KINDS = ("assign", "access", "hex")
PATTERNS = (
    re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII),
    re.compile(r"AKIA[A-Z0-9]+"),
    re.compile(r"[0-9a-f]+"),
)


def secrets(text: str | None):
    text = text or ""
    out = []
    for k, p in enumerate(PATTERNS):
        for m in p.finditer(text):
            size = len(m[2]) if k == 0 else len(m[0])
            if size >= (8, 16, 32)[k]:
                out.append((m.start(), k, m.end()))
    out.sort()
    joined = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in out)
    return [sum(1 for x in out if x[1] == k) for k in range(3)], hashlib.sha256(joined.encode()).hexdigest(), joined


WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode().translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))))


def shingles(text: str | None, n: int = 5) -> frozenset:
    w = words(text)
    if len(w) < n:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def near_components(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    """doc_id -> (shingles, component) by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                if x != y:
                    parent[max(x, y)] = min(x, y)
    least: dict[int, int] = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return {d: (len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)}


def removed(texts: list[str | None], length: int) -> list[list[tuple[int, int]]]:
    """Spans covered by a string of ``length`` bytes with another start anywhere."""
    raw = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for b in raw:
        for i in range(len(b) - length + 1):
            seen[b[i : i + length]] = seen.get(b[i : i + length], 0) + 1
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        out.append([m.span() for m in re.finditer(rb"\x01+", bytes(gone))])
    return out
