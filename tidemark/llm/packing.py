"""Best-fit packing of token sequences by a configuration linear program.

Pieces of the same length are interchangeable, so the program sees only the length histogram (one
entry a length, whatever the number of documents). Its columns are configurations: multisets of
lengths that fit one sequence. Multiplicative weights over the lengths' coverage price them, each
time by an unbounded knapsack solved with dynamic programming. The fractional solution is rounded
down; what is left is packed best-fit decreasing, again over the histogram. Pieces then find their
places by their rank among the pieces of the same length, so no task ever sees all of them.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import documents, durable

CAPACITY = 2048
END_ID = 0
TOKENIZER = "byte_bpe_50k.json"
#: Words whose ids a worker keeps in each of two generations; one that is used again moves to the younger.
CACHE_WORDS = 500_000

_WS = "\\t-\\r \\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Two white-space characters in a row: only there do a word's ids depend on its neighbours.
_RUN = re.compile(f"[{_WS}][{_WS}]")
_INNER = re.compile(f"[{_WS}]")
_SPECIAL = re.compile(r"<\|")
_ENCODERS: dict[str, Encoder] = {}


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes, equal to the tokenizer's own ids of each whole text.

    The tokenizer splits before every lone space and around every lone line end, so words are
    encoded once and looked up from then on. Texts with runs of white space, or with what may be a
    special token, are encoded whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.line_end = self._whole(["\n"])[0]
        #: By what stands before a word: nothing (a text's first), or a space or line end.
        self.caches: dict[str, list[dict[str, bytes]]] = {"": [{}, {}], " ": [{}, {}]}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", x.ids).tobytes() for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str], before: str) -> list[bytes]:
        """Ids of each of the words after ``before``, many lines to a call; a line's ids end at the next line end's."""
        out: dict[str, bytes] = {}
        plain = [w for w in words if w and not _INNER.search(w)]
        mark = int.from_bytes(self.line_end, "little")
        for at in range(0, len(plain), 256):
            some = plain[at : at + 256]
            ids = array("I", self.tokenizer.encode_batch_fast(["\n".join([before + w for w in some])], add_special_tokens=False)[0].ids)
            raw, ends = ids.tobytes(), [*(np.flatnonzero(np.frombuffer(ids, np.uint32) == mark) * 4).tolist(), 4 * len(ids)]
            if len(ends) != len(some):
                out.update(zip(some, self._whole([before + w for w in some]), strict=True))
                continue
            start = 0
            for w, e in zip(some, ends, strict=True):
                out[w] = raw[start:e]
                start = e + 4
        other = [w for w in words if w not in out]
        out.update(zip(other, self._whole([before + w for w in other]), strict=True))
        return [out[w] for w in words]

    def _learn(self, words: set[str], before: str) -> dict[str, bytes]:
        """A cache that has all of ``words``."""
        young, old = generations = self.caches[before]
        new = [w for w in words if w not in young]
        if len(young) + len(new) > CACHE_WORDS:
            young, old = {}, young
            generations[:] = young, old
            new = list(words)
        young.update((w, old[w]) for w in new if w in old)
        new = [w for w in new if w not in young]
        lines = [w for w in new if w[:1] == "\n"] if before else []
        new = [w for w in new if w[:1] != "\n"] if lines else new
        young.update(zip(new, self._words(new, before), strict=True))
        young.update((w, self.line_end + i) for w, i in zip(lines, self._words([w[1:] for w in lines], ""), strict=True))
        return young

    def forget(self) -> None:
        """Let the older generations go: a worker that waits for other work should hold little."""
        for generations in self.caches.values():
            generations[1] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = [bool(_RUN.search(t) or _SPECIAL.search(t)) for t in texts]
        split = [[] if w else t.replace("\n", " \n").split(" ") for t, w in zip(texts, whole, strict=True)]
        first = self._learn({w[0] for w in split if w}, "")
        rest = self._learn(set(chain.from_iterable(islice(w, 1, None) for w in split)), " ")
        get = rest.__getitem__
        out = [first[w[0]] + b"".join(map(get, islice(w, 1, None))) if w else b"" for w in split]
        for i, w in enumerate(whole):
            if w:
                out[i] = self._whole([texts[i]])[0]
        return out


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: all of ``capacity`` but, perhaps, the first."""
    head = n % capacity or capacity
    return [(0, head)] + [(s, capacity) for s in range(head, n, capacity)]


def pieces(df: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; part and nth: its task, and its rank there among its length.

    A null text is empty: the end id alone, one piece. Repeated rows are packed each for itself; a null doc_id stays null.
    """

    def run(batches):
        enc, seen, part = encoder(path), np.zeros(capacity + 1, np.int64).tolist(), TaskContext.get().partitionId()
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for at in range(0, batch.num_rows, 256):
                rows = []
                for doc, b in zip(ids[at : at + 256], enc.encode([t or "" for t in texts.slice(at, 256).to_pylist()]), strict=True):
                    b += END_ID.to_bytes(4, "little")
                    for k, (start, n) in enumerate(cut(len(b) // 4, capacity)):
                        rows.append((doc, k, start, n, zlib.crc32(b[4 * start : 4 * (start + n)]), part, seen[n]))
                        seen[n] += 1
                cols = list(zip(*rows, strict=True))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])
        enc.forget()

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
    )


def knapsack(lengths: np.ndarray, values: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value of each capacity (items may repeat), and the item that ends it, or -1."""
    best, item = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        k = int(np.searchsorted(lengths, c, "right"))
        best[c], item[c] = best[c - 1], -2
        if k:
            v = best[c - lengths[:k]] + values[:k]
            i = int(v.argmax())
            if v[i] > best[c]:
                best[c], item[c] = v[i], i
    return best, item


def _backtrack(lengths: list[int], item: list[int], c: int) -> dict[int, int]:
    out: dict[int, int] = {}
    while c > 0 and item[c] != -1:
        i = item[c]
        if i == -2:
            c -= 1
            continue
        out[i] = out.get(i, 0) + 1
        c -= lengths[i]
    return out


def weigh(lengths: np.ndarray, counts: np.ndarray, capacity: int, *, step: float = 0.25, eta: float = 6.0, rounds: int = 120) -> list[tuple[dict[int, int], float]]:
    """Fractional solution of the configuration program by multiplicative weights: (item number -> times, how often).

    A length's price falls as exp(-eta * coverage). Each round prices all lengths at once, takes the
    best configuration that holds each length, and adds those within ``step`` of the best of all.
    """
    cover, sizes = np.zeros(len(lengths)), lengths.tolist()
    pool: dict[tuple, float] = {}
    for _ in range(rounds):
        open_ = cover < 1
        if not open_.any():
            break
        y = np.where(open_, lengths / capacity * np.exp(-eta * np.minimum(cover, 50)), 0.0)
        best, item = knapsack(lengths, y, capacity)
        items = item.tolist()
        held = np.where(open_, y + best[capacity - lengths], 0)
        good = np.flatnonzero(held >= (1 - step) * held.max())
        for i in good[np.argsort(-held[good], kind="stable")].tolist():
            if cover[i] >= 1:
                continue
            config = _backtrack(sizes, items, capacity - sizes[i])
            config[i] = config.get(i, 0) + 1
            keys = list(config)
            a = np.array([config[k] for k in keys])
            x = float(min(step * counts[keys] / a))
            cover[keys] += x * a / counts[keys]
            key = tuple(sorted(config.items()))
            pool[key] = pool.get(key, 0.0) + x
    return [(dict(k), x) for k, x in pool.items()]


def best_fit(lengths: list[int], counts: list[int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing over a histogram: equal open sequences are one entry with a count."""
    room: dict[int, list[tuple[tuple, int]]] = {}
    rooms: list[int] = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        size, left = lengths[i], counts[i]
        while left:
            k = int(np.searchsorted(rooms, size)) if rooms else 0
            if k < len(rooms):
                r = rooms[k]
                held, n = room[r].pop()
                if not room[r]:
                    del room[r], rooms[k]
            else:
                r, held, n = capacity, (), left
            times = max(1, min(r // size, left // n if n <= left else 1))
            use = min(n, left // times) if n <= left else left
            if use < n and r < capacity:
                _put(room, rooms, r, held, n - use)
            left -= use * times
            _put(room, rooms, r - size * times, (*held, (i, times)), use)
    out = []
    for entries in room.values():
        for held, n in entries:
            config: dict[int, int] = {}
            for i, times in held:
                config[i] = config.get(i, 0) + times
            out.append((config, n))
    return out


def _put(room: dict, rooms: list[int], r: int, held: tuple, n: int) -> None:
    if r not in room:
        rooms.insert(int(np.searchsorted(rooms, r)) if rooms else 0, r)
        room[r] = []
    room[r].append((held, n))


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Whole configurations (length -> times, how often) that use every piece exactly once."""
    lengths = np.array(sorted(k for k, n in histogram.items() if n), np.int64)
    if not len(lengths):
        return []
    counts = np.array([histogram[int(k)] for k in lengths], np.int64)
    left, out = counts.copy(), []
    ranked = sorted(weigh(lengths, counts, capacity), key=lambda c: -sum(int(lengths[i]) * a for i, a in c[0].items()))
    for config, x in ranked:
        keys, a = list(config), np.array(list(config.values()))
        times = int(min(x, *(left[keys] // a)))
        if times:
            left[keys] -= times * a
            out.append((config, times))
    out += best_fit(lengths.tolist(), left.tolist(), capacity)
    return [({int(lengths[i]): a for i, a in c.items()}, n) for c, n in out if n]


def slots(configs: list[tuple[dict[int, int], int]], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Where the pieces of each length go, as runs: the ranks from ``first`` on fill ``times`` places in each sequence from ``sequence``."""
    runs: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    for config, n in configs:
        offset = 0
        for size in sorted(config, reverse=True):
            runs.append((size, n * config[size], config[size], sequence, offset))
            offset += size * config[size]
        sequence += n
    runs.sort(key=lambda r: r[0])
    size, held, times, seq, offset = (np.array(x, np.int64) for x in zip(*runs, strict=True)) if runs else [np.zeros(0, np.int64)] * 5
    total = np.cumsum(held)
    start = np.zeros(capacity + 2, np.int64)
    np.add.at(start, size + 1, held)
    return {"first": total - held, "start": np.cumsum(start), "times": times, "sequence": seq, "offset": offset, "size": size}


def place(table: dict[str, np.ndarray], length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of the piece with that rank among those of its length."""
    at = table["start"][length] + rank
    run = np.searchsorted(table["first"], at, "right") - 1
    t = at - table["first"][run]
    times = table["times"][run]
    return table["sequence"][run] + t // times, table["offset"][run] + t % times * length


def pack(df: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pack all rows of ``df`` (doc_id, text, others ignored): doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    The driver holds the histogram and at most a few thousand configurations, for any number of rows.
    """
    cutted = durable(pieces(df, path, capacity))
    by_part = cutted.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = slots(plan(histogram, capacity), capacity)
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = cutted.join(by_part.select("part", "length", before.alias("before")), ["part", "length"])

    def run(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            seq, off = place(table, length, rank)
            keep = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(seq, pa.int64()), pa.array(off, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )


def op7_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens. See ``pack``; an empty table gives no rows."""
    return pack(documents(spark, sf_dir), tokenizer_path())
