"""Scoring text by a log-bilinear language model trained with noise-contrastive estimation.

Statistics cover every training text: counts of all words, and of all adjacent pairs. Every word
seen at least SEEN times has vectors of its own, as context and as target, so the model grows with
the corpus; only rarer words share a class, in which a word has its own unigram share.

Pair counts are sparse. They meet by shuffles, once by context and once by target, in buckets of
bounded size whose number grows with the corpus. A small dense model of the most frequent words,
fitted on the driver, is what all vectors start from. Given its context vectors, the target vectors
of all words are independent problems, solved bucket by bucket; given these, so are the context
vectors of all words. Both tables travel by ``addFile`` and are memory-mapped.

Every probability is normalised over all words, exactly. What a frequent context says of any word, and
any context of a frequent word, is the product of their own vectors. Contexts of the tail meet words
of the tail by the mean vector of their group (see ``grouped``), plus what the context's own vector
adds to the tail as a whole, so the sum over the tail is taken once a group, not once a context.

Scoring looks frequent words up in a broadcast table of bounded size, the model's other words by a
64-bit hash; the counts of words that are not broadcast come by a join on the word.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import crc_mod, documents, durable, word_hash, word_spans

#: Times that a word is seen in training to have vectors of its own.
SEEN = 5
#: Words of the dense model that all vectors start from, the end of text and the class of all others included.
HEAD = 1024
#: Words whose counts are broadcast; the others' come by a join.
FREQUENT = 1 << 18
WIDTH = 32
#: Distinct words that a task counts before it passes them on.
COUNTED_AT_ONCE = 400_000
#: Tokens whose pairs a task sorts at a time, and tokens to a bucket of pairs.
PAIRED_AT_ONCE = 1 << 21
#: Buckets whose vectors the driver takes at a time, on their way to a file.
TAKEN_AT_ONCE = 128
#: Pairs of a bucket whose vectors are gathered at a time.
GATHERED_AT_ONCE = 1 << 16
#: Draws a token of the noise; words drawn once for all owners of a bucket; steps; tokens that pull a vector to where it starts.
NOISE, DRAWN, STEPS, DECAY = 8.0, 256, 6, 16.0
#: Deviation of the tail's context vectors from their class's, before they are fitted.
SCATTER = 0.3
#: Axes whose signs tell the groups of the tail's contexts; as many contexts as groups or fewer have a group each.
AXES = 12
#: Rows of an Arrow batch: texts are long, and a batch is held several times over on its way to and from Python.
BATCH_ROWS = 2000
#: Stands for the end of a text; no word is empty.
END = b""


class LogBilinear:
    """log p(next | previous) = (r[previous] * c) . q[next] + b[next], normalised over the vocabulary."""

    def __init__(self, size: int, width: int = WIDTH, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.r = rng.normal(0, 0.1, (size, width)).astype(np.float32)
        self.q = rng.normal(0, 0.1, (size, width)).astype(np.float32)
        self.c = np.ones(width, np.float32)
        self.b = np.zeros(size, np.float32)

    def fit(self, pairs: np.ndarray, *, noise: float = 8.0, steps: int = 160, rate: float = 0.05, decay: float = 16.0) -> LogBilinear:
        """Noise-contrastive estimation from pair counts (previous x next), by Adam.

        The noise is the unigram distribution, ``noise`` draws a token. Both expectations, over the
        data and over the noise, are taken exactly: each step is a product over the whole table.
        ``decay`` pulls the vectors to 0 with the weight of so many tokens.
        """
        pairs = pairs.astype(np.float32)
        total = float(pairs.sum())
        if not total:
            return self
        uni = pairs.sum(0) + 0.5
        log_q = np.log(uni / uni.sum()).astype(np.float32)
        self.b = log_q.copy()
        data = pairs / total
        drawn = noise * np.outer(data.sum(1), np.exp(log_q)).astype(np.float32)
        shift = log_q + np.float32(math.log(noise))
        params = [self.r, self.q, self.c, self.b]
        moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
        for t in range(1, steps + 1):
            rc = self.r * self.c
            s = rc @ self.q.T
            s += self.b - shift
            p = 1 / (1 + np.exp(-s))
            g = data - p * (data + drawn)  # d objective / d score
            by_next = g @ self.q
            pull = np.float32(decay / total)
            grads = [by_next * self.c - pull * self.r, g.T @ rc - pull * self.q, (by_next * self.r).sum(0), g.sum(0)]
            for i, (x, d) in enumerate(zip(params, grads, strict=True)):
                m, v = moments[i]
                m += 0.1 * (d - m)
                v += 0.001 * (d * d - v)
                x += rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9) * (1 - t / (steps + 1))
        return self

    def log10(self) -> np.ndarray:
        """Normalised log10 p, previous x next, by one product and a log-sum-exp a row."""
        s = ((self.r * self.c) @ self.q.T + self.b).astype(np.float64)
        s -= s.max(1, keepdims=True)
        return ((s - np.log(np.exp(s).sum(1, keepdims=True))) / math.log(10)).astype(np.float32)


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text, A-Z lower-cased; bytes' own rules are exactly those of the contract."""
    return text.lower().split() if text else []


def count_words(df: DataFrame) -> DataFrame:
    """word (binary), n over all rows' words and ends; a null text is empty."""

    def run(batches):
        held: dict[bytes, int] = {}

        def out():
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()

        from collections import _count_elements

        for batch in batches:
            for t in batch.column(0).to_pylist():
                _count_elements(held, words_of(t))
                if len(held) > COUNTED_AT_ONCE:
                    yield from out()
            held[END] = held.get(END, 0) + batch.num_rows
        yield from out()

    texts = df.select(F.encode(F.col("text").cast("string"), "UTF-8").alias("text"))
    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """The frequent words by falling count, the end of text at 0, and totals of all words.

    The model's words are the first ``inside`` of these and, by their hashes, those of ``more``
    (hash, n); the last id is the class of all other words.
    """

    def __init__(self, words: list[bytes], counts: np.ndarray, tokens: int, distinct: int, size: int | None):
        order = sorted(range(len(words)), key=lambda i: (words[i] != END, -counts[i], words[i]))
        self.words = [words[i] for i in order]
        self.counts = np.array([counts[i] for i in order], np.int64)
        self.tokens, self.distinct = tokens, distinct
        kept = self.counts >= SEEN
        kept[:1] = True
        self.inside = int(kept.sum()) if size is None else min(size - 1, len(words))
        self.include(np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def include(self, hashes: np.ndarray, n: np.ndarray) -> None:
        self.hashes, place = np.unique(hashes, return_inverse=True)
        self.more = np.bincount(place, n, len(self.hashes)).astype(np.int64)
        self.size = self.inside + len(self.more) + 1
        self.rest_tokens = self.tokens - int(self.counts[: self.inside].sum()) - int(self.more.sum())
        self.rest_distinct = self.distinct - self.inside - len(hashes)

    def unigram(self) -> np.ndarray:
        """Counts of the model's words and its class of other words."""
        return np.concatenate((self.counts[: self.inside], self.more, [self.rest_tokens]))

    @property
    def base_denominator(self) -> int:
        return self.tokens + self.distinct + 1

    @property
    def rest_denominator(self) -> int:
        return self.rest_tokens + self.rest_distinct + 1


def vocabulary(counts: DataFrame, size: int | None = None, frequent: int = FREQUENT) -> tuple[Vocabulary, int]:
    """The words of at least some count, at most ``frequent`` of them, and that count; the model's words beyond these as hashes.

    The count is found from a histogram over powers of 2**(1/16), so nothing is sorted. ``size``
    bounds the model's words; without it every word seen SEEN times is one.
    """
    step = F.floor(F.log2("n") * 16)
    bins = sorted(((r["s"], r["words"], r["n"], r["low"]) for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("words"), F.sum("n").alias("n"), F.min("n").alias("low")).collect()), reverse=True)
    tokens, distinct = sum(b[2] for b in bins), sum(b[1] for b in bins)
    held, least = 0, 1 << 62
    for _, words, _, low in bins:
        if held + words > frequent:
            break
        held, least = held + words, low
    top = counts.where((F.col("n") >= least) | (F.col("word") == F.lit(END))).toArrow()
    vocab = Vocabulary(top.column("word").to_pylist(), top.column("n").to_numpy(), tokens, distinct, size)
    if size is None and least > SEEN and tokens:

        def run(batches):
            for batch in batches:
                h = hash_words(batch.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), batch.column(1)], names=["h", "n"])

        got = counts.where((F.col("n") >= SEEN) & (F.col("n") < least) & (F.col("word") != F.lit(END))).select("word", "n").mapInArrow(run, "h long, n long").toArrow()
        vocab.include(got.column("h").to_numpy().view(np.uint64), got.column("n").to_numpy())
    return vocab, least


def hash_words(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, none of them empty."""
    data = np.frombuffer(b" ".join(words), np.uint8)
    starts, ends, _ = word_spans(data, np.array([0, len(data)]))
    return word_hash(data, starts, ends)


def ship(spark: SparkSession, array: np.ndarray) -> str:
    """Give ``array`` to every executor as a file, and return the name to open it by."""
    path = new_file()
    np.save(path, array)
    return ship_file(spark, path)


def new_file() -> str:
    return os.path.join(tempfile.mkdtemp(prefix="tidemark-"), f"lm-{uuid.uuid4().hex}.npy")


def ship_file(spark: SparkSession, path: str) -> str:
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


_OPEN: dict[str, np.ndarray] = {}


def shipped(name: str) -> np.ndarray:
    if name not in _OPEN:
        _OPEN[name] = np.load(SparkFiles.get(name), mmap_mode="r")
    return _OPEN[name]


def ids_of(words: list[bytes], at_word: np.ndarray, inside: int, hashes: np.ndarray) -> np.ndarray:
    """Model ids of words, given their places among the frequent words (-1 for none)."""
    other = inside + len(hashes)
    ids = np.where((at_word >= 0) & (at_word < inside), at_word, other)
    if len(hashes):
        rare = np.flatnonzero(at_word < 0)
        h = hash_words([words[i] for i in rare.tolist()])
        at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
        hit = hashes[at] == h
        ids[rare[hit]] = inside + at[hit]
    return ids


_INDEX: dict[str, dict[bytes, int]] = {}


def _shared_index(key: str, broadcast) -> dict[bytes, int]:
    """One dictionary a worker, however many tasks it runs."""
    if key not in _INDEX:
        _INDEX.clear()
        _INDEX[key] = {w: i for i, w in enumerate(broadcast.value["words"])}
    return _INDEX[key]


def pack_pairs(owner: np.ndarray, other: np.ndarray, n: np.ndarray) -> bytes:
    """Counted pairs, sorted by owner, as bytes."""
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    degree = np.diff(first, append=len(owner))
    big = n[n >= 255]
    head = np.array([len(first), len(owner), len(big)], "<i8")
    return b"".join(x.tobytes() for x in (head, owner[first].astype("<u4"), degree.astype("<u4"), other.astype("<u4"), np.minimum(n, 255).astype(np.uint8), big.astype("<i8")))


def unpack_pairs(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct owners, their degrees, other words and counts of all pairs."""
    owners, pairs, big = np.frombuffer(blob, "<i8", 3).tolist()
    at = 24 + 8 * owners
    n = np.frombuffer(blob, np.uint8, pairs, at + 4 * pairs).astype(np.int64)
    n[n == 255] = np.frombuffer(blob, "<i8", big, at + 5 * pairs)
    return np.frombuffer(blob, "<u4", owners, 24).astype(np.int64), np.frombuffer(blob, "<u4", owners, 24 + 4 * owners).astype(np.int64), np.frombuffer(blob, "<u4", pairs, at).astype(np.int64), n


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return [key[first]], [np.add.reduceat(n[order], first)]


def count_pairs(df: DataFrame, key: str, broadcast, vocab: Vocabulary, hashes: str) -> tuple[DataFrame, int]:
    """Counts of all adjacent tokens (the end before a text's first): slot, pairs (see ``pack_pairs``); and the buckets.

    Slots below the number of buckets own by context, those from there on by target.
    """
    inside, buckets = vocab.inside, max(1, -(-vocab.tokens // PAIRED_AT_ONCE))

    def run(batches):
        index = _shared_index(key, broadcast)
        held: list[np.ndarray] = []

        def out():
            found = np.concatenate(held)
            held.clear()
            found.sort()
            at = np.flatnonzero(np.diff(found, prepend=-1))
            n = np.diff(at, append=len(found)).astype(np.int32)
            found = found[at]
            del at
            halves = (found >> 32).astype(np.int32), (found & 0xFFFFFFFF).astype(np.int32)
            del found
            for side in (0, 1):
                owner, other = halves[side], halves[1 - side]
                order = np.lexsort((owner, owner % buckets)) if side else np.argsort(owner % buckets, kind="stable")
                owner, other, m = owner[order], other[order], n[order]
                first = np.flatnonzero(np.diff(owner % buckets, prepend=-1))
                for a, b in zip(first.tolist(), [*first[1:].tolist(), len(owner)], strict=True):
                    yield side * buckets + int(owner[a] % buckets), pack_pairs(owner[a:b], other[a:b], m[a:b])

        def rows(found):
            slots, blobs = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(slots, pa.int32()), pa.array(blobs, pa.binary())], names=["slot", "pairs"])

        for batch in batches:
            texts = batch.column(0)
            for at in range(0, len(texts), 512):
                flat = list(chain.from_iterable(chain(words_of(t), (END,)) for t in texts.slice(at, 512).to_pylist()))
                now = ids_of(flat, np.array(list(map(index.get, flat, repeat(-1))), np.int64), inside, shipped(hashes))
                held.append(np.concatenate(([0], now[:-1])) << 32 | now)
                if sum(map(len, held)) > PAIRED_AT_ONCE:
                    yield rows(out())
        if held:
            yield rows(out())

    def merge(batches):
        sums: dict[int, tuple[list, list]] = {}
        for batch in batches:
            for slot, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                owner, degree, other, n = unpack_pairs(blob)
                keys, counts = sums.setdefault(slot, ([], []))
                keys.append(np.repeat(owner, degree) << 32 | other)
                counts.append(n)
                if sum(map(len, keys[1:])) > max(PAIRED_AT_ONCE // 4, len(keys[0])):
                    sums[slot] = _summed(keys, counts)
        for slot in list(sums):
            (k,), (n,) = _summed(*sums.pop(slot))
            yield pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([pack_pairs(k >> 32, k & 0xFFFFFFFF, n)], pa.binary())], names=["slot", "pairs"])

    texts = df.select(F.encode(F.col("text").cast("string"), "UTF-8").alias("text"))
    schema = "slot int, pairs binary"
    return durable(texts.mapInArrow(run, schema).repartition(2 * buckets, "slot").mapInArrow(merge, schema)), buckets


def head_table(pairs: DataFrame, size: int) -> np.ndarray:
    """Dense counts (previous x next) of ids below ``size``; the last stands for all from there on."""

    def run(batches):
        table = np.zeros(size * size, np.int64)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                owner, degree, other, n = unpack_pairs(blob)
                np.add.at(table, np.repeat(np.minimum(owner, size - 1), degree) * size + np.minimum(other, size - 1), n)
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(table[at], pa.int64())], names=["pair", "n"])

    found = pairs.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * size, np.int64)
    out[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    return out.reshape(size, size)


_SCATTER: list[np.ndarray] = []


def scattered(r: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Vectors of contexts before they are fitted: the head's; and for the tail the class's, each moved at random, so that targets can tell them apart."""
    if not _SCATTER:
        _SCATTER.append(np.random.default_rng(5).normal(0, SCATTER, (1 << 14, WIDTH)).astype(np.float32))
    f = r[np.minimum(ids, len(r) - 1)]
    tail = np.flatnonzero(ids >= len(r) - 1)
    f[tail, :-1] += _SCATTER[0][(ids[tail] * 40503 >> 3) & 0x3FFF]
    return f


def fit_owners(start: np.ndarray, degree: np.ndarray, other: np.ndarray, n: np.ndarray, fixed, drawn: np.ndarray, prior: np.ndarray, with_bias: bool) -> np.ndarray:
    """Vectors of owners (their bias last), given the others': NCE by Newton steps, with a diagonal that bounds the Hessian.

    ``fixed(ids)`` gives the others' vectors, each with what it adds to the score last; ``drawn`` are
    those of the noise. The score is their product, plus the owner's bias. ``prior`` is where DECAY pulls.
    """
    v = start.copy()
    first = np.concatenate(([0], np.cumsum(degree)[:-1]))
    total = np.add.reduceat(n, first).astype(np.float32)
    own = np.repeat(np.arange(len(degree)), degree)
    width = v.shape[1] - 1
    wide = np.column_stack((drawn[:, :width], np.ones(len(drawn), np.float32)))
    bound = lambda f: np.abs(f) * np.abs(f).sum(1, keepdims=True)

    def gathered(ids):
        f = fixed(ids)
        off = f[:, width].copy()
        f[:, width] = 1
        return f, off, bound(f)

    kept = gathered(other) if len(other) <= GATHERED_AT_ONCE else None
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(v @ wide.T + drawn[:, width], -30, 30)))
        share = (NOISE / len(drawn)) * total[:, None]
        g = -(share * p) @ wide
        h = (share * p * (1 - p)) @ bound(wide)
        for a in range(0, len(other), GATHERED_AT_ONCE):
            b = min(len(other), a + GATHERED_AT_ONCE)
            f, off, bf = kept or gathered(other[a:b])
            o = own[a:b]
            x = np.einsum("ij,ij->i", v[o], f) + off
            p = 1 / (1 + np.exp(-np.clip(x, -30, 30)))
            w = n[a:b].astype(np.float32)
            at = np.flatnonzero(np.diff(o, prepend=-1))
            g[o[at]] += np.add.reduceat((w * (1 - p))[:, None] * f, at)
            h[o[at]] += np.add.reduceat((w * p * (1 - p))[:, None] * bf, at)
        step = (g - DECAY * (v - prior)) / (h + DECAY)
        if not with_bias:
            step[:, width] = 0
        v += np.clip(step, -1, 1).astype(np.float32)
    return v


def solve(pairs: DataFrame, slots: range, size: int, fixed, drawn_ids: np.ndarray, start: np.ndarray, own_shift: str | None, add: np.ndarray | None = None) -> str:
    """A file of the vectors of all ``size`` words as owners of the pairs in ``slots``, ``add`` added to their biases; see ``fit_owners``. ``start`` has the HEAD first, its last for all others.

    ``own_shift`` names the file of what each owner's noise takes off its score, if its bias is fitted.
    """
    zero = np.zeros_like(start)
    zero[-1] = start[-1] if size > len(start) else 0
    zero[:, -1] = start[:, -1]

    def run(batches):
        drawn = fixed(drawn_ids)
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                owner, degree, other, n = unpack_pairs(blob)
                ends, done, a = np.cumsum(degree), [], 0
                while a < len(owner):
                    lo = int(ends[a] - degree[a])
                    b = min(max(a + 1, int(np.searchsorted(ends, lo + GATHERED_AT_ONCE, "right"))), a + 4096)
                    hi = int(ends[b - 1])
                    at = np.minimum(owner[a:b], len(start) - 1)
                    v, prior = start[at], zero[at]
                    shift = shipped(own_shift)[owner[a:b]] if own_shift else np.zeros(b - a, np.float32)
                    v[:, -1] += -shift
                    prior[:, -1] += -shift
                    v = fit_owners(v, degree[a:b], other[lo:hi], n[lo:hi], fixed, drawn, prior, own_shift is not None)
                    v[:, -1] += shift
                    done.append(v)
                    a = b
                yield pa.RecordBatch.from_arrays([pa.array([owner.astype("<u4").tobytes()], pa.binary()), pa.array([np.concatenate(done).astype("<f2").tobytes()], pa.binary())], names=["ids", "vectors"])

    out = np.lib.format.open_memmap(path := new_file(), "w+", np.float16, (size, start.shape[1]))
    for a in range(0, size, GATHERED_AT_ONCE):
        b = min(size, a + GATHERED_AT_ONCE)
        out[a:b] = start[np.minimum(np.arange(a, b), len(start) - 1)]
    for a in range(slots.start, slots.stop, TAKEN_AT_ONCE):
        some = pairs.where(F.col("slot").between(a, min(slots.stop, a + TAKEN_AT_ONCE) - 1))
        got = some.select("pairs").mapInArrow(run, "ids binary, vectors binary").toArrow()
        for ids, vectors in zip(got.column("ids"), got.column("vectors"), strict=True):
            out[np.frombuffer(ids.as_py(), "<u4")] = np.frombuffer(vectors.as_py(), "<f2").reshape(-1, start.shape[1])
    if add is not None:
        out[:, -1] = out[:, -1].astype(np.float32) + add
    out.flush()
    return path


def grouped(r: np.ndarray, weight: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
    """Each context's group, and the groups' vectors. The first ``own`` contexts have a group each; the others share one by the signs of their
    vectors along the AXES widest axes, with the weighted mean as its vector, unless there are few of them. All contexts enter."""
    size, width = len(r), r.shape[1] - 1
    if size - own <= 1 << AXES:
        return np.arange(size), np.asarray(r[:, :width], np.float32)
    parts = [slice(a, min(size, a + GATHERED_AT_ONCE)) for a in range(own, size, GATHERED_AT_ONCE)]
    total, mean, square = 0.0, np.zeros(width), np.zeros((width, width))
    for p in parts:
        x, w = np.asarray(r[p, :width], np.float64), weight[p]
        total, mean, square = total + w.sum(), mean + w @ x, square + (x * w[:, None]).T @ x
    mean /= total
    axes = np.linalg.eigh(square / total - np.outer(mean, mean))[1][:, ::-1][:, :AXES]
    group = np.arange(size)
    sums, held = np.zeros((1 << AXES, width)), np.zeros(1 << AXES)
    for p in parts:
        x, w = np.asarray(r[p, :width], np.float64), weight[p]
        code = ((x - mean) @ axes > 0) @ (1 << np.arange(axes.shape[1]))
        group[p] = own + code
        held += np.bincount(code, w, 1 << AXES)
        for k in range(width):
            sums[:, k] += np.bincount(code, w * x[:, k], 1 << AXES)
    table = np.vstack((np.asarray(r[:own, :width], np.float64), sums / np.maximum(held, 1e-9)[:, None]))
    return group, table.astype(np.float32)


def log_sums(spark: SparkSession, rows: str, count: int, targets: str, words: tuple[int, int]) -> np.ndarray:
    """log sum exp of the scores of each of ``count`` vectors in a file over all words of a range of ids, exactly."""
    block = 256

    def run(batches):
        for batch in batches:
            for at in batch.column(0).to_pylist():
                u = np.asarray(shipped(rows)[at * block : (at + 1) * block, :WIDTH], np.float32)
                top, z = np.full(len(u), -np.inf, np.float32), np.zeros(len(u))
                for a in range(words[0], words[1], 1 << 13):
                    q = np.asarray(shipped(targets)[a : min(words[1], a + (1 << 13))], np.float32)
                    s = u @ np.ascontiguousarray(q[:, :-1].T)
                    s += q[:, -1]
                    new = np.maximum(top, s.max(1))
                    s -= new[:, None]
                    np.exp(s, out=s)
                    z, top = z * np.exp(top - new) + s.sum(1, dtype=np.float64), new
                yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([(top + np.log(z)).astype("<f4").tobytes()], pa.binary())], names=["at", "z"])

    blocks = -(-count // block)
    got = spark.range(0, blocks, 1, min(blocks, 64)).mapInArrow(run, "at long, z binary").toArrow()
    out = np.zeros(count, np.float32)
    for at, z in zip(got.column("at").to_pylist(), got.column("z").to_pylist(), strict=True):
        out[at * block : (at + 1) * block] = np.frombuffer(z, "<f4")
    return out


def normalised(spark: SparkSession, r_file: str, q_file: str, uni: np.ndarray, own: int) -> tuple[str, str]:
    """Files of the groups' vectors, and of each context's group, what it adds to the tail's scores and its log normaliser; words from ``own`` on are the tail."""
    size, r, q = len(uni), shipped(r_file), shipped(q_file)
    group, table = grouped(r, uni, own)
    g_file = ship(spark, table)
    context = np.zeros((size, 3), np.float32)
    context[:, 0] = group
    context[:, 2] = log_sums(spark, r_file, size, q_file, (0, own)) if own else -np.inf
    if own < size:
        mean = sum(uni[a : a + GATHERED_AT_ONCE] @ np.asarray(q[a : a + GATHERED_AT_ONCE, :-1], np.float64) for a in range(own, size, GATHERED_AT_ONCE)) / uni[own:].sum()
        for a in range(0, size, GATHERED_AT_ONCE):
            b = min(size, a + GATHERED_AT_ONCE)
            context[a:b, 1] = (np.asarray(r[a:b, :-1], np.float32) - table[group[a:b]]) @ mean.astype(np.float32)
        tail = log_sums(spark, g_file, len(table), q_file, (own, size))
        context[:, 2] = np.logaddexp(context[:, 2], context[:, 1] + tail[group])
    return g_file, ship(spark, context)


def log_probability(before: np.ndarray, now: np.ndarray, own: int, r: np.ndarray, q: np.ndarray, groups: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Natural log p(now | before) of ids."""
    at, u, v = context[before], r[before, :-1].astype(np.float32), q[now].astype(np.float32)
    tail = now >= own
    u[tail] = groups[at[tail, 0].astype(np.int64)]
    return np.einsum("ij,ij->i", u, v[:, :-1]) + v[:, -1] + np.where(tail, at[:, 1], 0) - at[:, 2]


def train_model(spark: SparkSession, pairs: DataFrame, buckets: int, vocab: Vocabulary) -> tuple[str, str, int, str, str]:
    """Files of the context vectors and the target vectors (bias last), the number of words before the tail, and the files of ``normalised``."""
    size, head = vocab.size, min(HEAD, vocab.size)
    model = LogBilinear(head).fit(head_table(pairs.where(F.col("slot") < buckets), head))
    uni = vocab.unigram() + 0.5
    log_q = np.log(uni / uni.sum()).astype(np.float32)
    rng = np.random.default_rng(11)
    drawn = rng.choice(size, DRAWN, p=uni / uni.sum())
    q = np.column_stack((model.q, model.b)).astype(np.float32)
    r = np.column_stack((model.r * model.c, np.zeros(head))).astype(np.float32)
    if size > head:
        # A word of the tail starts with the class's vectors and its own share of it.
        q[-1, -1] -= np.float32(math.log(uni[head - 1 :].sum() / uni.sum()))
        tail = np.arange(size) >= head - 1
        noise = ship(spark, (np.float32(math.log(NOISE)) + np.where(tail, 0, log_q)).astype(np.float32))
        q_file = ship_file(spark, solve(pairs, range(buckets, 2 * buckets), size, lambda ids: scattered(r, ids), drawn, q, noise, np.where(tail, log_q, 0)))
        off = ship(spark, log_q + np.float32(math.log(NOISE)))

        def fixed(ids):
            f = np.asarray(shipped(q_file)[ids], np.float32)
            f[:, -1] -= shipped(off)[ids]
            return f

        r_file = ship_file(spark, solve(pairs, range(buckets), size, fixed, drawn, r, None))
    else:
        q_file, r_file = ship(spark, q), ship(spark, r)
    own = head - 1 if size > head else size
    return r_file, q_file, own, *normalised(spark, r_file, q_file, uni, own)


def score(df: DataFrame, train: DataFrame, *, size: int | None = None, frequent: int = FREQUENT) -> DataFrame:
    """Score ``df`` (doc_id, held_out, text) by statistics of ``train`` (text): one row for each input row.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. A null text is empty: its
    end alone. Without training texts every count is 0.
    """
    spark = df.sparkSession
    counts = durable(count_words(train))
    vocab, least = vocabulary(counts, size, frequent)
    key = f"{id(vocab)}-{vocab.tokens}-{vocab.distinct}-{least}"
    shared = spark.sparkContext.broadcast({"words": vocab.words})
    hashes, inside, other = ship(spark, vocab.hashes), vocab.inside, vocab.size - 1
    r_file, q_file, common, g_file, c_file = train_model(spark, *count_pairs(train, key, shared, vocab, hashes), vocab)
    tables = spark.sparkContext.broadcast(np.log10(vocab.counts + 1.0))
    base_den, rest_den = math.log10(vocab.base_denominator), math.log10(vocab.rest_denominator)
    names = ["rid", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rest"]
    # Within a text's list of other words, the first entry has no word and carries the text's own figures.
    entry = pa.struct([("word", pa.binary()), ("n", pa.int64())])

    def run(batches):
        index, logs = _shared_index(key, shared), tables.value
        model = shipped(r_file), shipped(q_file), shipped(g_file), shipped(c_file)
        rid = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                words = [words_of(t) for t in part.column("text").to_pylist()]
                sizes = np.array([len(w) + 1 for w in words])
                owner = np.repeat(np.arange(len(words)), sizes)
                flat = list(chain.from_iterable(chain(w, (END,)) for w in words))
                at_word = np.array(list(map(index.get, flat, repeat(-1))), np.int64)
                here = at_word >= 0
                now = ids_of(flat, at_word, inside, shipped(hashes))
                before = np.concatenate(([0], now[:-1]))  # what precedes a text is an end
                logc = np.where(here, logs[at_word] if len(logs) else 0.0, 0.0)
                outside = now == other
                total = lambda w: np.bincount(owner, w, len(words))  # noqa: E731, B023
                base = total(logc) - sizes * base_den
                log_p = np.empty(len(now))
                for a in range(0, len(now), GATHERED_AT_ONCE):
                    b = a + GATHERED_AT_ONCE
                    log_p[a:b] = log_probability(before[a:b], now[a:b], common, *model)
                full = total(np.minimum(log_p, 0) / math.log(10) + np.where(outside, logc - rest_den, 0.0))
                rest: list[dict[bytes, int]] = [{} for _ in words]
                unseen = np.flatnonzero(~here)
                for i, o in zip(unseen.tolist(), owner[unseen].tolist(), strict=True):
                    r = rest[o]
                    w = flat[i]
                    r[w] = r.get(w, 0) + 1
                lens = np.cumsum([0, *(len(r) for r in rest)])
                flat_rest = pa.StructArray.from_arrays(
                    [pa.array(list(chain.from_iterable(rest)), pa.binary()), pa.array(list(chain.from_iterable(r.values() for r in rest)), pa.int64())], fields=list(entry)
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(rid + np.arange(len(words)), pa.int64()), part.column("doc_id"), part.column("held_out"), pa.array(sizes, pa.int64()),
                        pa.array(total(here & (at_word >= 0)).astype(np.int64), pa.int64()), pa.array(base), pa.array(full), pa.ListArray.from_arrays(pa.array(lens, pa.int32()), flat_rest),
                    ],
                    names=names,
                )
                rid += len(words)

    texts = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("held_out").cast("boolean").alias("held_out"), F.encode(F.col("text").cast("string"), "UTF-8").alias("text"))
    scored = texts.mapInArrow(run, "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, rest array<struct<word:binary,n:long>>")
    # One row for the text itself (a word that no text has: its own number), then one a word.
    own = F.struct(F.concat(F.lit(b" "), F.encode(F.col("rid").cast("string"), "UTF-8")).alias("word"), F.lit(0).cast("long").alias("n"))
    flat = scored.select("*", F.posexplode(F.concat(F.array(own), "rest")).alias("at", "w"))
    first = F.col("at") == 0
    figures = {c: F.when(first, F.col(c)) for c in names[1:-1]}
    rows = flat.select("rid", *[v.alias(k) for k, v in figures.items()], F.col("w.word").alias("word"), F.col("w.n").alias("k"))
    rare = counts.where(F.col("n") < least).withColumnRenamed("n", "c")
    joined = rows.join(rare, "word", "left")
    log_c = F.sum(F.when(F.col("c").isNotNull(), F.col("k") * F.log10(F.col("c") + 1.0)).otherwise(0.0))
    # Words with vectors have no share in the class of others.
    log_share = F.sum(F.when(F.col("c") < (SEEN if len(vocab.hashes) else 1 << 62), F.col("k") * F.log10(F.col("c") + 1.0)).otherwise(0.0))
    out = joined.groupBy("rid").agg(
        *[F.max(c).alias(c) for c in names[1:-1]], log_c.alias("log_c"), log_share.alias("log_share"), F.sum(F.when(F.col("c").isNotNull(), F.col("k")).otherwise(0)).alias("more")
    )
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("more")).alias("n_known"), F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.col("log_c")).alias("base_score"), (F.col("score") + F.col("log_share")).alias("score"),
    )


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score; those whose crc32(doc_id) mod 7 is 2 are held out. See ``score``; a null doc_id is not held out."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    docs = documents(spark, sf_dir).select("doc_id", "text", (crc_mod("doc_id", 7) == 2).alias("held_out"))
    return score(docs, docs.where(~F.col("held_out")))
