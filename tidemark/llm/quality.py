"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages. Each passage is encoded from its text alone: hashed words, shares
of character classes, and how much it repeats. A gated attention network learns from document
labels which passages matter, and scores the weighted passage representation.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import LOWER, crc_mod, documents, text_chunks, with_fields, word_hash, word_spans

PASSAGE_WORDS = 64
HASHED = 192
#: The most labelled documents that a model is fitted on, chosen by a hash of doc_id.
LABELLED = 4000
THRESHOLD = 0.3

_CLASS = np.full(256, 7, np.uint8)  # non-ASCII
_CLASS[:128] = 6  # other symbols and control characters
_CLASS[ord("a") : ord("z") + 1] = 0
_CLASS[ord("A") : ord("Z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[ord(" ")] = 3
_CLASS[[9, 10, 11, 12, 13]] = 4
_CLASS[[ord(c) for c in ".,;:'\"-"]] = 5
STATS = 8 + 5
WIDTH = HASHED + STATS


def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of some texts, and how many passages each has (at least one, of zeros if it has no words)."""
    n = len(offsets) - 1
    starts, ends, owner = word_spans(data, offsets)
    words = np.bincount(owner, minlength=n)
    count = np.maximum(1, -(-words // PASSAGE_WORDS))
    x = np.zeros((int(count.sum()), WIDTH), np.float32)
    base = np.cumsum(count) - count
    if not len(starts):
        x[:, -1] = 1
        return x, count
    first = np.cumsum(words) - words
    passage = base[owner] + (np.arange(len(starts)) - first[owner]) // PASSAGE_WORDS
    h = word_hash(LOWER[data], starts, ends)
    per = np.bincount(passage, minlength=len(x)).astype(np.float32)
    x[:, :HASHED] = np.bincount(passage * HASHED + (h % np.uint64(HASHED)).astype(np.int64), minlength=len(x) * HASHED).reshape(len(x), HASHED)
    safe = np.maximum(per, 1)
    x[:, :HASHED] /= np.sqrt(safe)[:, None]
    head = np.flatnonzero(np.diff(passage, prepend=-1))
    full, cuts = passage[head], starts[head]
    stop = np.append(ends[head[1:] - 1], ends[-1])
    kinds = _CLASS[data]
    size = np.maximum(1, stop - cuts)
    bounds = np.stack((cuts, stop), 1).reshape(-1)
    for c in range(8):
        total = np.concatenate(([0], np.cumsum(kinds == c, dtype=np.int64)))[bounds].reshape(-1, 2)
        x[full, HASHED + c] = (total[:, 1] - total[:, 0]) / size
    at = HASHED + 8
    pair = np.sort(passage.astype(np.uint64) << np.uint64(40) | h >> np.uint64(24))
    run = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
    times = np.diff(np.append(run, len(pair)))
    of = (pair[run] >> np.uint64(40)).astype(np.int64)
    x[:, at] = np.bincount(of, minlength=len(x)) / safe  # distinct words
    most = np.zeros(len(x))
    np.maximum.at(most, of, times)
    x[:, at + 1] = most / safe  # the commonest word's share
    x[full, at + 2] = np.log1p(size / safe[full])  # word length
    x[:, at + 3] = np.log1p(per)
    x[:, at + 4] = per == 0
    return x, count


class GatedAttention:
    """score = sigmoid(u . sum_k a_k h_k + b), h = tanh(x V + c), a = softmax over a document of w . (tanh(h A) * sigmoid(h B))."""

    def __init__(self, width: int = WIDTH, hidden: int = 24, gate: int = 12, seed: int = 3):
        rng = np.random.default_rng(seed)
        init = lambda a, b: rng.normal(0, a**-0.5, (a, b)).astype(np.float32)
        self.mean, self.scale = np.zeros(width, np.float32), np.ones(width, np.float32)
        self.p = {"V": init(width, hidden), "c": np.zeros(hidden, np.float32), "A": init(hidden, gate), "B": init(hidden, gate), "w": init(gate, 1)[:, 0], "u": init(hidden, 1)[:, 0], "b": np.zeros(1, np.float32)}

    def _forward(self, x: np.ndarray, starts: np.ndarray, owner: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        h = np.tanh(x @ p["V"] + p["c"])
        t, g = np.tanh(h @ p["A"]), 1 / (1 + np.exp(-(h @ p["B"])))
        s = (t * g) @ p["w"]
        e = np.exp(s - np.maximum.reduceat(s, starts)[owner])
        a = e / np.add.reduceat(e, starts)[owner]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"h": h, "t": t, "g": g, "a": a, "z": z, "y": 1 / (1 + np.exp(-(z @ p["u"] + p["b"])))}

    def scores(self, x: np.ndarray, count: np.ndarray) -> np.ndarray:
        if not len(count):
            return np.zeros(0)
        return self._forward((x - self.mean) / self.scale, np.cumsum(count) - count, np.repeat(np.arange(len(count)), count))["y"].astype(np.float64)

    def attention(self, x: np.ndarray, count: np.ndarray) -> np.ndarray:
        return self._forward((x - self.mean) / self.scale, np.cumsum(count) - count, np.repeat(np.arange(len(count)), count))["a"]

    def fit(self, x: np.ndarray, count: np.ndarray, label: np.ndarray, *, steps: int = 250, rate: float = 0.02, decay: float = 2e-3) -> GatedAttention:
        """Full-batch Adam on the log loss; without labels of both kinds the score is their (smoothed) share everywhere."""
        if not len(label) or label.min() == label.max():
            self.p["u"][:] = 0
            share = (label.sum() + 0.5) / (len(label) + 1) if len(label) else 0.5
            self.p["b"][:] = np.log(share / (1 - share))
            return self
        self.mean = x.mean(0, dtype=np.float64).astype(np.float32)
        x = np.subtract(x, self.mean, dtype=np.float32)
        self.scale = np.sqrt(np.einsum("ij,ij->j", x, x) / len(x)) + np.float32(1e-2)
        x /= self.scale
        starts, owner = np.cumsum(count) - count, np.repeat(np.arange(len(count)), count)
        p, m, v = self.p, {k: np.zeros_like(w) for k, w in self.p.items()}, {k: np.zeros_like(w) for k, w in self.p.items()}
        y = label.astype(np.float32)
        for i in range(1, steps + 1):
            f = self._forward(x, starts, owner)
            d = (f["y"] - y) / len(y)
            dz = d[:, None] * p["u"]
            dh = f["a"][:, None] * dz[owner]
            da = (f["h"] * dz[owner]).sum(1)
            ds = f["a"] * (da - np.add.reduceat(f["a"] * da, starts)[owner])
            gated = ds[:, None] * p["w"]
            dt, dg = gated * f["g"] * (1 - f["t"] ** 2), gated * f["t"] * f["g"] * (1 - f["g"])
            dh += dt @ p["A"].T + dg @ p["B"].T
            dx = dh * (1 - f["h"] ** 2)
            grad = {"V": x.T @ dx, "c": dx.sum(0), "A": f["h"].T @ dt, "B": f["h"].T @ dg, "w": (f["t"] * f["g"]).T @ ds, "u": f["z"].T @ d, "b": np.array([d.sum()])}
            for k, g in grad.items():
                g = g + decay * p[k] if k != "b" else g
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                p[k] -= (rate * (1 - i / (steps + 1)) * (m[k] / (1 - 0.9**i)) / (np.sqrt(v[k] / (1 - 0.99**i)) + 1e-8)).astype(np.float32)
        return self


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality", most: int = LABELLED) -> GatedAttention:
    """Fit on the labelled documents, or about ``most`` of them by a hash of doc_id. Rows without an id, a label or (once joined) a document don't count; of repeated labels the largest counts, and of rows with one id one text, so no more than ``most`` are gathered."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).groupBy("doc_id").agg(F.max("y").alias("y"))
    share = min(1.0, most / max(1, known.count()))
    some = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))

    def run(batches):
        for batch in batches:
            y = batch.column("y")
            for at, data, offsets in text_chunks(batch.column("text")):
                x, count = encode(data, offsets)
                rows = np.split(x, np.cumsum(count)[:-1])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(at, len(count)), y.slice(at, len(count)), pa.array([r.astype("<f2").tobytes() for r in rows], pa.binary())], names=["doc_id", "y", "x"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    one = texts.join(F.broadcast(some), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    got = one.mapInArrow(run, "doc_id long, y int, x binary").toArrow().sort_by("doc_id")  # at most ``most`` rows are broadcast
    y, raw = got.column("y").to_numpy(), got.column("x").to_pylist()
    del got
    count = np.array([len(b) // (2 * WIDTH) for b in raw], np.int64)
    x = np.frombuffer(b"".join(raw), "<f2").reshape(-1, WIDTH)  # half precision until it is fitted
    del raw
    model = GatedAttention().fit(x, count, y)
    pa.default_memory_pool().release_unused()
    return model


def score(df: DataFrame, model: GatedAttention, *, text: str = "text") -> DataFrame:
    """Add ``score``, of every whole text; a null text is empty. All rows stay; a column of that name is replaced."""
    out = df.drop("score")
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            col = batch.column(text)
            found = [shared.value.scores(*encode(data, offsets)) for _, data, offsets in text_chunks(col)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(found) if found else [], pa.float64())], names=[*batch.schema.names, "score"])

    return out.mapInArrow(run, with_fields(out, score="double"))


def train_on_labels(spark: SparkSession, docs: DataFrame, sf_dir: str) -> GatedAttention:
    """The model of the contract's fold: labels whose crc32(doc_id) mod 5 is not 0."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return train(docs, labels.where(crc_mod("doc_id", 5) != 0))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality. See ``score``; an empty table gives no rows; a null doc_id counts as held out."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = score(docs, train_on_labels(spark, docs, sf_dir))
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
