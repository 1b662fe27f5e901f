"""Mixing sources to target weights with soft membership.

A classifier trained on a labelled table gives every document posteriors over domains. Nonnegative
document rates are fitted so that the expected tokens of each domain, the sum of tokens x posterior
x rate, meet their targets: weighted least squares, projected to a least rate, by Newton steps on its dual.
Each step aggregates a matrix of domains x domains over all documents; a document's rate is a
function of its posteriors and one vector, so nothing is kept by document between steps.
"""

from __future__ import annotations

import math
import warnings
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import LOWER, documents, durable, text_chunks, with_fields, word_hash, word_spans

HASHED = 1024
#: The most labelled documents that the classifier is fitted on, chosen by a hash of doc_id.
LABELLED = 4000
#: Shares of tokens by domain; domains that are not labelled here keep their share among the rest.
TARGETS = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}
STEPS = 24
#: Of the least budget that cuts no domain, so that rates of at least 1 can still meet the targets where posteriors are soft.
SLACK = 1.05
#: What the default budget grows by, one after the other, while the targets cannot be met.
GROWTH = (1.5, 2.5, 5.0)
#: Largest miss of a domain, as a part of the budget.
TOLERANCE = 1e-6


def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words of each text, of length 1 (0 without words), and its tokens (words and an end)."""
    n = len(offsets) - 1
    low = LOWER[data]
    starts, ends, owner = word_spans(low, offsets)
    h = word_hash(low, starts, ends)
    x = np.bincount(owner * HASHED + (h % np.uint64(HASHED)).astype(np.int64), minlength=n * HASHED).reshape(n, HASHED).astype(np.float32)
    x /= np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)
    return x, np.bincount(owner, minlength=n) + 1


class Softmax:
    """Multinomial logistic regression by full-batch Adam; with one domain its posterior is 1."""

    def __init__(self, domains: list[str]):
        self.domains = domains
        self.w = np.zeros((HASHED, len(domains)), np.float32)
        self.b = np.zeros(len(domains), np.float32)

    def posterior(self, x: np.ndarray) -> np.ndarray:
        s = x @ self.w + self.b
        e = np.exp(s - s.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def fit(self, x: np.ndarray, y: np.ndarray, *, steps: int = 150, rate: float = 0.2, decay: float = 1e-4) -> Softmax:
        one = np.eye(len(self.domains), dtype=np.float32)[y]
        m = [np.zeros_like(self.w), np.zeros_like(self.b)]
        v = [np.zeros_like(self.w), np.zeros_like(self.b)]
        for i in range(1, steps + 1):
            d = (self.posterior(x) - one) / max(1, len(y))
            for k, (p, g) in enumerate(((self.w, x.T @ d + decay * self.w), (self.b, d.sum(0)))):
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                p -= rate * (m[k] / (1 - 0.9**i)) / (np.sqrt(v[k] / (1 - 0.99**i)) + 1e-8)
        return self


def train(docs: DataFrame, labelled: DataFrame, *, domain: str = "lang", most: int = LABELLED) -> Softmax:
    """Fit on the documents that ``labelled`` (doc_id) names and whose ``domain`` is known, or about ``most`` of them by a hash of doc_id; of rows with one id and domain one text."""
    ids = labelled.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    share = min(1.0, most / max(1, ids.count()))
    some = ids.where(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1 << 20)) < int(share * (1 << 20)))

    def run(batches):
        for batch in batches:
            for at, data, offsets in text_chunks(batch.column("text")):
                x, _ = encode(data, offsets)
                yield pa.RecordBatch.from_arrays([batch.column("y").slice(at, len(x)), pa.array([r.astype("<f2").tobytes() for r in x], pa.binary())], names=["y", "x"])

    known = docs.where(F.col(domain).isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col(domain).cast("string").alias("y"))
    one = known.join(F.broadcast(some), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))  # at most ``most`` ids are broadcast
    got = one.mapInArrow(run, "y string, x binary").toArrow()
    y, raw = got.column("y").to_pylist(), got.column("x").to_pylist()
    del got
    order = sorted(range(len(y)), key=lambda i: (y[i], raw[i]))
    x = np.frombuffer(b"".join([raw[i] for i in order]), "<f2").reshape(-1, HASHED).astype(np.float32)  # half precision on the way
    del raw
    names = sorted(set(y)) or ["all"]
    model = Softmax(names).fit(x, np.array([names.index(y[i]) for i in order], np.int64))
    pa.default_memory_pool().release_unused()
    return model


def with_posteriors(df: DataFrame, model: Softmax, *, keep: bool = True) -> DataFrame:
    """Add n_tokens and posterior (array, in the order of model.domains); columns of these names are replaced. Without ``keep`` only these two leave the worker."""
    out = df.drop("n_tokens", "posterior")
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            tokens, found = [], []
            for _, data, offsets in text_chunks(batch.column("text")):
                x, n = encode(data, offsets)
                tokens.append(n)
                found.append(shared.value.posterior(x))
            p = np.concatenate(found).astype(np.float64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * p.shape[1], pa.int32()), pa.array(p.reshape(-1)))
            held = batch.schema.names if keep else []
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in held], pa.array(np.concatenate(tokens), pa.int64()), lists], names=[*held, "n_tokens", "posterior"])

    return out.mapInArrow(run, with_fields(out, n_tokens="long", posterior="array<double>") if keep else "n_tokens long, posterior array<double>")


def targets_of(domains: list[str], targets: dict[str, float], have: np.ndarray) -> np.ndarray:
    """A share for each domain: as given, or (for one not given) its present share of what is left; they sum to 1."""
    given = np.array([targets.get(d, np.nan) for d in domains])
    free = np.isnan(given)
    left = max(0.0, 1 - np.nansum(given)) or have[free].sum() / max(have.sum(), 1e-12)
    out = np.where(free, left * have / max(have[free].sum(), 1e-12) if free.any() else 0, given)
    return out / out.sum()


def _rate(steps: list[list[float]], least: float) -> Column:
    """The rate after these steps from 1, each projected to at least ``least``."""
    p = F.col("posterior")
    move = lambda c: reduce(lambda a, b: a + b, [p[k] * float(x) for k, x in enumerate(c)])
    return reduce(lambda x, c: F.greatest(F.lit(float(least)), x - move(c)), steps, F.lit(max(1.0, least)))


def fit_rates(rows: DataFrame, domains: list[str], targets: dict[str, float], *, budget: float | None = None, least: float = 0.0, steps: int = STEPS) -> tuple[list[list[float]], np.ndarray, np.ndarray]:
    """The move of the rates for ``rows`` (n_tokens, posterior), as ``_rate`` takes it; also the domains' expected tokens reached, and wanted.

    Of all rates of at least ``least`` >= 0 that meet the targets, those nearest to 1 are sought (squares
    weighted by tokens). They are max(least, 1 - posterior . c), so only c is fitted, by Newton steps:
    the k x k matrix is the sum of n p p^T over rows above ``least``. A step that brings no gain is halved.
    ``budget`` is the tokens of the mixture, by default SLACK x the least that no domain must be cut
    for; where posteriors are too soft for that, it grows by GROWTH. If no such
    budget meets the targets, the first one's rates stay, with a warning.
    """
    k = len(domains)
    p, n = F.col("posterior"), F.col("n_tokens").cast("double")
    upper = [(i, j) for i in range(k) for j in range(i, k)]

    def at(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = _rate([c.tolist()], least)
        free = F.when(_rate([c.tolist()], -math.inf) + (max(1.0, least) - 1.0) >= least, n).otherwise(0.0)  # at c = 0 every row may move
        r = rows.select("n_tokens", "posterior", x.alias("x"), free.alias("free")).agg(
            *[F.coalesce(F.sum(n * p[i] * F.col("x")), F.lit(0.0)).alias(f"t{i}") for i in range(k)],
            *[F.coalesce(F.sum(F.col("free") * p[i] * p[j]), F.lit(0.0)).alias(f"m{i}_{j}") for i, j in upper],
        ).first()
        m = np.zeros((k, k))
        for (i, j), v in zip(upper, r[k:], strict=True):
            m[i, j] = m[j, i] = v
        return np.array(r[:k]), m

    first = rows.agg(*[F.coalesce(F.sum(n * p[i]), F.lit(0.0)).alias(f"t{i}") for i in range(k)], *[F.coalesce(F.sum(n * p[i] * p[j]), F.lit(0.0)).alias(f"m{i}_{j}") for i, j in upper]).first()
    have = np.array(first[:k])
    if not have.sum():
        return [], have, have
    whole = np.zeros((k, k))
    for (i, j), v in zip(upper, first[k:], strict=True):
        whole[i, j] = whole[j, i] = v
    share = targets_of(domains, targets, have)
    c, met, tried = np.zeros(k), False, []
    for grown in (1.0,) if budget is not None else (1.0, *GROWTH):
        wanted = share * (budget if budget is not None else grown * SLACK * float((have / np.maximum(share, 1e-12)).max()))
        reached, m = at(c)
        for _ in range(steps):
            off = np.linalg.norm(reached - wanted)
            if np.abs(reached - wanted).max() < TOLERANCE * wanted.sum():
                met = True
                break
            # A little of the whole matrix keeps a step finite where few rows are free.
            d, t = np.linalg.lstsq(m + 1e-3 * whole, reached - wanted, rcond=1e-9)[0], 1.0
            while t > 1e-3:
                reached_t, m_t = at(c + t * d)
                if np.linalg.norm(reached_t - wanted) < off:
                    break
                t /= 4
            else:
                break
            c, reached, m = c + t * d, reached_t, m_t
        tried.append((c, reached, wanted))
        if met:
            break
    if not met:
        c, reached, wanted = tried[0]
        warnings.warn(f"targets not met: reached {np.round(reached / max(reached.sum(), 1e-12), 4).tolist()} of {domains}, wanted {np.round(share, 4).tolist()}; {reached.sum():.0f} tokens of {wanted.sum():.0f}", stacklevel=2)
    return [c.tolist()], reached, wanted


def mixed(docs: DataFrame, labelled: DataFrame, *, domain: str = "lang", targets: dict[str, float] = TARGETS, budget: float | None = None, least: float = 1.0) -> DataFrame:
    """Add n_tokens, posterior, domain_of (the likeliest), rate and copies to ``docs``.

    With the default ``least`` every document stays, and those of scarce domains are repeated.
    copies is rate rounded up or down by a hash of doc_id and text, so its mean is the rate. A null
    text is empty: it has one token and the classifier's prior. Equal rows get equal copies.
    """
    model = train(docs, labelled, domain=domain)
    texts = docs.select(F.col("text").cast("string").alias("text"))
    rows = durable(with_posteriors(texts, model, keep=False))
    steps, _, _ = fit_rates(rows, model.domains, targets, budget=budget, least=least)
    names = F.array(*map(F.lit, model.domains))
    out = with_posteriors(docs, model).withColumn("rate", _rate(steps, least))
    uniform = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    best = F.get(names, (F.array_position("posterior", F.array_max("posterior")) - 1).cast("int"))
    return out.withColumns({"domain_of": best, "copies": F.floor(F.col("rate") + uniform).cast("int")})


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, domain posteriors, rate and copies. See ``mixed``; an empty table gives no rows."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    out = mixed(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "n_tokens", "posterior", F.col("domain_of").alias("domain"), "rate", "copies")
