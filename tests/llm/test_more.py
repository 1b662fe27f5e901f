"""Operators against plain versions, and with extra columns whose names clash with their own."""

import math

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ann, fingerprints, lm, mixing, ngram_join, packing, quality, shared, suffix_dedup


def clashing(df):
    names = "key n h rep root comp tokens keys bucket k v r d extra held_out score words word spans raw start size kind p side piece length rank task fingerprint next_value n_tokens posterior rate copies".split()
    return df.withColumns({c: F.lit("clash") for c in names if c not in df.columns})


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_clashing_columns_change_nothing(spark, docs):
    some = docs.where("doc_id < 40")
    odd = clashing(some)
    for f, cols in (
        (ngram_join.near_components, ("doc_id", "n_shingles", "component_id")),
        (suffix_dedup.remove_repeats, ("doc_id", "n_bytes", "n_removed", "kept_sha256")),
        (fingerprints.fingerprint, ("doc_id", "fingerprint")),
        (lambda d: fingerprints.with_successor(d, "doc_id", "text"), ("doc_id", "text", "next_value")),
        (lambda d: packing.pack(d, packing.tokenizer_path()), ("doc_id", "piece", "start", "length", "ids_crc32")),
    ):
        assert rows(f(odd), *cols) == rows(f(some), *cols)
    train = some.withColumn("held_out", F.lit(False))
    plain = lm.score(train, some)
    assert rows(lm.score(odd.withColumn("held_out", F.lit(False)), odd), "doc_id", "n_tokens", "n_known", "base_score") == rows(plain, "doc_id", "n_tokens", "n_known", "base_score")
    v = spark.createDataFrame([(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(60)], "vec_id bigint, vector array<double>")
    assert rows(ann.search(clashing(v), clashing(v.where("vec_id % 50 = 0"))), "query_id", "rank", "vec_id") == rows(ann.search(v, v.where("vec_id % 50 = 0")), "query_id", "rank", "vec_id")


def test_fingerprints_are_the_least_hashes(docs, corpus):
    got = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprint(docs).collect()}
    for i, t in corpus:
        raw = np.frombuffer((t or "").encode(), np.uint8)
        low = shared.LOWER[raw]
        s, e, _ = shared.word_spans(low, np.array([0, len(low)]))
        words = [low[a:b].tobytes() for a, b in zip(s.tolist(), e.tolist(), strict=True)]
        assert words == brute.words(t)
        each = shared.shingle_hashes(raw, np.array([0, len(raw)]))[0]
        assert len(each) == len(brute.shingles(t)) and got[i] == fingerprints.to_text(np.sort(each)[: fingerprints.K])


def test_likeness_to_the_next_document(spark, docs, corpus, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    texts = [t for _, t in corpus]
    for r in fingerprints.op5_fingerprint(spark, str(tmp_path)).collect():
        a, b = brute.shingles(texts[r["doc_id"]]), brute.shingles(texts[(r["doc_id"] + 1) % len(texts)])
        want = len(a & b) / len(a | b) if a | b else 1.0
        assert abs(r["near_next"] - want) < 0.3 and (len(a | b) > fingerprints.K or math.isclose(r["near_next"], want))


@pytest.mark.parametrize("least", [0.0, 0.5, 1.0])
def test_mixing_rates_are_the_optimum(spark, least):
    """Least squares with bounds is convex: rates max(least, 1 - p.c) that meet the targets are the only optimum."""
    rng = np.random.default_rng(9)
    p = rng.dirichlet([0.5, 0.4, 0.3], 400)
    n = rng.integers(1, 400, 400)
    df = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, p, strict=True)], "n_tokens bigint, posterior array<double>").cache()
    steps, _, wanted = mixing.fit_rates(df, ["a", "b", "c"], {"a": 0.4, "b": 0.35, "c": 0.25}, least=least)
    got = df.withColumn("rate", mixing._rate(steps, least)).collect()
    r = np.array([x["rate"] for x in got])
    q, m = np.array([x["posterior"] for x in got]), np.array([x["n_tokens"] for x in got])
    assert np.allclose((m * r) @ q, wanted, rtol=1e-4) and r.min() >= least - 1e-12
    free = r > least + 1e-9
    c = np.linalg.lstsq(q[free], 1 - r[free], rcond=None)[0]
    assert np.allclose(np.maximum(least, 1 - q @ c), r, atol=1e-6)
    # No small change that keeps the targets and the bound comes nearer to 1.
    for _ in range(20):
        d = rng.normal(size=len(r)) * free
        a = (q * m[:, None])[free]
        d[free] -= a @ np.linalg.lstsq(a.T @ a, a.T @ d[free], rcond=None)[0]
        t = r + 1e-4 * d
        if t.min() >= least:
            assert (m * (t - 1) ** 2).sum() >= (m * (r - 1) ** 2).sum() - 1e-6


def test_attention_score_by_plain_loops():
    rng = np.random.default_rng(4)
    m = quality.GatedAttention(quality.WIDTH)
    texts = ["one two three " * 70, "BUY NOW!!! " * 50 + "quiet rivers run", "", "x"]
    raw = [t.encode() for t in texts]
    data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])
    x, count = quality.encode(data, offsets)
    assert count.tolist() == [math.ceil(210 / 64), math.ceil(103 / 64), 1, 1]
    m.fit(x, count, np.array([1, 0, 0, 1]), steps=5)
    p, at, got = m.p, 0, m.scores(x, count)
    sigmoid = lambda z: 1 / (1 + math.exp(-z))
    for k, c in enumerate(count.tolist()):
        hs, ss = [], []
        for i in range(at, at + c):
            z = (x[i] - m.mean) / m.scale
            h = np.tanh(z @ p["V"] + p["c"])
            ss.append(sum(math.tanh(float(h @ p["A"][:, j])) * sigmoid(float(h @ p["B"][:, j])) * float(p["w"][j]) for j in range(len(p["w"]))))
            hs.append(h)
        weight = np.exp(np.array(ss) - max(ss))
        z = sum(a * h for a, h in zip(weight / weight.sum(), hs, strict=True))
        assert math.isclose(got[k], sigmoid(float(z @ p["u"] + p["b"][0])), rel_tol=1e-4)
        at += c
    # A passage is encoded by itself: the same passage in another document has the same features.
    alone, _ = quality.encode(np.frombuffer(b"one two three " * 22, np.uint8)[: 64 * 14 // 3], np.array([0, 64 * 14 // 3]))
    assert np.allclose(alone[0][quality.HASHED :], x[0][quality.HASHED :], atol=0.02)
    del rng
