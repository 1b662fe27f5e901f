"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation (random signs and a fast Hadamard transform, three times) turns a unit vector;
its hash is the nearest signed axis. Several tables hash independently. A query probes, in each
table, the buckets of its nearest axes, and every candidate found is ranked by its exact cosine.
For large inputs a second, shorter hash refines the buckets, so their mean size stays the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import durable

TABLES = 8
#: Of each table's buckets, the share that a query probes.
PROBED = 10 / 128
#: Mean vectors of a bucket beyond which the second hash comes in.
BUCKET = 2048
#: Vectors of a bucket that go to one task; larger buckets are dealt by vec_id.
SLICE = 4096
NEIGHBOURS = 5


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, scaled to keep lengths; the width is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), 2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def rotate(x: np.ndarray, seed: int) -> np.ndarray:
    """Three rounds of signs and transform, after padding to a power of two."""
    d = 1 << max(0, int(x.shape[1] - 1).bit_length())
    rng = np.random.default_rng((seed, d))
    y = np.zeros((len(x), d))
    y[:, : x.shape[1]] = x
    for _ in range(3):
        y = hadamard(y * rng.choice([-1.0, 1.0], d))
    return y


class CrossPolytope:
    """Hashes of one table for vectors of ``width``; ``fine`` axes of a second rotation refine them (0: none)."""

    def __init__(self, table: int, width: int, fine: int = 0):
        self.table, self.fine = table, fine
        self.axes = 1 << max(0, int(width - 1).bit_length())

    def _sides(self, x: np.ndarray) -> list[np.ndarray]:
        """Projections on every signed axis, for each hash."""
        out = [rotate(x, 2 * self.table)]
        if self.fine:
            out.append(rotate(x, 2 * self.table + 1)[:, : self.fine])
        return [np.concatenate((y, -y), 1) for y in out]

    def hash(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        for y in self._sides(x):
            out = out * y.shape[1] + y.argmax(1)
        return out

    def probes(self, x: np.ndarray, n: int) -> np.ndarray:
        """The n buckets nearest to each vector, by the summed shortfall of its projections."""
        sides = self._sides(x)
        n = min(n, int(np.prod([y.shape[1] for y in sides])))
        loss = sides[0].max(1, keepdims=True) - sides[0]
        if self.fine:
            second = sides[1].max(1, keepdims=True) - sides[1]
            loss = (loss[:, :, None] + second[:, None, :]).reshape(len(x), -1)
        return np.argpartition(loss, n - 1, axis=1)[:, :n]


def usable(vector: Column) -> Column:
    """Neither null nor empty, every component finite, some not 0."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.exists(vector, lambda c: c != 0)


def matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; first to largest component 1, so that no square overflows."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; equal rows give equal results wherever they stand."""
    a, b = a / np.abs(a).max(1, keepdims=True), b / np.abs(b).max(1, keepdims=True)
    return np.einsum("ij,ij->i", a, b) / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))


def nearest(q: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each row of q the k rows of x of largest cosine, ties to smaller ids: (ids, cosines)."""
    rough = unit(q) @ unit(x).T
    out = []
    for i in range(len(q)):
        at = np.arange(len(x))
        if len(x) > k:
            least = np.partition(rough[i], len(x) - k)[len(x) - k]
            at = np.flatnonzero(rough[i] >= least - 1e-9)
        c = cosines(np.broadcast_to(q[i], (len(at), q.shape[1])), x[at])
        best = np.lexsort((ids[at], -c))[:k]
        out.append((ids[at][best], c[best]))
    return out


_FOUND = "rep long, vec_id long, score double"


def _batch(found: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64)),
            pa.array(np.concatenate([f[1] for f in found]).astype(np.int64)),
            pa.array(np.concatenate([f[2] for f in found])),
        ],
        names=["rep", "vec_id", "score"],
    )


def _probe(queries: DataFrame, rows: DataFrame, n: int, k: int) -> DataFrame:
    """rep, vec_id, score: the k best of every bucket that a query probes."""

    def fine(width: int) -> int:
        """Axes of the second hash, so that buckets hold about BUCKET vectors."""
        axes = 2 << max(0, int(width - 1).bit_length())
        want = n / (axes * BUCKET)
        return 0 if want < 2 else min(axes // 2, 1 << int(np.log2(want)) >> 1)

    def by_width(batch: pa.RecordBatch):
        """A batch in parts of vectors of one width: (part, matrix)."""
        width = np.array(batch.column("vector").value_lengths().to_pylist())
        for w in np.unique(width).tolist():
            part = batch.take(pa.array(np.flatnonzero(width == w)))
            yield w, part, matrix(part.column("vector"))

    def index(batches):
        for batch in batches:
            for w, part, x in by_width(batch):
                u = unit(x)
                for t in range(TABLES):
                    h = CrossPolytope(t, w, fine(w)).hash(u)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), w * TABLES + t)), pa.array(h), part.column("vec_id"), part.column("vector")], names=["t", "h", "id", "vector"])

    def ask(batches):
        for batch in batches:
            for w, part, x in by_width(batch):
                u = unit(x)
                for t in range(TABLES):
                    cp = CrossPolytope(t, w, fine(w))
                    most = 2 * cp.axes * (2 * cp.fine or 1)
                    p = cp.probes(u, max(1, round(PROBED * most)))
                    again = pa.array(np.repeat(np.arange(len(u)), p.shape[1]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(p.size, w * TABLES + t)), pa.array(p.reshape(-1).astype(np.int64)), part.column("vec_id").take(again), part.column("vector").take(again)], names=["t", "h", "id", "vector"]
                    )

    kind = "t long, h long, id long, vector array<double>"
    indexed, asked = rows.mapInArrow(index, kind), queries.mapInArrow(ask, kind)
    sizes = indexed.groupBy("t", "h").agg(F.count("*").alias("n")).where(F.col("n") > SLICE).select("t", "h", F.ceil(F.col("n") / SLICE).cast("int").alias("slices"))
    slices = F.coalesce("slices", F.lit(1))
    dealt = indexed.join(sizes, ["t", "h"], "left").select("t", "h", F.pmod("id", slices).cast("int").alias("s"), F.lit(1).alias("side"), "id", "vector")
    spread = asked.join(sizes, ["t", "h"], "left").select("t", "h", F.explode(F.sequence(F.lit(0), slices - 1)).alias("s"), F.lit(0).alias("side"), "id", "vector")

    def meet(batches):
        """Rows come by bucket, queries first; a bucket's vectors are ranked a batch at a time."""
        now, q, qid = None, [], []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("t", "h", "s", "side")], 1)
            cuts = np.flatnonzero(np.any(np.diff(keys, axis=0, prepend=keys[:1] - 1) != 0, 1))
            found = []
            for s, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(keys)], strict=True):
                key, side = tuple(keys[s, :3].tolist()), keys[s, 3]
                if key != now:
                    now, q, qid = key, [], []
                ids, part = batch.column("id").slice(s, e - s).to_numpy(), batch.column("vector").slice(s, e - s)
                if side == 0:
                    q.append(matrix(part))
                    qid.append(ids)
                elif q:
                    if len(q) > 1:
                        q, qid = [np.concatenate(q)], [np.concatenate(qid)]
                    found += [(i, v, c) for i, (v, c) in zip(qid[0].tolist(), nearest(q[0], matrix(part), ids, k), strict=True)]
            if found:
                yield _batch(found)

    both = dealt.unionByName(spread)
    return both.repartition("t", "h", "s").sortWithinPartitions("t", "h", "s", "side").mapInArrow(meet, _FOUND)


def _scan(queries: DataFrame, rows: DataFrame, k: int, block: int = 1024) -> DataFrame | None:
    """The exact way: queries against all rows, a broadcast block of at most ``block`` at a time. None without queries."""
    n = queries.count()
    if not n:
        return None
    blocks = -(-n // block)
    out = None
    for b in range(blocks):
        got = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).toArrow()
        if not len(got):
            continue
        ids = got.column("vec_id").to_numpy()
        vectors = [np.array(v, np.float64) for v in got.column("vector").to_pylist()]
        shared = queries.sparkSession.sparkContext.broadcast((ids, vectors))

        def run(batches, shared=shared):
            ids, vectors = shared.value
            for batch in batches:
                width = np.array(batch.column("vector").value_lengths().to_pylist())
                for w in np.unique(width).tolist():
                    mine = [i for i, v in enumerate(vectors) if len(v) == w]
                    part = batch.take(pa.array(np.flatnonzero(width == w)))
                    if mine:
                        near = nearest(np.stack([vectors[i] for i in mine]), matrix(part.column("vector")), part.column("vec_id").to_numpy(), k)
                        yield _batch([(int(ids[i]), v, c) for i, (v, c) in zip(mine, near, strict=True)])

        found = rows.mapInArrow(run, _FOUND)
        out = found if out is None else out.unionByName(found)
    return out


def search(vectors: DataFrame, queries: DataFrame, *, k: int = NEIGHBOURS) -> DataFrame:
    """query_id, rank, vec_id, score: for each query its k nearest found, itself (its id) excepted.

    Both are (vec_id, vector). Unusable vectors (see ``usable``) and null ids take no part; vectors
    of different widths never meet. Equal vectors are searched for once, and of those found only the
    k + 1 smallest ids can be needed, so groups of copies cost no more than one vector. A query that
    the buckets give fewer than k is answered by a scan of all vectors. Repeated rows of one id and
    vector count once; ids that differ in their vectors are candidates with each.
    """
    clean = lambda df: df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector")).where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    copies = Window.partitionBy("vector").orderBy("vec_id")
    rows = durable(clean(vectors).withColumn("n", F.dense_rank().over(copies)).where(F.col("n") <= k + 1).select("vec_id", "vector").distinct())
    asked = clean(queries).distinct()
    reps = asked.groupBy("vector").agg(F.min("vec_id").alias("vec_id"))
    reps = durable(reps)
    members = asked.join(reps.withColumnRenamed("vec_id", "rep"), "vector").select(F.col("vec_id").alias("query_id"), "rep")
    found = durable(_top(_probe(reps, rows, rows.count(), k + 1), k + 1))
    enough = found.groupBy("rep").agg(F.count("*").alias("n")).where(F.col("n") >= k + 1).select(F.col("rep").alias("vec_id"))
    more = _scan(durable(reps.join(enough, "vec_id", "left_anti")), rows, k + 1)
    if more is not None:
        found = _top(found.unionByName(more), k + 1)
    best = members.join(found, "rep").where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _top(found: DataFrame, k: int) -> DataFrame:
    best = found.groupBy("rep", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("rep").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).drop("n")


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest of every vector whose vec_id is divisible by 50. See ``search``; an empty table gives no rows."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", F.col("embedding").alias("vector"))
    return search(rows, rows.where(F.col("vec_id") % 50 == 0))
