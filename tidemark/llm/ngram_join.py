"""N-gram Jaccard join: documents whose sets of word shingles are alike enough, as components.

1. Equal sets are one class, known by a hash of the set.
2. Of a fixed share of the hash space, shingles that only one class has are counted. A class with
   more than a quarter (1 - threshold) of its shingles its own can link to nothing and is done.
   The sets of the rest are written down, and all of their shingles counted in the same way.
3. Classes that share one of the first shingles of a global order (the prefix that a linked pair
   must share) form blocks. The order puts rare shingles first, so that a passage that many
   documents quote joins no blocks unless documents hold little else. Shared shingles are united
   within each batch first, so one that very many documents hold is one row a batch.
4. A signature tree joins the sets of each block. A block beyond BLOCK classes is cut in slices by
   size, and every two slices whose sizes can link are joined by a task of their own.
5. Links become components, and classes hand their component to their documents.

Shingles are 64-bit hashes, and classes hashes of their sets; all steps are exact on these. Two given
shingles, or sets, share a hash with a chance of about 2^-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import sigtree
from .components import UnionFind, components
from .shared import documents, durable, mix, shingle_hashes, text_chunks

NUMERATOR, DENOMINATOR = 3, 4
#: Share of the hash space whose shingles are counted in step 2; it must exceed 1 - threshold for the count to tell.
COUNTED = 0.31
#: Classes that one task joins at a time.
BLOCK = 4096
#: Positions of the bitmap that tells likely classes when texts are read again; what it lets through is tested exactly.
FILTER_BITS = 1 << 24
#: Positions of the table of how common shingles are (log2 of the classes that hold them, 2 and up). The order
#: that it gives is the same for all sets, so shingles that share a position cost time but no link.
LEVELS = 1 << 22
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def class_of(tokens: np.ndarray) -> int:
    """Signed 64-bit hash of a set of sorted tokens."""
    parts = np.array([np.bitwise_xor.reduce(mix(tokens + _GOLD)), np.add.reduce(mix(tokens ^ _GOLD)), len(tokens)], np.uint64)
    return int(mix(np.add.reduce(mix(parts * _ODD), keepdims=True)).view(np.int64)[0])


def _sets(batch: pa.RecordBatch):
    """(row, shingles) of every text in the batch."""
    for at, data, offsets in text_chunks(batch.column("text")):
        for i, s in enumerate(shingle_hashes(data, offsets)):
            yield at + i, s


def _place(keys: np.ndarray, ids: np.ndarray | None = None) -> np.ndarray:
    """Position of each class in the bitmap; with ``ids``, of each class in that document."""
    k = keys.astype(np.uint64)
    return mix(k if ids is None else k ^ mix(ids.astype(np.uint64))) % np.uint64(FILTER_BITS)


def _passes(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (7 - (at & np.uint64(7))).astype(np.uint8) & 1).astype(bool)


def _packed(tokens: np.ndarray, keys: np.ndarray, buckets: int):
    """Rows (bucket, tokens, keys as bytes): tokens dealt by their low half."""
    b = ((tokens & np.uint64(0xFFFFFFFF)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(b, kind="stable")
    b, tokens, keys = b[order], tokens[order], keys[order]
    cuts = np.flatnonzero(np.diff(b, prepend=-1))
    for s, e in zip(cuts.tolist(), [*cuts[1:].tolist(), len(b)], strict=True):
        yield int(b[s]), tokens[s:e].tobytes(), keys[s:e].tobytes()


def _gathered(batches) -> tuple[np.ndarray, np.ndarray]:
    """All tokens and keys of a partition of packed rows, sorted by token."""
    t, k = [], []
    for batch in batches:
        t += [np.frombuffer(x, np.uint64) for x in batch.column("tokens").to_pylist()]
        k += [np.frombuffer(x, np.int64) for x in batch.column("keys").to_pylist()]
    if not t:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    tokens, keys = np.concatenate(t), np.concatenate(k)
    order = np.argsort(tokens, kind="stable")
    return tokens[order], keys[order]


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the runs of equal values."""
    start = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.zeros(0, np.int64)
    return start, np.diff(np.append(start, len(x)))


_PACKED = "bucket long, tokens binary, keys binary"


def _pack_batch(rows) -> pa.RecordBatch:
    b, t, k = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(t, pa.binary()), pa.array(k, pa.binary())], names=["bucket", "tokens", "keys"])


def classes(df: DataFrame) -> DataFrame:
    """doc_id, key (null for an empty set), n and h (a hash of the text) of every row."""
    df = df.select("doc_id", "text", F.xxhash64("text").alias("h"))

    def run(batches):
        for batch in batches:
            found = [(class_of(s), len(s)) if len(s) else (None, 0) for _, s in _sets(batch)]
            k, n = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(k, pa.int64()), pa.array(n, pa.int64()), batch.column("h")], names=["doc_id", "key", "n", "h"])

    return df.mapInArrow(run, "doc_id long, key long, n long, h long")


def _count(packed: DataFrame, parts: int, levels: bool = False) -> tuple[DataFrame, np.ndarray]:
    """(key, own), how many of a class's packed shingles no other class has (classes with none are absent); and with ``levels`` the table of LEVELS.

    Counts by class leave a task as arrays, dealt by class, and so do the levels.
    """

    def count(batches):
        tokens, keys = _gathered(batches)
        start, n = _runs(tokens)
        if not len(start):
            return
        low, high = np.minimum.reduceat(keys, start), np.maximum.reduceat(keys, start)
        k, c = np.unique(low[low == high], return_counts=True)  # a class in two batches comes twice
        to = (k.astype(np.uint64) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(to, kind="stable")
        cuts = np.flatnonzero(np.diff(to[order], prepend=-1))
        rows = [(int(to[at[0]]), k[at].tobytes(), c[at].astype(np.int32).tobytes()) for at in np.split(order, cuts[1:])] if len(k) else []
        if levels:
            many = (n > 3) & (low != high)
            level = np.zeros(LEVELS, np.int32)
            np.maximum.at(level, (tokens[start[many]] % np.uint64(LEVELS)).astype(np.int64), np.log2(n[many]).astype(np.int32))
            at = np.flatnonzero(level)
            # Levels are told from counts by their negative numbers.
            cuts = np.searchsorted(at, np.arange(1, parts) * (LEVELS // parts + 1))
            rows += [(i, x.tobytes(), (-y).astype(np.int32).tobytes()) for i, (x, y) in enumerate(zip(np.split(at, cuts), np.split(level[at], cuts), strict=True)) if len(x)]
        if rows:
            yield _pack_batch(rows)

    def total(batches):
        k, c = [], []
        for batch in batches:
            k += [np.frombuffer(x, np.int64) for x in batch.column("tokens").to_pylist()]
            c += [np.frombuffer(x, np.int32) for x in batch.column("keys").to_pylist()]
        if k:
            key, count = np.concatenate(k), np.concatenate(c)
            keys, at = np.unique(key[count > 0], return_inverse=True)
            own = np.bincount(at, count[count > 0], len(keys)).astype(np.int64)
            level = np.zeros(LEVELS if (count < 0).any() else 0, np.int64)
            np.minimum.at(level, key[count < 0], count[count < 0])
            at = np.flatnonzero(level)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((keys, at))), pa.array(np.concatenate((own, level[at])))], names=["key", "own"])

    out = durable(packed.repartition(parts, "bucket").mapInArrow(count, _PACKED).repartition(parts, "bucket").mapInArrow(total, "key long, own long"))
    table = np.zeros(LEVELS, np.uint8)
    if levels:
        got = out.where("own < 0").groupBy("key").agg(F.min("own").alias("own")).toArrow()  # at most LEVELS rows
        table[got.column("key").to_numpy()] = -got.column("own").to_numpy()
    return out.where("own > 0"), table


def _sampled(df: DataFrame, parts: int) -> DataFrame:
    """Packed shingles of the counted share of the hash space, for all texts."""
    limit = np.uint64(int(COUNTED * 2.0**64))

    def pack(batches):
        for batch in batches:
            held: dict[int, np.ndarray] = {}
            for _, s in _sets(batch):
                if len(s):
                    held.setdefault(class_of(s), s[: np.searchsorted(s, limit)])
            yield from _packed_holders(held, parts)

    return df.mapInArrow(pack, _PACKED)


def _packed_holders(held: dict[int, np.ndarray], parts: int):
    """Packed rows of each shingle with its holders, of which there need be no more than four: more tell the counts nothing new but how common it is."""
    if not held:
        return
    tokens = np.concatenate(list(held.values()))
    keys = np.repeat(np.array(list(held), np.int64), [len(s) for s in held.values()])
    order = np.argsort(tokens, kind="stable")
    start, n = _runs(tokens[order])
    keep = np.arange(len(order)) - np.repeat(start, n) < 4
    if keep.any():
        yield _pack_batch(_packed(tokens[order][keep], keys[order][keep], parts * 4))


def _all_shingles(sets: DataFrame, parts: int) -> DataFrame:
    def pack(batches):
        for batch in batches:
            yield from _packed_holders(dict(_stored(batch)), parts)

    return sets.mapInArrow(pack, _PACKED)


def _stored(batch: pa.RecordBatch):
    """(key, shingles) of stored sets."""
    for k, t in zip(batch.column("key").to_pylist(), batch.column("tokens").to_pylist(), strict=True):
        yield k, np.frombuffer(t, np.uint64)


def _filter(keys: DataFrame, by_document: bool = False):
    """A broadcast bitmap of FILTER_BITS positions for the keys (or for each with its ``rep``): 2 MB, however many."""

    def run(batches):
        for batch in batches:
            ids = batch.column("rep").to_numpy() if by_document else None
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_place(batch.column("key").to_numpy(), ids)).astype(np.int32))], names=["at"])

    rows = keys.select("key", F.coalesce("rep", F.lit(0)).alias("rep")) if by_document else keys.select("key")
    at = rows.mapInArrow(run, "at int").distinct().toArrow()
    bits = np.zeros(FILTER_BITS, bool)
    bits[at.column("at").to_numpy()] = True
    return keys.sparkSession.sparkContext.broadcast(np.packbits(bits))


def _sets_of(df: DataFrame, alive: DataFrame) -> DataFrame:
    """(key, tokens) of the classes of ``alive``, and the few more that the bitmap lets through: of the rows of each class's smallest doc_id."""
    bits = _filter(alive, by_document=True)

    def run(batches):
        for batch in batches:
            ids = batch.column("doc_id").fill_null(0).to_numpy()
            held: dict[int, bytes] = {}
            for row, s in _sets(batch):
                if len(s):
                    key = class_of(s)
                    if _passes(bits.value, _place(np.array([key]), ids[row : row + 1]))[0]:
                        held[key] = s.tobytes()
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(list(held.values()), pa.binary())], names=["key", "tokens"])

    return df.mapInArrow(run, "key long, tokens binary")


def _kept(batch: pa.RecordBatch, bits: np.ndarray) -> pa.RecordBatch:
    """The rows whose key the bitmap lets through."""
    return batch.filter(pa.array(_passes(bits, _place(batch.column("key").to_numpy()))))


def _prefix(s: np.ndarray, level: np.ndarray) -> np.ndarray:
    """The first shingles in the order (level, hash), of which a linked set must have one."""
    n = len(s) - -(-NUMERATOR * len(s) // DENOMINATOR) + 1
    return s[np.argsort(level[(s % np.uint64(LEVELS)).astype(np.int64)], kind="stable")[:n]]


def _shared_edges(sets: DataFrame, keys: DataFrame, level: np.ndarray, parts: int) -> DataFrame:
    """(u, v): classes of ``keys`` that share a prefix shingle, as a star for each batch and one over the batches."""
    bits = _filter(keys)
    levels = keys.sparkSession.sparkContext.broadcast(level)  # LEVELS bytes

    def stars(tokens: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of runs of equal tokens: the least owner of each run, and the edges from its other owners."""
        start, n = _runs(tokens)
        low = np.minimum.reduceat(owners, start) if len(start) else owners
        hub = np.repeat(low, n)
        other = owners != hub
        edges = np.unique(np.stack((owners[other], hub[other]), 1), axis=0)
        return low, start, edges

    def pack(batches):
        for batch in batches:
            held = {k: _prefix(s, levels.value) for k, s in _stored(_kept(batch, bits.value))}
            if not held:
                continue
            tokens = np.concatenate(list(held.values()))
            owners = np.repeat(np.array(list(held), np.int64), [len(s) for s in held.values()])
            order = np.argsort(tokens, kind="stable")
            low, start, edges = stars(tokens[order], owners[order])
            yield _pack_batch(_packed(tokens[order][start], low, parts * 4))
            if len(edges):  # edges travel as pairs of keys, without tokens
                yield _pack_batch([(int(edges[0, 0]) % (parts * 4), b"", edges.astype(np.int64).tobytes())])

    def meet(batches):
        found, t, k = [], [], []
        for batch in batches:
            for tok, key in zip(batch.column("tokens").to_pylist(), batch.column("keys").to_pylist(), strict=True):
                if tok:
                    t.append(np.frombuffer(tok, np.uint64))
                    k.append(np.frombuffer(key, np.int64))
                else:
                    found.append(np.frombuffer(key, np.int64).reshape(-1, 2))
        if t:
            tokens, owners = np.concatenate(t), np.concatenate(k)
            order = np.argsort(tokens, kind="stable")
            found.append(stars(tokens[order], owners[order])[2])
        if found:
            e = np.unique(np.concatenate(found), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(e[:, 0], pa.int64()), pa.array(e[:, 1], pa.int64())], names=["u", "v"])

    # What the bitmap lets through by chance can only join blocks, never part them; such keys are not among ``keys`` later.
    return sets.mapInArrow(pack, _PACKED).repartition(parts, "bucket").mapInArrow(meet, "u long, v long").distinct()


def _tasks(keys: DataFrame, block: int) -> DataFrame:
    """key, task, side: which tasks join a class. Blocks of at most ``block`` classes are one task; of larger ones, every two slices that can link."""
    sizes = keys.groupBy("comp").agg(F.count("*").alias("members")).where("members > 1")
    inside = keys.join(sizes, "comp")
    whole = inside.where(F.col("members") <= block).select("key", F.struct("comp", F.lit(0).alias("a"), F.lit(0).alias("b")).alias("task"), F.lit(0).alias("side"))
    large = inside.where(F.col("members") > block)
    # Slices by size: places within a large block by a histogram of sizes, not by a sort of the block.
    by_size = large.groupBy("comp", "n", (F.pmod("key", F.lit(64))).alias("salt")).agg(F.count("*").alias("c"))
    before = F.sum("c").over(Window.partitionBy("comp").orderBy("n", "salt").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("c")
    cell = by_size.withColumn("slice", F.floor(before / (block // 2)).cast("int"))
    placed = large.withColumn("salt", F.pmod("key", F.lit(64))).join(cell.select("comp", "n", "salt", "slice"), ["comp", "n", "salt"])
    ranges = placed.groupBy("comp", "slice").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    other = ranges.select("comp", F.col("slice").alias("b"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"))
    pairs = ranges.withColumnRenamed("slice", "a").join(other, "comp").where(f"a <= b and {DENOMINATOR} * hi >= {NUMERATOR} * blo and {DENOMINATOR} * bhi >= {NUMERATOR} * lo").select("comp", "a", "b")
    first = placed.join(pairs.withColumn("slice", F.col("a")), ["comp", "slice"]).select("key", F.struct("comp", "a", "b").alias("task"), F.lit(0).alias("side"))
    second = placed.join(pairs.where("a < b").withColumn("slice", F.col("b")), ["comp", "slice"]).select("key", F.struct("comp", "a", "b").alias("task"), F.lit(1).alias("side"))
    return whole.unionByName(first).unionByName(second)


def _links(sets: DataFrame, keys: DataFrame, block: int, parts: int) -> DataFrame:
    """(u, v): each class of ``keys`` (key, rep, n, comp) with the least that a task found it linked to, if there is one."""
    tasks = durable(_tasks(keys, block))
    bits = _filter(keys.join(tasks.select("key").distinct(), "key", "left_semi"))

    def emit(batches):
        for batch in batches:
            yield _kept(batch, bits.value)

    sets = sets.mapInArrow(emit, "key long, tokens binary")
    rows = tasks.join(sets, "key").select("task.comp", "task.a", "task.b", "side", "key", "tokens")

    def solve(held: dict[int, dict[int, np.ndarray]]):
        names = sorted({*held.get(0, ()), *held.get(1, ())})
        at = {k: i for i, k in enumerate(names)}
        groups = UnionFind(len(names))
        trees = []
        for side in (0, 1):
            if side in held:
                k = list(held[side])
                tree = sigtree.SignatureTree([held[side][x] for x in k])
                trees.append((tree, np.array([at[k[i]] for i in tree.order])))
        if len(trees) == 1:
            sigtree.join(trees[0][0], None, NUMERATOR, DENOMINATOR, groups, (trees[0][1], None))
        else:
            sigtree.join(trees[0][0], trees[1][0], NUMERATOR, DENOMINATOR, groups, (trees[0][1], trees[1][1]))
        out = [(names[i], names[r]) for i in range(len(names)) if (r := groups.find(i)) != i]
        if out:
            u, v = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    def run(batches):
        now, held = None, {}
        for batch in batches:
            for comp, a, b, side, key, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (comp, a, b) != now:
                    if held:
                        yield from solve(held)
                    now, held = (comp, a, b), {}
                held.setdefault(side, {})[key] = np.frombuffer(tokens, np.uint64)
        if held:
            yield from solve(held)

    return rows.repartition(parts, "comp", "a", "b").sortWithinPartitions("comp", "a", "b").mapInArrow(run, "u long, v long")


def _texts(df: DataFrame) -> DataFrame:
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _rooted(texts: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """Every row's doc_id, key, n and h; and (key, rep, root) of every class: its smallest doc_id, and the least class of its component."""
    spark = texts.sparkSession
    rows = durable(classes(texts))
    full = rows.where("key is not null")
    keys = full.groupBy("key").agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.count("*").alias("copies"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // 20_000)
    few = f"{DENOMINATOR} * coalesce(own, 0) <= {DENOMINATOR - NUMERATOR} * n"
    own, _ = _count(_sampled(texts, parts), parts)
    alive = durable(keys.join(own, "key", "left").where(few).select("key", "rep", "n"))
    sets = durable(_sets_of(texts, alive))
    own, level = _count(_all_shingles(sets, parts), parts, levels=True)
    alive = durable(alive.join(own, "key", "left").where(few).select("key", "rep", "n"))
    blocks = components(_shared_edges(sets, alive, level, parts))
    in_blocks = alive.join(blocks.withColumnRenamed("u", "key"), "key", "left").select("key", "rep", "n", F.coalesce("v", "key").alias("comp"))
    links = components(_links(sets, in_blocks, block, parts))
    return rows, keys.join(links.withColumnRenamed("u", "key"), "key", "left").select("key", "rep", F.coalesce("v", "key").alias("root"))


def near_components(df: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``df`` (doc_id, text; other columns are ignored).

    Null and empty texts, and those without words, have no shingles and are components of their own,
    as are rows linked to nothing. A component's id is its smallest non-null doc_id. Repeated rows
    are equal texts and so one component.
    """
    rows, rooted = _rooted(_texts(df), block)
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    of_key = rooted.join(least, "root").select("key", "component_id")
    joined = rows.where("key is not null").join(of_key, "key").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return joined.unionByName(rows.where("key is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def one_of_each(df: DataFrame, *, block: int = BLOCK) -> DataFrame:
    """The rows of ``df`` (doc_id, text and any others) less near copies: of each component one row stays, that of its smallest non-null doc_id.

    Rows are told apart by doc_id and text, so two different texts under one doc_id, or under none, are
    judged apart; of rows equal in both, one stays. Rows without words are components of their own and
    all stay. Only rows that may go (a bitmap of fixed size tells) are shuffled with their texts.
    """
    rows, rooted = _rooted(_texts(df), block)
    known = rows.where("key is not null").join(rooted.select("key", "root"), "key").groupBy("root", "doc_id", "h").agg(F.count("*").alias("copies"))
    first = known.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "h")).alias("k"))
    stays = F.col("doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("h") == F.col("k.h"))
    marked = durable(known.join(first, "root").select("doc_id", "h", "copies", stays.alias("_tm_stays")).where("not _tm_stays or copies > 1").select(F.col("doc_id").alias("_tm_id"), F.col("h").alias("_tm_hash"), "_tm_stays"))
    bits = _filter(marked.select(F.col("_tm_hash").alias("key"), F.col("_tm_id").alias("rep")), by_document=True)
    here = df.withColumns({"_tm_i": F.col("doc_id").cast("long"), "_tm_h": F.xxhash64(F.col("text").cast("string"))})

    def split(wanted: bool):
        def run(batches):
            for batch in batches:
                at = _place(batch.column("_tm_h").to_numpy(), batch.column("_tm_i").fill_null(0).to_numpy())
                yield batch.filter(pa.array(_passes(bits.value, at) == wanted))

        return here.mapInArrow(run, here.schema)

    met = split(True).join(marked, F.col("_tm_i").eqNullSafe(F.col("_tm_id")) & (F.col("_tm_h") == F.col("_tm_hash")), "left")
    met = durable(met.where("_tm_stays is null or _tm_stays").select(*here.columns, "_tm_stays"))
    one = met.where("_tm_stays").dropDuplicates(["_tm_i", "_tm_h"])
    return split(False).unionByName(met.where("_tm_stays is null").drop("_tm_stays")).unionByName(one.drop("_tm_stays")).select(*df.columns)


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents at similarity 0.75 of five-word shingles. See ``near_components``; an empty table gives no rows."""
    return near_components(documents(spark, sf_dir))


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 75 * (x.n + y.n - o)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, e.b FROM reach JOIN edges e ON e.a = reach.r)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM documents d JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) m ON m.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id
"""
