"""Secret scans: fixed patterns, and strings that a Markov model holds for random.

Two character models are compared by log-likelihood ratio: one of random strings, one of ordinary
identifiers. Both are first-order Markov chains over 30 character classes, trained from labelled
samples. Everything is DataFrame functions: no shuffle, no Python on the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import documents

# The contract's patterns, with the least length of the part that counts.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A run that is long enough is the same match with the least length in the pattern; only for assign, whose
# short matches use up text that could start another, the length is tested afterwards.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
BASE = (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX))
KINDS = ("assign", "access", "hex", "model")
#: What the model judges: long unbroken runs.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"

_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_CLASSES = _LETTERS + "A0+_"
_FROM = _LETTERS.upper() + "0123456789" + "/=-"
_TO = "A" * 26 + "0" * 10 + "++_"
#: Thousandths of a nat.
SCALE = 1000

STEMS = (
    "get set read write load store open close make build find count merge split index user order item price total "
    "page table column batch stream config option value record session request response handler manager service "
    "customer account document version number message address network storage function structure interface "
    "geschwindigkeit verbindung einstellung bedeutung schlacht wirtschaft utilisateur chargement fichier "
    "verification nombre elementos configuracion direccion ejemplo usuario thing other ration tion able http www "
    "com org net html images static content default example release internal public"
).split()


def labelled_samples(spark: SparkSession, n: int = 4000) -> DataFrame:
    """``n`` random strings (hexadecimal, base64, alphanumeric) and ``n`` identifiers joined from stems: (s, random)."""
    i = F.col("id")
    digest = F.sha2(F.concat(F.lit("sample"), i.cast("string")), 256)
    base64 = F.regexp_replace(F.base64(F.unhex(digest)), "=", "")
    random = F.when(i % 4 == 0, F.substring(digest, 1, 40)).when(i % 4 == 1, base64).when(i % 4 == 2, F.regexp_replace(base64, "[+/]", "")).otherwise(F.upper(F.regexp_replace(base64, "[+/]", "")))
    stems = F.array(*map(F.lit, STEMS))
    draw = lambda k, n: F.conv(F.substring(F.sha2(F.concat_ws("-", i.cast("string"), F.lit(k)), 256), 1, 8), 16, 10).cast("long") % n
    part = [F.element_at(stems, (draw(k, len(STEMS)) + 1).cast("int")) for k in range(4)]
    number = draw(4, 2100).cast("string")
    plain = (
        F.when(i % 6 == 0, F.concat_ws("_", *part))
        .when(i % 6 == 1, F.concat_ws("-", *part[:3], number))
        .when(i % 6 == 2, F.concat(part[0], *[F.initcap(p) for p in part[1:]]))
        .when(i % 6 == 3, F.upper(F.concat_ws("_", *part)))
        .when(i % 6 == 4, F.concat_ws("/", *part[:3], number))
        .otherwise(F.concat(*part))
    )
    rows = spark.range(n)
    return rows.select(random.alias("s"), F.lit(True).alias("random")).unionByName(rows.select(plain.alias("s"), F.lit(False).alias("random")))


def train(samples: DataFrame) -> list[int]:
    """Log-likelihood ratio (random over ordinary, thousandths of a nat) of each of the 30 x 30 class bigrams.

    The samples are aggregated before anything reaches the driver: at most 2 x 900 counts.
    """
    s = F.translate(F.col("s"), _FROM, _TO)
    pairs = samples.where(F.length("s") > 1).select("random", F.explode(F.transform(F.sequence(F.lit(1), F.length("s") - 1), lambda p: F.substr(s, p, F.lit(2)))).alias("pair"))
    counts = {(bool(r["random"]), r["pair"]): r["n"] for r in pairs.groupBy("random", "pair").agg(F.count("*").alias("n")).collect()}
    size = len(_CLASSES)

    def log_p(kind: bool, a: str) -> list[float]:
        row = [counts.get((kind, a + b), 0) + 0.5 for b in _CLASSES]
        return [math.log(x / sum(row)) for x in row]

    out: list[int] = []
    for a in _CLASSES:
        out += [round(SCALE * (r - o)) for r, o in zip(log_p(True, a), log_p(False, a), strict=True)]
    assert len(out) == size * size
    return out


def log_ratio(string: Column, table: list[int]) -> Column:
    """Sum of the table over the bigrams of ``string``, whose characters are all of CANDIDATE's set."""
    size = len(_CLASSES)
    codes = F.transform(F.split(F.translate(string, _FROM, _TO), ""), lambda c: F.position(c, F.lit(_CLASSES)))
    start = F.struct(F.lit(0).alias("last"), F.lit(0).alias("sum"))

    def step(acc: Column, code: Column) -> Column:
        both = (acc["last"] > 0) & (code > 0)
        ratio = F.when(both, F.get(F.lit(table), (acc["last"] - 1) * size + code - 1)).otherwise(0)
        return F.struct(code.alias("last"), (acc["sum"] + ratio).alias("sum"))

    return F.aggregate(codes, start, step, lambda acc: acc["sum"])


def _carried(items: Column, start: Column, step, join, out: str) -> Column:
    """Each item with the state before it: array<struct<c, x>>, ``out`` being its type.

    ``step`` (state, item) -> state is folded over blocks of about sqrt(n) items, and ``join`` (state,
    state after a block from ``start``) over the blocks, so no array that is built item by item is
    longer than a block: n ** 1.5 steps in all, where one fold would copy n arrays of n items.
    """
    n = F.size(items)

    def over(held: Column) -> Column:
        blocks = held["b"]
        totals = F.transform(blocks, lambda b: F.aggregate(b, start, step))
        first = F.struct(start.alias("c"), F.array().cast("array<int>").alias("out"))
        heads = F.aggregate(totals, first, lambda acc, t: F.struct(join(acc["c"], t).alias("c"), F.concat(acc["out"], F.array(acc["c"])).alias("out")), lambda acc: acc["out"])

        def block(z: Column) -> Column:
            begin = F.struct(z["h"].alias("c"), F.array().cast(out).alias("out"))
            one = lambda acc, x: F.array(F.struct(acc["c"].alias("c"), x.alias("x"))).cast(out)
            return F.aggregate(z["b"], begin, lambda acc, x: F.struct(step(acc["c"], x).alias("c"), F.concat(acc["out"], one(acc, x)).alias("out")), lambda acc: acc["out"])

        return F.flatten(F.transform(F.arrays_zip(blocks.alias("b"), heads.alias("h")), block))

    width = F.greatest(F.lit(1), F.ceil(F.sqrt(n)).cast("int"))
    # A lambda's variable is evaluated once; an expression inside one, again for every item.
    cut = F.transform(F.array(F.struct(items.alias("a"), width.alias("w"))), lambda y: F.struct(F.transform(F.sequence(F.lit(0), F.floor((F.size(y["a"]) - 1) / y["w"]).cast("int")), lambda i: F.slice(y["a"], i * y["w"] + 1, y["w"])).alias("b")))
    return F.when(n > 0, F.get(F.transform(cut, over), F.lit(0))).otherwise(F.array().cast(out))


_SPAN = "struct<s:int,k:int,e:int,m:string>"
_SPANS = f"array<{_SPAN}>"


def _located(text: Column, found: Column, pattern: str, kind: int) -> Column:
    """Spans of the matches ``found``: the text between them is what ``split`` leaves, so lengths give the places."""
    pairs = F.arrays_zip(found.alias("m"), F.slice(F.split(text, pattern, -1), 1, F.greatest(F.size(found), F.lit(1))).alias("g"))
    sized = F.transform(pairs, lambda z: F.struct(F.length(z["g"]).alias("gap"), F.length(z["m"]).alias("len"), z["m"].alias("m")))
    at = _carried(sized, F.lit(0), lambda c, x: c + x["gap"] + x["len"], lambda c, t: c + t, "array<struct<c:int,x:struct<gap:int,len:int,m:string>>>")
    span = lambda z: F.struct((z["c"] + z["x"]["gap"]).alias("s"), F.lit(kind).alias("k"), (z["c"] + z["x"]["gap"] + z["x"]["len"]).alias("e"), z["x"]["m"].alias("m"))
    return F.when(F.size(found) > 0, F.transform(at, span)).otherwise(F.array().cast(_SPANS))


_FAR = (1 << 31) - 1


def _clear(base: Column, hot: Column) -> Column:
    """Those of ``hot`` (spans of kind 3, apart from each other) that touch no span of ``base``, by two passes over both in order."""
    own = lambda x: x["k"] < 3
    both = F.array_sort(F.concat(base, hot))
    seen = _carried(both, F.lit(0), lambda c, x: F.when(own(x), F.greatest(c, x["e"])).otherwise(c), lambda c, t: F.greatest(c, t), f"array<struct<c:int,x:{_SPAN}>>")
    far = F.lit(_FAR)
    back = _carried(F.reverse(seen), far, lambda c, z: F.when(own(z["x"]), z["x"]["s"]).otherwise(c), lambda c, t: F.when(t == far, c).otherwise(t), f"array<struct<c:int,x:struct<c:int,x:{_SPAN}>>>")
    free = F.filter(back, lambda z: (z["x"]["x"]["k"] == 3) & (z["x"]["c"] <= z["x"]["x"]["s"]) & (z["c"] >= z["x"]["x"]["e"]))
    return F.when(F.size(hot) == 0, hot).when(F.size(base) == 0, hot).otherwise(F.transform(free, lambda z: z["x"]["x"]))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def scan(df: DataFrame, table: list[int], *, text: str = "text", least_per_char: float = 0.35, least: float = 12.0) -> DataFrame:
    """Add ``secret_spans``: array<struct<s, k, e, m>> sorted by start, then kind (place in KINDS); code points, e exclusive, m the string.

    Base kinds are leftmost non-overlapping matches per kind, less those whose counting part is too
    short. The model adds runs of CANDIDATE with a digit and a letter that touch no base span and
    whose ratio is at least ``least`` nats and ``least_per_char`` nats a character; a run that touches
    a base span is known already and not judged. Work grows as the text and its matches to the power
    1.5, not with their product. A null text is
    empty and has no spans; every input row and column is kept, repeated rows as they are. A column
    named secret_spans or starting with _tm_ is replaced.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    out = df.withColumn("_tm_t", t)
    for kind, pattern in BASE:
        out = out.withColumn(f"_tm_{kind}", F.regexp_extract_all("_tm_t", F.lit(pattern), F.lit(0)))
    out = out.withColumn("_tm_model", F.regexp_extract_all("_tm_t", F.lit(CANDIDATE), F.lit(0)))
    base = [_located(F.col("_tm_t"), F.col(f"_tm_{kind}"), pattern, k) for k, (kind, pattern) in enumerate(BASE)]
    base[0] = F.filter(base[0], lambda x: F.length(F.regexp_extract(x["m"], ASSIGN, 2)) >= 8)
    out = out.withColumn("_tm_base", F.concat(*base))
    hot = F.filter(_located(F.col("_tm_t"), F.col("_tm_model"), CANDIDATE, 3), lambda x: x["m"].rlike("[0-9]") & x["m"].rlike("[A-Za-z]"))
    out = out.withColumn("_tm_hot", hot)
    clear = _clear(F.col("_tm_base"), F.col("_tm_hot"))
    need = lambda x: F.greatest(F.lit(least * SCALE), F.length(x["m"]) * (least_per_char * SCALE))
    found = F.filter(clear, lambda x: log_ratio(x["m"], table) >= need(x))
    out = out.withColumn("secret_spans", F.array_sort(F.concat("_tm_base", found)))
    return out.drop("_tm_t", "_tm_base", "_tm_hot", "_tm_model", *[f"_tm_{k}" for k, _ in BASE])


def redact(df: DataFrame, *, text: str = "text", spans: str = "secret_spans", mark: str = "[SECRET]") -> DataFrame:
    """Replace every span of ``text`` by ``mark``; overlapping spans become one mark. Rows without spans are unchanged.

    The text is taken apart into characters once, and what stands between the spans is cut from that.
    """
    t, found = F.col(text), F.array_sort(F.col(spans))
    kind = found_type(df, spans)
    ends = _carried(found, F.lit(0), lambda c, x: F.greatest(c, x["e"]), lambda c, u: F.greatest(c, u), f"array<struct<c:int,x:{kind}>>")
    # What stands before each span that begins at or after the end of all before it; an overlapping one adds nothing.
    apart = lambda y: F.transform(F.filter(y["z"], lambda z: z["x"]["s"] >= z["c"]), lambda z: F.concat(F.array_join(F.slice(y["t"], z["c"] + 1, z["x"]["s"] - z["c"]), ""), F.lit(mark)))
    last = lambda y: F.array_join(F.slice(y["t"], F.aggregate(y["z"], F.lit(0), lambda c, z: F.greatest(c, z["x"]["e"])) + 1, F.size(y["t"])), "")
    whole = F.transform(F.array(F.struct(F.split(t, "").alias("t"), ends.alias("z"))), lambda y: F.concat(F.array_join(apart(y), ""), last(y)))
    return df.withColumn(text, F.when(F.size(F.col(spans)) > 0, F.get(whole, F.lit(0))).otherwise(t))


def found_type(df: DataFrame, spans: str) -> str:
    return df.schema[spans].dataType.elementType.simpleString()


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets. See ``scan``; an empty table gives no rows."""
    spans = scan(documents(spark, sf_dir).select("doc_id", "text"), train(labelled_samples(spark))).select("doc_id", "secret_spans")
    base = spans.withColumn("b", F.filter("secret_spans", lambda x: x["k"] < 3))
    n = lambda k: F.size(F.filter("b", lambda x: x["k"] == k)).cast("long")
    return base.select(
        "doc_id",
        n(0).alias("n_assign"),
        n(1).alias("n_access"),
        n(2).alias("n_hex"),
        F.sha2(_joined(F.col("b")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("secret_spans")).alias("spans"),
    )


def oracle(n: int = 4000, least_per_char: int = 350, least: int = 12000) -> str:
    """The same in SQL, training included."""
    q = lambda x: "'" + x.replace("'", "''") + "'"
    stems = "[" + ", ".join(map(q, STEMS)) + "]"
    draw = lambda k, m: f"(('0x' || substr(sha256(i || '-{k}'), 1, 8))::BIGINT % {m})"
    p = [f"({stems})[1 + {draw(k, len(STEMS))}]" for k in range(4)]
    title = lambda x: f"upper(substr({x}, 1, 1)) || substr({x}, 2)"
    number = f"{draw(4, 2100)}::VARCHAR"
    joined = "p0 || '_' || p1 || '_' || p2 || '_' || p3"
    kinds = " UNION ALL ".join(
        f"SELECT doc_id, {k} AS k, generate_subscripts(m, 1) AS i, unnest(m) AS m, unnest(g) AS g FROM (SELECT doc_id, regexp_extract_all(t, {q(x)}) AS m, list_slice(string_split_regex(t, {q(x)}), 1, len(regexp_extract_all(t, {q(x)}))) AS g FROM docs)"
        for k, x in enumerate((ASSIGN, ACCESS, HEX, CANDIDATE))
    )
    text = lambda some: f"coalesce(string_agg(['assign', 'access', 'hex', 'model'][k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k, e){some}, '')"
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
ids AS (SELECT i, sha256('sample' || i) AS h, replace(to_base64(unhex(sha256('sample' || i))), '=', '') AS b, {p[0]} AS p0, {p[1]} AS p1, {p[2]} AS p2, {p[3]} AS p3, {number} AS num FROM range({n}) r(i)),
samples AS (
  SELECT true AS random, CASE i % 4 WHEN 0 THEN substr(h, 1, 40) WHEN 1 THEN b WHEN 2 THEN regexp_replace(b, '[+/]', '', 'g') ELSE upper(regexp_replace(b, '[+/]', '', 'g')) END AS s FROM ids
  UNION ALL SELECT false, CASE i % 6 WHEN 0 THEN {joined} WHEN 1 THEN p0 || '-' || p1 || '-' || p2 || '-' || num WHEN 2 THEN p0 || {title("p1")} || {title("p2")} || {title("p3")}
    WHEN 3 THEN upper({joined}) WHEN 4 THEN p0 || '/' || p1 || '/' || p2 || '/' || num ELSE p0 || p1 || p2 || p3 END FROM ids),
coded AS (SELECT random, translate(s, {q(_FROM)}, {q(_TO)}) AS s FROM samples),
pairs AS (SELECT random, substr(s, p, 2) AS pair, count(*) AS n FROM (SELECT random, s, unnest(range(1, length(s))) AS p FROM coded) GROUP BY ALL),
chars AS (SELECT unnest(string_split({q(_CLASSES)}, '')) AS c),
smooth AS (SELECT r.random, a.c AS a, a.c || b.c AS pair, coalesce(n, 0) + 0.5::DOUBLE AS n FROM (VALUES (true), (false)) r(random), chars a, chars b LEFT JOIN pairs x ON x.random = r.random AND x.pair = a.c || b.c),
logs AS (SELECT random, pair, ln(n / sum(n) OVER (PARTITION BY random, a)) AS l FROM smooth),
ratios AS (SELECT pair, round({SCALE} * (max(l) FILTER (random) - max(l) FILTER (NOT random)))::INT AS v FROM logs GROUP BY pair),
found AS ({kinds}),
placed AS (SELECT doc_id, k, i, m, (sum(length(g) + length(m)) OVER (PARTITION BY doc_id, k ORDER BY i))::INT AS e FROM found),
spans AS (SELECT doc_id, k, m, e - length(m) AS s, e FROM placed),
base AS (SELECT * FROM spans WHERE k IN (1, 2) OR (k = 0 AND length(regexp_extract(m, {q(ASSIGN)}, 2)) >= 8)),
maybe AS (SELECT * FROM spans x WHERE k = 3 AND regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]') AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = x.doc_id AND b.s < x.e AND x.s < b.e)),
scored AS (SELECT doc_id, k, m, s, e, sum(coalesce(v, 0)) AS v FROM (SELECT *, unnest(range(1, length(m))) AS p FROM maybe) x LEFT JOIN ratios ON pair = substr(translate(m, {q(_FROM)}, {q(_TO)}), p, 2) GROUP BY ALL),
every AS (SELECT doc_id, k, s, e FROM base UNION ALL SELECT doc_id, k, s, e FROM scored WHERE v >= greatest({least}, {least_per_char} * length(m)))
SELECT d.doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
  sha256({text(" FILTER (k < 3)")}) AS base_sha256, {text("")} AS spans
FROM docs d LEFT JOIN every e ON e.doc_id = d.doc_id GROUP BY d.doc_id
"""
