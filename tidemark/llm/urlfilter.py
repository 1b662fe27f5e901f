"""URL filters over a sorted digest array.

A rule list is stored as sorted 64-bit xxhash keys, their places, and the full strings. Workers
memory-map the arrays, probe them by vectorised binary search, and compare the stored string
before a hit counts, so a colliding digest changes nothing. The file travels with
``SparkContext.addFile``: every executor has its own copy and no folder need be shared.
"""

from __future__ import annotations

import hashlib
import os
import struct
import tempfile
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import with_fields

# The contract's rules, as (verdict, rule); a rule is host + path.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: The verdict where no stored key fits.
DEFAULT_VERDICT = "allow"
_MAGIC = b"TMDA"
_OPEN: dict[str, DigestArray] = {}
#: (application, name) of what this driver has shipped.
_SHIPPED: set[tuple[str, str]] = set()


class DigestArray:
    """A file of n sorted keys: magic, n, digests (n x u64), string ends (n + 1 x u64), the strings joined."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        magic, n = struct.unpack("<4sxxxxQ", raw[:16].tobytes())
        if magic != _MAGIC:
            raise ValueError(f"{path} is no digest array")
        self.digests = raw[16 : 16 + 8 * n].view("<u8")
        self.ends = raw[16 + 8 * n : 24 + 16 * n].view("<u8")
        self.strings = raw[24 + 16 * n :]

    @staticmethod
    def write(path: str, keys: Iterable[str]) -> str:
        """Store the distinct keys; any order, duplicates allowed, none at all too."""
        rows = sorted((xxhash.xxh64_intdigest(k), k) for k in {k.encode() for k in keys})
        with open(path, "wb") as f:
            f.write(struct.pack("<4sxxxxQ", _MAGIC, len(rows)))
            f.write(np.array([d for d, _ in rows], "<u8").tobytes())
            f.write(np.cumsum([0, *(len(k) for _, k in rows)]).astype("<u8").tobytes())
            f.write(b"".join(k for _, k in rows))
        return path

    def __len__(self) -> int:
        return len(self.digests)

    def key(self, i: int) -> bytes:
        return self.strings[int(self.ends[i]) : int(self.ends[i + 1])].tobytes()

    def probe(self, keys: list[bytes]) -> np.ndarray:
        """The place of each key, or -1. Equal digests stand together; each is compared in turn."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self) or not keys:
            return out
        want = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
        at = np.searchsorted(self.digests, want)
        for j in np.flatnonzero(self.digests[np.minimum(at, len(self) - 1)] == want).tolist():
            i = int(at[j])
            while i < len(self) and self.digests[i] == want[j]:
                if self.key(i) == keys[j]:
                    out[j] = i
                    break
                i += 1
        return out


def ship(spark: SparkSession, keys: Iterable[str]) -> str:
    """Write the array once, give it to every executor, and return the name to open it by."""
    keys = sorted(set(keys))
    name = f"digests-{hashlib.sha256(chr(10).join(keys).encode()).hexdigest()[:24]}.bin"
    sc = spark.sparkContext
    if (sc.applicationId, name) not in _SHIPPED:  # Spark refuses a second file of the name
        folder = tempfile.mkdtemp(prefix="tidemark-")
        sc.addFile(DigestArray.write(os.path.join(folder, name), keys))
        _SHIPPED.add((sc.applicationId, name))
    return name


def shipped(name: str) -> DigestArray:
    path = SparkFiles.get(name)
    if path not in _OPEN:
        _OPEN[path] = DigestArray(path)
    return _OPEN[path]


def host_and_path(url: F.Column) -> tuple[F.Column, F.Column]:
    """Host (A-Z lower-cased) and path after the first ``://``; both empty without one, or for null."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), upper, upper.lower())
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)?", 1)


def longest_rules(store: DigestArray, sizes: list[int], urls: list[tuple[str, str]], labels: int) -> list[str | None]:
    """The longest stored rule that fits each (host, path), or None.

    Candidate keys are the domain suffixes of the host, of as many labels as a rule has (``labels``)
    at most, joined with the path's prefix of every length that a rule has; equal pairs are probed
    once. So a host of a million labels costs no more than one of a few.
    """
    plans: dict[tuple[str, str], list[int]] = {}
    keys: dict[bytes, int] = {}
    wanted = []
    most = max(sizes, default=0)
    for host, path in urls:
        parts = host.rsplit(".", labels)
        pair = (".".join(parts[-labels:]), path[:most])
        if pair not in plans:
            parts, found = parts[-labels:], []
            for i in range(len(parts)):
                suffix = ".".join(parts[i:])
                found += [keys.setdefault((suffix + path[:n]).encode(), len(keys)) for n in sizes if n <= len(path)]
            plans[pair] = found
        wanted.append(pair)
    order = list(keys)
    hit = store.probe(order)
    best: dict[tuple[str, str], str | None] = {}
    for pair, found in plans.items():
        rules = [order[k].decode() for k in found if hit[k] >= 0]
        best[pair] = max(rules, key=lambda r: (len(r), r), default=None)
    return [best[p] for p in wanted]


def judge(df: DataFrame, rules: Iterable[tuple[str, str]], *, url: str = "url", default: str = DEFAULT_VERDICT) -> DataFrame:
    """Add host, path, rule and verdict; columns of these names are replaced.

    A rule (host + path) fits its host and all subdomains where the url's path starts with the
    rule's. The longest wins; without one, rule is null and the verdict is ``default``. Every row is
    kept, repeated ones too; a null url, or one without ``://``, has an empty host and path.
    """
    rules = list(rules)
    verdicts = {r: v for v, r in rules}
    sizes = sorted({len(r) - r.index("/") for _, r in rules})
    labels = max((r[: r.index("/")].count(".") + 1 for _, r in rules), default=1)
    name = ship(df.sparkSession, verdicts)
    host, path = host_and_path(F.col(url).cast("string"))
    out = df.drop("host", "path", "rule", "verdict").withColumns({"host": host, "path": path})
    schema = pa.schema([("rule", pa.string()), ("verdict", pa.string())])

    def run(batches):
        for batch in batches:
            pairs = list(zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True))
            found = longest_rules(shipped(name), sizes, pairs, labels)
            more = [pa.array(found, pa.string()), pa.array([verdicts.get(r, default) for r in found], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, *schema.names])

    fields = with_fields(out, rule="string", verdict="string")
    return out.mapInArrow(run, fields)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url. See ``judge``; an empty table gives no rows."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


OP6_SQL = r"""
WITH r(verdict, rule, rhost, rpath) AS (VALUES
  ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
  ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id,
  translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) AS path FROM u),
m AS (SELECT p.*, r.rule, r.verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(r.rule) DESC) AS n
  FROM p LEFT JOIN r ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE n = 1
"""
