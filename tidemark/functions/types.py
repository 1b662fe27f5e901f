"""Source types as Spark types, and which type can take another's values."""

from __future__ import annotations

import re

# How the source's types are read.
SPARK_TYPES = {
    "bit": "boolean", "tinyint": "smallint", "smallint": "smallint", "int": "int", "bigint": "bigint",
    "real": "float", "float": "double", "money": "decimal(19,4)", "smallmoney": "decimal(10,4)",
    "date": "date", "datetime": "timestamp_ntz", "datetime2": "timestamp_ntz", "smalldatetime": "timestamp_ntz",
    "datetimeoffset": "timestamp", "time": "string", "char": "string", "varchar": "string", "nchar": "string",
    "nvarchar": "string", "text": "string", "ntext": "string", "xml": "string", "uniqueidentifier": "string",
    "binary": "binary", "varbinary": "binary", "image": "binary", "timestamp": "binary", "rowversion": "binary",
}
#: Whole-number digits that a DECIMAL needs for every value of an integer type.
_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}
_RANK = {"tinyint": 0, "smallint": 1, "int": 2, "bigint": 3}


class UnmappedType(ValueError):
    pass


def spark_type(source: str, precision: int | None = None, scale: int | None = None) -> str:
    """Spark type of a source type; an unmapped one is an error unless the caller declares columns."""
    name = source.strip().lower()
    if name in ("decimal", "numeric"):
        return f"decimal({precision or 18},{scale or 0})"
    if name not in SPARK_TYPES:
        raise UnmappedType(f"source type {source!r} has no Spark type; declare the columns")
    return SPARK_TYPES[name]


def _clean(t: str) -> str:
    return re.sub(r"\s", "", t.lower()).replace("integer", "int")


def _decimal(t: str) -> tuple[int, int] | None:
    m = re.fullmatch(r"(?:decimal|numeric)\((\d+)(?:,(\d+))?\)", t)
    return (int(m[1]), int(m[2] or 0)) if m else None


def fits(value: str, into: str) -> bool:
    """Whether a column of type ``into`` holds every value of type ``value`` exactly."""
    a, b = _clean(value), _clean(into)
    if a == b:
        return True
    if a in _RANK and b in _RANK:
        return _RANK[a] <= _RANK[b]
    if b == "double":
        return a in ("tinyint", "smallint", "int", "float")
    if (a, b) == ("date", "timestamp_ntz"):
        return True
    if room := _decimal(b):
        whole = room[0] - room[1]
        if a in _DIGITS:
            return whole >= _DIGITS[a]
        if own := _decimal(a):
            return own[1] <= room[1] and own[0] - own[1] <= whole
    return False


def union_schema(older: list[tuple[str, str]], newer: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Columns of both, the older's order and spelling first; the newer's type where it holds the older's, else an error."""
    later = {n.lower(): t for n, t in newer}
    out = []
    for name, kind in older:
        new = later.pop(name.lower(), kind)
        if not fits(kind, new):
            raise SchemaChanged(f"column {name!r} changed from {kind} to {new}, which does not hold its values")
        out.append((name, new))
    return out + [(n, t) for n, t in newer if n.lower() in later]


class SchemaChanged(Exception):
    """The source's columns changed in a way that no read can follow."""


class DataLoss(Exception):
    """Changes were purged before they were read."""


def is_kind(error: BaseException, kind: type) -> bool:
    """Whether ``error`` is, wraps or (through Spark's wrapper) names an error of ``kind``."""
    seen: set[int] = set()
    e: BaseException | None = error
    while e is not None and id(e) not in seen:
        if isinstance(e, kind) or f"{kind.__module__}.{kind.__name__}" in str(e):
            return True
        seen.add(id(e))
        e = e.__cause__ or e.__context__
    return False


def data_type(name: str):
    """Spark type of a simple name; needs no session, so data sources can use it."""
    from pyspark.sql import types as T

    plain = {
        "boolean": T.BooleanType, "tinyint": T.ByteType, "smallint": T.ShortType, "int": T.IntegerType, "integer": T.IntegerType, "bigint": T.LongType,
        "float": T.FloatType, "double": T.DoubleType, "string": T.StringType, "binary": T.BinaryType, "date": T.DateType,
        "timestamp": T.TimestampType, "timestamp_ntz": T.TimestampNTZType,
    }
    t = _clean(name)
    if d := _decimal(t):
        return T.DecimalType(*d)
    if t not in plain:
        raise UnmappedType(f"no Spark type is called {name!r}")
    return plain[t]()


def columns_of(ddl: str) -> list[tuple[str, str]]:
    """(name, type) of a column list; names may be quoted with backticks, and commas inside brackets don't divide."""
    out, depth, quoted, part = [], 0, False, ""
    for ch in ddl + ",":
        quoted ^= ch == "`"
        depth += (ch == "(") - (ch == ")") if not quoted else 0
        if ch == "," and not depth and not quoted:
            m = re.fullmatch(r"\s*(?:`((?:[^`]|``)+)`|(\w+))\s+(.+?)\s*", part)
            if not m:
                raise ValueError(f"not a column: {part.strip()!r}")
            out.append(((m[1] or m[2]).replace("``", "`"), m[3]))
            part = ""
        else:
            part += ch
    return out


def struct_of(ddl: str):
    from pyspark.sql import types as T

    return T.StructType([T.StructField(n, data_type(t)) for n, t in columns_of(ddl)])


def from_rows(spark, rows: list[tuple], schema):
    """A DataFrame of a few rows of the driver. They travel as Arrow, which needs no Python worker, and are one task, so that written they are one file."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(schema)
    columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(kinds)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=kinds), schema).coalesce(1)
