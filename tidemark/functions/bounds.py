"""Bounds of key ranges: as text for a source, as values of a key's type, and which keys can have them."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from .types import UnmappedType, spark_type

BIGINT_MAX = (1 << 63) - 1
#: Source types whose values do not come back from a bound as they were.
NEVER = {"time", "float", "real", "xml", "text", "ntext", "image", "timestamp", "rowversion"}
#: Source types of 100 ns steps: a microsecond bound can be off by a part of one, which only the last key of a range allows.
FINE = {"datetime2", "datetimeoffset"}


def text_of(value: Any, source_type: str = "") -> str | None:
    """A bound as the source reads it: milliseconds for datetime, microseconds for finer times, plain decimals, hexadecimal for bytes."""
    if value is None:
        return None
    if isinstance(value, datetime):
        return value.isoformat(sep=" ", timespec="milliseconds" if source_type.strip().lower() in ("datetime", "smalldatetime") else "microseconds")
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, Decimal):
        return format(value, "f")
    if isinstance(value, bytes | bytearray):
        return "0x" + bytes(value).hex().upper()
    return str(value)


def coerce(value: Any, kind: str, *, lower: bool) -> Any:
    """A stored bound (of JSON) as a value of the Spark type ``kind``; None is open.

    A whole number above BIGINT's greatest is open. A date takes the first ten characters. Of a time
    with digits below the microsecond a lower bound moves up to the next microsecond, and an upper
    one is cut: the range then holds the same keys.
    """
    if value is None:
        return None
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return None if int(value) > BIGINT_MAX else int(value)
    if kind == "date":
        return date.fromisoformat(str(value)[:10])
    if kind in ("timestamp", "timestamp_ntz"):
        whole, _, part = str(value).replace("T", " ").partition(".")
        at = datetime.fromisoformat(whole + "." + part[:6].ljust(6, "0"))
        return at + timedelta(microseconds=1) if lower and part[6:].strip("0") else at
    if kind.startswith("decimal"):
        return Decimal(str(value))
    if kind == "binary":
        return bytes.fromhex(str(value).removeprefix("0x"))
    return value


def coerced(value: Column, *, lower: bool) -> Column:
    """Column form of ``coerce`` for times: text with any number of digits as a TIMESTAMP_NTZ bound."""
    whole = F.regexp_extract(value, r"^([^.]*)", 1)
    part = F.regexp_extract(value, r"\.(\d*)$", 1)
    at = F.to_timestamp_ntz(F.concat(F.translate(whole, "T", " "), F.lit("."), F.rpad(F.substr(part, F.lit(1), F.lit(6)), 6, "0")), F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS"))
    if not lower:
        return at
    return F.when(F.substr(part, F.lit(7), F.lit(20)).rlike("[1-9]"), at + F.expr("INTERVAL 0.000001 SECOND")).otherwise(at)


def text(value: Column, source_type: str = "") -> Column:
    """Column form of ``text_of`` for times."""
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSS" if source_type.strip().lower() in ("datetime", "smalldatetime") else "yyyy-MM-dd HH:mm:ss.SSSSSS")


def bound_types(keys: list[tuple[str, str, str | None]]) -> list[str] | None:
    """How each key (name, source type, collation) is cast in a bound, or None if one can't have bounds.

    Times of 100 ns steps are allowed for the last key alone; text carries its collation, in whose order the source compares.
    """
    out = []
    for i, (_, source, collation) in enumerate(keys):
        name = source.strip().lower()
        bare = name.partition("(")[0]
        if bare in NEVER or (bare in FINE and i < len(keys) - 1):
            return None
        try:
            spark_type(bare)
        except UnmappedType:
            return None
        out.append(f"{name} COLLATE {collation}" if collation and "char" in bare else name)
    return out
