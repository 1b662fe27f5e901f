"""Keys: ordinals and their buckets, tuple ranges with NULL first, and bounds as JSON."""

from __future__ import annotations

import json
import re
from datetime import date, datetime
from decimal import Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = date(1970, 1, 1)


def ordinal(c: Column, kind: str) -> Column:
    """An integer key itself, or a date's days since 1970."""
    return c.cast("bigint") if kind == "int" else F.datediff(c, F.lit(EPOCH)).cast("bigint")


def bucket(ordinal_: Column, width: int) -> Column:
    """Floor division, also below zero."""
    w = F.lit(width).cast("bigint")
    return F.floor((ordinal_ - F.pmod(ordinal_, w)) / w).cast("bigint")


def bound(n: int, kind: str) -> int | str | None:
    """An ordinal as a bound: None above the type's maximum, clamped below its minimum."""
    if kind == "int":
        return n if n < 1 << 63 else None
    low, high = (date.min - EPOCH).days, (date.max - EPOCH).days
    if n > high:
        return None
    return date.fromordinal(EPOCH.toordinal() + max(n, low)).isoformat()


def bound_of(ordinal_: Column, kind: str) -> Column:
    """Column form of ``bound``: the ordinal itself, or its date as text; null above the type's maximum."""
    if kind == "int":
        return ordinal_.cast("bigint")
    low, high = (date.min - EPOCH).days, (date.max - EPOCH).days
    return F.when(ordinal_ <= high, F.date_format(F.date_add(F.lit(EPOCH), F.greatest(ordinal_, F.lit(low)).cast("int")), "yyyy-MM-dd"))


def at_least(keys: list[str], lo: tuple) -> Column:
    """(k1..kn) >= lo, NULL first, as disjoint prefixes that file statistics can use."""
    parts = []
    for i, (k, v) in enumerate(zip(keys, lo, strict=True)):
        same = [_is(F.col(a), b) for a, b in zip(keys[:i], lo[:i], strict=True)]
        last = i == len(keys) - 1
        above = (F.lit(True) if last else F.col(k).isNotNull()) if v is None else (F.col(k) >= v if last else F.col(k) > v)
        parts.append(reduce(lambda x, y: x & y, [*same, above]))
    return reduce(lambda x, y: x | y, parts)


def below(keys: list[str], hi: tuple) -> Column:
    """(k1..kn) < hi, NULL first."""
    parts = []
    for i, (k, v) in enumerate(zip(keys, hi, strict=True)):
        same = [_is(F.col(a), b) for a, b in zip(keys[:i], hi[:i], strict=True)]
        under = F.lit(False) if v is None else (F.col(k).isNull() | (F.col(k) < v))
        parts.append(reduce(lambda x, y: x & y, [*same, under]))
    return reduce(lambda x, y: x | y, parts)


def in_range(keys: list[str], lo: tuple | None, hi: tuple | None) -> Column:
    """lo <= key < hi; an end of None is open."""
    out = F.lit(True)
    if lo is not None:
        out = out & at_least(keys, lo)
    if hi is not None:
        out = out & below(keys, hi)
    return out


def _is(c: Column, v: Any) -> Column:
    return c.isNull() if v is None else c == F.lit(v)


def as_json(keys: list[str]) -> Column:
    """The key as a JSON object, nulls included."""
    return F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})


def bound_to_json(bound_: tuple | None) -> str | None:
    """A bound as JSON: a scalar for one key, a list for more; decimals, times and binaries as text."""
    if bound_ is None:
        return None

    def plain(v: Any) -> Any:
        if isinstance(v, bytes | bytearray):
            return "0x" + bytes(v).hex().upper()
        if isinstance(v, Decimal):
            return format(v, "f")
        return v.isoformat(sep=" ") if isinstance(v, datetime) else v.isoformat() if isinstance(v, date) else v

    values = [plain(v) for v in bound_]
    return json.dumps(values[0] if len(values) == 1 else values)


def bound_from_json(text: str | None) -> tuple | None:
    if text is None:
        return None
    v = json.loads(text)
    return tuple(v) if isinstance(v, list) else (v,)


def row_hash(columns: list[str]) -> Column:
    """SHA-256 of the row as JSON; nulls are left out, so a column added as null changes nothing."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def differing(columns: list[str], a: str, b: str) -> Column:
    """Names of the columns that differ between two structs, null-safe."""
    return F.concat_ws(", ", *[F.when(~F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")), F.lit(c)) for c in columns])


def identifier(name: str, what: str = "name") -> str:
    """A source name that can be put into a statement: not empty, no closing bracket, no control characters."""
    if not name or len(name) > 128 or "]" in name or any(ord(c) < 32 or ord(c) == 127 for c in name):
        raise ValueError(f"not a {what}: {name!r}")
    return name


def zone_name(name: str) -> str:
    """The name of a time zone, or a fixed offset: letters, digits and the few signs that occur in them."""
    if not re.fullmatch(r"[A-Za-z0-9_+\-/ .:()]{1,64}", name):
        raise ValueError(f"not a time zone: {name!r}")
    return name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
