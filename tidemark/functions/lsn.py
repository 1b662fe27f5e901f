"""Log positions: ``0x`` and twenty upper-case hexadecimal digits, so text order is log order.

Scalar helpers for the driver and column expressions for plans. Ten bytes exceed BIGINT, so
arithmetic goes through DECIMAL(38, 0) in two halves.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDTH = 20
ZERO = "0x" + "0" * WIDTH
MAX = (1 << 80) - 1
_HALF = 16**10


def normalize(value: str | bytes | bytearray) -> str:
    """Canonical text of ten bytes, or of hexadecimal text with or without prefix, in any case, however short."""
    if isinstance(value, bytes | bytearray):
        if len(value) != WIDTH // 2:
            raise ValueError(f"a position has {WIDTH // 2} bytes, not {len(value)}")
        return "0x" + bytes(value).hex().upper()
    digits = re.fullmatch(r"(?:0[xX])?([0-9A-Fa-f]{1,20})", value.strip())
    if not digits:
        raise ValueError(f"not a log position: {value!r}")
    return "0x" + digits[1].upper().rjust(WIDTH, "0")


def to_int(position: str) -> int:
    return int(normalize(position), 16)


def from_int(value: int) -> str:
    if not 0 <= value <= MAX:
        raise ValueError(f"a position is between 0 and 2**80 - 1, not {value}")
    return f"0x{value:020X}"


def after(position: str) -> str:
    return from_int(to_int(position) + 1)


def before(position: str) -> str:
    """The position before; zero has none and stays."""
    return from_int(max(0, to_int(position) - 1))


def normalized(c: Column) -> Column:
    """Column form of ``normalize`` for text; null where it is no position."""
    digits = F.regexp_extract(F.trim(c), r"^(?:0[xX])?([0-9A-Fa-f]{1,20})$", 1)
    return F.when(digits != "", F.concat(F.lit("0x"), F.lpad(F.upper(digits), WIDTH, "0")))


def as_number(c: Column) -> Column:
    """DECIMAL(38, 0) of a canonical position."""
    half = lambda start: F.conv(F.substr(c, F.lit(start), F.lit(10)), 16, 10).cast("decimal(38,0)")
    return (half(3) * F.lit(_HALF).cast("decimal(20,0)") + half(13)).cast("decimal(38,0)")


def from_number(c: Column) -> Column:
    """Canonical position of a whole number below 2**80."""
    n = c.cast("decimal(38,0)")
    base = F.lit(_HALF).cast("decimal(20,0)")
    low = F.pmod(n, base).cast("decimal(38,0)")
    high = ((n - low) / base).cast("decimal(38,0)")
    part = lambda x: F.lpad(F.hex(x.cast("long")), 10, "0")
    return F.concat(F.lit("0x"), part(high), part(low))


def shifted(c: Column, by: int) -> Column:
    """The position ``by`` further on (or back, not below zero)."""
    return from_number(F.greatest(as_number(c) + F.lit(by).cast("decimal(20,0)"), F.lit(0).cast("decimal(38,0)")))
