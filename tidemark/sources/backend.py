"""What a feed needs of a database: batches of rows and single values, over any DB-API connection."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from statistics import median
from typing import Any, Protocol

import pyarrow as pa

from ..functions.bounds import text_of

#: Bytes of a batch at most.
MOST_BYTES = 64 << 20


class Backend(Protocol):
    def batches(self, sql: str, params: tuple = (), batch_rows: int = 10_000) -> Iterator[list[tuple]]: ...
    def scalar(self, sql: str, params: tuple = ()) -> Any: ...
    def close(self) -> None: ...


def width(row: tuple) -> int:
    """About how many bytes a row takes."""
    return sum(len(v) if isinstance(v, str | bytes | bytearray) else 8 for v in row if v is not None) + 8


def next_size(last: int, most: int, widest: int, room: int = MOST_BYTES) -> int:
    """Rows of the next batch: twice the last, within ``most`` and within what rows of the widest seen leave room for."""
    return max(1, min(most, 2 * last, room // max(1, widest)))


class DbApiBackend:
    """Batches begin with one row and double while rows stay small. ``connect`` is called again after a lost connection; parameters go as text if ``text_params``."""

    def __init__(self, connect: Callable[[], Any], *, text_params: bool = False):
        self.connect, self.text_params, self._held = connect, text_params, None

    def _cursor(self):
        if self._held is None:
            self._held = self.connect()
        return self._held.cursor()

    def _params(self, params: tuple) -> tuple:
        return tuple(text_of(p) for p in params) if self.text_params else tuple(params)

    def batches(self, sql: str, params: tuple = (), batch_rows: int = 10_000) -> Iterator[list[tuple]]:
        cursor, size, widest = self._cursor(), 1, 1
        cursor.execute(sql, self._params(params))
        while rows := cursor.fetchmany(size):
            yield [tuple(r) for r in rows]
            widest = max(widest, *map(width, rows))
            size = next_size(size, batch_rows, widest)

    def arrow(self, sql: str, schema: pa.Schema, params: tuple = (), batch_rows: int = 10_000) -> Iterator[pa.RecordBatch]:
        """The same as Arrow, times in microseconds."""
        kinds = pa.schema([pa.field(f.name, pa.timestamp("us", f.type.tz)) if pa.types.is_timestamp(f.type) else f for f in schema])
        for rows in self.batches(sql, params, batch_rows):
            yield pa.RecordBatch.from_arrays([_column([r[i] for r in rows], f.type) for i, f in enumerate(kinds)], schema=kinds)

    def scalar(self, sql: str, params: tuple = ()) -> Any:
        cursor = self._cursor()
        cursor.execute(sql, self._params(params))
        row = cursor.fetchone()
        return row[0] if row else None

    def ping(self, samples: int = 5, sql: str = "SELECT 1") -> float:
        """Median milliseconds of a round trip."""
        took = []
        for _ in range(samples):
            began = time.perf_counter()
            self.scalar(sql)
            took.append(1000 * (time.perf_counter() - began))
        return round(median(took), 1)

    def reconnect(self) -> None:
        self.close()

    def close(self) -> None:
        if self._held is not None:
            held, self._held = self._held, None
            held.close()


def _column(values: list[Any], kind: pa.DataType) -> pa.Array:
    if pa.types.is_timestamp(kind) and any(isinstance(v, str) for v in values):
        return pa.array(values, pa.string()).cast(kind)
    return pa.array(values, kind)


def network_wait(before: float | None, after: float | None) -> int | None:
    """Milliseconds that a session waited for its client between two readings of its counter; unknown if one is, or if it was reset."""
    if before is None or after is None or after < before:
        return None
    return int(after - before)
