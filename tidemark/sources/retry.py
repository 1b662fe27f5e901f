"""Transient errors of a source are tried again; others, and those that stay, reach the caller."""

from __future__ import annotations

import functools
import random
import re
import time
from collections.abc import Callable
from typing import Any

# SQLSTATE classes and codes that pass, and what drivers say without one.
STATES = re.compile(r"\b(?:08[0-9A-Z]{3}|HYT0[01]|40001)\b")
TEXTS = ("connection reset", "connection refused", "broken pipe", "timed out", "deadlock victim", "communication link failure", "temporarily unavailable")
TRIES = 3


def transient(error: BaseException) -> bool:
    """Whether it, or what caused it, names a passing state."""
    seen: set[int] = set()
    e: BaseException | None = error
    while e is not None and id(e) not in seen:
        said = str(e)
        if STATES.search(said) or any(t in said.lower() for t in TEXTS) or isinstance(e, ConnectionError | TimeoutError):
            return True
        seen.add(id(e))
        e = e.__cause__ or e.__context__
    return False


def retrying(f: Callable[..., Any]) -> Callable[..., Any]:
    """Call again up to TRIES times after 1-2, 2-4 and 4-8 seconds. A method's object may have ``reconnect``, called before each new try."""

    @functools.wraps(f)
    def call(*args: Any, **kwargs: Any) -> Any:
        for i in range(TRIES + 1):
            try:
                return f(*args, **kwargs)
            except Exception as e:
                if i == TRIES or not transient(e):
                    raise
                pause(2**i * random.uniform(1, 2))
                if args and hasattr(args[0], "reconnect"):
                    args[0].reconnect()
        raise AssertionError

    return call


def pause(seconds: float) -> None:
    time.sleep(seconds)
