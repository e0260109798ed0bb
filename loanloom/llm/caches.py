"""A Python worker outlives its stage; what one operator has cached in it should not burden the next."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

_clear: dict[str, Callable[[], None]] = {}


def using(name: str = "", clear: Callable[[], None] | None = None) -> None:
    """Called by a task at its start: keeps the named cache, empties all others, and hands freed
    memory back to the system where the C library can."""
    if clear is not None:
        _clear[name] = clear
    for other, empty in _clear.items():
        if other != name:
            empty()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass
