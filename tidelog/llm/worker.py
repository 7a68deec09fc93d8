"""What a Python worker keeps between tasks: the tables of one operator at a time.

Spark uses its workers again for later stages, so what an operator has cached would stay beside
the caches of the next ones. An operator says which one it is before it works; what others keep
is then let go of, and freed memory goes back to the system.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa

_clear: dict[str, Callable[[], None]] = {}
_current: list[str] = []


def keeps(operator: str, clear: Callable[[], None]) -> None:
    """An operator's cache, and how to empty it."""
    _clear[operator] = clear


def enter(operator: str) -> None:
    """From here on this process works for operator."""
    if _current == [operator]:
        return
    if _current:
        for name, clear in _clear.items():
            if name != operator:
                clear()
        release()
    _current[:] = [operator]


def release() -> None:
    """Let go of what nothing refers to, and give its memory back."""
    gc.collect()
    trim()


def trim() -> None:
    """Give freed memory back to the system, as an idle worker may stay for long beside others' work."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass
